"""Operators that shuffle: near-dedup, url classes, sharding, neighbours, against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tests.compare import compare
from tests.llm.fixtures import DOC_SCHEMA, clashing, odd_documents, prose
from visfold.llm import kd_sharding as KD
from visfold.llm import nn_descent as NN
from visfold.llm import pigeonring_simhash as PS
from visfold.llm import queries as Q
from visfold.llm.components import connected_components
from visfold.llm.url_aliases import judge_urls

ODD = odd_documents()


@pytest.fixture(scope="module")
def docs(spark):
    return clashing(spark.createDataFrame(ODD, DOC_SCHEMA)).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


class Classes:
    """Union-find for the brute-force versions."""

    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


# -------------------------------------------------------------------- components

@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(1, 2), (2, 3), (3, 1)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 200)],
    [(k, 1000) for k in range(200)], [(None, 1), (2, None), (5, 4)]])
def test_components(spark, edges):
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    c = Classes()
    for a, b in edges:
        if a is not None and b is not None and a != b:
            c.link(a, b)
    assert got == {x: c.root(x) for x in c.up}


def test_components_of_random_strings(spark):
    r = random.Random(3)
    edges = [(f"n{r.randrange(300)}", f"n{r.randrange(300)}") for _ in range(220)]
    c = Classes()
    for a, b in edges:
        if a != b:
            c.link(a, b)
    got = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {x: c.root(x) for x in c.up}


# -------------------------------------------------------------------- near-dedup

def brute_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(rows, distance=3):
    """(doc_id, fingerprint) rows -> component id of each fingerprint."""
    fps = sorted({f for _, f in rows})
    c = Classes()
    for i, a in enumerate(fps):
        c.root(a)
        for b in fps[:i]:
            if (a ^ b).bit_count() <= distance:
                c.link(a, b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[c.root(f)] = min(least.get(c.root(f), d), d)
    return {f: least.get(c.root(f)) for f in fps}


def test_near_duplicates_equal_brute_force(docs, empty):
    sketch = [(d, brute_fingerprint(t or "")) for d, t, *_ in ODD]
    component = brute_components(sketch)
    got = Counter((r["doc_id"], r["fingerprint"] % 2 ** 64, r["component_id"]) for r in PS.near_duplicates(docs).collect())
    assert got == Counter((d, f, component[f]) for d, f in sketch)
    assert PS.near_duplicates(empty).count() == 0


def test_query_equals_brute_force(spark):
    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    sketch = [(r["doc_id"], brute_fingerprint(r["text"])) for r in texts]
    component = brute_components(sketch)
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in queries()["op9_pigeonring_simhash"](spark, sf).collect()}
    assert got == {(d, f"{f:016x}", component[f]) for d, f in sketch}


@pytest.mark.parametrize("group", [PS.GROUP, 40])
def test_links_within_dense_and_sparse_groups(spark, group):
    """With small groups the dense ones are dealt anew; the classes stay the same."""
    r = random.Random(5)
    fps = {r.getrandbits(64) for _ in range(300)}
    for centre in [r.getrandbits(64) for _ in range(3)]:
        for _ in range(60):
            f = centre
            for _ in range(r.randint(0, 4)):
                f ^= 1 << r.randrange(64)
            fps.add(f)
    rows = spark.createDataFrame([(f - 2 ** 64 if f >= 2 ** 63 else f,) for f in fps], "fp bigint")
    c = Classes()
    for a in fps:
        c.root(a)
    for x in PS.fingerprint_links(rows, group=group).collect():
        a, b = x["a"] % 2 ** 64, x["b"] % 2 ** 64
        assert (a ^ b).bit_count() <= 3
        c.link(a, b)
    want = Classes()
    ordered = sorted(fps)
    for i, a in enumerate(ordered):
        want.root(a)
        for b in ordered[:i]:
            if (a ^ b).bit_count() <= 3:
                want.link(a, b)
    assert {f: c.root(f) for f in fps} == {f: want.root(f) for f in fps}


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 5])
def test_every_close_pair_meets(distance):
    r = random.Random(distance)
    budgets, masks = PS.chain_budgets(distance), PS.chain_masks(distance)
    for _ in range(500):
        x = 0
        for b in r.sample(range(64), distance):
            x |= 1 << b
        assert any(not x & m and PS.linked(np.array([x], np.uint64), np.uint64(s), budgets)[0] for s, m in masks)


def test_streamed_groups_may_span_batches():
    fps = np.arange(40, dtype=np.uint64)  # all within 6 bits of one another
    key = np.repeat(np.array([16, 32, 48], np.uint64), [3, 30, 7])
    mask = np.full(40, 1, np.uint64)
    for cut in (1, 2, 7, 40):
        batches = [PS._batch(key[i:i + cut], mask[i:i + cut], fps[i:i + cut]) for i in range(0, 40, cut)]
        out = pa.Table.from_batches(list(PS._links(iter(batches), 10, 10)), batches[0].schema).to_pydict()
        large = [f for f, m in zip(out["fp"], out["mask"]) if m]
        assert sorted(x % 2 ** 64 for x in large) == fps[3:33].tolist()
        assert sum(m == 0 for m in out["mask"]) == 2 + 6  # a spanning tree of each other group


def test_one_per_group(docs, empty):
    kept = PS.one_per_group(docs)
    assert kept.columns == docs.columns
    sketch = [(d, brute_fingerprint(t or "")) for d, t, *_ in ODD]
    component = brute_components(sketch)
    rows = kept.collect()
    # one row of every component, with the smallest doc_id in it
    label = {f: min(g for g in component if PS_linked(sketch, f, g)) for f in component}
    of_row = [label[brute_fingerprint(r["text"] or "")] for r in rows]
    assert sorted(of_row) == sorted(set(label.values()))
    for r, c in zip(rows, of_row):
        ids = [d for d, f in sketch if label[f] == c and d is not None]
        assert r["doc_id"] == min(ids, default=None)
    assert PS.one_per_group(empty).count() == 0


def PS_linked(sketch, f, g):
    """Are two fingerprints in one class?"""
    c = Classes()
    fps = sorted({x for _, x in sketch})
    for i, a in enumerate(fps):
        c.root(a)
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                c.link(a, b)
    return c.root(f) == c.root(g)


def test_one_per_group_loses_no_text(spark):
    """Ids that repeat with other texts, rows without an id, and copies of either."""
    from tests.llm.fixtures import DOC_SCHEMA, prose

    a, b, c, d, e, f = (prose(900 + k) for k in range(6))
    rows = [(1, a), (1, b), (2, b), (3, c), (3, d), (4, d), (None, e), (None, e), (None, f), (9, f), (1, a), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(rows)], DOC_SCHEMA).repartition(4)
    kept = [(r["doc_id"], r["text"] or "") for r in PS.one_per_group(docs).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (1, b), (3, c), (3, d), (None, e), (9, f), (None, "")], key=str)


# --------------------------------------------------------------------------- urls

PAGES = [
    (1, "http://a.example.org/en/7", None), (2, "https://www.shop.net/x", '<link rel="canonical" href="http://example.org/es/1">'),
    (3, "http://shop.net/x/", ""), (4, "http://shop.net/y", "<LINK HREF='/z' rel=canonical>"), (5, "http://shop.net/z", "plain"),
    (6, "http://m.net/1", '<meta http-equiv="refresh" content="0; url=http://b.com/de/3?a=1&amp;b=2">'),
    (7, "http://n.net/1", '<link rel="canonical" href="http://m.net/1"><link rel=canonical href="http://c.com/fr/2">'),
    (8, None, "<link rel=canonical href=http://b.com/de/3>"), (9, "no scheme/at/all", None), (10, "", None), (11, "HTTP://EXAMPLE.org/ES/1", None),
    (12, "http://example.org/es/9?q#f", None), (13, "http://Example.ORG/en/12", None), (14, "http://com/de/", None), (15, "http://x.com", None),
    (16, "http://notcom/de/1", None), (17, "ftp://b.com/de/3?b=2#t", None), (None, "http://x.org/", None), (2, "https://www.shop.net/x", None),
    (18, "http://k.net/p?utm_source=f", None), (19, "http://k.net/p", '<link rel="canonical" href="//b.com/de/k">'), (20, "a://" + "x." * 3000 + "com/de/", None)]


def url_rules(spark):
    return spark.createDataFrame(Q.URL_RULES, "host string, path string, allow boolean")


def test_urls(spark):
    pages = clashing(spark.createDataFrame(PAGES, "page_id bigint, url string, html string"))
    got = Counter((r["page_id"], r["rule"], r["verdict"]) for r in judge_urls(pages, url_rules(spark)).collect())
    want = [(1, "org/", "allow"), (2, None, "block"), (2, None, "block"), (3, None, "block"), (4, None, "allow"), (5, None, "allow"),
            (6, None, "allow"), (7, None, "allow"), (8, None, "allow"), (9, None, "allow"), (10, None, "allow"), (11, "org/", "allow"),
            (12, "example.org/es/", "block"), (13, "example.org/en/1", "block"), (14, "com/de/", "block"), (15, None, "allow"),
            (16, None, "allow"), (17, "com/de/", "block"), (None, "org/", "allow"), (18, None, "block"), (19, None, "block"), (20, "com/de/", "block")]
    assert got == Counter(want)
    assert judge_urls(pages.limit(0), url_rules(spark)).count() == 0
    none = judge_urls(pages, url_rules(spark).limit(0)).collect()
    assert {r["verdict"] for r in none} == {"allow"} and {r["rule"] for r in none} == {None}


def test_url_query_equals_its_sql_with_aliases(spark, tmp_path):
    import duckdb

    spark.createDataFrame([p for p in PAGES if p[0] is not None], "page_id bigint, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert compare(Q.QUERIES["op1_url_aliases"](spark, str(tmp_path)), con, Q.ORACLE["op1_url_aliases"]) is None


RELATIVE = [("http://a.net/x/y/p.html", t) for t in
            ["q.html", "../q.html", "../../../q.html", "./q.html?k=1", "?id=2", "/r/../s/./t.html", "..", ".", "z/../", "/", "//b.net/c", "http://c.net/../d", "u/v#w"]]
RELATIVE += [("http://a.net", "q.html"), ("http://a.net/x?y=1#z", "?y=2"), ("http://a.net/x/", "q.html")]


def test_relative_targets_resolve_as_in_urllib(spark):
    from urllib.parse import urljoin

    from pyspark.sql import functions as F

    from visfold.llm.url_aliases import resolved

    odd = [("http://a.net/x", t) for t in ("#top", "mailto:me@a.net", "javascript:go()")] + [("no scheme", "q.html"), ("", "?id=1")]
    df = spark.createDataFrame(RELATIVE + odd, "url string, target string")
    got = {(r["url"], r["target"]): r["full"] for r in df.select("url", "target", resolved(F.col("target"), F.col("url")).alias("full")).collect()}
    assert {k: got[k] for k in odd} == dict.fromkeys(odd)
    for url, target in RELATIVE:
        assert got[url, target] == ("http://c.net/../d" if target == "http://c.net/../d" else urljoin(url, target)), (url, target)


def linked_pages():
    def link(target, rel='rel="canonical"'):
        return f'<html><head><link {rel} href="{target}"></head></html>'

    return [(1, "http://k.net/a/one.html", link("../es/1.html")), (2, "http://k.example.org/es/../a", link("?p=1")),
            (3, "http://m.com/a/2", link("../de/7", "class=x rel='alternate canonical'")), (4, "http://n.net/1", link("http://m.com/a/2", "rel=canonical")),
            (5, "http://n.net/2", link("http://m.com/a/2", 'rel="non-canonical"')), (6, "http://n.net/3", link("http://m.com/de/1", 'data-rel="canonical"')),
            (7, "http://w.de.com/a/b", '<meta http-equiv="refresh" content="0; URL=/de/x">'), (8, "http://w.de.com/a/c", '<meta content="3;url=b" http-equiv=Refresh>'),
            (9, "http://n.net/4", link("mailto:a@b.com")), (10, "http://n.net/5", link("#here")), (11, "http://n.net/6", link("")), (12, None, link("q")),
            (13, "plain", link("q")), (14, "http://n.net/7", None)]


def test_relative_aliases_pass_on_decisions(spark, tmp_path):
    import duckdb

    spark.createDataFrame(linked_pages(), "page_id bigint, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    found = {r["page_id"]: r["verdict"] for r in Q.QUERIES["op1_url_aliases"](spark, str(tmp_path)).collect()}
    assert {k for k, v in found.items() if v == "block"} == {2, 3, 4, 7, 8}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert compare(Q.QUERIES["op1_url_aliases"](spark, str(tmp_path)), con, Q.ORACLE["op1_url_aliases"]) is None


def test_aliases_given_as_a_table(spark):
    pages = spark.createDataFrame([(1, "http://q.net/1", None), (2, "http://r.net/1", None)], "page_id bigint, url string, html string")
    aliases = spark.createDataFrame([("http://q.net/1", "http://example.org/es/4"), ("http://r.net/1", "http://q.net/1"), (None, "x")], "url string, target string")
    assert {r["page_id"]: r["verdict"] for r in judge_urls(pages, url_rules(spark), aliases).collect()} == {1: "block", 2: "block"}


# ----------------------------------------------------------------------- sharding

def check_shards(rows, want, shards, slack):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots, sizes = {}, Counter()
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    mean = sum(sizes.values()) / shards
    assert all(abs(sizes[k] - mean) <= slack for k in range(shards)), sizes


def test_shards_of_odd_documents(docs, empty):
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in ODD)
    rows = KD.shard_documents(docs, 4).collect()
    check_shards(rows, want, 4, 2 * max(w[1] for w in want))
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
    assert KD.shard_documents(empty, 4).count() == 0


def test_a_third_of_all_rows_alike_is_cut(spark):
    rows = [(k, prose(k, 30), "en", "s", None) for k in range(400)] + [(7, "the same text again", "en", "s", None)] * 600
    want = Counter((d, len(t.encode()) + 16, zlib.crc32(t.encode())) for d, t, *_ in rows)
    got = KD.shard_documents(spark.createDataFrame(rows, DOC_SCHEMA).repartition(5), 8).collect()
    check_shards(got, want, 8, 3 * max(w[1] for w in want))


def test_cuts_are_weighted_medians(spark):
    """The first cut, by brute force: the widest dimension, at the place nearest half of the bytes."""
    r = random.Random(2)
    data = [(r.randint(20, 60), r.random(), r.random() ** 3, k) for k in range(2000)]
    rows = spark.createDataFrame(data, "size bigint, d0 double, d1 double, tie bigint")
    keyed = KD.with_keys(rows, ["d0", "d1"])
    tree = KD.kd_tree(keyed, ["d0", "d1"], 2)
    keys = sorted((x[f"d{tree.dimension}"], x["size"]) for x in keyed.collect())
    left = sum(s for k, s in keys if k < tree.at)
    assert abs(left - sum(s for _, s in keys) / 2) <= 60


# --------------------------------------------------------------------- neighbours

def brute_neighbours(rows, k):
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    ids, x = np.array([g[0] for g in good]), np.stack([g[1] for g in good])
    out = {}
    for i, v in good:
        if i % 20 == 0:
            s = x @ v
            order = [j for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), s[j]) for j in order]
    return out


def recall_of(found, want):
    hit = total = 0
    for q, best in want.items():
        least = min((s for _, s in best), default=0)
        mine = found.get(q, [])
        assert len(mine) == len(best) and [r for r, _, _ in mine] == list(range(1, len(best) + 1))
        hit += sum(s >= least - 1e-9 for _, _, s in mine)
        total += len(best)
    return hit / total


def search(spark, rows, k=20, **more):
    from pyspark.sql import functions as F

    df = clashing(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    out = {}
    for r in NN.nearest_neighbours(df, F.col("id") % 20 == 0, k, **more).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def floats(x):
    return np.asarray(x, np.float32).astype(float).tolist()


def test_neighbours_of_odd_vectors(spark):
    r = np.random.default_rng(4)
    rows = [(k, floats(r.normal(size=8) * (3 if k % 7 == 0 else 1))) for k in range(300)]
    rows += [(300, None), (301, [0.0] * 8), (302, [float("nan")] + [1.0] * 7), (303, [float("inf")] + [1.0] * 7), (304, [None] + [1.0] * 7), (305, []),
             (306, [1.0, 2.0]), (None, floats(r.normal(size=8)))]
    rows += [(k, rows[40][1]) for k in range(400, 460)]  # a group of equal vectors, three of them queries
    want = brute_neighbours([x for x in rows if x[0] != 306], 20)
    found = search(spark, rows)
    assert set(found) == set(want)
    assert recall_of(found, want) >= 0.99
    for q, best in want.items():  # equal scores in order of the ids
        assert [v for _, v, _ in found[q]] == [v for v, _ in best] or recall_of({q: found[q]}, {q: best}) < 1
    assert search(spark, rows[:1]) == {} and search(spark, []) == {}
    few = search(spark, rows[:5])
    assert [v for _, v, _ in few[0]] == [v for v, _ in brute_neighbours(rows[:5], 20)[0]]


def test_recall_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(NN, "BLOCK", 300)
    r = np.random.default_rng(6)
    x = r.normal(size=(2400, 24))
    x[:800] = x[0] + 0.05 * r.normal(size=(800, 24))  # a third of all rows lies close together
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(k, floats(v)) for k, v in enumerate(x)]
    assert recall_of(search(spark, rows), brute_neighbours(rows, 20)) >= 0.9


def third_close(r, n, dim, spread):
    """Unit vectors, the first third of them distinct and within about ``spread`` of one another."""
    x = r.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[:n // 3] = x[0] + spread / dim ** 0.5 * r.normal(size=(n // 3, dim))
    return x / np.linalg.norm(x, axis=1)[:, None]


def test_search_ranks_nearly_equal_vectors(spark):
    """One block, so the graph is exact and only the search's own precision counts."""
    rows = [(k, floats(v)) for k, v in enumerate(third_close(np.random.default_rng(7), 3000, 64, 0.005))]
    assert recall_of(search(spark, rows), brute_neighbours(rows, 20)) >= 0.99


@pytest.mark.parametrize("spread, longest", [(0.02, 1), (0.005, 1), (2, 40), (0.02, 40)])
def test_local_joins_tell_the_nearest(spread, longest):
    """64 nodes linked with one: all are told their nearest among them, beside one long vector and in a tight group."""
    x = third_close(np.random.default_rng(8), 900, 64, spread)[:300]
    x[-1] *= longest
    block = pa.table({"block": pa.array([0] * 300), "id": pa.array(range(300)), "embedding": pa.array(x.tolist())})
    top = float(np.linalg.norm(x, axis=1).max())
    state = NN._start_block(block, top, 1, 300)
    none = pa.array([b""] * 300, pa.binary())
    state = state.set_column(state.column_names.index("sim"), "sim", none)
    links = pa.table({"block": [0] * 64, "node": list(range(1, 65)), "other": [0] * 64, "fresh": [1] * 64})
    told = NN._local_join(NN._send((), state, links))
    node, near, sim = NN._all(told, "node", np.int64), NN._all(told, "near", np.int64), NN._all(told, "sim", np.float32)
    full = np.hstack([x, np.sqrt(np.maximum(0, top * top - (x * x).sum(axis=1)))[:, None]])[1:65]
    apart = ((full[:, None] - full[None]) ** 2).sum(axis=2) / 2
    np.fill_diagonal(apart, np.inf)
    want = {(a + 1, int(b) + 1) for a in range(64) for b in np.argsort(apart[a])[:NN.TOLD_EACH]}
    assert len(set(zip(node.tolist(), near.tolist())) & want) >= 0.98 * len(want)
    assert np.allclose(-sim, apart[node - 1, near - 1], rtol=1e-3)


def test_bounds_are_told_and_not_reached(spark, monkeypatch):
    import warnings

    monkeypatch.setattr(NN, "BLOCK", 100)
    rows = [(k, floats(v)) for k, v in enumerate(np.random.default_rng(9).normal(size=(400, 16)))]
    with pytest.warns(RuntimeWarning, match="unfinished after 1 iterations"):
        search(spark, rows, iterations=1)
    with warnings.catch_warnings():
        warnings.simplefilter("error", RuntimeWarning)
        search(spark, rows)


def test_parts_give_the_same_neighbours_and_leave_only_the_answers(spark, monkeypatch):
    """However little may be under way at a time; superseded tables go, and so do shuffle files."""
    import glob

    from visfold.llm import common as CM
    from visfold.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    monkeypatch.setattr(NN, "BLOCK", 100)
    monkeypatch.setattr(NN, "CHANGED", 0.5)
    rows = [(k, floats(v)) for k, v in enumerate(np.random.default_rng(10).normal(size=(200, 12)))]
    assert NN._parts_of(3 * NN.FLIGHT, 1, 8) == 3
    whole = search(spark, rows)
    monkeypatch.setattr(NN, "_parts_of", lambda *a: 2)
    before, switch = set(glob.glob(f"{folder}/stored-*")), spark.conf.get(CM._CLEANUP)
    assert search(spark, rows) == whole
    assert spark.conf.get(CM._CLEANUP) == switch
    assert len(set(glob.glob(f"{folder}/stored-*")) - before) == 1
