"""Token alignment and spelling variants against brute force, with every odd case."""

import random
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.fixtures import DOC_SCHEMA, clashing, odd_documents, prose
from visfold.llm import gram_variants as GV
from visfold.llm import token_alignment as TA
from visfold.llm.queries import byte_vocabulary, vocabulary

ODD = odd_documents() + [(300, "▁ a ▁▁ token", "en", "s", None), (301, "  two  spaces   three \n\n\t tab", "en", "s", None),
                         (302, "ｆｕｌｌ ﬁ ² width <|endoftext|>", "en", "s", None), (303, "\x00 zero <0x41> <unk> </s>", "en", "s", None),
                         (304, "日" * 3000 + "🎉" * 500, "ja", "s", None), (305, "-" * 5000 + " " * 3000, "xx", "s", None)]
A, PIECES = byte_vocabulary(), vocabulary("piece_bpe_32k.model")
ALIGN = {"bytes_path": A["path"], "ranks": A["ranks"], "pattern": A["pattern"], "pieces_path": PIECES}


@pytest.fixture(scope="module")
def docs(spark):
    return clashing(spark.createDataFrame(ODD, DOC_SCHEMA)).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


# ----------------------------------------------------------------- token alignment

EXACT = Tokenizer.from_file(A["path"])
EXACT.encode_special_tokens = True
SP = sentencepiece.SentencePieceProcessor(model_file=PIECES)
LETTERS = {c: bytes([b]) for c, b in TA.byte_alphabet().items()}


def plain_groups(text):
    """Groups as lists of ids, from the libraries and sets of ends."""
    if not text:
        return []
    a, b = EXACT.encode(" " + text, add_special_tokens=False), SP.encode(text)
    a_bytes = [b"".join(LETTERS[c] for c in t) for t in a.tokens]
    b_bytes = []
    for i in b:
        p = SP.id_to_piece(i)
        b_bytes.append(bytes([int(p[3:5], 16)]) if SP.is_byte(i) else p.replace("▁", " ").encode())
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return []
    a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
    out, i, j, ids = [], 0, 0, a.ids
    for end in sorted(set(a_ends) & set(b_ends)):
        ni, nj = a_ends.index(end, i) + 1, b_ends.index(end, j) + 1
        out.append((ids[i:ni], list(b[j:nj])))
        i, j = ni, nj
    return out


def spell(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def plain_alignment(rows):
    groups = [plain_groups(r[1]) for r in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    counts = Counter(p for doc in links for p in doc)
    highest = defaultdict(int)
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    return Counter((r[0], sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(l.values()),
                    sum(n for p, n in l.items() if counts[p] == highest[p[0]]), sum(n * counts[p] for p, n in l.items()),
                    sha256(spell(g).encode()).hexdigest() if g else "") for r, g, l in zip(rows, groups, links))


@pytest.mark.parametrize("block_bytes", [TA.BLOCK_BYTES, 500])
def test_alignment_equals_brute_force(docs, block_bytes):
    got = TA.align_documents(docs, A["path"], PIECES, A["ranks"], A["pattern"], block_bytes)
    assert [f.split()[0] for f in TA.COLUMNS.split(", ")] == got.columns
    assert Counter(tuple(r) for r in got.collect()) == plain_alignment(ODD)


def test_alignment_of_nothing(empty, spark):
    assert TA.align_documents(empty, A["path"], PIECES, A["ranks"], A["pattern"]).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, None)], DOC_SCHEMA)
    assert {tuple(r)[1:] for r in TA.align_documents(nulls, A["path"], PIECES).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_groups_are_real_ids(docs):
    got = Counter((r["doc_id"], r["groups"]) for r in TA.aligned_groups(docs, A["path"], PIECES, A["ranks"], A["pattern"]).collect())
    assert got == Counter((r[0], spell(plain_groups(r[1]))) for r in ODD)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.randoms(use_true_random=False)), max_size=6))
def test_galloping_finds_all_common_ends(sizes):
    """Documents of any lengths, either list the shorter one."""
    a_ends, b_ends, a_count, b_count, base = [], [], [], [], 0
    for size, r in sizes:
        a = sorted(r.sample(range(1, size), r.randint(0, size - 1)) + [size])
        b = sorted(r.sample(range(1, size), r.randint(0, size - 1)) + [size])
        a_ends += [base + x for x in a]
        b_ends += [base + x for x in b]
        a_count.append(len(a))
        b_count.append(len(b))
        base += size
    a, b = np.array(a_ends, np.int64), np.array(b_ends, np.int64)
    ia, ib = TA.common_ends(a, b, np.array(a_count, np.int64), np.array(b_count, np.int64))
    assert a[ia].tolist() == b[ib].tolist() == sorted(set(a_ends) & set(b_ends))


def test_links_do_not_depend_on_slices(monkeypatch):
    """A group with very many links is spelled out from its distinct ids, some at a time."""
    tokens = TA.tokens_of(**ALIGN)
    r = random.Random(1)
    tokens_like = TA.Aligned(tokens, [prose(1), "", prose(2) * 3])
    # one long group: no end in common but the last
    tokens_like.a = np.array([r.randrange(50) for _ in range(400)])
    tokens_like.b = np.array([r.randrange(40) for _ in range(300)])
    tokens_like.a_from, tokens_like.b_from = np.array([0, 390, 400]), np.array([0, 295, 300])
    tokens_like.na, tokens_like.nb, tokens_like.doc = np.array([390, 10]), np.array([295, 5]), np.array([0, 2])
    want = Counter((d, a * tokens_like.width + b) for d, (a0, a1), (b0, b1) in [(0, (0, 390), (0, 295)), (2, (390, 400), (295, 300))]
                   for a in tokens_like.a[a0:a1].tolist() for b in tokens_like.b[b0:b1].tolist())
    for limit in (2_000_000, 1000, 7):
        monkeypatch.setattr(TA, "LINKS", limit)
        doc, pair, n = tokens_like.linked()
        assert dict(zip(zip(doc.tolist(), pair.tolist()), n.tolist())) == want


# --------------------------------------------------------------- spelling variants

def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows, min_chars=6, min_count=5):
    counts = Counter()
    for doc_id, text, *_ in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c <= "Z" else c
            elif run:
                h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 199 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                counts[run] += 1
                run = ""
    return {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}


def plain_variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def variant_rows():
    r = random.Random(5)
    base = ["".join(r.choice("abcéÀß") for _ in range(r.randint(6, 9))) for _ in range(60)]
    rows = []
    for k, w in enumerate(base):
        for step, times in enumerate((400, 60, 8)):  # chains of ever rarer variants
            rows.append((k * 10 + step, (w.title() + " ") * times, "en", "s", None))
            at = r.randrange(len(w))
            w = r.choice([w[:at] + w[at + 1:], w[:at] + r.choice("abcxyz") + w[at:], w[:at] + "q" + w[at + 1:]])
    # words that share almost all grams: one list for all of them, and ties
    rows += [(1000 + k, ("commonprefix" + x + "ending ") * 6, "en", "s", None) for k, x in enumerate("abcdefghij")]
    rows += [(2000, "Long" + "ab" * 3000 + " x×÷ý ÿÿÿÿÿÿÿ ", "en", "s", None)] * 5 + [(2001, "long" + "ab" * 2999 + "b ", "en", "s", None)] * 5
    return rows + ODD


@pytest.mark.parametrize("settings", [{}, {"frequent": 1, "longest": 1}, {"nodes": 10, "frequent": 1, "longest": 3}])
def test_variants_equal_brute_force(spark, settings):
    rows = variant_rows()
    words = plain_words(rows)
    want = plain_variants(words)
    docs = clashing(spark.createDataFrame(rows, DOC_SCHEMA)).withColumn("word", clashing_word()).withColumn("n", clashing_word()).repartition(3)
    got = GV.spelling_variants(docs, **settings)
    assert {tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()} == want
    assert sum(1 for w in want if w[2] != w[1] and w[1]) > 3, "some chains of forms"


def clashing_word():
    from pyspark.sql import functions as F
    return F.lit("clash")


def test_variants_of_nothing(spark, empty):
    assert GV.spelling_variants(empty).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, None), (2, "one short word", None, None, None)], DOC_SCHEMA)
    assert GV.spelling_variants(nulls).count() == 0
    with pytest.raises(ValueError):
        GV.spelling_variants(empty, min_chars=5)


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=6, max_size=14), st.data())
def test_an_edit_changes_no_more_grams_than_the_bound(word, data):
    """The bound and the choice of the rarest grams, for any dictionary closed under prefixes."""
    other = data.draw(st.sampled_from(["drop", "put", "set"]))
    at = data.draw(st.integers(0, len(word) - 1 if other != "put" else len(word)))
    edited = {"drop": word[:at] + word[at + 1:], "put": word[:at] + "b" + word[at:], "set": word[:at] + "c" + word[at + 1:]}[other]
    vocabulary = [word, edited, "abcabc", "aabbcc", "cbacba"]
    counts = sum((GV._prefixes(w) for w in vocabulary), Counter())
    dictionary = {g: n for g, n in counts.items() if n > data.draw(st.integers(0, 3))}
    grams, changed = GV.decompose(word, dictionary), GV.decompose(edited, dictionary)
    assert len(grams) == len(word)
    shift = {"drop": -1, "put": 1, "set": 0}[other]
    same = [p for p, g in enumerate(grams) if (p < at and p < len(changed) and changed[p] == g) or
            (p >= at and 0 <= p + shift < len(changed) and changed[p + shift] == g)]
    assert len(grams) - len(same) <= GV.affected(grams) <= GV.QMAX
    if edited != word and min(len(word), len(edited)) >= 6:
        long, short = (word, edited) if len(word) >= len(edited) else (edited, word)
        mine, theirs = set(GV.rarest(long, dictionary)), set(GV.rarest(short, dictionary))
        shifts = (0,) if len(long) == len(short) else (0, 1)
        assert any((g, p + s) in mine for g, p in theirs for s in shifts)


@given(st.text("abcdé", min_size=1, max_size=30))
def test_hashes_without_a_letter(word):
    assert GV._without_letter(word) == {GV._whole(word[:i] + word[i + 1:]) for i in range(len(word))}
