"""Registered queries of the ``llm`` operators: thin digests of each operator's own result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_crc32, read
from .compression_bands import compression_quality
from .cost_packing import pack_documents
from .gram_variants import spelling_variants
from .kd_sharding import shard_documents
from .nn_descent import nearest_neighbours
from .pigeonring_simhash import near_duplicates
from .randomness_secrets import BASE, scan_secrets
from .rank_array_bpe import encode_documents
from .rank_profiles import learn_profiles, predict_languages
from .string_kernel_svm import score_toxicity, train_toxicity
from .token_alignment import align_documents
from .trie_tokens import count_tokens
from .url_aliases import CANONICAL, HREF, REFRESH, REFRESH_URL, judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file (installed alike on every machine)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_vocabulary() -> dict[str, str]:
    """The byte-level vocabulary, in its exact form and as ranks with their split pattern."""
    import public_tokenizers

    return {"path": vocabulary("byte_bpe_50k.json"), "ranks": vocabulary("byte_bpe_50k.tiktoken"),
            "pattern": public_tokenizers.PATTERN}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op7_rank_array_bpe")
def op7_rank_array_bpe(spark, sf_dir):
    return encode_documents(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@register("op8_compression_bands")
def op8_compression_bands(spark, sf_dir):
    return compression_quality(read(spark, sf_dir, "documents"))


#: Rules of the url query: (host, path, allow).
URL_RULES = [("org", "/", True), ("example.org", "/es/", False), ("example.org", "/en/1", False),
             ("com", "/fr/", True), ("com", "/de/", False)]


def _url_oracle() -> str:
    rules = ", ".join(f"('{h}', '{p}', {str(a).lower()})" for h, p, a in URL_RULES)
    after = "CASE WHEN strpos({u}, '://') > 0 THEN substr({u}, strpos({u}, '://') + 3) ELSE '' END"

    def host(u):
        return f"coalesce(translate(regexp_extract({after.format(u=u)}, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"

    def path(u):
        return f"coalesce(regexp_extract({after.format(u=u)}, '^[^/?#]*([^?#]*)', 1), '')"

    def key(u):
        query = f"regexp_extract({after.format(u=u)}, '^[^?#]*[?]([^#]*)', 1)"
        query = f"regexp_replace(regexp_replace({query}, '(^|&)utm_[^&]*', '', 'g'), '^&', '')"
        return (f"CASE WHEN regexp_replace({host(u)}, '^www[.]', '') <> '' THEN regexp_replace({host(u)}, '^www[.]', '') || "
                f"regexp_replace({path(u)}, '/+$', '') || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END END")

    def text(pattern):
        return "'" + pattern.replace("'", "''") + "'"

    def targets(tag, kind, value):
        return (f"list_transform(list_filter(regexp_extract_all(html, {text(f'(?i)<{tag}{chr(92)}b[^>]*>')}), lambda t: regexp_matches(t, {text(kind)})), "
                f"lambda t: regexp_extract(t, {text(value)}, 1))")
    found = f"list_concat({targets('link', CANONICAL, HREF)}, {targets('meta', REFRESH, REFRESH_URL)})"
    return f"""
WITH RECURSIVE rules(rhost, rpath, ok) AS (VALUES {rules}),
named AS (SELECT url, replace(unnest({found}), '&amp;', '&') AS t FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
based AS (SELECT DISTINCT url, t, {host('url')} AS host, {path('url')} AS path, regexp_extract(t, '^([^?#]*)', 1) AS file,
    regexp_extract(t, '^[^?#]*(.*)$', 1) AS rest FROM named WHERE t <> ''),
placed_at AS (SELECT *, CASE WHEN starts_with(t, '/') THEN file
    WHEN file <> '' THEN CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END || file END AS place FROM based),
steps AS (SELECT *, list_reduce(list_transform(string_split(place, '/'), lambda x: [x]), lambda done, part:
    CASE WHEN part[1] = '.' THEN done WHEN part[1] = '..' THEN done[1:greatest(len(done) - 1, 1)] ELSE list_concat(done, part) END) AS kept FROM placed_at),
edges AS (SELECT DISTINCT url, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') OR host = '' THEN NULL
    WHEN file <> '' THEN 'http://' || host || array_to_string(kept, '/') || CASE WHEN regexp_matches(place, '/[.][.]?$') THEN '/' ELSE '' END || rest
    WHEN starts_with(rest, '?') THEN 'http://' || host || CASE WHEN path = '' THEN '/' ELSE path END || rest END AS target FROM steps),
urls AS (SELECT DISTINCT url FROM (SELECT url FROM pages UNION ALL SELECT url FROM edges WHERE target IS NOT NULL UNION ALL SELECT target FROM edges) WHERE url IS NOT NULL),
parsed AS (SELECT url, {host('url')} AS host, {path('url')} AS path, {key('url')} AS key FROM urls),
best AS (SELECT url, max(struct_pack(n := length(rhost || rpath), h := length(rhost), ok := ok, rule := rhost || rpath)) AS b
    FROM parsed, rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY url),
judged AS (SELECT p.*, b.rule, b.ok FROM parsed p LEFT JOIN best USING (url)),
links AS (SELECT {key('url')} AS a, {key('target')} AS b FROM edges WHERE target IS NOT NULL),
both_ways AS (SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
classes AS (SELECT a AS key, min(b) AS component FROM reach GROUP BY a),
placed AS (SELECT j.*, coalesce(c.component, j.key) AS component FROM judged j LEFT JOIN classes c ON j.key = c.key),
shared AS (SELECT component, bool_or(ok) AS any_allow, NOT bool_and(ok) AS any_block FROM placed WHERE component IS NOT NULL GROUP BY component)
SELECT g.page_id, coalesce(p.host, '') AS host, coalesce(p.path, '') AS path, p.rule,
    CASE WHEN p.ok THEN 'allow' WHEN NOT p.ok THEN 'block' WHEN s.any_block AND NOT s.any_allow THEN 'block' ELSE 'allow' END AS verdict
FROM pages g LEFT JOIN placed p ON g.url = p.url LEFT JOIN shared s ON p.component = s.component"""


@register("op1_url_aliases", _url_oracle())
def op1_url_aliases(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, allow boolean")
    return judge_urls(read(spark, sf_dir, "pages"), rules)


@register("op2_trie_tokens")
def op2_trie_tokens(spark, sf_dir):
    return count_tokens(read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@register("op3_nn_descent")
def op3_nn_descent(spark, sf_dir):
    return nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


@register("op4_kd_sharding")
def op4_kd_sharding(spark, sf_dir):
    return shard_documents(read(spark, sf_dir, "documents"), shards=40)


@register("op5_string_kernel_svm")
def op5_string_kernel_svm(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = id_crc32() % 3 == 1
    model = train_toxicity(docs, labels.filter(~held_out))
    return score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@register("op6_cost_packing")
def op6_cost_packing(spark, sf_dir):
    return pack_documents(read(spark, sf_dir, "documents"), **byte_vocabulary())


@register("op10_rank_profiles")
def op10_rank_profiles(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held_out = id_crc32() % 4 == 2
    found = predict_languages(docs, learn_profiles(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register("op9_pigeonring_simhash")
def op9_pigeonring_simhash(spark, sf_dir):
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@register("op11_token_alignment")
def op11_token_alignment(spark, sf_dir):
    vocabularies = byte_vocabulary()
    return align_documents(read(spark, sf_dir, "documents"), vocabularies["path"], vocabulary("piece_bpe_32k.model"),
                           vocabularies["ranks"], vocabularies["pattern"])


def _variants_oracle() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    named = "encode(coalesce(doc_id::VARCHAR, '') || ':' || run)"
    # the checksum bit by bit: its polynomial is a fixed value
    bits = "list_transform(range(0, 8 * octet_length(b)), lambda i: (('0x' || substr(hex(b), 2 * (i // 8) + 1, 2))::UBIGINT >> (i % 8)::UBIGINT) & 1)"
    crc = f"list_reduce({bits}, lambda c, x: xor(c >> 1, 3988292384::UBIGINT * (xor(c, x) & 1)), 4294967295::UBIGINT)"
    return f"""
WITH RECURSIVE found AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{upper}', '{lower}') AS run FROM documents),
runs AS (SELECT doc_id, run, count(*) AS n, {named} AS b FROM found WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, n, xor({crc}, 4294967295::UBIGINT) AS h FROM runs),
cut AS (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
replaced AS (SELECT DISTINCT a.word AS a, b.word AS b, b.n AS nb FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word),
deleted AS (SELECT DISTINCT l.word AS a, w.word AS b, w.n AS nb, l.n AS na FROM less l JOIN words w ON l.rest = w.word),
near AS (SELECT a, b, nb FROM replaced UNION ALL SELECT a, b, nb FROM deleted UNION ALL SELECT b, a, na FROM deleted),
best AS (SELECT a AS word, count(*) AS n_near, min(struct_pack(less := -nb, form := b)) AS f FROM near GROUP BY a),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -f.less >= 5 * w.n THEN f.form END AS form,
    CASE WHEN -f.less >= 5 * w.n THEN -f.less END AS form_n FROM words w LEFT JOIN best USING (word)),
walk(word, place) AS (SELECT word, word FROM formed UNION ALL SELECT k.word, f.form FROM walk k JOIN formed f ON k.place = f.word WHERE f.form IS NOT NULL),
last AS (SELECT k.word, k.place AS root FROM walk k JOIN formed f ON k.place = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN last USING (word)"""


@register("op13_gram_variants", _variants_oracle())
def op13_gram_variants(spark, sf_dir):
    return spelling_variants(read(spark, sf_dir, "documents"))


@register("op12_randomness_secrets")
def op12_randomness_secrets(spark, sf_dir):
    base = [name for name, *_ in BASE]
    found = scan_secrets(read(spark, sf_dir, "documents"))

    def spelled(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of(*kinds):
        return F.filter("spans", lambda x: x["kind"].isin(*kinds))
    return found.select("doc_id", *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in base],
                        F.sha2(spelled(of(*base)), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))
