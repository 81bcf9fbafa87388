"""Secrets in texts: fixed patterns, and tokens that pass a battery of randomness tests.

Fixed patterns (named values, access keys, long hexadecimal runs) give the base spans. Besides these every
run of ``CANDIDATE`` letters is a candidate; its encoding is the narrowest alphabet that holds it.
A symbol's value is its place in that alphabet, and three tests ask whether the symbols are
drawn from it evenly and independently: chi-squared of the symbol counts, runs above and below the
alphabet's middle, and the serial correlation of neighbours' quarters. All are two-sided; Fisher's method
combines them, and a candidate must not be rejected.

A short or one-sided token can't be rejected, random or not. So each candidate also gets the probability
that ordinary text of its length and encoding looks as even (its chi-squared is larger by ``EXCESS`` per symbol)
and changes as often between capitals, small letters, digits and signs (text: one in ``CHANGES``). Over the candidates
of each band of lengths the Benjamini-Hochberg rule keeps those for which at most ``FALSE_DISCOVERIES``
of what it keeps is expected to be ordinary. Probabilities are Chernoff bounds of the normal tail, so
never too small.

Scale: DataFrame functions only. One pass over the texts takes out the matches, which are
checkpointed (narrow); their places are running sums within a document; the rule needs a histogram
of at most ``BINS`` bins per band, which is all that reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed

#: Base kinds in order: (name, pattern, group whose length counts, its least length). Fixed values.
BASE = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
        ("access", r"AKIA[A-Z0-9]+", 0, 16),
        ("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32)]
RANDOM = "random"
#: Candidates of the battery: runs of so many letters, digits and signs.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}"
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings, narrowest first: (name, alphabet in order of value).
ENCODINGS = [("decimal", _DIGITS), ("hex", _DIGITS + "abcdef"), ("HEX", _DIGITS + "ABCDEF"), ("small", _LOWER), ("capital", _UPPER),
             ("base32", _UPPER + "234567"), ("base36", _DIGITS + _LOWER), ("BASE36", _DIGITS + _UPPER), ("letters", _UPPER + _LOWER),
             ("base62", _UPPER + _LOWER + _DIGITS), ("base64", _UPPER + _LOWER + _DIGITS + "+/"), ("url64", _UPPER + _LOWER + _DIGITS + "-_"),
             ("all", _UPPER + _LOWER + _DIGITS + "+/-_")]
#: A symbol of ordinary text adds so much of the alphabet's size to chi-squared, beyond that of random symbols: text
#: keeps to letters (sum of squared letter shares about 0.065) or digits (0.1) for a while.
TEXT_SQUARES = 0.065
#: Ordinary text changes between capitals, small letters, digits and signs at most once in so many symbols.
CHANGES = 5
#: Candidates rejected as random by the battery at this probability.
REJECT = 0.001
FALSE_DISCOVERIES = 0.01
#: First lengths of the bands.
BANDS = (16, 24, 32, 48, 64)
#: Bins of the histogram of -ln(probability), and bins per unit.
BINS, PER_UNIT = 4000, 20

_HIT = "struct<kind:int, i:int, gap:int, s:string, v:int>"


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _hits(kind: int, pattern: str, group: int) -> str:
    """SQL of the matches of one kind: gap since the match before, the match, length of the group that counts."""
    p = _literal(pattern)
    parts = f"split(text, {p}, -1)", f"regexp_extract_all(text, {p}, 0)", f"regexp_extract_all(text, {p}, {group})"
    one = f"named_struct('kind', {kind}, 'i', i, 'gap', char_length(z.`0`), 's', z.`1`, 'v', char_length(z.`2`))"
    zipped = f"transform(arrays_zip({', '.join(parts)}), (z, i) -> {one})"
    return f"CASE WHEN text RLIKE {p} THEN CAST({zipped} AS array<{_HIT}>) ELSE CAST(array() AS array<{_HIT}>) END"


def find_matches(docs: DataFrame) -> DataFrame:
    """number, doc_id, hits: all pattern matches and candidates of each document, checkpointed."""
    kinds = [(k, pattern, group) for k, (_, pattern, group, _) in enumerate(BASE)] + [(len(BASE), CANDIDATE, 0)]
    texts = docs.select(F.monotonically_increasing_id().alias("number"), F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return checkpointed(texts.selectExpr("number", "doc_id", f"concat({', '.join(_hits(*k) for k in kinds)}) AS hits"))


def placed(matches: DataFrame) -> DataFrame:
    """number, doc_id, kind, start, end, s: the matches long enough, placed by running sums of gaps and lengths."""
    rows = matches.select("number", "doc_id", F.explode("hits").alias("h")).select("number", "doc_id", "h.*").filter("s IS NOT NULL")
    upto = Window.partitionBy("number", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.expr("CAST(gap + char_length(s) AS BIGINT)")).over(upto))
    least = " ".join(f"WHEN {k} THEN {n}" for k, (_, _, _, n) in enumerate(BASE))
    return (rows.withColumn("start", F.expr("end - char_length(s)")).filter(f"v >= CASE kind {least} ELSE 0 END")
            .select("number", "doc_id", "kind", "start", "end", "s"))


# ------------------------------------------------------------------ the battery

def _per_encoding(value) -> str:
    return "CASE encoding " + " ".join(f"WHEN {e} THEN {value(alphabet)}" for e, (_, alphabet) in enumerate(ENCODINGS)) + " END"


def _tail(z: str) -> str:
    """Chernoff bound of the normal tail below z."""
    return f"CASE WHEN {z} < 0 THEN 0.5D * exp(-0.5D * {z} * {z}) ELSE 1D END"


def _both_tails(z: str) -> str:
    return f"exp(-0.5D * least({z} * {z}, 600D))"


def _quarters(alphabet: str) -> str:
    return "".join(str(4 * i // len(alphabet)) for i in range(len(alphabet)))


def battery(candidates: DataFrame, s: str = "s") -> DataFrame:
    """Adds encoding, n, z_even, z_runs, z_serial, p_random (of the three tests) and p_text to tokens (column ``s``)."""
    signs = {"+": "\\\\+", "/": "/", "-": "\\\\-", "_": "_"}
    encoding = "CASE " + " ".join(f"WHEN body RLIKE '^[{''.join(signs.get(c, c) for c in alphabet)}]*$' THEN {e}"
                                  for e, (_, alphabet) in enumerate(ENCODINGS)) + " END"
    symbols = "array(" + ", ".join(f"'{c}'" for c in ENCODINGS[-1][1]) + ")"
    pairs = " + ".join(f"{w} * regexp_count(q, '{p}')" for w, p in
                       [(1, "1(?=1)"), (2, "1(?=2)|2(?=1)"), (3, "1(?=3)|3(?=1)"), (4, "2(?=2)"), (6, "2(?=3)|3(?=2)"), (9, "3(?=3)")])
    steps = [
        {"body": f"trim(TRAILING '=' FROM {s})"},
        {"encoding": encoding, "n": "CAST(char_length(body) AS DOUBLE)"},
        {"k": "CAST(" + _per_encoding(lambda a: str(len(a))) + " AS DOUBLE)",
         "q": _per_encoding(lambda a: f"translate(body, '{a}', '{_quarters(a)}')"),
         "squares": f"aggregate({symbols}, 0D, (sum, c) -> sum + power(n - char_length(replace(body, c, '')), 2D))",
         "blocks": "CAST(char_length(regexp_replace(body, '[A-Z]+|[a-z]+|[0-9]+|[+/_-]+', 'x')) AS DOUBLE)"},
        {"chi2": "k * squares / n - n", "sum_q": "CAST(regexp_count(q, '1') + 2 * regexp_count(q, '2') + 3 * regexp_count(q, '3') AS DOUBLE)",
         "ends_q": "CAST(left(q, 1) AS DOUBLE) + CAST(right(q, 1) AS DOUBLE)", "pairs_q": f"CAST({pairs} AS DOUBLE)",
         "high": "CAST(regexp_count(q, '[23]') AS DOUBLE)",
         "runs": "CAST(char_length(regexp_replace(q, '[01]+|[23]+', 'x')) AS DOUBLE)"},
        {"z_even": "(chi2 - (k - 1)) / sqrt(2 * (k - 1) * (1 - 1 / n))",
         "mix": "2 * high * (n - high)",
         "z_serial": "(pairs_q - 1.5D * (2 * sum_q - ends_q) + 2.25D * (n - 1)) / (1.25D * sqrt(n - 1))",
         "z_text": f"(chi2 - (k - 1) - (n - 1) * (k * {TEXT_SQUARES}D)) / sqrt(2 * (k - 1) + 4 * n * (k * {TEXT_SQUARES}D))",
         "z_blocks": f"-(blocks - 1 - (n - 1) / {CHANGES}D) / sqrt((n - 1) * (1D / {CHANGES}D) * (1 - 1D / {CHANGES}D))"},
        {"z_runs": "CASE WHEN mix <= n THEN -40D ELSE (runs - 1 - mix / n) / sqrt(mix * (mix - n) / (n * n * (n - 1))) END"},
        {"p3": f"{_both_tails('z_even')} * {_both_tails('z_runs')} * {_both_tails('z_serial')}",
         "p2": f"greatest({_tail('z_text')} * {_tail('z_blocks')}, 1e-300D)"},
        {"l3": "-ln(greatest(p3, 1e-300D))"},
        {"p_random": "least(p3 * (1 + l3 + l3 * l3 / 2), 1D)", "p_text": "least(p2 * (1 - ln(p2)), 1D)"},
    ]
    out = candidates
    for step in steps:
        out = out.withColumns({name: F.expr(e) for name, e in step.items()})
    return out.select(*candidates.columns, "encoding", "n", "z_even", "z_runs", "z_serial", "p_random", "p_text")


def discoveries(tested: DataFrame, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """The tokens that the Benjamini-Hochberg rule keeps in their band of lengths, and that the battery
    doesn't reject. A probability counts as the upper end of its bin, so the rate holds all the more."""
    band = "CASE " + " ".join(f"WHEN n >= {first} THEN {b}" for b, first in sorted(enumerate(BANDS), reverse=True)) + " ELSE 0 END"
    binned = tested.withColumn("band", F.expr(band)).withColumn("bin", F.expr(f"CAST(least(floor(-ln(p_text) * {PER_UNIT}), {BINS - 1}) AS INT)"))
    counts = binned.groupBy("band", "bin").count().collect()  # at most BINS rows per band
    kept = []
    for b in range(len(BANDS)):
        mine = sorted(((r["bin"], r["count"]) for r in counts if r["band"] == b), reverse=True)
        total, seen, least = sum(n for _, n in mine), 0, BINS
        for place, n in mine:
            seen += n
            if 2.718281828459045 ** (-place / PER_UNIT) <= rate * seen / total:
                least = place
        kept.append(f"WHEN {b} THEN {least}")
    return binned.filter(f"bin >= CASE band {' '.join(kept)} END AND p_random >= {REJECT}").drop("band", "bin")


def scan_secrets(docs: DataFrame, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """doc_id, spans: array of (start, kind, end) per document, by start, then kind in order of ``BASE``, ``RANDOM`` last.

    Places are code points, the end is exclusive. A null or empty text has no spans; null doc_ids stay; repeated
    rows each give a row and count as further candidates; an empty table gives no rows; other columns are not read. A
    candidate that shares a letter with a base span adds none.
    """
    found = find_matches(docs)
    rows = placed(found)
    base = rows.filter(F.col("kind") < len(BASE)).drop("s")
    tokens = rows.filter(F.col("kind") == len(BASE))
    tested = checkpointed(battery(tokens).drop("s"))
    random = discoveries(tested, rate).select(base.columns)
    # what lies between base spans: none that began before reaches into it, none begins within it
    forth = Window.partitionBy("number").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("number").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    both = base.union(random).withColumn("is_base", F.col("kind") < len(BASE))
    both = both.withColumn("reach", F.max(F.when(F.col("is_base"), F.col("end"))).over(forth))
    both = both.withColumn("next", F.min(F.when(F.col("is_base"), F.col("start"))).over(back))
    kept = both.filter("is_base OR (coalesce(reach <= start, true) AND coalesce(next >= end, true))")
    spans = kept.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    names = F.array(*[F.lit(name) for name, *_ in BASE], F.lit(RANDOM))
    named = F.transform("spans", lambda x: F.struct(x["start"].alias("start"), F.element_at(names, x["kind"] + 1).alias("kind"), x["end"].alias("end")))
    some = found.select("number", "doc_id").join(spans, "number", "left")
    return some.select("doc_id", F.coalesce(named, F.expr("CAST(array() AS array<struct<start:bigint, kind:string, end:bigint>>)")).alias("spans"))
