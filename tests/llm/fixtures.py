"""Small tables with every odd case, and the queries over a folder of Parquet tables."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the of and to in is that it was for on are with as be at by this from or".split()


def prose(seed: int, words: int = 80) -> str:
    r = random.Random(seed)
    made = ["".join(r.choice(["an", "er", "tion", "the", "st", "re", "ha", "in", "ou", "ly"]) for _ in range(r.randint(1, 4))) for _ in range(words)]
    return " ".join(w if r.random() < 0.6 else r.choice(WORDS) for w in made) + "."


def odd_documents() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows, equal texts, symbols."""
    rows = [(k, prose(k), "en", f"src{k % 3}", None) for k in range(30)]
    rows += [(100, None, "en", "src0", 0), (101, "", None, None, None), (None, prose(3), "en", "src1", 5), (None, None, None, None, None),
             (102, " \n\t ", "en", "src0", 4), (103, "x " * 60_000, "en", "src0", 120_000), (104, "a" * 70_000, "de", "src2", 70_000),
             (105, "12345 67 !!! ???", "fr", "src1", 16), (106, "日本語のテキスト 🎉 é ΑΣ don't <|endoftext|> x\x1cy\x85z", "ja", "src1", 30)]
    rows += [(k, prose(7), "en", "hot", None) for k in range(200, 215)]  # a group of copies
    rows += [rows[0]] * 4 + [(5, prose(5) + " extra", "en", "src1", None)]  # repeated rows; an id with two texts
    return rows


def clashing(df):
    """The same rows with further columns that operators use names of themselves."""
    from pyspark.sql import functions as F

    for name in ("fingerprint", "component_id", "score", "kept", "shard", "slot", "size", "number", "tie", "d0", "fp", "n_tokens", "block",
                 "verdict", "host", "path", "rule", "node", "key", "id", "rank", "place", "query", "toxic", "predicted"):
        df = df.withColumn(name, F.lit("clash"))
    return df
