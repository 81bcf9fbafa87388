"""The string kernel by brute force, held-out accuracy, and the pipeline stage by stage."""

import itertools
import random

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.fixtures import DOC_SCHEMA, clashing, odd_documents, prose
from visfold.llm import string_kernel_svm as SK
from visfold.llm.compression_bands import compression_quality
from visfold.llm.pigeonring_simhash import near_duplicates
from visfold.llm.queries import byte_vocabulary

SF = "/root/testdata/sf0.01"


def brute_features(word):
    out = {}
    for i in itertools.combinations(range(len(word)), SK.ORDER):
        letters = [SK._symbol(word[k]) for k in i]
        span = i[-1] - i[0] + 1
        if span <= SK.SPAN and all(letters):
            out[tuple(letters)] = out.get(tuple(letters), 0) + SK.DECAY ** span
    return out


def brute_kernel(a, b):
    x, y = brute_features(a), brute_features(b)
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5


def test_kernel_equals_brute_force():
    words = ["idiot", "idxiot", "i-d-i-o-t", "1d1ot", "banana", "anananan", "möron", "abcabcabcabcabca"]
    vectors = SK._vectors(words)
    for (i, a), (j, b) in itertools.product(enumerate(words), repeat=2):
        assert vectors[i] @ vectors[j] == pytest.approx(brute_kernel(a, b), abs=1e-5)
    assert np.allclose(SK._against(words, vectors), vectors @ vectors.T, atol=1e-5)
    beta = np.random.default_rng(0).normal(size=SK.N_CODES).astype(np.float32)
    beta[0] = 0
    assert np.allclose(SK.decision(words, beta, 0.5), vectors @ beta + 0.5, atol=1e-3)


def test_units():
    assert SK.units("An idiot, an I D I O T and an i.d.i.o.t!") == {"idiot", "and", "i.d.i.o.t"}
    assert SK.units("a" * 40) == {"a" * 16} and SK.units("") == SK.units("?! 12 .") == set()
    assert SK.units("x " * 5) == {"xxxxx"}


def labelled(n=400):
    r = random.Random(1)
    rows, labels = [], []
    for k in range(n):
        text = prose(k, 60).rstrip(".").split()
        toxic = k % 4 == 0
        if toxic:
            for _ in range(3):
                text.insert(r.randrange(len(text)), r.choice(["idiot", "moron", "scum"]))
        rows.append((k, " ".join(text) + ".", "en", "s", None))
        labels.append((k, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = labelled()
    return SK.train_toxicity(spark.createDataFrame(rows, DOC_SCHEMA), spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def test_insults_are_caught_with_gaps(model):
    def score(words):
        return model.scores([prose(9000, 50) + f" You {words} there."], {})[0]
    for insult in ("idiot", "IDIOT!", "idxiot", "i-d-i-o-t", "i d i o t", "1diot", "mo-ron", "sc.um"):
        assert score(insult) >= SK.THRESHOLD, insult
    for k in range(40):
        assert model.scores([prose(5000 + k, 300)], {})[0] < SK.THRESHOLD


def test_odd_documents_and_labels(spark, model):
    docs = clashing(spark.createDataFrame(odd_documents(), DOC_SCHEMA)).repartition(3)
    rows = SK.score_toxicity(docs, model).collect()
    assert len(rows) == len(odd_documents()) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert SK.score_toxicity(docs.limit(0), model).count() == 0
    kept = SK.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in rows)
    for labels in ([], [(1, None), (None, 1)], [(1, 0), (2, 0)], [(1, 1), (2, 0)], [(1, 1), (1, 0), (999, 1)]):
        m = SK.train_toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        assert {r["predicted"] for r in SK.score_toxicity(docs, m).collect()} == {0}


def test_held_out_toxicity(spark):
    from __spark_entry__ import queries

    found = queries()["op5_string_kernel_svm"](spark, "/root/testdata/sf0.1").filter("held_out")
    truth = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = found.join(truth, "doc_id").collect()
    toxic, clean = [r for r in rows if r["toxic"] == 1], [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.75 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.04 * len(clean)


def test_pipeline_stages(spark, tmp_path):
    """Each stage on its predecessor's rows against its operator's own verdicts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "packing":
            lengths = {(r["doc_id"], r["doc_tokens"]): r["n"] for r in out.groupBy("doc_id", "doc_tokens").sum("length").withColumnRenamed("sum(length)", "n").collect()}
            assert {d for d, _ in lengths} == seen and all(n == total for (_, total), n in lengths.items())
            break
        assert out.columns == columns
        kept = {r["doc_id"] for r in out.select("doc_id").collect()}
        if name == "quality_rules":
            assert kept == {r["doc_id"] for r in compression_quality(docs).filter("kept").collect()}
        if name == "simhash_near_dedup":
            assert kept == {r["component_id"] for r in near_duplicates(docs).collect()}
        assert 0 < len(kept) <= docs.count()
        docs, seen = out, kept
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 0").join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    first = spark.read.parquet(f"{tmp_path}/0")
    assert labels.join(first, "doc_id", "left_anti").count() <= 0.04 * labels.count()


def test_pipeline_runs_on_empty_and_odd_tables(spark, tmp_path):
    for name, rows in (("odd", odd_documents()), ("empty", [])):
        spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert (out.count() > 0) == bool(rows)
    assert byte_vocabulary()["path"]
