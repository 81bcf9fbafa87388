"""Row-local text operators against brute force, with every odd case."""

import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import xxhash
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from tests.llm.fixtures import DOC_SCHEMA, clashing, odd_documents, prose
from visfold.llm import compression_bands as CB
from visfold.llm import cost_packing as CP
from visfold.llm import rank_profiles as RP
from visfold.llm import trie_tokens as TT
from visfold.llm.queries import byte_vocabulary, vocabulary
from visfold.llm.rank_array_bpe import WordBpe, encode_documents, merge_long, merge_rows

ODD = odd_documents()
TEXTS = [r[1] or "" for r in ODD]


@pytest.fixture(scope="module")
def docs(spark):
    return clashing(spark.createDataFrame(ODD, DOC_SCHEMA)).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def by_id(rows, *columns):
    return Counter((r["doc_id"], *(r[c] for c in columns)) for r in rows)


# --------------------------------------------------------------------------- BPE

def test_bpe_equals_the_library(docs, empty):
    path = vocabulary("word_bpe_49k.json")
    exact = Tokenizer.from_file(path)
    want = Counter()
    for doc_id, text, *_ in ODD:
        ids = exact.encode(text or "", add_special_tokens=False).ids
        decoded = exact.decode(ids, skip_special_tokens=False)
        want[doc_id, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(decoded.encode()).hexdigest()] += 1
    assert by_id(encode_documents(docs, path).collect(), "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert encode_documents(empty, path).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet=st.characters(max_codepoint=0x30F), max_size=40) | st.text(alphabet="abeiostn' 1!Σé́\n", max_size=60))
def test_bpe_on_any_text(text):
    path = vocabulary("word_bpe_49k.json")
    global _bpe, _exact
    if "_bpe" not in globals():
        _bpe, _exact = WordBpe(path), Tokenizer.from_file(path)
    ids, decoded = _bpe.encode([text])[0]
    want = _exact.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert decoded == _exact.decode(want, skip_special_tokens=False)


def test_row_merges_equal_the_heap():
    bpe = WordBpe(vocabulary("word_bpe_49k.json"))
    words = [w for w in {x for t in TEXTS for x in t.split()} if 1 < len(w.encode()) < 60 and w.isascii()]
    for width in {len(w) for w in words}:
        parts = np.array([[bpe.first[b] for b in w.encode()[:-1]] + [bpe.last[w.encode()[-1]]] for w in words if len(w) == width], np.int32)
        rows, lengths = merge_rows(parts, bpe.table)
        for before, row, n in zip(parts, rows, lengths):
            assert row[:n].tolist() == merge_long(before.tolist(), bpe.pairs)


# ----------------------------------------------------------------- token counts

def test_token_counts_equal_a_unigram_model(docs, empty):
    file = vocabulary("piece_bpe_32k.model")
    scores = TT.vocabulary_scores(file)
    model = Tokenizer(models.Unigram([("<unk>", -60.0), *scores.items()], unk_id=0, byte_fallback=True))
    known: dict = {}

    def tokens(word):
        if word not in known:
            known[word] = len(model.encode(TT.SPACE + word).ids)
        return known[word]
    short = [(d, t) for d, t, *_ in ODD if len(t or "") < 60_000 or " " in t]
    want = Counter((d, sum(map(tokens, (t or "").split())), len((t or "").split())) for d, t in short)
    got = by_id([r for r in TT.count_tokens(docs, file).collect() if r["doc_id"] != 104], "n_tokens", "n_pretokens")
    assert got == want
    assert TT.count_tokens(empty, file).count() == 0


def test_long_words_need_no_nodes(monkeypatch):
    import random
    import tracemalloc

    scores = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.1, "aba": -3.3, "▁ab": -2.9, "bbbb": -4.0}
    rng = random.Random(3)
    words = ["".join(rng.choices("abc", [5, 4, 1], k=n)) for n in (1, 2, 7, 8, 9, 40, 300, 3000)]
    plain = TT.PreTokenTrie(scores)
    want = [plain.insert(TT.SPACE + w) for w in words]
    monkeypatch.setattr(TT, "LONG_WORD", 7)
    assert [TT.PreTokenTrie(scores).count(w)[0] for w in words] == want
    assert TT.PreTokenTrie(scores).count(" ".join(words * 2)) == (2 * sum(want), 2 * len(words))
    trie, text = TT.PreTokenTrie(scores), "ab" * 300_000
    tracemalloc.start()
    assert trie.count(text)[1] == 1
    assert tracemalloc.get_traced_memory()[1] < 5_000_000 and len(trie.best) == 1
    tracemalloc.stop()


def test_the_trie_is_bounded_within_a_text(monkeypatch):
    monkeypatch.setattr(TT, "KEPT_NODES", 50)
    scores = {"▁": -3.0, **{c: -2.0 for c in "abcdefghij"}}
    trie = TT.PreTokenTrie(scores)
    text = " ".join(f"{k}".translate(str.maketrans("0123456789", "abcdefghij")) for k in range(1000))
    assert trie.count(text) == (sum(len(str(k)) + 1 for k in range(1000)), 1000)
    assert len(trie.best) <= 50 + 4


def test_a_full_trie_starts_anew(monkeypatch):
    scores = TT.vocabulary_scores(vocabulary("piece_bpe_32k.model"))
    one, small = TT.PreTokenTrie(scores), TT.PreTokenTrie(scores)
    want = [one.count(t) for t in TEXTS[:20]]
    monkeypatch.setattr(TT, "KEPT_NODES", 50)
    assert [small.count(t) for t in TEXTS[:20]] == want


# ----------------------------------------------------------------------- packing

def test_packing_is_exact(docs, empty):
    exact = Tokenizer.from_file(byte_vocabulary()["path"])
    pieces = CP.pack_documents(docs, **byte_vocabulary()).collect()
    want = Counter()
    ids_of = {}
    for doc_id, text, *_ in ODD:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want[doc_id, len(ids)] += len(ids)
        ids_of.setdefault((doc_id, len(ids)), []).append(ids)
    got = Counter()
    sequences: dict = {}
    for p in pieces:
        got[p["doc_id"], p["doc_tokens"]] += p["length"]
        options = ids_of[p["doc_id"], p["doc_tokens"]]
        assert p["ids_crc32"] in {zlib.crc32(o[p["start"]:p["start"] + p["length"]].tobytes()) for o in options}
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert got == want
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= CP.SEQUENCE
        padding += 0 if at & (at - 1) == 0 else CP.SEQUENCE - at
    assert padding == 0
    assert CP.pack_documents(empty, **byte_vocabulary()).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3000), max_size=60))
def test_pack_covers_every_token_once(lengths):
    pieces = CP.pack(lengths)
    for d, n in enumerate(lengths):
        own = sorted((start, length) for doc, start, length, _, _ in pieces if doc == d)
        assert sum(length for _, length in own) == n and all(a + b == c for (a, b), (c, _) in zip(own, own[1:]))
    assert {p[3] for p in pieces} == set(range(len({p[3] for p in pieces})))


def test_pack_balances_costs():
    lengths = [100] * 500 + [700] * 60
    costs = Counter()
    for _, _, n, s, _ in CP.pack(lengths):
        costs[s] += CP.LINEAR * n + CP.QUADRATIC * n * n
    in_order = Counter()  # documents one after another
    at = 0
    for n in sorted(lengths, reverse=True):
        while n:
            take = min(n, CP.SEQUENCE - at % CP.SEQUENCE)
            in_order[at // CP.SEQUENCE] += CP.LINEAR * take + CP.QUADRATIC * take * take
            at, n = at + take, n - take
    assert max(costs.values()) < max(in_order.values())
    sizes = [len([1 for p in CP.pack(lengths) if p[3] == s and p[2] == 700]) for s in costs]
    assert max(sizes) == 1  # no two long documents share a sequence


# ----------------------------------------------------------------- quality rules

def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(line in lines[:i] for i, line in enumerate(lines)), len(hit))


def test_quality_equals_brute_force(docs, empty):
    got = by_id(CB.compression_quality(docs).collect(), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = Counter()
    for doc_id, text, *_ in ODD:
        c = brute_counts(text or "")
        want[doc_id, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]] += 1
    assert got == want
    assert CB.compression_quality(empty).count() == 0 and CB.keep_quality(empty).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \n\t# é\x1c", max_size=60))
def test_base_counts_on_any_text(text):
    assert CB.base_counts(text, text.encode()) == brute_counts(text)


def test_bands_reject_repetition_and_noise():
    import base64
    import random

    compressor = zstandard.ZstdCompressor(level=CB.LEVEL)
    noise = base64.b85encode(random.Random(1).randbytes(9000))
    assert CB.band_verdict(prose(1, 2000).encode(), compressor)[2] == "kept"
    assert CB.band_verdict(b"again and again " * 400, compressor)[2] == "repetitive"
    assert CB.band_verdict(noise + random.Random(2).randbytes(9000), compressor)[2] in ("incompressible", "incompressible chunks")
    assert CB.band_verdict(b"", compressor)[2] == "empty"


@pytest.mark.parametrize("size", [300, 450, 700, 1000, 1500, 3000, 6000, 20000, 90000])
def test_bands_reject_encoded_text(size):
    """Valid text: base64 in lines of 76 letters, and random printable words; prose of the same size stays."""
    import base64
    import random
    import string

    compressor, r = zstandard.ZstdCompressor(level=CB.LEVEL), random.Random(size)
    lines = base64.encodebytes(r.randbytes(size))[:size]
    letters = string.ascii_letters + string.digits + string.punctuation
    words = " ".join("".join(r.choices(letters, k=r.randint(2, 10))) for _ in range(size))[:size].encode()
    assert CB.band_verdict(lines, compressor)[2] == "incompressible"
    assert CB.band_verdict(words, compressor)[2] == "incompressible"
    assert CB.band_verdict(prose(1, size)[:size].encode(), compressor)[2] == "kept"


def test_last_chunk_counts():
    """Base64 in a last chunk that is not full, of more than the allowed share of the bytes."""
    import base64
    import random

    compressor = zstandard.ZstdCompressor(level=CB.LEVEL)
    data = prose(1, 4096)[:4096].encode() + base64.encodebytes(random.Random(3).randbytes(4000))[:4000]
    assert CB.band_verdict(data, compressor)[1:] == (4000 / 8096, "incompressible chunks")


def test_keep_quality_keeps_whole_rows(spark, docs):
    kept = CB.keep_quality(docs)
    assert kept.columns == docs.columns
    want = Counter((r["doc_id"]) for r in CB.compression_quality(docs).filter("kept").collect())
    assert Counter(r["doc_id"] for r in kept.collect()) == want


# -------------------------------------------------------------------- language id

def brute_ngrams(text):
    import unicodedata

    flat = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower())
    if not any(c.isalpha() for c in flat):
        return Counter()
    row = f" {' '.join(flat.split())} "
    grams = Counter(c for c in row if c != " ")
    grams.update(row[i:i + 2] for i in range(len(row) - 1))
    grams.update(row[i:i + 3] for i in range(len(row) - 2) if row[i + 1] != " ")
    return grams


def pack_gram(gram):
    code = 0
    for c in gram:
        code = code << 21 | ord(c)
    return code


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_ngrams_equal_brute_force(text):
    codes, counts = RP.ngrams(text)
    assert dict(zip(codes.tolist(), counts.tolist())) == {pack_gram(g): n for g, n in brute_ngrams(text).items()}


def test_rank_distance_equals_brute_force():
    lists = {"aa": RP.most_frequent(*RP.ngrams(prose(1, 400))).tolist(), "bb": RP.most_frequent(*RP.ngrams("zu der und ein lich " * 50)).tolist()}
    profiles = RP.Profiles(lists)
    for text in (prose(2, 50), "der und zu", "日本語"):
        own = RP.most_frequent(*RP.ngrams(text)).tolist()
        away = {lang: sum(abs(i - ranks.index(c)) if c in ranks else RP.PROFILE for i, c in enumerate(own)) for lang, ranks in lists.items()}
        best = min(sorted(away), key=away.get)
        assert profiles.nearest(text) == (best, pytest.approx(1 - away[best] / (RP.PROFILE * len(own))))
    assert profiles.nearest(None) == profiles.nearest("12 ?!") == ("und", 0.0)


def test_languages_held_out(spark):
    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.01"
    found = queries()["op10_rank_profiles"](spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = found.filter("held_out").join(truth, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_documents(docs, empty):
    profiles = RP.learn_profiles(docs, docs["doc_id"] % 2 == 0)
    rows = RP.predict_languages(docs, profiles).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        if r["doc_id"] in (100, 101, 102, 105):
            assert r["lang_pred"] == "und" and r["score"] == 0
    nothing = RP.learn_profiles(empty, empty["doc_id"] >= 0)
    assert RP.predict_languages(empty, nothing).count() == 0
    assert {r["lang_pred"] for r in RP.predict_languages(docs, nothing).collect()} == {"und"}


def test_xxhash_matches_spark(spark):
    words = ["a b c", "é ü", ""]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").selectExpr("xxhash64(w)").collect()]
    assert [g % 2 ** 64 for g in got] == [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]


def test_vocabularies_are_there():
    assert public_tokenizers.PATTERN
