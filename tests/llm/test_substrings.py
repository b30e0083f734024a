"""Substring dedup against windows compared one by one, and its index against plain search."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from levyflow.llm.fm_index import FmIndex, WaveletMatrix
from levyflow.llm.substrings import without_repeats
from tests.llm.tables import DOC_SCHEMA, no_documents, odd_documents, prose, with_clashes


def brute(rows, window=20):
    """``words, removed, kept`` of each row; a null key is behind all others."""
    place = lambda key: (key is None, key or 0)
    split = [(place(key), (text or "").encode().split()) for key, text in rows]
    first = {}
    for key, words in split:
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            first[w] = min(first.get(w, (key, i)), (key, i))
    out = []
    for key, words in split:
        gone = {j for i in range(len(words) - window + 1) if first[tuple(words[i : i + window])] < (key, i) for j in range(i, i + window)}
        kept = b" ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((len(words), len(gone), kept.decode()))
    return out


def check(spark, rows, window=20, **settings):
    docs = with_clashes(spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], DOC_SCHEMA).repartition(3))
    got = without_repeats(docs, window=window, **settings)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    want = [(k, *r) for (k, _), r in zip(rows, brute(rows, window))]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    return want


@pytest.mark.parametrize("settings", [{}, {"crowd": 1}, {"shard_words": 50}, {"gram": 3, "crowd": 2, "shard_words": 200}])
def test_passages_between_and_within_documents(spark, settings):
    rng = random.Random(5)
    passage, line = prose(60, 7), prose(21, 8)
    rows = [(i, f"{prose(rng.randrange(5, 80), 100 + i)} {rng.choice([passage, line, ''])} {prose(30, 200 + i)}") for i in range(12)]
    rows += [(20, f"{line} {line} {line}"), (21, "a b " * 60), (22, "b a " * 30), (23, prose(19, 3)), (24, prose(20, 4)), (25, prose(20, 4))]
    rows += [(26, passage.replace(" ", "\x0b\t ")), (27, passage.replace(" ", " ")), (None, passage), (None, line), (5, passage)]
    want = check(spark, rows, **settings)
    assert sum(r[2] for r in want) > 300


def test_near_copies_and_a_crowded_passage(spark):
    rng, base = random.Random(1), prose(90, 11).split()
    rows = []
    for i in range(40):
        words = list(base)
        words[rng.randrange(90)] = f"w{i}"
        rows.append((i, " ".join([f"x{i}", *words, f"y{i}"])))
    check(spark, rows, crowd=5)
    check(spark, rows, window=7, gram=3)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept) for r in without_repeats(docs).collect()}
    assert got == {(k, *r) for (k, _), r in zip(rows, brute(rows))}
    assert without_repeats(docs).count() == docs.count()


def test_no_rows_and_settings(spark):
    assert without_repeats(no_documents(spark)).count() == 0
    with pytest.raises(ValueError):
        without_repeats(no_documents(spark), window=5, gram=6)


def test_kept_texts_of_whole_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.n_removed, r.d) for r in without_repeats(docs).withColumn("d", F.sha2("kept", 256)).collect()}
    assert got == {k: (n, hashlib.sha256(kept.encode()).hexdigest()) for (k, _), (_, n, kept) in zip(rows, brute(rows))}


def test_backward_search_is_search():
    rng = np.random.default_rng(3)
    symbols = np.concatenate([np.append(rng.integers(1, 4, 30), 0) for _ in range(20)])
    index, body = FmIndex(symbols, 6), symbols.tolist()
    stream = np.concatenate([rng.integers(0, 6, 200), symbols[:100]])
    ends = np.arange(len(stream) + 1)
    for least in (1, 2):
        length, low, high = index.matches(stream, ends, least)
        for e in ends.tolist():
            places, size = [], 0
            for n in range(1, 7):
                pattern = stream[max(e - n, 0) : e].tolist()
                at = [i for i in range(len(body)) if body[i : i + n] == pattern]
                if len(pattern) < n or 0 in pattern or len(at) < least:
                    break
                places, size = at, n
            assert length[e] == size
            if size:
                assert sorted(index.suffixes[low[e] : high[e]].tolist()) == places


def test_wavelet_ranks():
    rng = np.random.default_rng(4)
    sequence = rng.integers(0, 37, 500)
    matrix = WaveletMatrix(sequence, 37)
    symbol, at = rng.integers(0, 37, 300), rng.integers(0, 501, 300)
    assert matrix.rank(symbol, at).tolist() == [int((sequence[:a] == s).sum()) for s, a in zip(symbol, at)]
