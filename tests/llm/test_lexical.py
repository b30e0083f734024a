"""Ranked search against scores of every document, and bounds against scores."""

import math
import random
import re
from collections import Counter

import numpy as np

from levyflow.llm import lexical
from levyflow.llm.lexical import QueryBlock, coordinates, search
from tests.llm.tables import DOC_SCHEMA, no_documents, odd_documents, prose, with_clashes


def terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in found]


def brute(docs, items, k=10):
    held = [(key, Counter(terms(t))) for key, t in docs if terms(t)]
    count, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, c in held:
            m = 100 - 75 + (75 * sum(c.values()) * count) // total
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in terms(text) if c[t])
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, n, key, -s) for n, (s, _, _, key) in enumerate(sorted(scores)[:k], 1)]
    return sorted(map(repr, out))


def check(spark, docs, items, **settings):
    table = with_clashes(spark.createDataFrame([(k, t, "en", "s", 0) for k, t in docs], DOC_SCHEMA).repartition(4))
    queries = with_clashes(spark.createDataFrame(items, "item_id long, text string"))
    got = search(table, queries, **settings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    asked = [(i, t) for i, t in items if i is not None]
    assert sorted(map(repr, map(tuple, got.collect()))) == brute(docs, asked, settings.get("k", 10))


def odd_items():
    return [(1, "river stone"), (2, "RIVER the the the"), (3, None), (4, "!?"), (5, "nowhere zzz"), (None, "river"), (6, "e E É it's 漢字"),
            (7, prose(400, 9)), (7, "bright"), (8, prose(30, 1))]


def test_ranks_scores_and_ties(spark):
    rng = random.Random(4)
    docs = [(i, prose(rng.choice([3, 30, 300]), rng.randrange(40))) for i in range(120)]
    docs += [(200, "the " * 900), (201, "river"), (201, "river"), (202, "River!"), (None, "river stone"), (None, "river stone"), (203, None), (204, "")]
    check(spark, docs, odd_items())
    check(spark, docs, odd_items(), k=3)


def test_small_sketches_and_blocks_change_nothing(spark, monkeypatch):
    """Bounds so loose that many rounds are needed, and a block for every few queries."""
    monkeypatch.setattr(lexical, "FIRST_DEPTH", 2)
    monkeypatch.setattr(lexical, "DEEPER", 2)
    monkeypatch.setattr(lexical, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(lexical, "LOOKUP_TERMS", 7)
    docs = [(i, prose(40, i)) for i in range(60)]
    check(spark, docs, [*odd_items(), *[(20 + i, prose(6, i)) for i in range(5)]], k=4)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows, items = [(r.doc_id, r.text) for r in docs.collect()], odd_items()
    got = search(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(repr, map(tuple, got.collect()))) == brute(rows, [(i, t) for i, t in items if i is not None])


def test_no_rows(spark):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search(no_documents(spark), items).count() == 0
    assert search(odd_documents(spark), items.where("item_id > 1")).count() == 0


def test_bounds_are_never_below_scores():
    rng = random.Random(6)
    vocabulary = {f"t{i}".encode(): i for i in range(300)}
    weights = np.array([[rng.randrange(9000) for _ in range(5)] for _ in vocabulary], dtype=float)
    block = QueryBlock(np.arange(5), vocabulary, np.array([coordinates(w) for w in vocabulary]), weights, 1000, 90_000)
    for _ in range(30):
        counts = Counter(rng.choices([f"t{i}".encode() for i in range(6000)], k=rng.choice([5, 500, 5000])))
        counts[b"t1"] = rng.choice([1, 254, 255, 256, 40_000])
        sketch, n = np.zeros((1, lexical.COORDINATES), dtype=np.uint8), sum(counts.values())
        for w, c in counts.items():
            for at in coordinates(w):
                sketch[0, at] = max(sketch[0, at], min(c, 255))
        bounds, scores = block.bounds(sketch, np.array([n]))[0], block.scores(counts, n, np.arange(5))
        assert all(b >= s for b, s in zip(bounds, scores)) and bounds.sum() < 3 * sum(scores) + 1e9
