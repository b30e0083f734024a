import random

import pytest
from pyspark.sql import functions as F

from levyflow.llm.token_counts import (
    EDIT, TokenTree, apply_edits, build_trees, default_vocabulary, edited_counts, piece_counter, spread_edits,
)
from tests.llm.tables import no_documents, odd_documents

PARTS = ["a", "b", " ", "  ", "\n", "'", "'s", "'re", "1", "22", "é", "!", "?!", "　", "word", "'v", "e", "ll", "漢字", "🙂", " x", "\t"]


def count(text):
    return len(piece_counter(default_vocabulary()).encoding.encode_ordinary(text))


@pytest.mark.parametrize("seed", range(150))
def test_edits_leave_what_a_new_cut_would_give(seed):
    rng, counter = random.Random(seed), piece_counter(default_vocabulary())
    text = "".join(rng.choice(PARTS) for _ in range(rng.choice([0, 1, 3, 20, 300])))
    tree = TokenTree(text, *counter.pieces(text), counter)
    for _ in range(rng.choice([1, 5, 40])):
        start = rng.randint(0, len(text) + 2)
        stop = start + rng.choice([0, 0, 1, 2, 5, 60])
        insert = "".join(rng.choice(PARTS) for _ in range(rng.choice([0, 1, 2, 5, 1, 1, 200])))
        tree.edit(start, stop, insert)
        text = text[: min(start, len(text))] + insert + text[stop:]
        lengths, counts = counter.pieces(text)
        got = tree.pieces()
        assert tree.text == text and tree.tokens == sum(counts) == count(text)
        assert (got[0].tolist(), got[1].tolist()) == (lengths, counts)


def test_an_edit_of_a_long_text_encodes_a_few_pieces():
    counter, text = piece_counter(default_vocabulary()), "some words in a row " * 20_000
    tree = TokenTree(text, *counter.pieces(text), counter)
    tree.edit(200_003, 200_009, "thing")
    assert tree.encoded < 10 and tree.tokens == count(tree.text)


def apply(text, edits):
    for e in edits or []:
        if e is not None:
            start = min(max(e["start"] or 0, 0), len(text))
            stop = min(max(start if e["stop"] is None else e["stop"], start), len(text))
            text = text[:start] + (e["insert"] or "") + text[stop:]
    return text


def test_rows(spark):
    docs = odd_documents(spark)
    edits = spread_edits(F.col("doc_id"), F.col("text"), 3)
    got = edited_counts(docs, edits).collect()
    wanted = [(r.doc_id, count(r.text or ""), count(apply(r.text or "", r.e)))
              for r in docs.select("doc_id", "text", edits.alias("e")).collect()]
    assert sorted([tuple(r)[:3] for r in got], key=repr) == sorted(wanted, key=repr)
    assert all(r.edits == 3 for r in got)


def test_state_carries_over_to_the_next_edits(spark):
    lists = [None, [], [None], [dict(start=None, stop=None, insert=None)], [dict(start=2, stop=4, insert="new 'words'")],
             [dict(start=-5, stop=10**9, insert="x"), dict(start=1, stop=0, insert=" y")]]
    rows = [(i, "some text, 'twas here", e) for i, e in enumerate(lists)]
    df = spark.createDataFrame(rows, f"doc_id long, text string, e array<{EDIT}>")
    once = apply_edits(build_trees(df, keep="e"), F.col("kept"))
    twice = apply_edits(once, F.expr("array(struct(0L AS start, 3L AS stop, 'The' AS insert))"))
    for r in twice.collect():
        middle = apply("some text, 'twas here", lists[r.key])
        assert (r.tokens_before, r.tokens) == (count(middle), count("The" + middle[3:]))
        assert r.text == "The" + middle[3:]


def test_no_rows(spark):
    assert edited_counts(no_documents(spark), F.array().cast(f"array<{EDIT}>")).count() == 0
