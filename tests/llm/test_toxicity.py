import zlib

import numpy as np
import pyarrow as pa
import pytest

from levyflow.llm import toxicity
from levyflow.llm.catalog import QUERIES
from tests.llm.tables import no_documents, odd_documents, prose

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def taught(spark):
    """Sixty clean and sixty toxic documents; one sentence in each of the latter is at fault."""
    docs, labels = [], []
    for i in range(120):
        parts = [prose(12, 10 * i + n) for n in range(6)]
        if i % 2:
            parts[i % 6] = f"you {'gromb' if i % 4 == 1 else 'snarfling'} of a {prose(4, i)}"
        docs.append((i, " ".join(parts), "en", "s", 1))
        labels.append((i, 1, i % 2))
    labels += [(3, 0, 0), (None, 1, 1), (999, 1, 1), (5, None, None), (7, 1, 7)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    return frame, toxicity.train(frame, spark.createDataFrame(labels, LABELS))


def test_finds_the_document_and_the_sentence(spark, taught):
    docs, model = taught
    for r in toxicity.score(docs, model).collect():
        assert r.predicted == r.doc_id % 2 and 0 <= r.score <= 1
    text = f"{prose(10, 5)} {prose(10, 6)} What a gromb that is! {prose(10, 7)}"
    row = toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [text[s.start : s.stop].strip() for s in row.sentences] == ["What a gromb that is"]


def test_document_score_is_the_noisy_or_of_sentences(taught):
    scorer = taught[1].scorer()
    p = [scorer(s)[0] for s in ("the gromb.", "a snarfling", "cold stone")]
    both = scorer("the gromb. a snarfling! cold stone")[0]
    assert both == pytest.approx(1 - (1 - p[0]) * (1 - p[1]) * (1 - p[2]))


def test_odd_rows_and_filter(spark, taught):
    docs, model = odd_documents(spark), taught[1]
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count()
    assert all(r.score == 0 and not r.sentences for r in got if r.doc_id in (4, 5, 6))
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and sorted(map(repr, kept.collect())) == sorted(map(repr, docs.collect()))
    assert {r.doc_id for r in toxicity.drop_toxic(taught[0], model).collect()} == set(range(0, 120, 2))


def test_nothing_to_learn_from(spark):
    none = toxicity.train(no_documents(spark), spark.createDataFrame([], LABELS))
    assert toxicity.score(no_documents(spark), none).count() == 0
    assert toxicity.score(odd_documents(spark), none).where("score > 1e-6").count() == 0


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = QUERIES["op7_toxicity"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    caught = sum(r.predicted for r in held if r.toxic) / sum(r.toxic for r in held)
    blamed = sum(r.predicted for r in held if not r.toxic) / sum(not r.toxic for r in held)
    assert caught > 0.85 and blamed < 0.01


def sample(seed, docs=12, width=5):
    """Documents of some sentences with some of ``width`` features, as training has them."""
    rng, rows = np.random.default_rng(seed), []
    for i in range(docs):
        feature, sentence = [], []
        count = int(rng.integers(1, 5))
        for n in range(1, count + 1):
            own = sorted(rng.choice(width, rng.integers(0, width), replace=False).tolist())
            feature += own
            sentence += [n] * len(own)
        rows.append((i, i % 2, [*feature, -1], [*sentence, count]))
    kind = pa.list_(pa.int32())
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), kind, kind))], ["key", "y", "feature", "sentence"])


@pytest.mark.parametrize("seed", range(5))
def test_gradient_is_that_of_the_loss(seed):
    loss = toxicity._Loss(sample(seed), 5, {0: 70, 1: 6})
    theta = np.random.default_rng(seed).normal(0, 1, 6)
    unit = np.eye(6) * 1e-6
    numeric = [(loss.value(theta + u) - loss.value(theta - u)) / 2e-6 for u in unit]
    assert np.allclose(loss.gradient(theta), numeric, atol=1e-6)


def test_documents_score_as_in_training(spark):
    """What ``_fit`` minimises is the score that documents get, repeated words, stems and signs included."""
    texts = ["gromb gromb gromb grombing of stone. grombly!", "the river. stone stone gromb", "", "kind kindly kind words? stone", "gromb"]
    texts += [f"{prose(20, n)} calmly" for n in range(30)] + [f"{prose(9, n)} gromb grombs {prose(3, n)} kind" for n in range(30)]
    docs = spark.createDataFrame([(i, t, int("gromb" in t)) for i, t in enumerate(texts)], "doc_id long, text string, toxic int")
    schema = "key long, y int, feature array<int>, sentence array<int>"
    held = docs.selectExpr("doc_id key", "text", "toxic y").repartition(3).mapInArrow(toxicity._instances, schema).cache()
    telling = toxicity._telling(held, 4096, 1)
    table = held.mapInArrow(lambda batches: toxicity._only(batches, telling), schema).toArrow().sort_by("key")
    model = toxicity._fit(table, telling, {0: 32, 1: 33})
    assert min(model.weights.values()) < 0 < max(model.weights.values())
    theta = np.array([*[model.weights[int(f)] for f in telling], model.bias])
    _, total = toxicity._Loss(table, len(telling), {0: 32, 1: 33}).totals(theta)
    assert np.allclose([model.scorer()(t)[0] for t in texts], -np.expm1(-total), atol=1e-12)


def test_filter_of_no_rows(spark, taught):
    assert toxicity.drop_toxic(no_documents(spark), taught[1]).count() == 0
