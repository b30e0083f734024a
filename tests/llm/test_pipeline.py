"""The pipeline against its stages done plainly, and the registered queries with SQL twins."""

import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from levyflow.llm.catalog import ORACLES, QUERIES, train_toxicity
from levyflow.llm.secret_scan import candidates
from tests.llm.test_simhash import brute
from tests.oracle import compare, duck

SF_DIR = "/root/testdata/sf0.01"


def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = train_toxicity(spark, SF_DIR).scorer()
    inputs = [docs]
    for _, stage in corpus_pipeline.STAGES:
        inputs.append(stage(spark, inputs[-1], SF_DIR).cache())
    rows = [{r.doc_id: r for r in df.collect()} for df in inputs[:4]]
    assert all(df.columns == docs.columns for df in inputs[:4])

    clean = {i for i, r in rows[0].items() if model(r.text)[0] < 0.7}
    assert set(rows[1]) == clean and len(clean) < len(rows[0])
    groups = brute([(i, r.text) for i, r in rows[1].items()])
    assert set(rows[2]) == {i for i, _, c in groups if i == c}
    owners = defaultdict(set)
    for r in rows[2].values():
        for _, _, _, start, stop in candidates(r.text):
            owners[r.text[start:stop]].add(r.source)
    for i, r in rows[2].items():
        text = list(r.text)
        for _, _, _, start, stop in candidates(r.text):
            if len(owners[r.text[start:stop]]) <= 2:
                text[start:stop] = "*" * (stop - start)
        assert rows[3][i].text == "".join(text) and rows[3][i].n_chars == r.n_chars
    assert any(re.search(r"\*{16}", r.text) for r in rows[3].values())
    assert set(Counter(r.doc_id for r in inputs[4].collect())) == set(rows[3])


def test_run_is_the_stages_and_reads_everything(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns) and got.count() > 100


def test_every_operator_has_one_query():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, name):
    frame = QUERIES[name](spark, "/root/testdata/sf0.01").toPandas()
    if "refers_to" in frame:
        frame["refers_to"] = frame["refers_to"].astype("Int64")
    assert compare(frame, duck("/root/testdata/sf0.01"), ORACLES[name]).startswith("ok")
