"""Tables stored by key: what merges give, and that stored rows stay where they are."""

import random
import re
from pathlib import Path

import pytest

from levyflow.operators.ranking import dedupe_by, latest_by
from levyflow.plans.keyed import merge_keyed, merged_rows, newest, open_keyed, store_keyed

SCHEMA = "k int, at int, v string, extra array<int>"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(repr, df.collect()))


def made(seed, n=300):
    rng = random.Random(seed)
    keys = [None, 7, 7, 7, *range(20)]  # one key holds a good part, and null is a key
    return [(rng.choice(keys), rng.choice([None, *range(5)]), rng.choice(["a", "b", "", None]), rng.choice([[1], [], None]))
            for _ in range(n)]


@pytest.mark.parametrize("cuts", [(0,), (100, 101), (50, 150, 250), (300,)])
def test_any_merges_give_the_table_of_one(spark, tmp_path, cuts):
    rows = made(1)
    whole = spark.createDataFrame(rows, SCHEMA)
    parts = [rows[a:b] for a, b in zip((0, *cuts), (*cuts, len(rows)))]
    random.Random(len(cuts)).shuffle(parts)
    frames = [spark.createDataFrame(p, SCHEMA).select("v", "extra", "k", "at") for p in parts]
    store_keyed(frames[0].select("k", "at", "v", "extra"), str(tmp_path), ["k"], ["at"], buckets=3)
    for frame in [*frames[1:], frames[-1]]:  # the last one twice
        table = merge_keyed(frame, str(tmp_path))
    assert rows_of(table.rows(spark)) == rows_of(newest(whole, ["k"], ["at"]))
    assert table.rows(spark).columns == ["k", "at", "v", "extra"]


def test_the_row_kept_is_the_newest_and_then_the_lowest(spark, tmp_path):
    store_keyed(spark.createDataFrame([(1, 5, "b", [2]), (1, None, "a", None), (2, None, "z", None)], SCHEMA), str(tmp_path), ["k"], ["at"])
    table = merge_keyed(spark.createDataFrame([(1, 5, "a", [9]), (2, None, "y", None), (1, 4, None, None)], SCHEMA), str(tmp_path))
    assert rows_of(table.rows(spark)) == rows_of(spark.createDataFrame([(1, 5, "a", [9]), (2, None, "y", None)], SCHEMA))


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("keyed"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    store_keyed(orders, root, ["o_custkey"], ["o_orderdate", "o_orderkey"], buckets=6)
    return root, orders


def test_stored_rows_are_not_shuffled(spark, stored):
    rows = open_keyed(spark, stored[0]).rows(spark)
    for df in (dedupe_by(rows, ["o_custkey"]), latest_by(rows, ["o_custkey"], ["o_orderdate"], ["o_orderpriority"]),
               rows.groupBy("o_custkey").count()):
        text = plan(df)
        assert "Exchange" not in text and "SelectedBucketsCount: 6 out of 6" in text


def test_a_merge_sends_the_new_rows_only(spark, stored):
    root, orders = stored
    text = plan(merged_rows(open_keyed(spark, root), orders))
    above, below = text.split("Union", 1)
    assert "Exchange" not in above
    scan, sent = re.split(r"\n *\+- Exchange", below, maxsplit=1)
    assert "Bucketed: true" in scan and "Exchange" not in scan
    # Of the new rows, one of each key and task is sent.
    assert "Bucketed: true" not in sent and "row_number(), 1, Partial" in sent


def test_a_bucket_is_a_file(spark, stored):
    table = open_keyed(spark, stored[0])
    assert len(list(Path(f"{table.root}/{table.folder}").glob("part-*.parquet"))) == 6


def test_tables_of_as_many_buckets_join_in_place(spark, stored):
    rows = open_keyed(spark, stored[0]).rows(spark)
    other = open_keyed(spark, stored[0]).rows(spark).withColumnRenamed("o_orderpriority", "p")
    text = plan(rows.join(other.hint("merge"), "o_custkey"))
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_versions_and_what_lost_jobs_leave(spark, tmp_path):
    root = str(tmp_path)
    first = store_keyed(spark.createDataFrame(made(2), SCHEMA), root, ["k"], ["at"], buckets=2)
    before, opened = rows_of(first.rows(spark)), first.rows(spark)
    (tmp_path / "rows-lost").mkdir()  # a job that was lost before it named its version
    (tmp_path / "rows-lost" / "part-0.parquet").write_text("x")
    second = merge_keyed(spark.createDataFrame(made(3), SCHEMA), root)
    assert rows_of(opened) == before and open_keyed(spark, root) == second and second.version == 2
    merge_keyed(spark.createDataFrame([], SCHEMA), root)
    assert not (tmp_path / first.folder).exists() and (tmp_path / second.folder).exists()
    assert rows_of(open_keyed(spark, root).rows(spark)) == rows_of(second.rows(spark))
    assert not spark.sql("SHOW TABLES").where("tableName like 'levyflow%'").count()


def test_a_merge_that_comes_second_fails(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    store_keyed(spark.createDataFrame(made(2), SCHEMA), root, ["k"], ["at"], buckets=2)
    (tmp_path / "versions" / "2").mkdir()  # named by the merge that was faster
    with pytest.raises(Exception, match="(?i)already.exists"):
        merge_keyed(spark.createDataFrame(made(3), SCHEMA), root)
    assert open_keyed(spark, root).version == 1


def test_a_table_that_outgrows_its_buckets_is_dealt_anew(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("levyflow.plans.keyed.shuffle_width", lambda stored, current: 9)
    root, rows = str(tmp_path), made(4)
    store_keyed(spark.createDataFrame(rows[:10], SCHEMA), root, ["k"], ["at"], buckets=2)
    table = merge_keyed(spark.createDataFrame(rows, SCHEMA), root)
    assert table.buckets == 9
    assert rows_of(table.rows(spark)) == rows_of(newest(spark.createDataFrame(rows, SCHEMA), ["k"], ["at"]))


def test_empty_tables_and_odd_names(spark, tmp_path):
    odd = "`a b` int, `sel``ect` string"
    root = str(tmp_path / "it's here")
    store_keyed(spark.createDataFrame([], odd), root, ["a b"], buckets=2)
    assert open_keyed(spark, root).rows(spark).count() == 0
    table = merge_keyed(spark.createDataFrame([(1, "x"), (1, "w")], odd), root)
    assert [tuple(r) for r in table.rows(spark).collect()] == [(1, "w")]


def test_what_is_refused(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    root = str(tmp_path)
    with pytest.raises(ValueError, match="no keyed table"):
        merge_keyed(df, root)
    with pytest.raises(ValueError, match="no such columns"):
        store_keyed(df, root, ["z"])
    with pytest.raises(ValueError, match="needs a key"):
        store_keyed(df, root, [])
    store_keyed(df, root, ["k"], buckets=1)
    with pytest.raises(ValueError, match="already"):
        store_keyed(df, root, ["k"])
    with pytest.raises(ValueError, match="not those of the table"):
        merge_keyed(df.withColumn("w", df.v), root)
