"""What the jobs write and shuffle stays a small multiple of their input."""

from pathlib import Path

import pytest

from levyflow import sizing
from levyflow.catalog.inputs import levy, levy_text
from levyflow.catalog.jobs import write_levy_text
from levyflow.plans import etl, incremental, load_fact, load_increment, run_etl
from levyflow.plans.etl import build_tables, fact_schema, newest_bills
from levyflow.sizing import FILE_BYTES, dealt_width
from levyflow.sources import read_delimited, read_table, write_delimited, write_table, writers

SMALL = "/root/testdata/sf0.001"


def size(folder) -> int:
    return sum(f.stat().st_size for f in Path(folder).rglob("part-*"))


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_text_tables_are_compressed(spark, tmp_path):
    fact = levy(spark, SMALL).select(*fact_schema().names)
    write_table(fact, str(tmp_path / "t.json"), "json")
    fact.write.json(str(tmp_path / "plain.json"))
    assert 4 * size(tmp_path / "t.json") < size(tmp_path / "plain.json")
    assert rows_of(read_table(spark, str(tmp_path / "t.json"), fact_schema(), "json")) == rows_of(fact)
    text = write_levy_text(spark, SMALL)
    assert 2 * size(text) < sum(len(";".join(v or "" for v in r)) for r in levy_text(spark, SMALL).collect())
    assert rows_of(read_delimited(spark, text)) == rows_of(levy_text(spark, SMALL))


def test_text_files_stay_small_enough_for_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "TEXT_FILE_ROWS", 100)
    write_delimited(spark.range(1000, numPartitions=1), str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("part-*.csv.gz"))) == 10
    assert read_delimited(spark, str(tmp_path / "t")).count() == 1000


def test_tasks_write_to_all_periods_if_that_leaves_no_small_files():
    assert dealt_width(7 * 12 * FILE_BYTES - 1, 7, 12) is None
    assert dealt_width(7 * 12 * FILE_BYTES, 7, 12) == 12
    assert dealt_width(7 * 1024**3, 7, 12) == 84
    assert dealt_width(7 * 1024**3, 1000, 12) is None
    assert dealt_width(0, 0, 12) is None


@pytest.fixture(params=[1, FILE_BYTES], ids=["dealt", "rebalanced"])
def rebalanced(request, monkeypatch):
    """Whether fact tables were dealt to tasks by period once more, one after the other."""
    seen = []
    for module in (etl, incremental):
        def spy(df, path, fmt="parquet", partition_by=(), rebalance=True, write=module.write_table):
            seen.extend([rebalance] if partition_by else [])
            write(df, path, fmt, partition_by, rebalance)

        monkeypatch.setattr(module, "write_table", spy)
    monkeypatch.setattr(sizing, "FILE_BYTES", request.param)
    return seen, request.param > 1


def test_the_fact_table_is_the_same_either_way(spark, tmp_path, rebalanced):
    seen, expected = rebalanced
    width = spark.conf.get(sizing.SETTING)
    run_etl(spark, write_levy_text(spark, SMALL), str(tmp_path / "out"))
    assert seen == [expected] and spark.conf.get(sizing.SETTING) == width
    assert rows_of(load_fact(spark, str(tmp_path / "out"))) == rows_of(build_tables(levy(spark, SMALL))[1])


def test_loads_shuffle_no_more_than_the_job(spark, tmp_path, rebalanced):
    seen, expected = rebalanced
    for name, part in (("one", "UBIGEO < '000003'"), ("two", "UBIGEO >= '000003'")):
        write_delimited(levy_text(spark, SMALL).where(part), str(tmp_path / "in" / name))
        load_increment(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert seen == [expected, expected]
    fact = read_table(spark, str(tmp_path / "out/tables/emisiones.parquet"), fact_schema())
    assert rows_of(fact) == rows_of(build_tables(levy(spark, SMALL))[1])


def test_bills_leave_in_the_order_of_the_partitioned_table(spark):
    bills = levy(spark, SMALL).select(*fact_schema().names)
    plan = newest_bills(bills).sortWithinPartitions("PERIODO")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 2
