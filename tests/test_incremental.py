import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from levyflow import LevyConfig
from levyflow.catalog.inputs import levy_text
from levyflow.config import RAW_COLUMNS
from levyflow.plans import build_tables, incremental, load_increment, load_raw
from levyflow.plans.etl import dimension_schema, fact_schema
from levyflow.sources.readers import read_table

SMALL = "/root/testdata/sf0.001"


def line(cut, period, taxpayer, name, prop, amount="1.00"):
    return ";".join([cut, period, taxpayer, name, prop, "100", amount, "1", "1", "1", "0", "0", "0", "0", "D", "P", "D", "000001"])


def put(folder: Path, name: str, *lines: str) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([";".join(RAW_COLUMNS), *lines]) + "\n")


def tables(spark, out):
    return (read_table(spark, f"{out}/tables/contribuyentes.parquet", dimension_schema()),
            read_table(spark, f"{out}/tables/emisiones.parquet", fact_schema()))


def same(spark, source, out):
    for got, expected in zip(tables(spark, out), build_tables(load_raw(spark, str(source)))):
        assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def files(out, period):
    folder = Path(out) / "tables" / "emisiones.parquet" / f"PERIODO={period}"
    return {(f.name, f.stat().st_mtime_ns) for f in folder.glob("*.parquet")}


def counts(df):
    return {r["table"]: r["rows"] for r in df.collect()}


def test_loads_merge_by_key_and_touch_their_periods_only(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put(source, "a.csv", line("20230101", "2023", "T1", "Old", "P1"), line("20240101", "2024", "T1", "New", "P1"),
        line("20240101", "", "T3", "None", "P9"))
    assert counts(load_increment(spark, str(source), out)) == {"raw": 3, "periods": 3, "contribuyentes": 2, "emisiones": 3}
    before = files(out, 2023), files(out, 2024)
    put(source, "b.csv", line("20240201", "2024", "T1", "Newer", "P1", "2.00"), line("20230901", "2024", "T2", "B", "P2"),
        line("20240201", "", "T3", "Later", "P9"))
    assert counts(load_increment(spark, str(source), out)) == {"raw": 3, "periods": 2, "contribuyentes": 3, "emisiones": 4}
    assert files(out, 2023) == before[0] and not files(out, 2024) & before[1]
    same(spark, source, out)
    last = files(out, 2024)
    assert counts(load_increment(spark, str(source), out))["raw"] == 0
    assert files(out, 2024) == last
    assert incremental.read_manifest(spark, out).count() == 2


def test_order_of_loads_does_not_matter(spark, tmp_path):
    rows = levy_text(spark, SMALL)
    source, out = tmp_path / "in", str(tmp_path / "out")
    for part in (2, 0, 1):
        rows.where(F.pmod(F.xxhash64("COD_PREDIO", "FECHA_CORTE"), F.lit(3)) == part).write.option("header", True).option(
            "sep", ";").csv(str(source / f"part{part}"))
        load_increment(spark, str(source), out)
    same(spark, source / "*", out)


@pytest.mark.parametrize("at", range(3))
def test_a_load_that_broke_off_is_run_again(spark, tmp_path, monkeypatch, at):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put(source, "a.csv", line("20240101", "2024", "T1", "New", "P1"))
    if at != 1:
        load_increment(spark, str(source), out)
    put(source, "b.csv", line("20240201", "2024", "T1", "Newer", "P1"), line("20250201", "2025", "T2", "B", "P1"))
    replace, calls = incremental._replace, []

    def breaks(session, ready, target):
        calls.append(target)
        if len(calls) > at:
            # The worst place: the old folder is gone and the new one not there yet.
            session._jvm.org.apache.hadoop.fs.Path(target).getFileSystem(session._jsc.hadoopConfiguration()).delete(
                session._jvm.org.apache.hadoop.fs.Path(target), True)
            raise OSError("lost")
        replace(session, ready, target)

    monkeypatch.setattr(incremental, "_replace", breaks)
    with pytest.raises(OSError, match="lost"):
        load_increment(spark, str(source), out)
    monkeypatch.setattr(incremental, "_replace", replace)
    load_increment(spark, str(source), out)
    same(spark, source, out)
    assert incremental.read_manifest(spark, out).count() == 2


def test_changed_files_foreign_tables_and_other_formats_are_errors(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put(source, "a.csv", line("20240101", "2024", "T1", "New", "P1"))
    load_increment(spark, str(source), out)
    put(source, "a.csv", line("20240101", "2024", "T1", "Changed", "P1"))
    with pytest.raises(ValueError, match="changed.*a.csv"):
        load_increment(spark, str(source), out)
    tables(spark, out)[1].write.parquet(str(tmp_path / "other/tables/emisiones.parquet"))
    with pytest.raises(ValueError, match="not written by an incremental load"):
        load_increment(spark, str(source), str(tmp_path / "other"))
    with pytest.raises(ValueError, match="Parquet"):
        load_increment(spark, str(source), out, LevyConfig())


def test_no_files_and_empty_files(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    nothing = {"raw": 0, "periods": 0, "contribuyentes": 0, "emisiones": 0}
    assert counts(load_increment(spark, str(source), out)) == nothing
    (source / "empty.csv").touch()
    assert counts(load_increment(spark, str(source), out)) == nothing
    put(source, "head.csv")
    assert counts(load_increment(spark, str(source), out)) == nothing
    assert os.path.exists(f"{out}/manifest")
