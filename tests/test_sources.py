import json
from pathlib import Path

import pytest
from pyspark.sql import Row

from levyflow.sources import (
    read_delimited,
    read_rejects,
    read_table,
    scratch_path,
    write_loss_curve,
    write_single_file,
    write_table,
)


def test_delimited_text_is_all_strings_and_empty_is_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;amount;code\n1;1,257.60;007\n2;;"x;y"\n3\n')
    got = read_delimited(spark, str(tmp_path))
    assert got.dtypes == [("id", "string"), ("amount", "string"), ("code", "string")]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [
        ("1", "1,257.60", "007"), ("2", None, "x;y"), ("3", None, None),
    ]


def test_given_columns_must_agree_with_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;amount\n1;5\n")
    assert read_delimited(spark, str(tmp_path), columns=["id", "amount"]).first() == Row(id="1", amount="5")
    with pytest.raises(Exception, match="header does not conform"):
        read_delimited(spark, str(tmp_path), columns=["amount", "id"]).collect()


def test_files_with_another_column_order_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;amount\n1;5\n")
    (tmp_path / "b.csv").write_text("amount;id\n5;1\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_delimited(spark, str(tmp_path)).collect()


def test_json_keeps_order_types_and_empty_columns_only_with_a_schema(spark, tmp_path):
    rows = spark.createDataFrame([(1, "000123", None), (2, "04", None)], "z int, code string, nothing double")
    path = str(tmp_path / "t.json")
    write_table(rows, path, "json")
    assert (tmp_path / "t.json" / "_SUCCESS").exists()
    back = read_table(spark, path, rows.schema, "json")
    assert back.dtypes == rows.dtypes
    assert sorted(map(tuple, back.collect())) == [(1, "000123", None), (2, "04", None)]
    inferred = read_table(spark, path, fmt="json")
    assert inferred.dtypes == [("code", "string"), ("z", "bigint")]


def test_partitioned_table_comes_back_in_schema_order(spark, tmp_path):
    rows = spark.createDataFrame([(2024, 1.5), (2025, 2.5), (None, 3.5)], "period int, v double")
    path = str(tmp_path / "t")
    write_table(rows, path, "parquet", ["period"])
    back = read_table(spark, path, rows.schema)
    assert back.columns == ["period", "v"]
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_single_file_and_loss_curve(spark, tmp_path):
    write_single_file(spark.range(100, numPartitions=7), str(tmp_path / "one.json"))
    assert len(list((tmp_path / "one.json").glob("part-*.json"))) == 1
    write_loss_curve(spark, "svr", [(1, 0.5), (2, 0.25)], str(tmp_path))
    [part] = (tmp_path / "loss_curves" / "svr_loss.json").glob("part-*.json")
    assert [json.loads(line) for line in part.read_text().splitlines()] == [
        {"epoch": 1, "loss": 0.5}, {"epoch": 2, "loss": 0.25},
    ]


def test_scratch_is_below_the_named_folder_and_fresh(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert one != two and (root is None or one.startswith(root))
    assert Path(one).is_dir()


def test_rejects_name_the_file_the_line_and_the_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;amount;day\n1;1,257.60;007\n2;;"x;y"\n3\n4;5;6;7\n5;1.2.3;x\n')
    (tmp_path / "b.csv").write_text("id;amount;day\n6;1e3;2025.7\n7;1,2;8\n")
    columns = ["id", "amount", "day"]
    got = read_rejects(spark, str(tmp_path), columns, numbers=["amount"], integers=["id", "day"])
    assert got.columns == ["file", "line", "column", "reason"]
    rows = sorted((Path(r.file).name, r.line, r.column or "", r.reason) for r in got.collect())
    assert rows == [
        ("a.csv", "2;;x;y", "day", "integer"), ("a.csv", "3", "", "fields"), ("a.csv", "4;5;6;7", "", "fields"),
        ("a.csv", "5;1.2.3;x", "amount", "number"), ("a.csv", "5;1.2.3;x", "day", "integer"),
    ]
    strict = read_rejects(spark, str(tmp_path / "b.csv"), columns, numbers=["amount"], strict=True)
    assert [(r.line, r.reason) for r in strict.collect()] == [("7;1,2;8", "number")]
    with pytest.raises(Exception, match="header does not conform"):
        read_rejects(spark, str(tmp_path), ["amount", "id", "day"]).collect()


def test_no_rejects_in_clean_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;amount\n1;5\n2;\n")
    assert read_rejects(spark, str(tmp_path), ["id", "amount"], numbers=["amount"], integers=["id"]).collect() == []
