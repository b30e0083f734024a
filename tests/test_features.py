import math

import numpy as np
import pytest
from pyspark.ml.feature import StandardScaler, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from levyflow.operators import (
    assemble,
    drop_invalid,
    feature_stats,
    fit_scaling,
    invalid_counts,
    label_frequencies,
    label_stats,
    random_split,
    standardize,
    train_test_split,
    without,
)

NAN = float("nan")
ROWS = [(1, 1.0, 5.0, 7.0, 1.0), (2, 2.0, None, 7.0, 2.0), (3, NAN, 6.0, 7.0, 3.0), (4, 4.0, 9.0, 7.0, None)]


def samples(spark):
    return spark.createDataFrame(ROWS, "id int, x1 double, x2 double, flat double, y double")


def test_drop_invalid_takes_null_and_nan_but_not_other_columns(spark):
    assert [r["id"] for r in drop_invalid(samples(spark), ["x1", "x2"]).collect()] == [1, 4]
    assert tuple(invalid_counts(samples(spark), ["x1", "x2"]).first()) == (4, 2, 2)


def test_assemble_skips_the_same_rows_in_both_forms(spark):
    vectors = assemble(samples(spark), ["x1", "x2"]).select("id", vector_to_array("features").alias("f"))
    arrays = assemble(samples(spark), ["x1", "x2"], "f", as_array=True).select("id", "f")
    assert vectors.collect() == arrays.collect()
    assert [r["f"] for r in arrays.collect()] == [[1.0, 5.0], [4.0, 9.0]]


def test_scaling_agrees_with_spark_ml_and_flattens_constant_columns(spark, sf_dir):
    columns = ["l_quantity", "l_tax", "flat"]
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("flat", F.lit(7.0)).limit(5000).cache()
    ours = standardize(lines, fit_scaling(lines, columns)).select(*columns).collect()
    vectors = assemble(lines, columns)
    model = StandardScaler(inputCol="features", outputCol="z", withMean=True, withStd=True).fit(vectors)
    theirs = model.transform(vectors).select(vector_to_array("z").alias("z")).collect()
    assert np.allclose(np.array(ours), np.array([r["z"] for r in theirs]), atol=1e-9)
    assert all(r["flat"] == 0.0 for r in ours)


def test_feature_std_is_of_the_sample_and_label_std_of_the_population(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    assert tuple(feature_stats(df, ["v"]).first()) == ("v", 2.0, pytest.approx(math.sqrt(2)))
    assert tuple(label_stats(df, "v").first()) == (2.0, 1.0)
    scaling = fit_scaling(df, ["v"], "v")
    assert scaling.features["v"][1] == pytest.approx(math.sqrt(2)) and scaling.label == (2.0, 1.0)


def test_label_std_has_a_floor(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert tuple(label_stats(df, "v").first()) == (4.0, 1e-6)
    assert fit_scaling(df, [], "v").label == (4.0, 1e-6)


def test_scaling_of_an_empty_table_is_refused(spark):
    with pytest.raises(ValueError):
        fit_scaling(spark.createDataFrame([], "v double"), ["v"])


def test_label_index_agrees_with_spark_ml(spark):
    labels = ["b", "a", "c", "c", "a", "d", "c"]
    df = spark.createDataFrame([(v,) for v in labels], "label string")
    ours = {r["label"]: r["index"] for r in label_frequencies(df, "label").collect()}
    theirs = StringIndexer(inputCol="label", outputCol="i").fit(df).labels
    assert [k for k, _ in sorted(ours.items(), key=lambda kv: kv[1])] == list(theirs)


def test_label_index_runs_through_all_partitions(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.col("id") % 700).alias("label"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # or the sort would be merged into one partition
    try:
        got = label_frequencies(df, "label")
        assert got.rdd.getNumPartitions() > 1
        rows = sorted(got.collect(), key=lambda r: r["index"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert [r["index"] for r in rows] == list(range(700))
    assert rows == sorted(rows, key=lambda r: (-r["rows"], r["label"]))


def test_label_index_of_nothing_is_empty(spark):
    assert label_frequencies(spark.createDataFrame([], "label string"), "label").collect() == []


def test_without_keeps_order():
    assert without(["a", "b", "c"], ["b"]) == ["a", "c"]


def test_split_depends_on_keys_and_seed_only(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey")
    keys = ["l_orderkey", "l_linenumber"]
    sizes, digests = set(), set()
    for n in (1, 3, 7):
        train, test = train_test_split(lines.repartition(n), keys)
        digests.add(train.agg(F.sum(F.xxhash64(*lines.columns).cast("decimal(38,0)"))).first()[0])
        sizes.add((train.count(), test.count()))
    assert len(sizes) == len(digests) == 1
    [(train_rows, test_rows)] = sizes
    assert train_rows + test_rows == lines.count()
    assert abs(train_rows / lines.count() - 0.8) < 0.01
    other, _ = train_test_split(lines, keys, seed=7)
    assert other.count() != train_rows


def test_split_keeps_rows_of_a_key_together(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    train, test = train_test_split(lines, ["l_orderkey"])
    assert train.select("l_orderkey").intersect(test.select("l_orderkey")).count() == 0


def test_random_split_covers_the_table(spark):
    train, test = random_split(spark.range(1000))
    assert train.count() + test.count() == 1000
