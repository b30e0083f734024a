import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from levyflow import LevyConfig
from levyflow.catalog.inputs import LEVY_PERIOD, levy
from levyflow.catalog.jobs import write_levy_text
from levyflow.catalog.classifiers import _CLASS_FEATURES, KEYS, _priced
from levyflow.config import RAW_COLUMNS
from levyflow.models import MlpLoss, SvrLoss, Task
from levyflow.plans import build_tables, load_fact, load_raw, run_classification, run_etl, run_regression
from levyflow.plans.classification import compare_classifiers, with_class_label
from levyflow.plans.etl import fact_schema
from levyflow.plans.regression import prepare
from levyflow.plans.reports import run_reports, top_properties

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("levy"))
    counts = {r["table"]: r["rows"] for r in run_etl(spark, write_levy_text(spark, SMALL), out).collect()}
    return out, counts


def test_etl_keeps_every_key_once(spark, stored):
    out, counts = stored
    source = levy(spark, SMALL)
    assert counts["raw"] == source.count()
    keys = source.select("COD_PREDIO", "COD_CONTRIBUYENTE", "PERIODO").distinct().count()
    assert counts["emisiones"] == keys
    assert counts["contribuyentes"] == source.select("COD_CONTRIBUYENTE").distinct().count()


def test_both_table_formats_hold_the_same_rows(spark, stored):
    out, _ = stored
    columnar = load_fact(spark, out)
    text = load_fact(spark, out, LevyConfig(table_formats=("json",)))
    assert columnar.schema == text.schema == fact_schema()
    assert columnar.exceptAll(text).isEmpty() and text.exceptAll(columnar).isEmpty()
    assert all(len(r["UBIGEO"]) == 6 for r in columnar.select("UBIGEO").distinct().collect())


def test_raw_columns_may_be_named_up_front(spark):
    path = write_levy_text(spark, SMALL)
    named = load_raw(spark, path, columns=RAW_COLUMNS)
    assert named.exceptAll(load_raw(spark, path)).isEmpty()


def test_malformed_money_fails_the_job_or_is_let_through(spark, tmp_path):
    header = ";".join(RAW_COLUMNS)
    row = "20250131;2025;T1;N;P1;100;1,257.60;abc;1;1;0;0;0;0;D;P;D;000001"
    (tmp_path / "raw.csv").write_text(f"{header}\n{row}\n")
    with pytest.raises(PySparkException, match="malformed number: abc"):
        run_etl(spark, str(tmp_path / "raw.csv"), str(tmp_path / "a"))
    lenient = LevyConfig(on_error="null", table_formats=("json",))
    run_etl(spark, str(tmp_path / "raw.csv"), str(tmp_path / "b"), lenient)
    fact = load_fact(spark, str(tmp_path / "b"), lenient).first()
    assert fact["MONTO_PARQUE_JARDIN"] == 1257.6 and fact["MONTO_SERENAZGO"] is None


def test_tables_do_not_depend_on_partitioning(spark):
    results = set()
    for n in (1, 3, 7):
        dimension, fact = build_tables(levy(spark, SMALL).repartition(n))
        results.add(tuple(
            t.agg(F.sum(F.xxhash64(*t.columns).cast("decimal(38,0)")), F.count(F.lit(1))).first()
            for t in (dimension, fact)
        ))
    assert len(results) == 1


def test_reports_obey_their_definitions(spark, stored):
    out, counts = stored
    summary, top = run_reports(spark, load_fact(spark, out), out, period=LEVY_PERIOD)
    assert sum(r["num_emisiones"] for r in summary.collect()) == counts["emisiones"]
    rows = top.collect()
    nets = [r["monto_total_neto"] for r in rows]
    assert len(rows) == 20 and nets == sorted(nets, reverse=True)
    assert {r["PERIODO"] for r in rows} == {LEVY_PERIOD}


def test_report_leaves_null_net_for_last(spark):
    rows = levy(spark, SMALL).where("PERIODO = 2000 AND PORCENTAJE_CONDOMINIO = 100").limit(3)
    gaps = rows.withColumn("MONTO_SERENAZGO", F.when(F.col("MONTO_RESIDUO_SOLIDO") > 0, F.lit(None)))
    mixed = rows.unionByName(gaps.withColumn("MONTO_SERENAZGO", F.col("MONTO_SERENAZGO").cast("double")))
    nets = [r["monto_total_neto"] for r in top_properties(spark, mixed, period=2000).collect()]
    assert nets[3:] == [None] * 3 and None not in nets[:3]


def test_regression_writes_metrics_and_curves(spark, stored):
    out, _ = stored
    tasks = [
        Task("MLPRegressor", MlpLoss(8, 4), 40, 0.05),
        Task("SVRegressor", SvrLoss(8, 0.1, 1e-4), 60, 0.2),
    ]
    run = run_regression(spark, load_fact(spark, out), out, tasks=tasks)
    metrics = {r["model"]: r for r in run.metrics.collect()}
    assert metrics["SVRegressor"]["r2"] > 0.9 and metrics["MLPRegressor"]["r2"] > 0.5
    variances = [m["mse"] / (1 - m["r2"]) for m in metrics.values()]
    assert variances[0] == pytest.approx(variances[1])  # same test rows
    curve = spark.read.json(f"{out}/loss_curves/mlp_regressor_loss.json")
    assert curve.count() == 40
    losses = [r["loss"] for r in curve.orderBy("epoch").collect()]
    assert all(b < a for a, b in zip(losses, losses[1:]))


def test_rows_without_label_or_feature_stay_out_of_regression(spark):
    rows = levy(spark, SMALL)
    gaps = rows.limit(10).withColumn("MONTO_SERENAZGO", F.lit(None).cast("double"))
    config = LevyConfig()
    train, test, _ = prepare(gaps.unionByName(rows), config.features, config.regression_label, config.fact_key)
    assert train.count() + test.count() == rows.count()


def test_scaling_can_be_fitted_on_train_rows_only(spark):
    config = LevyConfig()
    arguments = (levy(spark, SMALL), config.features, config.regression_label, config.fact_key)
    _, _, everything = prepare(*arguments)
    train, _, train_only = prepare(*arguments, fit_on="train")
    assert everything != train_only
    assert train.agg(F.avg("label_z")).first()[0] == pytest.approx(0.0, abs=1e-9)
    with pytest.raises(ValueError):
        prepare(*arguments, fit_on="test")


def test_class_label_follows_the_share(spark):
    shares = spark.createDataFrame([(100.0,), (99.9,), (None,)], "PORCENTAJE_CONDOMINIO double")
    labels = [r["TIPO_PREDIO"] for r in with_class_label(shares).collect()]
    assert labels == ["Exclusivo", "Compartido", "Compartido"]
    assert "PORCENTAJE_CONDOMINIO" not in LevyConfig().class_features


def test_classifiers_beat_the_majority_class(spark):
    metrics = compare_classifiers(
        _priced(spark, SMALL), "price_class", _CLASS_FEATURES, KEYS,
        standardized=True, with_baseline=True, trees=20, iterations=40,
    )
    accuracy = {r["model"]: r["accuracy"] for r in metrics.metrics.collect()}
    assert accuracy["RandomForest"] > accuracy["MajorityClass"] + 0.2
    assert accuracy["MLPClassifier"] > accuracy["MajorityClass"] + 0.2


def test_classification_writes_one_row_per_model(spark, stored):
    out, _ = stored
    run_classification(spark, load_fact(spark, out), out, trees=5, depth=4, iterations=10)
    [part] = Path(f"{out}/metrics/classification_metrics.json").glob("part-*.json")
    rows = [json.loads(line) for line in part.read_text().splitlines()]
    assert {r["model"] for r in rows} == {"RandomForest", "MLPClassifier"}
    assert all(list(r) == ["model", "accuracy", "precision", "recall", "f1"] for r in rows)


def test_files_of_a_period_do_not_grow_with_shuffle_width(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    text, files = write_levy_text(spark, SMALL), []
    try:
        for width in ("4", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            run_etl(spark, text, str(tmp_path / width))
            files.append(len(list((tmp_path / width / "tables/emisiones.parquet").rglob("part-*.parquet"))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    periods = levy(spark, SMALL).select("PERIODO").distinct().count()
    assert max(files) <= 2 * periods


def test_staging_is_gone_and_rejects_are_counted(spark, tmp_path, monkeypatch):
    from levyflow.plans import etl

    paths, make = [], etl.scratch_path
    monkeypatch.setattr(etl, "scratch_path", lambda s, label: paths.append(make(s, label)) or paths[-1])
    rows = ["20250131;2025;T1;N;P1;100;1,257.60;abc;1;1;0;0;0;0;D;P;D;000001",
            "20250131;2025;T1;N;P2;100;1.257,60;1;1;1;0;0;0;0;D;P;D;000001"]
    (tmp_path / "raw.csv").write_text("\n".join([";".join(RAW_COLUMNS), *rows]) + "\n")
    for strict, rejected in ((False, 1), (True, 2)):
        config = LevyConfig(on_error="null", strict_numbers=strict)
        counts = run_etl(spark, str(tmp_path / "raw.csv"), str(tmp_path / str(strict)), config).collect()
        assert ("rejected", rejected) in [tuple(r) for r in counts]
        assert "__rejected" not in load_fact(spark, str(tmp_path / str(strict)), config).columns
    assert len(paths) == 2 and not any(Path(p.removeprefix("file:")).exists() for p in paths)


def test_forest_takes_many_classes(spark):
    rows = spark.range(6000).select(
        F.col("id").alias("k"), F.concat(F.lit("c"), F.col("id") % 2000).alias("kind"), (F.col("id") % 2000).cast("double").alias("x"))
    gaps = rows.withColumn("x", F.when(F.col("k") > 4, F.col("x")))
    run = compare_classifiers(gaps, "kind", ["x"], ["k"], trees=1, depth=2, models=["RandomForest"], with_baseline=True)
    assert sum(run.rows.values()) == 6000 and run.rows["dropped"] == 5
    assert {r["model"] for r in run.metrics.collect()} == {"RandomForest", "MajorityClass"}


def test_classification_scaling_can_leave_test_rows_out(spark):
    rows = spark.range(400).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("kind"),
                                   F.col("id").cast("double").alias("x"))
    settings = dict(standardized=True, trees=2, depth=2, models=["RandomForest"])
    for fit_on in ("all", "train"):
        assert compare_classifiers(rows, "kind", ["x"], ["k"], fit_on=fit_on, **settings).metrics.count() == 1
    with pytest.raises(ValueError):
        compare_classifiers(rows, "kind", ["x"], ["k"], fit_on="test", **settings)
