"""Time the headline queries and the whole levy job; prints one JSON line.

Each query runs twice and the second time counts, as the first compiles its code; ``first_runs`` has the
first times. ``epoch`` says where
an epoch of the regression job goes: all of it, and the part that a pass over the same blocks without
any arithmetic takes, which is planning, launching and moving blocks to the Python workers.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores. Query
results go to Spark's ``noop`` sink, which computes every row and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from levyflow import catalog
from levyflow.catalog.inputs import LEVY_PERIOD, levy
from levyflow.catalog.jobs import write_levy_text
from levyflow.config import LevyConfig
from levyflow.models.blocks import pack_blocks
from levyflow.models.descent import gradient_sums
from levyflow.plans import load_fact, run_classification, run_etl, run_regression, run_reports
from levyflow.plans.regression import levy_tasks, prepare
from levyflow.sources import scratch_path

# Queries inside the whole job are left out here: the job's stages are timed on their own.
SKIPPED = ("job_", "rf_metrics", "mlpc_metrics")


def session(cores: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("levyflow-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        # Loopback TCP to the Python workers waits 40 ms for an acknowledgement in every task.
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def timed(times: dict[str, float], name: str, work) -> None:
    started = time.perf_counter()
    work()
    times[name] = round(time.perf_counter() - started, 3)


def epoch_parts(spark: SparkSession, sf_dir: str, passes: int = 20) -> dict[str, float]:
    config = LevyConfig()
    train, _, _ = prepare(levy(spark, sf_dir), config.features, config.regression_label, config.fact_key)
    blocks = pack_blocks(train, [f"{c}_z" for c in config.features], "label_z")
    losses = [task.loss for task in levy_tasks(len(config.features))]
    thetas = [loss.start(1) for loss in losses]
    idle = blocks.data.select("block").mapInArrow(lambda batches: (b.slice(0, 0) for b in batches), "block binary")
    took = {}
    for name, work in (("pass", lambda: gradient_sums(blocks, losses, thetas)), ("idle_pass", idle.collect)):
        work()
        started = time.perf_counter()
        for _ in range(passes):
            work()
        took[name] = round((time.perf_counter() - started) / passes, 4)
    blocks.release()
    return took


def whole_job(spark: SparkSession, sf_dir: str, times: dict[str, float]) -> None:
    """The four jobs with their full settings: 100 and 400 epochs, 100 trees, 200 iterations."""
    text, out = write_levy_text(spark, sf_dir), scratch_path(spark, "bench")
    timed(times, "job_etl", lambda: run_etl(spark, text, out).collect())
    fact = load_fact(spark, out)
    timed(times, "job_reports", lambda: run_reports(spark, fact, out, period=LEVY_PERIOD))
    timed(times, "job_regression", lambda: run_regression(spark, fact, out).metrics.collect())
    timed(times, "job_classification", lambda: run_classification(spark, fact, out).metrics.collect())


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    chosen = {n: q for n, q in catalog.queries().items() if not n.startswith(SKIPPED)}
    spark.range(8).mapInArrow(lambda batches: batches, "id long").collect()  # start the workers
    for name, query in chosen.items():
        for run in (first, times):
            timed(run, name, lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save())
    whole_job(spark, sf_dir, times)
    stages = [n for n in times if n.startswith("job_")]
    times["job_all"] = round(sum(times[n] for n in stages), 3)
    total = sum(t for n, t in times.items() if n != "job_all")
    print(json.dumps({
        "metric": "total_seconds", "value": round(total, 3), "unit": "sec", "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"), "cores": int(os.environ.get("BENCH_CPUS", "8")),
        "first_runs": first, "epoch": epoch_parts(spark, sf_dir),
    }))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
