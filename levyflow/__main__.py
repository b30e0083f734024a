"""``spark-submit --py-files levyflow.zip run.py <input> <output> <job>`` or ``python -m levyflow``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from levyflow.plans import load_fact, run_all, run_classification, run_etl, run_regression, run_reports


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="levyflow", description=__doc__)
    parser.add_argument("input", help="delimited text with a header line")
    parser.add_argument("output", help="base folder of tables, queries, metrics and loss curves")
    parser.add_argument("job", choices=["etl", "sql", "regression", "classification", "all"])
    chosen = parser.parse_args(arguments)
    # Neither master nor file system is set here: the launcher and the paths decide.
    spark = SparkSession.builder.appName("levyflow").getOrCreate()
    try:
        if chosen.job == "etl":
            run_etl(spark, chosen.input, chosen.output).show()
        elif chosen.job == "all":
            run_all(spark, chosen.input, chosen.output).counts.show()
        else:
            fact = load_fact(spark, chosen.output)
            job = {"sql": run_reports, "regression": run_regression, "classification": run_classification}
            job[chosen.job](spark, fact, chosen.output)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
