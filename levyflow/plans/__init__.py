"""Whole jobs over the levy data set."""

from levyflow.plans.classification import run_classification
from levyflow.plans.etl import build_tables, load_fact, load_raw, run_etl
from levyflow.plans.incremental import load_increment
from levyflow.plans.keyed import KeyedTable, merge_keyed, open_keyed, store_keyed
from levyflow.plans.regression import run_regression
from levyflow.plans.reports import period_summary, run_reports, top_properties
from levyflow.plans.run import run_all

__all__ = [
    "KeyedTable",
    "build_tables",
    "load_fact",
    "load_increment",
    "load_raw",
    "merge_keyed",
    "open_keyed",
    "period_summary",
    "run_all",
    "run_classification",
    "run_etl",
    "run_regression",
    "run_reports",
    "store_keyed",
    "top_properties",
]
