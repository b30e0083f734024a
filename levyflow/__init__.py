"""levyflow - billing and levy analytics as PySpark data jobs.

``functions``  column expressions (number cleaning, net amounts, labels, scaling)
``sources``    readers and writers for delimited text, JSON lines and Parquet
``operators``  DataFrame -> DataFrame steps (latest-by, dedupe, summaries, features, metrics)
``models``     distributed gradient descent (SVR, MLP) and the Spark ML classifiers
``plans``      whole jobs: ETL, reports, regression, classification, all of them
``catalog``    the checked queries over the shared test tables, each with its SQL twin
"""

from levyflow.config import LevyConfig

__all__ = ["LevyConfig"]
