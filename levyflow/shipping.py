"""Make the package importable in the executors' Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand the package to the workers, once per application.

    Functions that run in Python workers are pickled by reference, so without this they
    would only be found where the package is installed or in the working directory.
    """
    context, package = spark.sparkContext, Path(__file__).parent
    # No directory: imported from an archive, which was submitted with --py-files.
    if context.applicationId in _shipped or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="levyflow-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
