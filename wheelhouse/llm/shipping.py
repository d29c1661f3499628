"""This package on the Python path of the executors, wherever the driver has it from."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package's source (well under 1 MB) to Spark once per application, which hands it to all executors.

    Spark serves the file from the driver, also to executors that join later, so it stays until the driver ends.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    folder = os.path.realpath(tempfile.mkdtemp(prefix="wheelhouse-source-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "wheelhouse_source.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
