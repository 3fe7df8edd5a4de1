"""What a session needs once: the package on the executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        into = Path(tempfile.mkdtemp(prefix="strandloom-zip-"))
        ignore = shutil.ignore_patterns("__pycache__")
        shutil.copytree(root, into / "src" / root.name, ignore=ignore)
        spark.sparkContext.addPyFile(shutil.make_archive(str(into / root.name), "zip", into / "src"))
        _shipped.add(app)
