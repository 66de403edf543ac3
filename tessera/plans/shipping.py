"""Sends this package to the executors, which may not have it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package as a zip to the application, once; Spark hands it to every Python worker."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="package"), f"{root.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)
