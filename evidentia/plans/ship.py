"""Sends this package to the executors, whose Python may not have it on its path."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application, adds a zip of the package to what Python workers import from."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    to = Path(tempfile.mkdtemp(prefix="evidentia-")) / f"{package.name}.zip"
    with zipfile.ZipFile(to, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(to))
    _sent.add(context.applicationId)
