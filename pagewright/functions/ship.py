"""Sends this package to the Python workers, so that a job needs no installation on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Adds the package as a zip file to the session's context, once per context."""
    context = spark.sparkContext
    if getattr(context, "_pagewright_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="pagewright-code-"), "pagewright_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    context.addPyFile(path)
    context._pagewright_shipped = True
