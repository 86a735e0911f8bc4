"""This package on the executors, for the functions that run in Python there."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver found it."""
    context = spark.sparkContext
    if getattr(context, "_ships_this_package", None):
        return
    root = Path(__file__).resolve().parents[1]
    # Only the driver reads this file; executors fetch it from the driver.
    folder = tempfile.mkdtemp(prefix=f"{root.name}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, f"{root.name}.zip")
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(target)
    context._ships_this_package = True
