"""The folder all executors share, for written intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a temporary folder; on a
    cluster that would differ from machine to machine, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all nodes share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@cache
def _own_folder() -> str:
    # The setting can't be changed in a running session; one folder per process does.
    folder = tempfile.mkdtemp(prefix="fleetstream-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
