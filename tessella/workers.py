"""Makes this package importable in Python workers, wherever the driver was started from.

A cluster gets the package with --py-files or an environment; in local mode workers inherit only PYTHONPATH and the working
directory. Functions sent to workers carry the context's environment, so the package's parent folder goes in there.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def reach_workers(spark: SparkSession) -> None:
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def importable(query: Callable) -> Callable:
    """A function (spark, ...) whose plans find the package in their workers."""

    @wraps(query)
    def run(spark: SparkSession, *args):
        reach_workers(spark)
        return query(spark, *args)

    return run
