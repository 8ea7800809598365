"""Spark operators for operations data and, in :mod:`gridmill.llm`, for training corpora."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies on a path that they share with
    the driver. On a cluster without such a path, submit it with ``--py-files``."""
    root = str(Path(__file__).resolve().parent.parent)
    held = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in held.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{held}".rstrip(":")
