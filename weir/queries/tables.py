"""Access to the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]


@cache
def _schema(spark: SparkSession, path: str) -> T.StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, its schema read from the files once per session."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)
