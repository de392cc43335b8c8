"""Row-wise operators: filter and enrich. Both work on streams unchanged."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_rows(df: DataFrame, condition: str) -> DataFrame:
    """Rows where ``condition`` is TRUE; a NULL verdict drops the row."""
    return df.filter(F.expr(condition))


def enrich(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add or replace columns in the given order.

    A later expression sees the earlier ones. Catalyst folds the chain into
    one projection.
    """
    for name, expression in columns.items():
        df = df.withColumn(name, F.expr(expression))
    return df
