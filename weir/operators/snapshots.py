"""Incremental and as-of views of tables that only grow."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newer_than(
    df: DataFrame,
    column: str,
    checkpoint: DataFrame,
    checkpoint_column: str,
    initial: Any = None,
) -> DataFrame:
    """Rows of ``df`` past the highest checkpoint value.

    The maximum is a scalar subquery, so the scan of ``df`` gets it as a
    pushed-down filter and skips row groups below it. An empty checkpoint
    starts from ``initial``; without one it selects nothing, as SQL does.
    """
    mark = F.max(checkpoint_column)
    if initial is not None:
        mark = F.coalesce(mark, F.lit(initial).cast(df.schema[column].dataType))
    return df.filter(F.col(column) > checkpoint.agg(mark).scalar())


def high_water_mark(df: DataFrame, column: str, alias: str = "last_processed") -> DataFrame:
    """The next checkpoint: one row with the highest value seen."""
    return df.agg(F.max(column).alias(alias))


def snapshot_as_of(
    change_log: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    as_of: Column | Any = None,
    time_column: str | None = None,
) -> DataFrame:
    """Latest version of every key in a change log, at or before ``as_of``.

    ``order`` names the columns that rank versions, most significant first;
    ``time_column`` (default: the first of them) is compared with ``as_of``.
    Map-side aggregation keeps one candidate per key and task, so a hot key
    shuffles little.
    """
    keys = [key] if isinstance(key, str) else list(key)
    source = change_log
    if as_of is not None:
        limit = as_of if isinstance(as_of, Column) else F.lit(as_of)
        source = source.filter(F.col(time_column or order[0]) <= limit)
    others = [c for c in change_log.columns if c not in keys]
    latest = source.groupBy(*keys).agg(
        F.max_by(F.struct(*others), F.struct(*order)).alias("_latest")
    )
    return latest.select(*keys, "_latest.*").select(*change_log.columns)
