"""Grouped and global aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The function names, and the suffix of the column each gives.
NAMED_FUNCTIONS = {
    "sum": (F.sum, "sum"),
    "avg": (F.avg, "avg"),
    "mean": (F.avg, "avg"),
    "count": (F.count, "count"),
    "min": (F.min, "min"),
    "max": (F.max, "max"),
}


def aggregate(
    df: DataFrame, group_by: Sequence[str], aggregations: Mapping[str, str]
) -> DataFrame:
    """Group and aggregate; an empty ``group_by`` aggregates all rows.

    Each entry is either ``column: function`` with one of the names above,
    giving ``<column>_<function>``, or ``alias: SQL aggregate``.
    """
    if not aggregations:
        raise ValueError("give at least one aggregation")
    return df.groupBy(*group_by).agg(*[measure(*item) for item in aggregations.items()])


def measure(name: str, function: str) -> Column:
    """One aggregate of a mapping as :func:`aggregate` takes it."""
    known = NAMED_FUNCTIONS.get(function.strip().lower())
    if known:
        call, suffix = known
        return call(F.col(name)).alias(f"{name}_{suffix}")
    if "(" not in function:
        raise ValueError(
            f"{function!r} is neither one of {sorted(NAMED_FUNCTIONS)} nor an SQL aggregate"
        )
    return F.expr(function).alias(name)
