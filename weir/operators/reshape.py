"""Pivot and unpivot."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.operators.aggregates import NAMED_FUNCTIONS


def pivot(
    df: DataFrame,
    group_by: Sequence[str],
    pivot_column: str,
    aggregate_column: str | None = None,
    agg: str = "sum",
    values: Sequence[Any] | None = None,
    rest: str | None = None,
) -> DataFrame:
    """Turn the values of ``pivot_column`` into columns.

    Without ``aggregate_column`` each cell counts rows. Empty cells are NULL.
    Naming the ``values`` fixes the result columns and saves the extra job
    that looks them up. Rows with another value, or NULL, are then counted in
    the column ``rest``; without one such a row is an error, not a silent loss.
    """
    names = None
    if values:
        names = [str(v).lower() if isinstance(v, bool) else str(v) for v in values]
        value = F.col(pivot_column)
        label = F.coalesce(*[F.when(value == F.lit(v), name) for v, name in zip(values, names)])
        if rest is None:
            found = F.coalesce(value.cast("string"), F.lit("NULL"))
            other = F.raise_error(F.concat(F.lit(f"{pivot_column} has a value that is not listed: "), found)).cast("string")
        else:
            other = F.lit(rest)
            names.append(rest)
        df = df.withColumn(pivot_column, F.coalesce(label, other))
    grouped = df.groupBy(*group_by).pivot(pivot_column, names)
    if aggregate_column is None:
        return grouped.agg(F.count(F.lit(1)))
    if agg.lower() not in NAMED_FUNCTIONS:
        raise ValueError(f"pivot aggregate must be one of {sorted(NAMED_FUNCTIONS)}: {agg}")
    return grouped.agg(NAMED_FUNCTIONS[agg.lower()][0](F.col(aggregate_column)))


def unpivot(
    df: DataFrame,
    value_columns: Sequence[str],
    variable_name: str,
    value_name: str,
    id_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Wide to long; NULL values keep their row. No shuffle."""
    if not value_columns:
        raise ValueError("give at least one value column")
    if id_columns is None:
        id_columns = [c for c in df.columns if c not in value_columns]
    return df.unpivot(list(id_columns), list(value_columns), variable_name, value_name)
