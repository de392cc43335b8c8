"""Cubes, rollups and other sets of groupings, from one aggregate at the finest level."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The measures that add up from finer groups.
MEASURES = ("sum", "count", "min", "max", "avg")


def cube_sets(columns: Sequence[str]) -> list[tuple[str, ...]]:
    return [some for size in range(len(columns), -1, -1) for some in combinations(columns, size)]


def rollup_sets(columns: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(columns[:size]) for size in range(len(columns), -1, -1)]


def grouping_sets(
    df: DataFrame,
    sets: Sequence[Sequence[str]],
    measures: Mapping[str, tuple[str, str]],
    grouping_id: str = "grouping_id",
) -> DataFrame:
    """Measures for each set of columns: the columns, the ``grouping_id``, the measures.

    ``measures`` maps names to (function, SQL expression); count counts values that
    are not NULL, so ``("count", "1")`` counts rows. The facts are grouped once, by
    all columns together; that result is expanded, one row per set and finest
    group, not one per set and fact, and added up. In ``grouping_id`` the last
    column is the lowest bit; a set bit means that the row is over all its values,
    which tells such a row from a NULL group.
    """
    columns = list(dict.fromkeys(c for some in sets for c in some))
    for name, (function, _) in measures.items():
        if function not in MEASURES:
            raise ValueError(f"{name}: {function!r} does not add up from finer groups; use one of {MEASURES}")
    if not measures or not sets:
        raise ValueError("give at least one set and one measure")
    parts: list[Column] = []
    whole: list[Column] = []
    for i, (name, (function, text)) in enumerate(measures.items()):
        value, part = F.expr(text), f"_m{i}"
        if function == "avg":
            parts += [F.sum(value).alias(part), F.count(value).alias(f"{part}n")]
            whole.append((F.sum(part) / F.sum(f"{part}n")).alias(name))
        elif function == "count":
            parts.append(F.count(value).alias(part))
            whole.append(F.coalesce(F.sum(part), F.lit(0)).alias(name))
        else:
            parts.append(getattr(F, function)(value).alias(part))
            whole.append(getattr(F, function)(part).alias(name))
    finest = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(*parts)
    if not columns:
        return finest.agg(*whole).select(F.lit(0).cast("long").alias(grouping_id), "*")
    named = [[F.col(f"`{c}`") for c in some] for some in sets]
    over = finest.groupingSets(named, *[F.col(f"`{c}`") for c in columns])
    return over.agg(F.grouping_id().cast("long").alias(grouping_id), *whole)
