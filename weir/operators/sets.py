"""Unions, intersections and differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = 10_000  # rows that one step of repeating makes at most


def union_frames(frames: Sequence[DataFrame], distinct: bool = False) -> DataFrame:
    """Rows of all frames, matched by position; duplicates stay by default.

    ``distinct=True`` removes equal rows, most of them before the shuffle.
    """
    if not frames:
        raise ValueError("give at least one frame")
    if not isinstance(distinct, bool):
        raise TypeError("distinct is True or False")
    united = reduce(DataFrame.union, frames)
    return united.distinct() if distinct else united


def intersect(left: DataFrame, right: DataFrame, keep_all: bool = False) -> DataFrame:
    """Rows that both frames have, matched by position: once, or as often as the side with fewer has them."""
    return _by_counts(left, right, F.least("_l", "_r"), keep_all)


def subtract(left: DataFrame, right: DataFrame, keep_all: bool = False) -> DataFrame:
    """Rows of ``left`` that ``right`` lacks: once, or ``left``'s copies beyond those of ``right``."""
    more = F.col("_l") - F.col("_r") if keep_all else F.when(F.col("_r") == 0, F.col("_l")).otherwise(0)
    return _by_counts(left, right, more, keep_all)


def _by_counts(left: DataFrame, right: DataFrame, copies: Column, keep_all: bool) -> DataFrame:
    """Equal rows of both sides are counted in every task and meet in one shuffle; NULLs are equal."""
    names = [f"_c{i}" for i in range(len(left.columns))]
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    sides = left.toDF(*names).select("*", one.alias("_l"), none.alias("_r"))
    sides = sides.union(right.toDF(*names).select("*", none, one))
    counts = sides.groupBy(*names).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    kept = counts.select(*names, copies.alias("_n")).filter("_n > 0")
    if keep_all:  # in two steps, so that no row makes a long array
        steps = kept.withColumn("_first", F.explode(F.sequence(F.lit(1).cast("long"), "_n", F.lit(COPIES).cast("long"))))
        left_over = F.least(F.col("_n") - F.col("_first") + 1, F.lit(COPIES))
        kept = steps.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), left_over)))
    return kept.select(*names).toDF(*left.columns)
