"""Samples of a bounded size per stratum that do not depend on the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def draw(seed: int, key: Sequence[str]) -> Column:
    """A text that looks random and depends on the seed and the key columns only."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("")) for c in key]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def sample_per(df: DataFrame, by: Sequence[str], rows: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """``rows`` random rows of every stratum, all where it has fewer; an empty ``by`` samples the whole.

    Those with the smallest draws are taken, so the same seed gives the same rows
    however they are spread, and a larger sample contains the smaller one. ``key``
    tells rows apart; rows of one key share a draw. Each task keeps ``rows`` of a
    stratum before the shuffle, and a hot stratum is thinned in ``SALTS`` parts
    before its last step.
    """
    if rows < 1:
        raise ValueError("rows is 1 or more")
    strata = [F.col(f"`{c}`") for c in by]
    drawn = df.withColumn("_draw", draw(seed, key)).withColumn("_salt", F.pmod(F.xxhash64("_draw"), F.lit(SALTS)))
    for some in ([*strata, F.col("_salt")], strata):
        place = F.row_number().over(Window.partitionBy(*some).orderBy("_draw"))
        drawn = drawn.withColumn("_place", place).filter(F.col("_place") <= rows).drop("_place")
    return drawn.drop("_draw", "_salt")
