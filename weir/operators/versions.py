"""Change logs as validity intervals, and lookups as of each row's own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.operators.scans import filled_forward, shifted


def validity_intervals(
    changes: DataFrame,
    key: Sequence[str],
    time: str,
    tie_break: Sequence[str] = (),
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    slices: int | None = None,
) -> DataFrame:
    """Each version with the time from which it holds and that at which the next one replaces it.

    The last version of a key has no end. Of versions at one time the last by
    ``tie_break`` holds; the others stay, with an empty interval.
    """
    order = [F.col(f"`{c}`") for c in (time, *tie_break)]
    ended = shifted(changes, key, order, {valid_to: (time, 1)}, slices)
    return ended.withColumn(valid_from, F.col(f"`{time}`")).select(*changes.columns, valid_from, valid_to)


def as_of_join(
    facts: DataFrame,
    changes: DataFrame,
    key: Sequence[str],
    fact_time: str,
    change_time: str,
    tie_break: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """``facts`` with the version of their key that held at their own time; NULLs where there was none yet.

    Of versions at one time the last by ``tie_break`` counts; a version holds from
    its own instant on. Facts without a time or key get NULLs. Both frames are
    sorted together into ranges of (key, time), and the last version before a
    range is carried into it, so no task holds all rows of a key. Apart from the
    key the frames have different column names.
    """
    clash = (set(facts.columns) & set(changes.columns)) - set(key)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    theirs = [c for c in changes.columns if c not in key]
    keys = [F.col(f"`{c}`") for c in key]
    known = changes.filter(F.col(f"`{change_time}`").isNotNull())
    versions = known.select(
        *keys, F.col(f"`{change_time}`").alias("_time"), F.lit(0).alias("_kind"),
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in tie_break]).alias("_tie"),
        F.struct(*[F.col(f"`{c}`") for c in theirs]).alias("_version"),
    )
    asked = facts.select(
        *keys, F.col(f"`{fact_time}`").alias("_time"), F.lit(1).alias("_kind"),
        F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_fact"),
    )
    both = versions.unionByName(asked, allowMissingColumns=True)
    # versions before facts of the same time; a fact without a time comes before all
    filled = filled_forward(both, key, ["_time", "_kind", "_tie"], {"_held": "_version"}, slices)
    found = filled.filter("_kind = 1")
    held = F.col("_held")
    for one in keys:
        held = F.when(one.isNotNull(), held)
    found = found.withColumn("_held", F.when(F.col("_time").isNotNull(), held))
    return found.select("_fact.*", *[F.col("_held")[c].alias(c) for c in theirs])
