"""Exact nearest-rank percentiles that never order a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.scratch import checkpointed

ACCURACY = 10_000
LEAF_ROWS = 4_000_000
BROADCAST_ROWS = 20_000  # of at most some kilobytes each
EVEN_CUTS = [i / 32 for i in range(1, 32)]


def nearest_rank(
    df: DataFrame,
    value: str,
    percentiles: Sequence[int],
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Value at position ``ceil(p / 100 * n)`` of each group, NULLs left out.

    Approximate quantiles just below and above each wanted one cut a group
    into slices. Counting all slices exactly tells which slice holds each rank
    and which position in it; only those thin slices, about ``4 / accuracy`` of
    the rows, are collapsed to distinct values and ordered. A slice of more
    than ``leaf_rows`` values is cut again first, as long as that makes it smaller.
    The cut points are fixed before use and only steer how thin the slices are,
    never the result. Where no group has more than ``leaf_rows`` rows, which is
    counted first, its distinct values are ordered as they are.

    Returns the ``by`` columns, ``percentile``, ``value`` and ``n``.
    """
    wished, keys = sorted(set(percentiles)), list(by)
    if not wished or wished[0] < 0 or wished[-1] > 100:
        raise ValueError("percentiles lie between 0 and 100")
    rows = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).alias("_v"), F.lit(1).cast("bigint").alias("_c")
    )
    most = rows.groupBy(*keys).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0] or 0
    if most <= leaf_rows:
        whole = rows.groupBy(*keys, "_v").agg(F.sum("_c").alias("_c"))
        group = Window.partitionBy(*keys)
        seen = whole.withColumn("_seen", F.sum("_c").over(group.orderBy("_v"))).withColumn("n", F.sum("_c").over(group))
        hits = seen.withColumn("percentile", F.explode(F.array(*[F.lit(p) for p in wished])))
        rank = F.greatest(F.lit(1), F.ceil(F.col("percentile") * F.col("n") / 100))
        found = hits.filter((rank <= F.col("_seen")) & (rank > F.col("_seen") - F.col("_c")))
        return found.select(*by, "percentile", F.col("_v").alias("value"), "n")
    sliced = _sliced(rows, "_s0", keys, _around(wished, 2 / accuracy), accuracy)
    targets = _fixed(_targets(sliced, "_s0", keys, wished))
    keys = [*keys, "_s0"]
    inside = _match(sliced, targets.select(*keys), keys)
    pool = inside.groupBy(*keys, "_v").agg(F.sum("_c").alias("_c"))

    largest = targets.agg(F.max("_rows")).first()[0] or 0
    depth = 0
    while largest > leaf_rows:  # values of a slice are distinct, so every cut makes it smaller
        depth, before = depth + 1, largest
        pool, part = checkpointed(pool), f"_s{depth}"
        sliced = _sliced(pool, part, keys, EVEN_CUTS, accuracy)
        targets = _fixed(_targets(sliced, part, keys, targets))
        keys = [*keys, part]
        pool = _match(sliced, targets.select(*keys), keys)
        largest = pool.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        if largest >= before:  # too close together to tell apart: ordered as it is
            break

    seen = F.sum("_c").over(Window.partitionBy(*keys).orderBy("_v"))
    hits = _match(pool.withColumn("_seen", seen), targets, keys).withColumn("_t", F.explode("_targets"))
    found = hits.filter((F.col("_t.rank") <= F.col("_seen")) & (F.col("_t.rank") > F.col("_seen") - F.col("_c")))
    return found.select(
        *by,
        F.col("_t.percentile").alias("percentile"),
        F.col("_v").alias("value"),
        F.col("_t.n").alias("n"),
    )


def _around(percentiles: Sequence[int], margin: float) -> list[float]:
    points = {min(max(p / 100 + side * margin, 0.0), 1.0) for p in percentiles for side in (-1, 1)}
    return sorted(points)


def _sliced(rows: DataFrame, part: str, keys: list[str], fractions: list[float], accuracy: int) -> DataFrame:
    """Number the slice of every row: how many cut points lie below its value."""
    sketch = F.percentile_approx("_v", fractions, accuracy).alias("_cuts")
    if keys:
        cut = _match(rows, _fixed(rows.groupBy(*keys).agg(sketch)), keys)
        points: list[Column] = [F.col("_cuts")[i] for i in range(len(fractions))]
    else:
        cut = rows
        points = [F.lit(point) for point in rows.agg(sketch).first()["_cuts"] or []]
    below = [F.when(F.col("_v") > point, 1).otherwise(0) for point in points]
    return cut.select(*keys, "_v", "_c", reduce(lambda a, b: a + b, below, F.lit(0)).alias(part))


def _targets(
    sliced: DataFrame, part: str, keys: list[str], asked: Sequence[int] | DataFrame
) -> DataFrame:
    """Slices that hold a wanted rank, with the ranks counted from their start.

    The windows run over the counted slices of a group: one row per slice.
    """
    upto = F.sum("_rows").over(Window.partitionBy(*keys).orderBy(part))
    sizes = (
        sliced.groupBy(*keys, part)
        .agg(F.sum("_c").alias("_rows"))
        .withColumn("_before", upto - F.col("_rows"))
    )
    if isinstance(asked, DataFrame):
        ranks = _match(sizes, asked.select(*keys, "_targets"), keys)
    else:
        counted = sizes.withColumn("n", F.sum("_rows").over(Window.partitionBy(*keys)))
        first = [
            F.struct(
                F.lit(p).alias("percentile"),
                F.col("n"),
                F.greatest(F.lit(1), F.ceil(p * F.col("n") / 100)).cast("bigint").alias("rank"),
            )
            for p in asked
        ]
        ranks = counted.withColumn("_targets", F.array(*first))
    placed = ranks.withColumn("_t", F.explode("_targets")).withColumn(
        "_rank", F.col("_t.rank") - F.col("_before")
    )
    return (
        placed.filter((F.col("_rank") >= 1) & (F.col("_rank") <= F.col("_rows")))
        .groupBy(*keys, part)
        .agg(
            F.max("_rows").alias("_rows"),
            F.collect_list(F.struct("_t.percentile", "_t.n", F.col("_rank").alias("rank"))).alias("_targets"),
        )
    )


def _fixed(df: DataFrame) -> DataFrame:
    """Checkpoint a small result; hint a broadcast once its row count proves it small."""
    done = checkpointed(df)
    return F.broadcast(done) if done.count() <= BROADCAST_ROWS else done


def _match(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join in which NULL group keys meet each other."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    same = [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in on]
    return left.join(renamed, same, "inner").drop(*[f"_r_{c}" for c in on])
