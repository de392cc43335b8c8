"""Window functions without a window's bottleneck: two-pass prefix scans.

A window puts all rows of a key, or the whole table, in one task. Here rows are
sorted into ranges of (key, order); each range is one slice of each of its keys
and bounded by the range partitioning. The first pass works inside the slices
and leaves one row per slice and key; what came before a slice follows from
those few rows; the second pass adds it to the rows.

The sorted rows are written to the checkpoint folder, so that a lost executor
cannot move the ranges. Orders are column names or sort columns such as
``F.desc("price")``; they should tell the rows of a key apart, or rows of equal
order share one slice, and their place among each other is open.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.scratch import checkpointed

Order = Sequence[str | Column]
SLICE, BEFORE = "_slice", "_before"


def _sliced(df: DataFrame, by: Sequence[str], order: Order, slices: int | None) -> DataFrame:
    """Sorted into ranges, with the number of the range; cut from its lineage."""
    names = [F.col(f"`{c}`") for c in by]
    ranged = df.repartitionByRange(*([slices] if slices else []), *names, *order)
    return checkpointed(ranged.withColumn(SLICE, F.spark_partition_id()))


def _carried(rows: DataFrame, by: Sequence[str], inside: Mapping[str, Column], over: Mapping[str, Column]) -> DataFrame:
    """Per key and slice what all earlier slices of the key add up to: one row per slice and key."""
    keys = [F.col(f"`{c}`") for c in by]
    counts = rows.groupBy(*keys, SLICE).agg(*[c.alias(name) for name, c in inside.items()])
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*keys, SLICE, *[c.over(earlier).alias(name) for name, c in over.items()])


def _with_carried(rows: DataFrame, carried: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join by key and slice; a NULL key meets itself."""
    theirs = carried.withColumnsRenamed({c: f"_k{i}" for i, c in enumerate([*by, SLICE])})
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*by, SLICE])]
    return rows.join(theirs, same).drop(*[f"_k{i}" for i in range(len(by) + 1)])


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Order,
    sums: Mapping[str, str] | None = None,
    row_number: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """``df`` with running sums per key, and the row's number from 1; an empty ``by`` runs over all rows.

    ``sums`` maps new columns to SQL expressions. NULLs add nothing; a sum is
    NULL until the first value.
    """
    sums = dict(sums or {})
    rows = _sliced(df, by, order, slices)
    names = {alias: f"_{BEFORE}{i}" for i, alias in enumerate(sums)}
    inside = {names[alias]: F.sum(F.expr(text)) for alias, text in sums.items()} | {"_rows": F.count(F.lit(1))}
    over = {name: F.sum(name) for name in [*names.values(), "_rows"]}
    within = Window.partitionBy(SLICE, *[F.col(f"`{c}`") for c in by]).orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = _with_carried(rows, _carried(rows, by, inside, over), by)
    for alias, text in sums.items():
        here, before = F.sum(F.expr(text)).over(upto), F.col(names[alias])
        done = done.withColumn(alias, F.coalesce(here + before, here, before))
    if row_number:
        done = done.withColumn(row_number, F.row_number().over(within) + F.coalesce("_rows", F.lit(0)))
    return done.drop(SLICE, "_rows", *names.values())


def ranked(
    df: DataFrame,
    by: Sequence[str],
    order: Mapping[str, str],
    rank: str = "rank",
    dense_rank: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """``df`` with the rank of each row in its key; ``order`` maps columns to ``asc`` or ``desc``.

    Equal values are counted before they are ranked, so many equal rows are one
    row of the scan, and the ranks are joined back by value.
    """
    for column, direction in order.items():
        if direction not in ("asc", "desc"):
            raise ValueError(f"{column}: {direction!r} is neither asc nor desc")
    values = [*by, *order]
    counted = df.groupBy(*[F.col(f"`{c}`") for c in values]).agg(F.count(F.lit(1)).alias("_n"))
    sorting = [F.asc(f"`{c}`") if direction == "asc" else F.desc(f"`{c}`") for c, direction in order.items()]
    numbered = running(counted, by, sorting, {"_upto": "_n"}, "_dense", slices)
    places = numbered.select(*[F.col(f"`{c}`").alias(f"_v{i}") for i, c in enumerate(values)], (F.col("_upto") - F.col("_n") + 1).alias(rank), F.col("_dense").cast("long").alias("_dense"))
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_v{i}")) for i, c in enumerate(values)]
    done = df.join(places, same).drop(*[f"_v{i}" for i in range(len(values))])
    return done.withColumnRenamed("_dense", dense_rank) if dense_rank else done.drop("_dense")


def shifted(
    df: DataFrame,
    by: Sequence[str],
    order: Order,
    columns: Mapping[str, tuple[str, int]],
    slices: int | None = None,
) -> DataFrame:
    """``df`` with values of other rows of its key: ``new: (column, offset)``, an offset of -1 is the row before.

    Rows find each other by their number in the key, so a hot key is spread by number.
    """
    numbered = checkpointed(running(df, by, order, row_number="_at", slices=slices))
    done = numbered
    for offset in sorted({offset for _, offset in columns.values()}):
        wanted = {alias: c for alias, (c, own) in columns.items() if own == offset}
        theirs = numbered.select(
            *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(by)],
            (F.col("_at") - offset).alias("_there"),
            *[F.col(f"`{c}`").alias(alias) for alias, c in wanted.items()],
        )
        same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)]
        done = done.join(theirs, [*same, F.col("_at") == F.col("_there")], "left")
        done = done.drop("_there", *[f"_k{i}" for i in range(len(by))])
    return done.drop("_at")


def filled_forward(
    df: DataFrame, by: Sequence[str], order: Order, columns: Mapping[str, str], slices: int | None = None
) -> DataFrame:
    """``df`` with the latest value of each column that is not NULL, the row's own included: ``new: column``."""
    rows = _sliced(df, by, order, slices)
    names = {alias: f"{BEFORE}{i}" for i, alias in enumerate(columns)}
    within = Window.partitionBy(SLICE, *[F.col(f"`{c}`") for c in by]).orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = rows
    for alias, column in columns.items():
        here = here.withColumn(alias, F.last(F.col(f"`{column}`"), ignorenulls=True).over(upto))
    here = here.withColumn("_at", F.row_number().over(within))
    inside = {names[alias]: F.max_by(F.col(f"`{alias}`"), F.col("_at")) for alias in columns}
    over = {name: F.last(name, ignorenulls=True) for name in names.values()}
    done = _with_carried(here, _carried(here, by, inside, over), by)
    for alias, name in names.items():
        done = done.withColumn(alias, F.coalesce(F.col(f"`{alias}`"), F.col(name)))
    return done.drop(SLICE, "_at", *names.values())
