"""Operators by event time: windows, sessions, interval joins, deduplication, late rows.

A watermark trails the latest event time by ``delay`` and bounds what a stream
has to remember: results are final, and leave the state, once it has passed
them. The operators take batch frames as well and give the same rows there.

A stream that ends would keep its last results open. :func:`with_end` adds a
source of end marks; a mark, written by :func:`mark_end`, moves the watermark
past everything and is left out of the results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weir.operators.aggregates import measure
from weir.operators.joins import join_type
from weir.scratch import scratch_path
from weir.streaming.streams import read_file_stream
from weir.streaming.triggers import parse_trigger

END = "_end"


def with_end(stream: DataFrame, folder: str) -> DataFrame:
    """The stream together with the end marks of ``folder``; a batch frame stays as it is."""
    if not stream.isStreaming:
        return stream
    spark = stream.sparkSession
    schema = T.StructType([*stream.schema.fields, T.StructField(END, T.BooleanType())])
    spark.createDataFrame([], schema).write.mode("append").parquet(folder)
    return stream.withColumn(END, F.lit(False)).unionByName(read_file_stream(spark, folder, schema))


def mark_end(spark: SparkSession, stream: DataFrame, folder: str, time: str, at: datetime | str) -> None:
    """Write an end mark for streams made by :func:`with_end` on ``folder``; ``at`` lies past all events and their windows.

    Its other columns hold empty values, as joins leave out NULL keys before the
    watermark sees them; nested columns are NULL.
    """
    columns = [F.lit(at).cast(f.dataType) if f.name == time else _empty(f.dataType) for f in stream.schema.fields]
    named = [c.alias(f.name) for c, f in zip(columns, stream.schema.fields)]
    spark.range(1).select(*named).withColumn(END, F.lit(True)).coalesce(1).write.mode("append").parquet(folder)


def _empty(kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit("").cast(kind)
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.lit(0).cast(kind)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(kind)
    return F.lit(None).cast(kind)


def watermarked(stream: DataFrame, time: str, delay: str) -> DataFrame:
    """The stream under a watermark, end marks left out behind it; times without a zone are read in the session's."""
    if not isinstance(stream.schema[time].dataType, T.TimestampType):  # all that a watermark takes
        stream = stream.withColumn(time, F.col(time).cast("timestamp"))
    marked = stream.withWatermark(time, delay)
    if END not in stream.columns:
        return marked
    # compares the event time, so that the optimizer leaves the filter behind the watermark
    return marked.filter(f"not {END} or `{time}` < timestamp'0001-01-01'").drop(END)


def window_aggregate(
    stream: DataFrame,
    time: str,
    length: str,
    measures: Mapping[str, str],
    *,
    delay: str,
    slide: str | None = None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Measures per window and group: window_start, window_end, the groups, the measures.

    Windows tumble, or slide by ``slide``. Measures are those of ``aggregate``.
    Tasks combine rows before the shuffle, so a hot group shuffles little. In
    append mode a window comes out once the watermark has passed its end.
    """
    window = F.window(time, length, slide).alias("_window")
    return _by_window(watermarked(stream, time, delay), window, group_by, measures)


def session_aggregate(
    stream: DataFrame,
    time: str,
    gap: str,
    measures: Mapping[str, str],
    *,
    delay: str,
    group_by: Sequence[str],
) -> DataFrame:
    """Measures per session of a group: a session ends after ``gap`` without an event.

    A late row that falls between two sessions makes them one. Tasks merge
    sessions before the shuffle where the session setting of
    ``weir.session`` asks for it.
    """
    window = F.session_window(time, gap).alias("_window")
    return _by_window(watermarked(stream, time, delay), window, group_by, measures)


def _by_window(df: DataFrame, window: Column, group_by: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    if not measures:
        raise ValueError("give at least one measure")
    grouped = df.groupBy(window, *group_by).agg(*[measure(*item) for item in measures.items()])
    bounds = [F.col(f"_window.{side}").alias(f"window_{side}") for side in ("start", "end")]
    return grouped.select(*bounds, *[c for c in grouped.columns if c != "_window"])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    within: str,
    *,
    delay: str,
    how: str = "inner",
) -> DataFrame:
    """Pairs of equal keys whose right time is at or up to ``within`` after the left time.

    ``how`` is inner or left. Both sides are remembered until both watermarks
    have passed what could still meet them; a left row without a partner comes
    out then. The key columns appear once; other columns need different names.
    """
    kind = join_type(how)
    if kind not in ("inner", "left"):
        raise ValueError("an interval join is inner or left")
    clash = (set(left.columns) & set(right.columns)) - {*on, END}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    ours = watermarked(left, left_time, delay)
    theirs = watermarked(right, right_time, delay).withColumnsRenamed({key: f"_{key}" for key in on})
    near = [F.col(f"`{key}`") == F.col(f"`_{key}`") for key in on]
    near += [F.col(right_time) >= F.col(left_time), F.col(right_time) <= F.col(left_time) + F.expr(f"interval {within}")]
    return ours.join(theirs, near, kind).drop(*[f"_{key}" for key in on])


def deduplicate_within(stream: DataFrame, keys: Sequence[str], time: str, *, delay: str) -> DataFrame:
    """The first row of each key among those that arrive within ``delay`` of each other.

    Keys are forgotten once the watermark has passed their time plus ``delay``.
    A batch frame is deduplicated as a whole.
    """
    marked = watermarked(stream, time, delay)
    return marked.dropDuplicatesWithinWatermark(list(keys)) if marked.isStreaming else marked.dropDuplicates(list(keys))


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the operators of a query dropped behind the watermark, as far as its progress is kept."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])


def write_split_late(
    stream: DataFrame,
    time: str,
    delay: str,
    path: str,
    late_path: str,
    *,
    checkpoint: str,
    trigger: str = "5 seconds",
    file_format: str = "parquet",
    **options: Any,
) -> StreamingQuery:
    """Append rows on time to ``path`` and those behind the watermark to ``late_path``; none is lost.

    The watermark of a batch is the latest time of all earlier batches less
    ``delay``, like that of the engine's own operators. It is kept beside
    ``checkpoint``, one row a batch. Each batch has its own folder ``batch=n``
    in both places and replaces it, so a batch that runs again after a failure
    leaves the same rows. Rows without a time count as on time. Windows over a
    stream of ``path`` lose no row.
    """
    if not stream.isStreaming:
        raise ValueError("this is a batch frame")
    marks = f"{checkpoint.rstrip('/')}-marks"
    latest = T.StructType([T.StructField("latest", stream.schema[time].dataType)])

    def split(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema(latest).parquet(f"{marks}/batch={number - 1}") if number else spark.createDataFrame([], latest)
        mark = before.agg(F.max("latest")).scalar()
        batch.persist()
        try:
            late = F.coalesce(F.col(time) < mark - F.expr(f"interval {delay}"), F.lit(False))
            for rows, folder in ((batch.filter(~late), path), (batch.filter(late), late_path)):
                rows.write.format(file_format).options(**options).mode("overwrite").save(f"{folder}/batch={number}")
            seen = batch.select(F.col(time).alias("latest")).union(before)
            seen.agg(F.max("latest").alias("latest")).write.mode("overwrite").parquet(f"{marks}/batch={number}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    return writer.trigger(**parse_trigger(trigger)).start()


def end_folder(spark: SparkSession) -> str:
    """A fresh folder for end marks in the shared scratch space."""
    return scratch_path(spark, "stream-end")
