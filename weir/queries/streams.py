"""Streams over the event files; each ends when all files are read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators import enrich, filter_rows, join_using, range_checks, with_violations
from weir.queries.tables import table
from weir.scratch import scratch_path
from weir.sources import read_files
from weir.streaming import (
    await_all,
    deduplicate_within,
    end_folder,
    interval_join,
    mark_end,
    read_file_stream,
    session_aggregate,
    window_aggregate,
    with_end,
    write_split_late,
    write_stream,
)

FILES_PER_BATCH = 10_000


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, whether it is one file or a folder."""
    schema = table(spark, sf_dir, "events").schema
    return read_file_stream(
        spark,
        f"{sf_dir.rstrip('/')}/events.parque[t]",
        schema,
        max_files_per_trigger=FILES_PER_BATCH,
    )


def _drained(df: DataFrame, label: str, **how: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    query = write_stream(
        df, path, checkpoint=scratch_path(spark, f"{label}-checkpoint"), trigger="once", **how
    )
    await_all([query])
    return read_files(spark, path, schema=df.schema)


def stream_filter_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = filter_rows(event_stream(spark, sf_dir), "event_type = 'purchase' and value > 10")
    marked = enrich(bought, {"high_value": "value >= 50"}).drop("ts", "props")
    return _drained(marked, "stream-filter")


def stream_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = event_stream(spark, sf_dir).select("event_id", "user_id", "event_type", "value")
    return _drained(stream, "stream-partitioned", partition_by="event_type")


def stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment"
    )
    stream = event_stream(spark, sf_dir).select("event_id", "user_id", "event_type")
    joined = join_using([stream, customer], "user_id", broadcast=True)
    return _drained(joined, "stream-join")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = event_stream(spark, sf_dir).select("event_id", "event_type", "value")
    marked = with_violations(stream, range_checks({"value": [1, 120]}))
    return _drained(
        marked.select("event_id", "event_type", "value", F.array_join("violations", "; ").alias("reasons")),
        "stream-quarantine",
    )


PAST_ALL_EVENTS = "2100-01-01"


def _ended(
    spark: SparkSession, sf_dir: str, label: str, operator: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Run a stateful operator in append mode over all events, then end the stream and let its state go.

    The second run resumes from the checkpoint of the first.
    """
    events = event_stream(spark, sf_dir)
    marks, path, checkpoint = end_folder(spark), scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    out = operator(with_end(events, marks))
    for last in (False, True):
        if last:
            mark_end(spark, events, marks, "ts", PAST_ALL_EVENTS)
        await_all([write_stream(out, path, checkpoint=checkpoint, trigger="once")])
    return read_files(spark, path, schema=out.schema)


def _clock(column: str) -> str:
    return f"date_format({column}, 'yyyy-MM-dd HH:mm:ss')"


COUNTS = {"events": "count(1)", "cents": "sum(cast(round(value * 100) as bigint))"}


def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and amounts by hour and type."""
    done = _ended(
        spark, sf_dir, "stream-windows",
        lambda events: window_aggregate(events, "ts", "1 hour", COUNTS, delay="2 hours", group_by=["event_type"]),
    )
    return done.selectExpr(f"{_clock('window_start')} as hour", "event_type", "events", "cents")


def stream_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and amounts of the past six hours, every two hours."""
    done = _ended(
        spark, sf_dir, "stream-sliding",
        lambda events: window_aggregate(events, "ts", "6 hours", COUNTS, delay="2 hours", slide="2 hours"),
    )
    return done.selectExpr(
        f"{_clock('window_start')} as starts", f"{_clock('window_end')} as ends", "events", "cents"
    )


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions per user, ended by half an hour without an event."""
    measures = {"first_event": "min(ts)", "last_event": "max(ts)", **COUNTS}
    done = _ended(
        spark, sf_dir, "stream-sessions",
        lambda events: session_aggregate(events, "ts", "30 minutes", measures, delay="2 hours", group_by=["user_id"]),
    )
    return done.selectExpr(
        "user_id", f"{_clock('first_event')} as first_event", f"{_clock('last_event')} as last_event", "events", "cents"
    )


def stream_view_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each view with the purchases of its user in the hour after it; views without one stay."""

    def joined(events: DataFrame) -> DataFrame:
        kinds = {kind: events.filter(f"event_type = '{kind}' or _end") for kind in ("view", "purchase")}
        names = {"event_id": "purchase_id", "ts": "bought_at"}
        views = kinds["view"].select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("viewed_at"), "_end")
        bought = kinds["purchase"].select("user_id", *[F.col(c).alias(a) for c, a in names.items()], "_end")
        return interval_join(views, bought, ["user_id"], "viewed_at", "bought_at", "1 hour", delay="2 hours", how="left")

    return _ended(spark, sf_dir, "stream-view-purchase", joined).select("user_id", "view_id", "purchase_id")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once, although the stream brings each of them twice."""
    events = event_stream(spark, sf_dir)
    replayed = events.union(event_stream(spark, sf_dir))
    once = deduplicate_within(replayed, ["event_id"], "ts", delay="40 days")
    return _drained(once.select("event_id", "user_id", "event_type", "value"), "stream-dedup")


ARRIVALS = 4


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive in four lots out of order, split by a watermark of ten days."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    names = ("arrivals", "on-time", "late", "late-checkpoint")
    inbox, on_time, late, checkpoint = (scratch_path(spark, f"stream-{name}") for name in names)
    for lot in range(ARRIVALS):
        events.filter(F.col("event_id") % ARRIVALS == lot).write.mode("append").parquet(inbox)
        stream = read_file_stream(spark, inbox, events.schema)
        await_all([write_split_late(stream, "ts", "10 days", on_time, late, checkpoint=checkpoint, trigger="once")])
    schema = "event_id long, batch int"
    kept, lost = (spark.read.schema(schema).parquet(folder).withColumn("late", F.lit(flag)) for folder, flag in ((on_time, False), (late, True)))
    return kept.union(lost)


def _clock_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


CENTS_SQL = "cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents"


QUERIES = {
    "stream_filter_enrich": (
        stream_filter_enrich,
        """select event_id, user_id, event_type, value, value >= 50 as high_value from events
        where event_type = 'purchase' and value > 10""",
    ),
    "stream_partitioned": (
        stream_partitioned,
        "select event_id, user_id, event_type, value from events",
    ),
    "stream_static_join": (
        stream_static_join,
        """select event_id, user_id, event_type, c_name, c_mktsegment from events
        join customer on user_id = c_custkey""",
    ),
    "stream_quarantine": (
        stream_quarantine,
        """select event_id, event_type, value, concat_ws('; ', case when value < 1 then 'value >= 1' end,
        case when value > 120 then 'value <= 120' end) as reasons from events""",
    ),
    "stream_window_counts": (
        stream_window_counts,
        f"""select {_clock_sql("date_trunc('hour', ts)")} as hour, event_type, count(*) as events, {CENTS_SQL}
        from events group by date_trunc('hour', ts), event_type""",
    ),
    "stream_sliding_counts": (
        stream_sliding_counts,
        f"""with windows as (
            select value, to_timestamp(7200 * (epoch_us(ts) // 7200000000 - back))::timestamp as starts
            from events, unnest([0, 1, 2]) as steps(back))
        select {_clock_sql("starts")} as starts, {_clock_sql("starts + interval 6 hours")} as ends,
            count(*) as events, {CENTS_SQL}
        from windows group by starts""",
    ),
    "stream_sessions": (
        stream_sessions,
        f"""with marked as (
            select *, case when ts <= lag(ts) over (partition by user_id order by ts) + interval 30 minutes
                then 0 else 1 end as starts from events
        ), numbered as (
            select *, sum(starts) over (partition by user_id order by ts, event_id rows unbounded preceding) as session
            from marked)
        select user_id, {_clock_sql("min(ts)")} as first_event, {_clock_sql("max(ts)")} as last_event,
            count(*) as events, {CENTS_SQL}
        from numbered group by user_id, session""",
    ),
    "stream_view_purchase": (
        stream_view_purchase,
        """select v.user_id, v.event_id as view_id, p.event_id as purchase_id
        from events v left join events p on p.user_id = v.user_id and p.event_type = 'purchase'
            and p.ts >= v.ts and p.ts <= v.ts + interval 1 hour
        where v.event_type = 'view'""",
    ),
    "stream_dedup": (
        stream_dedup,
        "select event_id, user_id, event_type, value from events",
    ),
    "stream_late_rows": (
        stream_late_rows,
        f"""with lots as (
            select event_id, ts, cast(event_id % {ARRIVALS} as int) as batch from events
        ), marks as (
            select batch, max(max(ts)) over (order by batch rows between unbounded preceding and 1 preceding) as mark
            from lots group by batch)
        select event_id, batch, coalesce(ts < mark - interval 10 days, false) as late
        from lots join marks using (batch)""",
    ),
}
