"""Sources, sinks, layouts, incremental reads and metrics."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.functions import nearest_rank
from weir.metrics import append_history, metrics_frame, read_history, throughput
from weir.operators import (
    cache,
    coalesce,
    enrich,
    filter_rows,
    newer_than,
    repartition,
    repartition_by,
    snapshot_as_of,
    uncache,
    union_frames,
)
from weir.plans import run_steps
from weir.queries.tables import table
from weir.scratch import scratch_path
from weir.sinks import kafka_frame, write_files, write_parquet_with_avro_schema, write_table
from weir.sources import decode_json, read_files, read_table


def kafka_frame_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kafka_frame(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props"))


def kafka_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to JSON messages and back, then the JSON inside one of the fields."""
    messages = kafka_frame(
        table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    )
    decoded = decode_json(
        messages, "event_id bigint, user_id bigint, event_type string, value double, props string"
    )
    return decode_json(decoded, "k int", "props", ("event_id", "user_id", "event_type", "value"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text")


def _digest(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "lang", "n_chars", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def sink_roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    write_files(_documents(spark, sf_dir), path, "parquet", "errorifexists", compression="zstd")
    return _digest(read_files(spark, path))


def sink_roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, source = scratch_path(spark, "json"), _documents(spark, sf_dir)
    write_files(source, path, "json", compression="gzip")
    return _digest(read_files(spark, path, "json", source.schema))


def sink_roundtrip_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orc")
    write_files(table(spark, sf_dir, "customer"), path, "orc", compression="snappy")
    return read_files(spark, path, "orc")


def sink_roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, source = scratch_path(spark, "csv"), table(spark, sf_dir, "customer")
    write_files(source, path, "csv", header="true")
    return read_files(spark, path, "csv", source.schema)


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types found by the reader, as without a schema."""
    path = scratch_path(spark, "csv-inferred")
    source = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    write_files(source, path, "csv", header="true")
    return read_files(spark, path, "csv").withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


def sink_parquet_avro_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored Avro schema, next to what was written under it."""
    path = scratch_path(spark, "parquet-avro")
    write_parquet_with_avro_schema(table(spark, sf_dir, "supplier"), path)
    stored = read_files(spark, path)
    record = json.loads(stored.schema.fields[0].metadata["avroSchema"])
    fields = ",".join(field["name"] for field in record["fields"])
    return stored.withColumn("avro_fields", F.lit(fields))


def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned write, then a read that prunes all but two folders."""
    path = scratch_path(spark, "partitioned")
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    write_files(orders, path, partition_by=["o_orderstatus"], balance=True)
    return filter_rows(read_files(spark, path), "o_orderstatus in ('F', 'O')")


def sink_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    finished = filter_rows(orders, "o_orderstatus = 'F'")
    results = []
    for mode in ("append", "ignore", "overwrite"):
        path = scratch_path(spark, f"mode-{mode}")
        write_files(orders, path, mode="errorifexists")
        write_files(finished, path, mode=mode)
        results.append(read_files(spark, path).groupBy(F.lit(mode).alias("mode"), "o_orderstatus").count())
    return union_frames(results)


def sink_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of a table folder, the second with one column more."""
    path = scratch_path(spark, "merge")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    early = filter_rows(orders, "o_orderstatus <> 'P'")
    late = enrich(filter_rows(orders, "o_orderstatus = 'P'"), {"review": "if(o_totalprice > 250000, 'yes', 'no')"})
    write_table(early, path, table_format="parquet")
    write_table(late, path, table_format="parquet")
    return read_table(spark, path, table_format="parquet", merge_schema=True)


def sink_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One derived frame, computed once, in two sinks."""
    shared = cache(
        enrich(filter_rows(table(spark, sf_dir, "orders"), "o_totalprice > 100000"), {"big": "o_totalprice > 400000"})
    )
    files = {fmt: scratch_path(spark, f"fanout-{fmt}") for fmt in ("parquet", "json")}
    for fmt, path in files.items():
        write_files(shared, path, fmt)
    uncache(shared)
    return union_frames(
        [
            read_files(spark, path, fmt, shared.schema).groupBy(F.lit(fmt).alias("sink"), "big").count()
            for fmt, path in files.items()
        ]
    )


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    checkpoint = filter_rows(orders, "o_orderdate < '2000-06-01'").select("o_orderdate")
    fresh = newer_than(orders, "o_orderdate", checkpoint, "o_orderdate")
    return fresh.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return snapshot_as_of(events, "user_id", ["ts", "event_id"]).drop("ts")


def layout_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repartition(table(spark, sf_dir, "orders").drop("o_orderdate"), "8")


def layout_by_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repartition_by(table(spark, sf_dir, "orders").drop("o_orderdate"), ["o_custkey"], 6)


def layout_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coalesce(table(spark, sf_dir, "orders").drop("o_orderdate"), 2)


def step_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a step list records about its steps, rows of every step included."""
    steps = [
        {"type": "transform", "method": "filterRows", "config": {"condition": "event_type = 'purchase'"}},
        {"type": "validate", "method": "validateNulls", "config": {"notNullColumns": ["event_id"]}},
        {"type": "validate", "method": "validateBusinessRules", "config": {"rules": ["event_id >= 0"]}},
        {
            "type": "load",
            "method": "toDeltaLake",
            "config": {"path": scratch_path(spark, "metered"), "tableFormat": "parquet"},
        },
    ]
    run = run_steps(spark, {"name": "purchases", "steps": steps}, primary=table(spark, sf_dir, "events"), count_rows=True)
    lines = metrics_frame(spark, run.metrics)
    # the second check shares the scan of the first, and its time
    again = F.when(F.col("step") == 2, F.col("duration_ms")).alias("second_check_ms")
    return lines.select("pipeline", "step", "type", "method", "status", "records", again)


def metrics_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended runs of step metrics, summed up per pipeline.

    Every event stands for one recorded step.
    """
    path = scratch_path(spark, "history")
    for half in (0, 1):
        steps = table(spark, sf_dir, "events").selectExpr(
            "event_type as pipeline",
            f"{half} as step",
            "'load' as type",
            "'toS3' as method",
            "'SUCCESS' as status",
            "cast(value as bigint) + 1 as duration_ms",
            "user_id as records",
        )
        append_history(steps, path)
    return throughput(read_history(spark, path))


def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_rank(table(spark, sf_dir, "events"), "value", [50, 95, 99], ["event_type"])


def price_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ungrouped: all rows are one group, still ordered in slices."""
    return nearest_rank(table(spark, sf_dir, "lineitem"), "l_extendedprice", [1, 25, 50, 75, 99, 100])


def _rank_sql(source: str, value: str, percentiles: list[int], by: str = "") -> str:
    over = f"partition by {by} " if by else ""
    keys = f"{by}, " if by else ""
    return f"""select {keys}p as percentile, {value} as value, n from (
        select {keys}{value}, row_number() over ({over}order by {value}) as r,
        count(*) over ({over}) as n from {source}) t
        join (select unnest({percentiles}) as p) on r = ceil(p * n / 100)"""


QUERIES = {
    "kafka_frame": (
        kafka_frame_query,
        """select cast(null as varchar) as key, cast(to_json({'event_id': event_id, 'user_id': user_id,
        'event_type': event_type, 'props': props}) as varchar) as value from events""",
    ),
    "kafka_decode": (
        kafka_decode,
        """select event_id, user_id, event_type, value, cast(json_extract(props, '$.k') as integer) as k from events""",
    ),
    "sink_roundtrip_parquet": (
        sink_roundtrip_parquet,
        "select doc_id, lang, n_chars, md5(text) as text_md5 from documents",
    ),
    "sink_roundtrip_json": (
        sink_roundtrip_json,
        "select doc_id, lang, n_chars, md5(text) as text_md5 from documents",
    ),
    "sink_roundtrip_orc": (sink_roundtrip_orc, "select * from customer"),
    "sink_roundtrip_csv": (sink_roundtrip_csv, "select * from customer"),
    "csv_inferred": (csv_inferred, "select p_partkey, p_brand, p_size, p_retailprice from part"),
    "sink_parquet_avro_schema": (
        sink_parquet_avro_schema,
        "select *, 's_suppkey,s_name,s_nationkey,s_acctbal' as avro_fields from supplier",
    ),
    "sink_partitioned": (
        sink_partitioned,
        "select * exclude (o_orderdate) from orders where o_orderstatus in ('F', 'O')",
    ),
    "sink_modes": (
        sink_modes,
        """select 'append' as mode, o_orderstatus, count(*) * case when o_orderstatus = 'F' then 2 else 1 end as count
        from orders group by o_orderstatus
        union all select 'ignore', o_orderstatus, count(*) from orders group by o_orderstatus
        union all select 'overwrite', o_orderstatus, count(*) from orders where o_orderstatus = 'F' group by o_orderstatus""",
    ),
    "sink_merge_schema": (
        sink_merge_schema,
        """select o_orderkey, o_orderstatus, o_totalprice,
        case when o_orderstatus <> 'P' then null when o_totalprice > 250000 then 'yes' else 'no' end as review
        from orders""",
    ),
    "sink_fanout": (
        sink_fanout,
        """select s.sink, o_totalprice > 400000 as big, count(*) as count from orders,
        (values ('parquet'), ('json')) as s(sink) where o_totalprice > 100000 group by 1, 2""",
    ),
    "incremental_load": (
        incremental_load,
        """select * replace (strftime(o_orderdate, '%Y-%m-%d') as o_orderdate) from orders where o_orderdate >
        (select max(o_orderdate) from orders where o_orderdate < timestamp '2000-06-01')""",
    ),
    "snapshot_latest": (
        snapshot_latest,
        """select user_id, event_id, event_type, value from
        (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events) t
        where r = 1""",
    ),
    "layout_repartition": (layout_repartition, "select * exclude (o_orderdate) from orders"),
    "layout_by_columns": (layout_by_columns, "select * exclude (o_orderdate) from orders"),
    "layout_coalesce": (layout_coalesce, "select * exclude (o_orderdate) from orders"),
    "step_metrics": (
        step_metrics,
        """select 'purchases' as pipeline, s.step, s.type, s.method, 'SUCCESS' as status, s.records,
        case when s.step = 2 then 0::bigint end as second_check_ms from (values
        (0, 'transform', 'filterRows', (select count(*) from events where event_type = 'purchase')),
        (1, 'validate', 'validateNulls', (select count(*) from events where event_type = 'purchase')),
        (2, 'validate', 'validateBusinessRules', (select count(*) from events where event_type = 'purchase')),
        (3, 'load', 'toDeltaLake', (select count(*) from events where event_type = 'purchase'))
        ) as s(step, type, method, records)""",
    ),
    "metrics_history": (
        metrics_history,
        """select event_type as pipeline, cast(2 * sum(user_id) as bigint) as records,
        cast(2 * sum(cast(trunc(value) as bigint) + 1) as bigint) as duration_ms,
        cast(2 * sum(user_id) * 1000 as double) / cast(2 * sum(cast(trunc(value) as bigint) + 1) as double)
        as records_per_second from events group by event_type""",
    ),
    "latency_percentiles": (
        latency_percentiles,
        _rank_sql("events", "value", [50, 95, 99], "event_type"),
    ),
    "price_percentiles": (
        price_percentiles,
        _rank_sql("lineitem", "l_extendedprice", [1, 25, 50, 75, 99, 100]),
    ),
}
