"""The end-to-end jobs over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators import Check, filter_rows, null_checks, range_checks, rule_checks
from weir.plans import jobs
from weir.plans.jobs import PRIORITIES
from weir.queries.quality import (
    EVENT_TARGET,
    LINE_RANGES,
    LINE_RULES,
    RANGE_CHECKS_SQL,
    RULE_CHECKS_SQL,
    report_sql,
)
from weir.queries.streams import event_stream
from weir.queries.tables import table
from weir.scratch import scratch_path
from weir.sinks import write_files
from weir.sources import read_files

AS_OF = "2000-12-31 00:00:00"
TODAY = "2002-01-01"
MESSAGE = "event_id bigint, user_id bigint, event_type string, value double, timestamp bigint"


def sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.sales_summary(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"), AS_OF
    )


def job_sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary as a table partitioned by the day it was made."""
    path = scratch_path(spark, "sales-summary")
    dated = sales_summary(spark, sf_dir).withColumn("aggregation_date", F.lit(TODAY))
    write_files(dated, path, partition_by="aggregation_date", compression="snappy")
    return read_files(spark, path, schema=dated.schema)


def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = [
        {"name": "l_orderkey", "type": "long"},
        {"name": "l_quantity", "type": "double"},
        {"name": "l_shipdate", "type": "timestamp_ntz"},
        {"name": "l_returnflag", "type": "string"},
    ]
    lines = table(spark, sf_dir, "lineitem")
    return jobs.quality_gate(lines, expected, _gate_checks(), scratch_path(spark, "gate"))


def _gate_checks() -> list[Check]:
    return null_checks(["l_orderkey", "l_partkey"]) + range_checks(LINE_RANGES) + rule_checks(LINE_RULES[1:2])


def job_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gate(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "dq_status",
        F.array_join(F.sort_array("violations"), "; ").alias("reasons"),
    )


def job_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate found, read from its output."""
    return jobs.gate_report(_gate(spark, sf_dir), _gate_checks())


def job_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows with their date parts, next to the checkpoint they leave behind."""
    orders = table(spark, sf_dir, "orders")
    checkpoint = orders.filter("o_orderdate < '2001-04-01'").agg(F.max("o_orderdate").alias("last_processed"))
    loaded, mark = jobs.incremental_load(orders, checkpoint, "o_orderdate", scratch_path(spark, "incremental"))
    return loaded.withColumn("next_checkpoint", mark.scalar()).select(
        "o_orderkey",
        "o_custkey",
        "year",
        "month",
        "day",
        F.date_format("next_checkpoint", "yyyy-MM-dd").alias("next_checkpoint"),
    )


def job_snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = jobs.latest_orders(table(spark, sf_dir, "orders"), "1999-06-30 00:00:00")
    return latest.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def job_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return jobs.compaction(orders, "year", scratch_path(spark, "compaction")).drop("o_orderdate")


def job_join_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.join_summary(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"))


def job_simple_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = jobs.simple_etl(table(spark, sf_dir, "orders"), scratch_path(spark, "etl"))
    return written.drop("o_orderdate")


def job_user_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = jobs.order_attributes(table(spark, sf_dir, "orders"), TODAY, scratch_path(spark, "attributes"))
    return written.select("o_orderkey", "o_custkey", "is_large", "age_days", "price_step", "overdue")


def job_event_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.event_export(table(spark, sf_dir, "events"), scratch_path(spark, "export")).drop("ts")


def job_schema_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = [
        {"name": "event_id", "type": "long"},
        {"name": "event_type", "type": "string"},
        {"name": "value", "type": "double"},
        {"name": "channel", "type": "string"},
        {"name": "schema_version", "type": "int"},
    ]
    legacy = table(spark, sf_dir, "events").drop("props")
    return jobs.schema_migration(legacy, EVENT_TARGET, expected, scratch_path(spark, "migration"))


def job_stream_high_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events framed as JSON messages, those of errors cut off; what is decoded is filtered, the rest kept as it came."""
    messages = jobs.as_messages(event_stream(spark, sf_dir))
    whole = F.col("value").cast("string")
    messages = messages.select(F.when(whole.contains('"error"'), F.left(whole, F.lit(30))).otherwise(whole).alias("value"))
    path, checkpoint = scratch_path(spark, "high-value"), scratch_path(spark, "high-value-checkpoint")
    kept = jobs.stream_high_value(messages, MESSAGE, path, checkpoint, f"{path}-rejects")
    lost = read_files(spark, f"{path}-rejects", schema="message string")
    return kept.unionByName(lost, allowMissingColumns=True)


def job_daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.daily_rollup(table(spark, sf_dir, "events"))


def job_union_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources that together hold every order."""
    orders = table(spark, sf_dir, "orders")
    return jobs.union_summary(
        [
            filter_rows(orders, "o_orderdate < '1997-01-01'"),
            filter_rows(orders, "o_orderdate >= '1997-01-01' and o_orderdate < '1999-07-01'"),
            filter_rows(orders, "o_orderdate >= '1999-07-01'"),
        ]
    )


def job_star_denorm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some parts and suppliers are left out, so that facts miss a dimension."""
    wide = jobs.star_denorm(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "part").filter("p_size > 10"),
        table(spark, sf_dir, "supplier").filter("s_acctbal > 1000"),
        table(spark, sf_dir, "orders"),
    )
    return wide.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "p_brand", "s_name", "o_orderpriority"
    )


_SALES = f"""select n_name, o_orderpriority,
    cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) as average
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    where o_orderdate <= timestamp '{AS_OF}' and o_totalprice > 0 group by 1, 2"""
_SALES_WIDE = (
    "select n_name, "
    + ", ".join(f"""max(average) filter (o_orderpriority = '{p}') as "{p}\"""" for p in PRIORITIES)
    + f" from ({_SALES}) s group by n_name"
)

QUERIES = {
    "sales_summary": (sales_summary, _SALES_WIDE),
    "job_sales_summary": (
        job_sales_summary,
        f"select *, '{TODAY}' as aggregation_date from ({_SALES_WIDE}) t",
    ),
    "job_quality_gate": (
        job_quality_gate,
        f"""select l_orderkey, l_linenumber, l_partkey,
        case when reasons = '' then 'clean' else 'quarantined' end as dq_status, reasons from (
        select l_orderkey, l_linenumber, l_partkey, concat_ws('; ',
        case when l_discount < cast(0.02 as double) then 'l_discount >= 0.02' end,
        case when l_quantity > 40 then 'l_quantity <= 40' end,
        case when l_quantity < 1 then 'l_quantity >= 1' end,
        case when not ({LINE_RULES[1]}) then '{LINE_RULES[1].replace("'", "''")}' end) as reasons from lineitem) t""",
    ),
    "job_quality_report": (
        job_quality_report,
        report_sql(
            "lineitem",
            [
                ("not_null", "l_orderkey is not null", "l_orderkey is null"),
                ("not_null", "l_partkey is not null", "l_partkey is null"),
                *RANGE_CHECKS_SQL,
                RULE_CHECKS_SQL[1],
            ],
        ),
    ),
    "job_incremental": (
        job_incremental,
        """select o_orderkey, o_custkey, cast(year(o_orderdate) as integer) as year,
        cast(month(o_orderdate) as integer) as month, cast(day(o_orderdate) as integer) as day,
        (select strftime(max(o_orderdate), '%Y-%m-%d') from orders) as next_checkpoint from orders
        where o_orderdate > (select max(o_orderdate) from orders where o_orderdate < timestamp '2001-04-01')""",
    ),
    "job_snapshot_as_of": (
        job_snapshot_as_of,
        """select * exclude (r) replace (strftime(o_orderdate, '%Y-%m-%d') as o_orderdate) from (
        select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r
        from orders where o_orderdate <= timestamp '1999-06-30') t where r = 1""",
    ),
    "job_compaction": (
        job_compaction,
        "select * exclude (o_orderdate), cast(year(o_orderdate) as integer) as year from orders",
    ),
    "job_join_summary": (
        job_join_summary,
        """select c_custkey, c_name, count(*) as total_orders,
        cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total_amount,
        cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) as avg_order_value
        from customer join orders on o_custkey = c_custkey group by 1, 2""",
    ),
    "job_simple_etl": (
        job_simple_etl,
        """select * exclude (o_orderdate), cast(year(o_orderdate) as integer) as year,
        cast(month(o_orderdate) as integer) as month from orders where o_orderstatus = 'F' and o_totalprice >= 1500""",
    ),
    "job_user_attributes": (
        job_user_attributes,
        f"""select o_orderkey, o_custkey, o_totalprice >= 250000 as is_large, age_days,
        cast(floor(o_totalprice / 50000) as integer) as price_step, o_orderstatus = 'O' and age_days > 730 as overdue
        from (select *, cast(date_diff('day', cast(o_orderdate as date), date '{TODAY}') as integer) as age_days
        from orders) t where o_totalprice >= 1500 and o_orderstatus <> 'P'""",
    ),
    "job_event_export": (
        job_event_export,
        """select event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') as processing_date,
        value > 50 as over_fifty from events where event_type = 'purchase' and value > 10""",
    ),
    "job_schema_migration": (
        job_schema_migration,
        """select event_id, user_id, event_type, value, cast(null as varchar) as channel,
        cast(null as integer) as schema_version from events""",
    ),
    "job_stream_high_value": (
        job_stream_high_value,
        """select event_id, user_id, event_type, value, cast(floor(epoch(ts)) as bigint) as timestamp,
        strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as event_timestamp, value >= 50 as high_value,
        cast(null as varchar) as message from events where event_type = 'purchase' and value > 10
        union all
        select null, null, null, null, null, null, null,
            left('{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"error"', 30)
        from events where event_type = 'error'""",
    ),
    "job_daily_rollup": (
        job_daily_rollup,
        """select user_id, strftime(ts, '%Y-%m-%d') as event_date, count(*) as event_count,
        min(cast(floor(epoch(ts)) as bigint)) as first_event, max(cast(floor(epoch(ts)) as bigint)) as last_event
        from events group by 1, 2""",
    ),
    "job_union_summary": (
        job_union_summary,
        """select o_orderpriority, cast(year(o_orderdate) as integer) as year, count(*) as total_orders,
        count(distinct o_custkey) as unique_customers from orders group by 1, 2""",
    ),
    "job_star_denorm": (
        job_star_denorm,
        """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, p_brand, s_name, o_orderpriority
        from lineitem left join (select * from part where p_size > 10) p on l_partkey = p_partkey
        left join (select * from supplier where s_acctbal > 1000) s on l_suppkey = s_suppkey
        left join orders on l_orderkey = o_orderkey""",
    ),
}
