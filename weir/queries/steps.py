"""Chained joins, kept rejects, step lists that filter, load and stream, and repeated loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.functions import cents_sql, whole_to_amount
from weir.operators import (
    aggregate,
    enrich,
    filter_rows,
    join_frames,
    pivot,
    schema_compat,
    union_frames,
    validate_schema,
)
from weir.plans import jobs, run_steps
from weir.queries.streams import event_stream
from weir.queries.tables import table
from weir.scratch import scratch_path
from weir.sources import read_files, split_json


def _keyed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Customers, their orders of one status, and their purchases, on one key name."""
    customer = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    finished = filter_rows(table(spark, sf_dir, "orders"), "o_orderstatus = 'F' and o_totalprice > 200000")
    bought = filter_rows(table(spark, sf_dir, "events"), "event_type = 'purchase' and value > 40")
    return {
        "customer": customer.selectExpr("c_custkey as id", "c_name"),
        "orders": aggregate(finished.withColumnRenamed("o_custkey", "id"), ["id"], {"n_orders": "count(*)"}),
        "bought": aggregate(bought.withColumnRenamed("user_id", "id"), ["id"], {"n_bought": "count(*)"}),
    }


def join_chain_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner and left joins whose second condition names the merged key of the first."""
    conditions = ["customer.id = orders.id", "orders.id = bought.id"]
    frames = _keyed(spark, sf_dir)
    return union_frames([enrich(join_frames(frames, conditions, how), {"how": f"'{how}'"}) for how in ("inner", "left")])


def join_chain_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain whose last condition compares with a text that spells a merged key."""
    frames = _keyed(spark, sf_dir)
    frames["bought"] = enrich(frames["bought"], {"tag": "if(id % 2 = 0, 'orders.id', 'no')"})
    conditions = ["customer.id = orders.id", "orders.id = bought.id and bought.tag = 'orders.id'"]
    return join_frames(frames, conditions).select("c_name", "n_orders", "n_bought", "tag")


def join_full_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full join of three frames, once plain and once for hot keys."""
    conditions = ["customer.id = orders.id", "customer.id = bought.id"]
    frames = _keyed(spark, sf_dir)
    both = [join_frames(frames, conditions, "full", hot_keys=hot).withColumn("hot", F.lit(hot)) for hot in (False, True)]
    return union_frames(both)


def pivot_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two priorities as columns, and all others together."""
    orders = enrich(table(spark, sf_dir, "orders"), {"cents": cents_sql("o_totalprice")})
    wide = pivot(orders, ["o_orderstatus"], "o_orderpriority", "cents", values=["1-URGENT", "2-HIGH"], rest="others")
    amounts = [whole_to_amount(F.col(f"`{c}`")).alias(c) for c in wide.columns[1:]]
    return wide.select("o_orderstatus", *amounts)


def kafka_decode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some are cut off; all come back, decoded or as they came."""
    message = F.when(F.col("event_type") == "error", F.left(F.to_json(F.struct("event_id", "value")), F.lit(9))).otherwise(
        F.to_json(F.struct("event_id", "value"))
    )
    messages = table(spark, sf_dir, "events").select("user_id", message.alias("value"))
    decoded, rejects = split_json(messages, "event_id bigint, value double", keep=("user_id",))
    return union_frames(
        [
            decoded.select("user_id", "event_id", "value", F.lit(None).cast("string").alias("message")),
            rejects.selectExpr("user_id", "cast(null as bigint)", "cast(null as double)", "message"),
        ]
    )


def _step(kind: str, method: str, **config) -> dict:
    return {"type": kind, "method": method, "config": config}


def steps_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that pass neighbouring checks, and the quarantined ones with their reasons."""
    how = {"onViolation": "quarantine", "rejectsAs": "bad"}
    run = run_steps(
        spark,
        {
            "steps": [
                _step("validate", "validateRanges", ranges={"value": {"min": 1, "max": 120}}, **how),
                _step("validate", "validateBusinessRules", rules=["event_type <> 'error'"], **how),
            ]
        },
        primary=table(spark, sf_dir, "events").select("event_id", "event_type", "value"),
    )
    reasons = F.array_join("violations", "; ").alias("reasons")
    good = run.current().select("*", F.lit(None).cast("string").alias("reasons"))
    return union_frames([good, run.frame("bad").select("event_id", "event_type", "value", reasons)])


def steps_reference_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of known customers go on; the others are kept under a name."""
    check = _step(
        "validate", "validateReferentialIntegrity", foreignKey="user_id", referencedDataFrame="known",
        referencedColumn="c_custkey", onViolation="quarantine", rejectsAs="unknown",
    )
    known = table(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0")
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    run = run_steps(spark, {"steps": [check]}, {"known": known}, events)
    return union_frames([run.current().withColumn("found", F.lit(True)), run.frame("unknown").withColumn("found", F.lit(False))])


def steps_partitioned_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step list that loads by partition, in even files, and reads them back."""
    path = scratch_path(spark, "steps-load")
    spec = {
        "steps": [
            _step("transform", "filterRows", condition="o_totalprice > 50000"),
            _step("load", "toDeltaLake", path=path, tableFormat="parquet", partitionBy="o_orderpriority", mode="overwrite"),
        ]
    }
    run_steps(spark, spec, primary=table(spark, sf_dir, "orders").drop("o_orderdate"))
    return read_files(spark, path)


def steps_streaming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step list in streaming mode, run until all files are read."""
    path = scratch_path(spark, "steps-stream")
    spec = {
        "mode": "streaming",
        "steps": [
            _step("transform", "filterRows", condition="event_type = 'view'"),
            _step("validate", "validateRanges", ranges={"value": {"min": 5}}, onViolation="filter"),
            _step(
                "load", "toDeltaLake", path=path, tableFormat="parquet", trigger="once", queryName="views",
                checkpointLocation=scratch_path(spark, "steps-stream-checkpoint"),
            ),
        ],
    }
    stream = event_stream(spark, sf_dir).select("event_id", "event_type", "value")
    run_steps(spark, spec, primary=stream).queries["views"].awaitTermination()
    return read_files(spark, path, schema=stream.schema)


def steps_kafka_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step list that decodes messages, loads the decoded ones and the cut-off ones apart; all come back."""
    good, bad = scratch_path(spark, "steps-good"), scratch_path(spark, "steps-bad")
    message = F.to_json(F.struct("event_id", "value"))
    message = F.when(F.col("event_type") == "error", F.left(message, F.lit(9))).otherwise(message)
    to_table = {"tableFormat": "parquet", "mode": "overwrite"}
    spec = {
        "steps": [
            _step("transform", "decodeMessages", schema="event_id bigint, value double", keepColumns=["user_id"], rejectsAs="bad"),
            _step("transform", "filterRows", condition="value > 10 or value is null"),
            _step("load", "toDeltaLake", path=good, **to_table),
            _step("load", "toDeltaLake", path=bad, inputDataFrame="bad", **to_table),
        ]
    }
    run_steps(spark, spec, primary=table(spark, sf_dir, "events").select("user_id", message.alias("value")))
    loaded = read_files(spark, good, schema="user_id bigint, event_id bigint, value double")
    kept = read_files(spark, bad, schema="user_id bigint, message string")
    return loaded.unionByName(kept, allowMissingColumns=True)


def steps_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step list run twice: from a start date, and from the checkpoint that the first run left."""
    orders, marks, target = (scratch_path(spark, f"steps-{name}") for name in ("orders", "marks", "target"))
    source = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    source.filter("false").selectExpr("o_orderdate as done").write.parquet(marks)
    table_of = {"tableFormat": "parquet"}
    spec = {
        "steps": [
            _step("extract", "fromDeltaLake", path=marks, registerAs="checkpoint", **table_of),
            _step(
                "extract", "fromDeltaLake", path=orders, **table_of,
                incremental={"checkpoint": "checkpoint", "column": "o_orderdate", "checkpointColumn": "done", "initial": "1999-01-01"},
            ),
            _step("load", "toDeltaLake", path=target, partitionBy="lot", **table_of),
            _step("transform", "aggregateData", groupBy=[], aggregations={"done": "max(o_orderdate)"}),
            _step("load", "toDeltaLake", path=marks, **table_of),
        ]
    }
    for lot, until in enumerate(("2000-06-01", "2100-01-01")):
        source.filter(f"o_orderdate < '{until}'").withColumn("lot", F.lit(lot)).write.mode("overwrite").parquet(orders)
        run_steps(spark, spec)
    return read_files(spark, target).select("o_orderkey", "lot")


def job_incremental_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that is run twice from the same mark leaves every row once."""
    orders = table(spark, sf_dir, "orders")
    checkpoint = orders.filter("o_orderdate < '2000-01-01'").agg(F.max("o_orderdate").alias("last_processed"))
    path = scratch_path(spark, "incremental-rerun")
    for _ in range(2):
        loaded, _ = jobs.incremental_load(orders, checkpoint, "o_orderdate", path)
    return loaded.select("o_orderkey", "o_custkey", "year")


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "array(event_id, user_id) as ids", "named_struct('kind', event_type, 'values', array(value)) as seen"
    )


def dq_schema_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected nested types are met whatever their nullability says."""
    expected = [
        {"name": "ids", "type": "array<bigint>"},
        {"name": "seen", "type": "struct<kind: string, values: array<double>>"},
        {"name": "gone", "type": "map<string, int>"},
    ]
    return validate_schema(_nested(spark, sf_dir), expected)


def schema_compat_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    longs = {"type": "array", "items": "long"}
    fields = [{"name": "ids", "type": longs}, {"name": "marks", "type": ["null", longs], "default": None}]
    return schema_compat(_nested(spark, sf_dir), {"type": "record", "name": "Nested", "fields": fields})


KEYED_SQL = """with customer3 as (select c_custkey as id, c_name from customer where c_mktsegment <> 'BUILDING'),
    orders3 as (select o_custkey as id, count(*) as n_orders from orders
        where o_orderstatus = 'F' and o_totalprice > 200000 group by 1),
    bought3 as (select user_id as id, count(*) as n_bought from events
        where event_type = 'purchase' and value > 40 group by 1)"""

QUERIES = {
    "join_chain_three": (
        join_chain_three,
        KEYED_SQL
        + " union all ".join(
            f" select c.id, c_name, n_orders, n_bought, '{how}' as how from customer3 c {how} join orders3 o on c.id = o.id"
            f" {how} join bought3 b on o.id = b.id"
            for how in ("inner", "left")
        ),
    ),
    "join_chain_literal": (
        join_chain_literal,
        KEYED_SQL
        + """ select c_name, n_orders, n_bought, 'orders.id' as tag from customer3 c join orders3 o on c.id = o.id
        join bought3 b on o.id = b.id and b.id % 2 = 0""",
    ),
    "join_full_three": (
        join_full_three,
        KEYED_SQL
        + """ select coalesce(c.id, o.id, b.id) as id, c_name, n_orders, n_bought, hot from customer3 c
        full join orders3 o on c.id = o.id full join bought3 b on c.id = b.id
        cross join (select unnest([false, true]) as hot)""",
    ),
    "pivot_rest": (
        pivot_rest,
        "select o_orderstatus, "
        + ", ".join(
            f"cast(sum(cast(o_totalprice as decimal(18,2))) filter (o_orderpriority {test}) as double) as \"{name}\""
            for name, test in (("1-URGENT", "= '1-URGENT'"), ("2-HIGH", "= '2-HIGH'"), ("others", "not in ('1-URGENT', '2-HIGH')"))
        )
        + " from orders group by 1",
    ),
    "kafka_decode_rejects": (
        kafka_decode_rejects,
        """select user_id, case when event_type <> 'error' then event_id end as event_id,
        case when event_type <> 'error' then value end as value,
        case when event_type = 'error' then left('{"event_id":' || event_id, 9) end as message from events""",
    ),
    "steps_quarantine": (
        steps_quarantine,
        """select event_id, event_type, value, nullif(concat_ws('; ', case when value < 1 then 'value >= 1' end,
        case when value > 120 then 'value <= 120' end,
        case when event_type = 'error' then 'event_type <> ''error''' end), '') as reasons from events""",
    ),
    "steps_reference_filter": (
        steps_reference_filter,
        """select event_id, user_id, user_id is null or user_id in
        (select c_custkey from customer where c_custkey % 3 <> 0) as found from events""",
    ),
    "steps_partitioned_load": (
        steps_partitioned_load,
        "select * exclude (o_orderdate) from orders where o_totalprice > 50000",
    ),
    "steps_streaming": (
        steps_streaming,
        "select event_id, event_type, value from events where event_type = 'view' and (value >= 5 or value is null)",
    ),
    "steps_kafka_rejects": (
        steps_kafka_rejects,
        """select user_id, event_id, value, cast(null as varchar) as message from events
        where event_type <> 'error' and (value > 10 or value is null)
        union all
        select user_id, null, null, left('{"event_id":' || event_id, 9) from events where event_type = 'error'""",
    ),
    "steps_incremental": (
        steps_incremental,
        """select o_orderkey, case when o_orderdate < timestamp '2000-06-01' then 0 else 1 end as lot
        from orders where o_orderdate > timestamp '1999-01-01'""",
    ),
    "job_incremental_rerun": (
        job_incremental_rerun,
        """select o_orderkey, o_custkey, cast(year(o_orderdate) as integer) as year from orders
        where o_orderdate > (select max(o_orderdate) from orders where o_orderdate < timestamp '2000-01-01')""",
    ),
    "dq_schema_nested": (
        dq_schema_nested,
        """select * from (values ('ids', 'array<bigint>', 'array<bigint>', 'ok', 0::bigint),
        ('seen', 'struct<kind:string,values:array<double>>', 'struct<kind:string,values:array<double>>', 'ok', 0),
        ('gone', 'map<string,int>', null, 'missing', 0)) as t("column", expected, actual, status, uncastable)""",
    ),
    "schema_compat_nested": (
        schema_compat_nested,
        """select * from (values ('ids', 'same', 'array<bigint>', 'array<bigint>', 0::bigint),
        ('marks', 'default', null, 'array<bigint>', 0)) as t(field, verdict, actual, target, failing_rows)""",
    ),
}
