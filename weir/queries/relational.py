"""Filters, enrichment, joins, aggregation, reshaping and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.functions import amount_sql, cents_sql, exact_sum, whole_to_amount
from weir.operators import (
    aggregate,
    enrich,
    filter_rows,
    join_frames,
    join_using,
    pivot,
    union_frames,
    unpivot,
)
from weir.plans import run_steps
from weir.plans.jobs import PRIORITIES
from weir.queries.tables import table

TODAY = "2002-01-01"


def filter_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filter_rows(
        table(spark, sf_dir, "orders"),
        "o_orderstatus in ('F', 'O') and o_totalprice >= 1500.5 and not (o_orderpriority = '5-LOW')",
    )
    return kept.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def filter_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filter_rows(
        table(spark, sf_dir, "lineitem"), "l_shipdate >= '1996-01-01' and l_shipdate < '1998-01-01'"
    )
    return kept.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
    )


def filter_enrich_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, two dependent expressions, filter: one scan, one projection."""
    kept = filter_rows(table(spark, sf_dir, "lineitem"), "l_quantity > 10")
    derived = enrich(
        kept,
        {"quantity_band": "floor(l_quantity / 10)", "wanted": "quantity_band >= 2"},
    )
    return filter_rows(derived, "wanted and l_discount < 0.05").select(
        "l_orderkey", "l_partkey", "l_quantity", "quantity_band"
    )


def enrich_case_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = enrich(
        table(spark, sf_dir, "orders"),
        {
            "is_large": "o_totalprice >= 250000",
            "band": "case when o_totalprice < 100000 then 'LOW' "
            "when o_totalprice < 300000 then 'MEDIUM' else 'HIGH' end",
            "needs_review": "case when is_large and o_orderstatus = 'P' then true else false end",
        },
    )
    return derived.select("o_orderkey", "is_large", "band", "needs_review")


def enrich_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = enrich(
        table(spark, sf_dir, "orders"),
        {
            "year": "year(o_orderdate)",
            "month": "month(o_orderdate)",
            "day": "dayofmonth(o_orderdate)",
            "order_date": "date_format(o_orderdate, 'yyyy-MM-dd')",
        },
    )
    return derived.select("o_orderkey", "year", "month", "day", "order_date")


def enrich_age_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = enrich(
        table(spark, sf_dir, "orders"), {"age_days": f"datediff(date'{TODAY}', o_orderdate)"}
    )
    return derived.select("o_orderkey", "age_days")


def enrich_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = enrich(
        table(spark, sf_dir, "events"),
        {
            "epoch": "unix_seconds(cast(ts as timestamp))",
            "event_time": "from_unixtime(epoch)",
            "event_date": "cast(to_date(from_unixtime(epoch)) as string)",
            "event_hour": "hour(from_unixtime(epoch))",
        },
    )
    return derived.select("event_id", "epoch", "event_time", "event_date", "event_hour")


def enrich_concat_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = enrich(
        table(spark, sf_dir, "part"),
        {
            "label": "concat(p_brand, ' ', p_type)",
            "brand_number": "cast(substring(p_brand, 7) as int)",
            "price_tens": "floor(p_retailprice / 10)",
            "size_mod": "p_size % 7",
            "double_price": "p_retailprice * 2",
            "price_per_step": "try_divide(p_retailprice, p_size - 1)",
        },
    )
    return derived.select(
        "p_partkey", "label", "brand_number", "price_tens", "size_mod", "double_price", "price_per_step"
    )


def _customers(spark: SparkSession, sf_dir: str, segment: str | None = None) -> DataFrame:
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "custkey")
    return customer.filter(F.col("c_mktsegment") == segment) if segment else customer


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")


def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_frames(
        [
            ("orders", _orders(spark, sf_dir)),
            ("customer", _customers(spark, sf_dir)),
            ("nation", table(spark, sf_dir, "nation")),
        ],
        ["orders.custkey = customer.custkey", "customer.c_nationkey = nation.n_nationkey"],
        broadcast=["nation"],
    )
    return joined.select("o_orderkey", "custkey", "c_name", "n_name", "o_totalprice")


def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_frames(
        {"orders": _orders(spark, sf_dir), "customer": _customers(spark, sf_dir, "BUILDING")},
        ["orders.custkey = customer.custkey"],
        "left",
    )
    return joined.select("o_orderkey", "custkey", "c_name")


def join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_frames(
        {"customer": _customers(spark, sf_dir, "BUILDING"), "orders": _orders(spark, sf_dir)},
        ["customer.custkey = orders.custkey"],
        "right",
    )
    return joined.select("custkey", "c_name", "o_orderkey")


def join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one segment against order totals; both sides have unique keys."""
    totals = aggregate(
        filter_rows(_orders(spark, sf_dir), "o_orderstatus = 'F'"),
        ["custkey"],
        {"n_orders": "count(*)", "top_price": "max(o_totalprice)"},
    )
    joined = join_frames(
        {"customer": _customers(spark, sf_dir, "MACHINERY"), "totals": totals},
        ["customer.custkey = totals.custkey"],
        "outer",
    )
    return joined.select("custkey", "c_name", "n_orders", "top_price")


def join_full_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level full join that stays balanced when one customer has most orders."""
    pricey = filter_rows(_orders(spark, sf_dir), "o_totalprice > 300000")
    joined = join_using(
        [_customers(spark, sf_dir, "MACHINERY"), pricey], "custkey", "outer", hot_keys=True
    )
    return joined.select("custkey", "c_name", "o_orderkey", "o_totalprice")


def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    pricey = filter_rows(_orders(spark, sf_dir), "o_totalprice > 490000")
    kept = join_using([_customers(spark, sf_dir), pricey], "custkey", "leftsemi", hot_keys=True)
    return kept.select("custkey", "c_name")


def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    pricey = filter_rows(_orders(spark, sf_dir), "o_totalprice > 450000")
    kept = join_using([_customers(spark, sf_dir), pricey], "custkey", "leftanti", hot_keys=True)
    return kept.select("custkey", "c_name")


def join_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cross join comes with a condition, which makes it an inner join."""
    joined = join_frames(
        {"supplier": table(spark, sf_dir, "supplier"), "nation": table(spark, sf_dir, "nation")},
        ["supplier.s_nationkey = nation.n_nationkey"],
        "cross",
        broadcast=["nation"],
    )
    return joined.select("s_suppkey", "s_name", "n_name")


def join_theta_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_frames(
        {"l": table(spark, sf_dir, "lineitem"), "o": table(spark, sf_dir, "orders")},
        [
            "l.l_orderkey = o.o_orderkey and l.l_shipdate > o.o_orderdate "
            "and l.l_extendedprice between o.o_totalprice * 0.05 and o.o_totalprice * 0.25"
        ],
    )
    return joined.select("l_orderkey", "l_linenumber", "l_extendedprice", "o_totalprice")


def join_using_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "nationkey")
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nationkey")
    joined = join_using([customer, nation], "nationkey", broadcast=True)
    return joined.select("nationkey", "c_custkey", "n_name")


def join_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by region, from facts collapsed to one row per order first."""
    revenue = aggregate(
        enrich(
            table(spark, sf_dir, "lineitem"),
            {"net": cents_sql("l_extendedprice * (1 - l_discount)", 4)},
        ),
        ["l_orderkey"],
        {"net": "sum", "l_linenumber": "count"},
    )
    joined = join_frames(
        {
            "revenue": revenue,
            "orders": table(spark, sf_dir, "orders"),
            "customer": table(spark, sf_dir, "customer"),
            "nation": table(spark, sf_dir, "nation"),
            "region": table(spark, sf_dir, "region"),
        },
        [
            "revenue.l_orderkey = orders.o_orderkey",
            "orders.o_custkey = customer.c_custkey",
            "customer.c_nationkey = nation.n_nationkey",
            "nation.n_regionkey = region.r_regionkey",
        ],
        broadcast=["nation", "region"],
    )
    return aggregate(
        joined,
        ["r_name"],
        # Whole regions may pass the range of a bigint; orders do not.
        {"lines": "sum(l_linenumber_count)", "revenue": "cast(sum(cast(net_sum as decimal(20,0))) / 10000 as double)"},
    )


def join_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order next to its successor: two aliases of one table, unique keys."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    joined = join_frames(
        [("a", orders), ("b", orders)], ["b.o_orderkey = a.o_orderkey + 1"], "left"
    )
    return joined.select(
        F.col("a.o_orderkey").alias("order_key"),
        F.col("b.o_orderkey").alias("next_key"),
        F.coalesce(F.col("b.o_totalprice") > F.col("a.o_totalprice"), F.lit(False)).alias("rises"),
    )


def aggregate_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = enrich(table(spark, sf_dir, "lineitem"), {"price": cents_sql("l_extendedprice")})
    grouped = aggregate(
        priced,
        ["l_returnflag", "l_linestatus"],
        {"price": "sum", "l_quantity": "mean", "l_partkey": "count", "l_discount": "min", "l_tax": "max"},
    )
    return enrich(grouped, {"price_sum": amount_sql("price_sum")})


def aggregate_exprs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate(
        table(spark, sf_dir, "events"),
        ["event_type"],
        {
            "total": "count(*)",
            "amount": amount_sql(f"sum({cents_sql('value')})"),
            "first_seen": "date_format(min(ts), 'yyyy-MM-dd HH:mm:ss')",
            "last_seen": "date_format(max(ts), 'yyyy-MM-dd HH:mm:ss')",
        },
    )


def aggregate_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = enrich(table(spark, sf_dir, "events"), {"day": "date_format(ts, 'yyyy-MM-dd')"})
    return aggregate(
        dated, ["day"], {"total": "count(*)", "unique_users": "count(distinct user_id)"}
    )


def aggregate_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate(
        table(spark, sf_dir, "orders"),
        [],
        {
            "o_orderkey": "count",
            "o_totalprice": "max",
            "total": amount_sql(f"sum({cents_sql('o_totalprice')})"),
        },
    )


def aggregate_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, sum, average, minimum and maximum over a thousand categories."""
    banded = enrich(
        table(spark, sf_dir, "lineitem"),
        {"category": "cast(l_partkey % 1000 as string)", "qty": "cast(l_quantity as bigint)"},
    )
    return aggregate(
        banded,
        ["category"],
        {
            "n": "count(*)",
            "qty_avg": "avg(qty)",
            "qty_sum": "sum(qty)",
            "price_min": "min(l_extendedprice)",
            "price_max": "max(l_extendedprice)",
        },
    )


def pivot_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = enrich(table(spark, sf_dir, "orders"), {"price": cents_sql("o_totalprice")})
    wide = pivot(priced, ["o_orderstatus"], "o_orderpriority", "price", values=PRIORITIES)
    return wide.select(
        "o_orderstatus", *[whole_to_amount(F.col(f"`{p}`")).alias(p) for p in PRIORITIES]
    )


def pivot_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = enrich(table(spark, sf_dir, "events"), {"day": "date_format(ts, 'yyyy-MM-dd')"})
    return pivot(
        dated, ["user_id", "day"], "event_type", values=["click", "error", "purchase", "signup", "view"]
    )


def pivot_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot(
        table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus", "o_custkey", "avg", ["F", "O", "P"]
    )


def unpivot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "nullif(p_retailprice, 900.1) as price",
        "cast(p_size as double) as size",
        "p_retailprice * 2 as double_price",
    )
    return unpivot(wide, ["price", "size", "double_price"], "metric", "amount")


def unpivot_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pivoted and turned back: one row per status and priority again."""
    wide = pivot_sum(spark, sf_dir)
    return unpivot(wide, PRIORITIES, "o_orderpriority", "total", ["o_orderstatus"])


def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    return union_frames(
        [
            filter_rows(events, "event_type in ('click', 'view')"),
            filter_rows(events, "event_type in ('view', 'error')"),
            filter_rows(events, "event_type in ('purchase', 'signup')"),
        ]
    )


def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type")
    return union_frames(
        [
            filter_rows(events, "event_type in ('click', 'view')"),
            filter_rows(events, "event_type in ('view', 'error')"),
        ],
        distinct=True,
    )


def distinct_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag").distinct()


def composed_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step list as users write it: filter, join, aggregate, enrich."""
    spec = {
        "name": "spend-by-segment",
        "mode": "batch",
        "steps": [
            {
                "type": "transform",
                "method": "filterRows",
                "config": {"condition": "o_orderstatus <> 'P'", "registerAs": "done"},
            },
            {
                "type": "transform",
                "method": "enrichData",
                "config": {
                    "columns": {"amount": cents_sql("o_totalprice")},
                    "registerAs": "done",
                },
            },
            {
                "type": "transform",
                "method": "joinDataFrames",
                "config": {
                    "inputDataFrames": ["done", "customers"],
                    "joinConditions": ["done.custkey = customers.custkey"],
                },
            },
            {
                "type": "transform",
                "method": "aggregateData",
                "config": {
                    "groupBy": ["c_mktsegment"],
                    "aggregations": {"amount": "sum", "o_orderkey": "count"},
                },
            },
            {
                "type": "transform",
                "method": "enrichData",
                "config": {
                    "columns": {
                        "amount_sum": amount_sql("amount_sum"),
                        "average": "amount_sum / o_orderkey_count",
                    }
                },
            },
        ],
    }
    frames = {"customers": _customers(spark, sf_dir)}
    return run_steps(spark, spec, frames, primary=_orders(spark, sf_dir)).current()


def aggregate_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact spend per customer: the documented form of an aggregate by key."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(exact_sum("o_totalprice").alias("spend"))
    )


_FULL_TOTALS = """
    select o_custkey as custkey, count(*) as n_orders, max(o_totalprice) as top_price
    from orders where o_orderstatus = 'F' group by o_custkey
"""

QUERIES = {
    "filter_rows": (
        filter_rows_query,
        """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders
        where o_orderstatus in ('F', 'O') and o_totalprice >= 1500.5 and o_orderpriority <> '5-LOW'""",
    ),
    "filter_date_range": (
        filter_date_range,
        """select l_orderkey, l_linenumber, l_quantity, strftime(l_shipdate, '%Y-%m-%d') as ship_date
        from lineitem where l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1998-01-01'""",
    ),
    "filter_enrich_filter": (
        filter_enrich_filter,
        """select l_orderkey, l_partkey, l_quantity, cast(floor(l_quantity / 10) as bigint) as quantity_band
        from lineitem where l_quantity > 10 and cast(floor(l_quantity / 10) as bigint) >= 2
        and l_discount < 0.05""",
    ),
    "enrich_case_flags": (
        enrich_case_flags,
        """select o_orderkey, o_totalprice >= 250000 as is_large,
        case when o_totalprice < 100000 then 'LOW' when o_totalprice < 300000 then 'MEDIUM' else 'HIGH' end as band,
        (o_totalprice >= 250000 and o_orderstatus = 'P') as needs_review from orders""",
    ),
    "enrich_date_parts": (
        enrich_date_parts,
        """select o_orderkey, cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
        cast(day(o_orderdate) as integer) as day, strftime(o_orderdate, '%Y-%m-%d') as order_date from orders""",
    ),
    "enrich_age_days": (
        enrich_age_days,
        f"""select o_orderkey, cast(date_diff('day', cast(o_orderdate as date), date '{TODAY}') as integer) as age_days
        from orders""",
    ),
    "enrich_epoch": (
        enrich_epoch,
        """select event_id, cast(floor(epoch(ts)) as bigint) as epoch,
        strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as event_time,
        strftime(ts, '%Y-%m-%d') as event_date, cast(hour(ts) as integer) as event_hour from events""",
    ),
    "enrich_concat_math": (
        enrich_concat_math,
        """select p_partkey, p_brand || ' ' || p_type as label, cast(substring(p_brand, 7) as integer) as brand_number,
        cast(floor(p_retailprice / 10) as bigint) as price_tens, p_size % 7 as size_mod,
        p_retailprice * 2 as double_price, p_retailprice / nullif(p_size - 1, 0) as price_per_step from part""",
    ),
    "join_inner": (
        join_inner,
        """select o_orderkey, o_custkey as custkey, c_name, n_name, o_totalprice from orders
        join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    ),
    "join_left": (
        join_left,
        """select o_orderkey, o_custkey as custkey, c_name from orders
        left join (select * from customer where c_mktsegment = 'BUILDING') c on o_custkey = c_custkey""",
    ),
    "join_right": (
        join_right,
        """select o_custkey as custkey, c_name, o_orderkey from
        (select * from customer where c_mktsegment = 'BUILDING') c right join orders on o_custkey = c_custkey""",
    ),
    "join_full": (
        join_full,
        f"""select coalesce(c_custkey, t.custkey) as custkey, c_name, n_orders, top_price
        from (select * from customer where c_mktsegment = 'MACHINERY') c
        full join ({_FULL_TOTALS}) t on c_custkey = t.custkey""",
    ),
    "join_full_hot_keys": (
        join_full_hot_keys,
        """select coalesce(c_custkey, o_custkey) as custkey, c_name, o_orderkey, o_totalprice
        from (select * from customer where c_mktsegment = 'MACHINERY') c
        full join (select * from orders where o_totalprice > 300000) o on c_custkey = o_custkey""",
    ),
    "join_semi": (
        join_semi,
        """select c_custkey as custkey, c_name from customer
        where exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 490000)""",
    ),
    "join_anti": (
        join_anti,
        """select c_custkey as custkey, c_name from customer
        where not exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 450000)""",
    ),
    "join_cross": (
        join_cross,
        """select s_suppkey, s_name, n_name from supplier cross join nation where s_nationkey = n_nationkey""",
    ),
    "join_theta_band": (
        join_theta_band,
        """select l_orderkey, l_linenumber, l_extendedprice, o_totalprice from lineitem
        join orders on l_orderkey = o_orderkey and l_shipdate > o_orderdate
        and l_extendedprice >= o_totalprice * cast(0.05 as double)
        and l_extendedprice <= o_totalprice * cast(0.25 as double)""",
    ),
    "join_using_broadcast": (
        join_using_broadcast,
        """select c_nationkey as nationkey, c_custkey, n_name from customer join nation on c_nationkey = n_nationkey""",
    ),
    "join_star": (
        join_star,
        """select r_name, count(*) as lines,
        cast(sum(cast(l_extendedprice * (1 - l_discount) as decimal(18,4))) as double) as revenue
        from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by r_name""",
    ),
    "join_self": (
        join_self,
        """select a.o_orderkey as order_key, b.o_orderkey as next_key, coalesce(b.o_totalprice > a.o_totalprice, false) as rises
        from orders a left join orders b on b.o_orderkey = a.o_orderkey + 1""",
    ),
    "aggregate_basic": (
        aggregate_basic,
        """select l_returnflag, l_linestatus, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as price_sum,
        avg(l_quantity) as l_quantity_avg, count(l_partkey) as l_partkey_count, min(l_discount) as l_discount_min,
        max(l_tax) as l_tax_max from lineitem group by l_returnflag, l_linestatus""",
    ),
    "aggregate_exprs": (
        aggregate_exprs,
        """select event_type, count(*) as total, cast(sum(cast(value as decimal(18,2))) as double) as amount,
        strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_seen
        from events group by event_type""",
    ),
    "aggregate_distinct": (
        aggregate_distinct,
        """select strftime(ts, '%Y-%m-%d') as day, count(*) as total, count(distinct user_id) as unique_users
        from events group by 1""",
    ),
    "aggregate_global": (
        aggregate_global,
        """select count(o_orderkey) as o_orderkey_count, max(o_totalprice) as o_totalprice_max,
        cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total from orders""",
    ),
    "aggregate_categories": (
        aggregate_categories,
        """select cast(l_partkey % 1000 as varchar) as category, count(*) as n, avg(cast(l_quantity as bigint)) as qty_avg,
        cast(sum(cast(l_quantity as bigint)) as bigint) as qty_sum, min(l_extendedprice) as price_min,
        max(l_extendedprice) as price_max from lineitem group by 1""",
    ),
    "pivot_sum": (
        pivot_sum,
        "select o_orderstatus, "
        + ", ".join(
            f"""cast(sum(cast(o_totalprice as decimal(18,2))) filter (o_orderpriority = '{p}') as double) as "{p}\""""
            for p in PRIORITIES
        )
        + " from orders group by o_orderstatus",
    ),
    "pivot_count": (
        pivot_count,
        "select user_id, strftime(ts, '%Y-%m-%d') as day, "
        + ", ".join(
            f"""nullif(count(*) filter (event_type = '{t}'), 0) as "{t}\""""
            for t in ("click", "error", "purchase", "signup", "view")
        )
        + " from events group by 1, 2",
    ),
    "pivot_avg": (
        pivot_avg,
        "select o_orderpriority, "
        + ", ".join(f"""avg(o_custkey) filter (o_orderstatus = '{s}') as "{s}\"""" for s in "FOP")
        + " from orders group by 1",
    ),
    "unpivot": (
        unpivot_query,
        """select p_partkey, 'price' as metric, nullif(p_retailprice, 900.1) as amount from part
        union all select p_partkey, 'size', cast(p_size as double) from part
        union all select p_partkey, 'double_price', p_retailprice * 2 from part""",
    ),
    "unpivot_totals": (
        unpivot_totals,
        """select o_orderstatus, o_orderpriority, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
        from orders group by o_orderstatus, o_orderpriority""",
    ),
    "union_all": (
        union_all,
        """select event_id, event_type, user_id from events
        union all select event_id, event_type, user_id from events where event_type = 'view'""",
    ),
    "union_distinct": (
        union_distinct,
        """select user_id, event_type from events where event_type in ('click', 'view')
        union select user_id, event_type from events where event_type in ('view', 'error')""",
    ),
    "distinct_projection": (
        distinct_projection,
        "select distinct l_suppkey, l_returnflag from lineitem",
    ),
    "composed_steps": (
        composed_steps,
        """select c_mktsegment, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as amount_sum,
        count(o_orderkey) as o_orderkey_count,
        cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(o_orderkey) as average
        from orders join customer on o_custkey = c_custkey where o_orderstatus <> 'P' group by c_mktsegment""",
    ),
    "aggregate_by_key": (
        aggregate_by_key,
        """select o_custkey, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as spend
        from orders group by o_custkey""",
    ),
}
