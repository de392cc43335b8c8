"""Range joins, prefix scans, counted sets, cubes, sketches, samples and lookups as of a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.functions import cents_sql
from weir.operators import enrich, filter_rows
from weir.operators.grouping import cube_sets, grouping_sets, rollup_sets
from weir.operators.ranges import range_join
from weir.operators.sampling import sample_per
from weir.operators.scans import ranked, running, shifted
from weir.operators.sets import intersect, subtract
from weir.operators.sketches import (
    distinct_estimate,
    frequent_estimates,
    merged,
    quantile_estimates,
    read_store,
    update_sketches,
)
from weir.operators.versions import as_of_join, validity_intervals
from weir.queries.tables import table
from weir.scratch import scratch_path


def join_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases, dated back to 1997, within the first days of urgent orders; no column is equal."""
    bought = filter_rows(table(spark, sf_dir, "events"), "event_type = 'purchase'")
    bought = bought.selectExpr("event_id", "ts - interval '27' year as at")
    urgent = filter_rows(table(spark, sf_dir, "orders"), "o_orderpriority = '1-URGENT'")
    periods = urgent.selectExpr("o_orderkey", "o_orderdate as opens", "o_orderdate + make_dt_interval(int(o_orderkey % 5)) as closes")
    return range_join(bought, periods, "at", "opens", "closes").select("event_id", "o_orderkey")


def join_interval_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with the suppliers of their line items whose balance band holds the part's price; parts without stay."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    bands = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey", "s_acctbal as low", "s_acctbal + 10 as high", "cast(1 + s_suppkey % 50 as int) as p_size"
    )
    return range_join(parts, bands, "p_retailprice", "low", "high", ["p_size"], "left").select("p_partkey", "s_suppkey")


def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with its customer's spending up to it, and with the number of the order."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    spent = running(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"cents": cents_sql("o_totalprice")}, "nth")
    return spent.selectExpr("o_custkey", "o_orderkey", "cents", "cast(nth as bigint) as nth")


def running_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders by date: how much of the whole had been ordered by then, over one key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return running(orders, [], ["o_orderdate", "o_orderkey"], {"cents": cents_sql("o_totalprice")}).select("o_orderkey", "cents")


def rank_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each line item among all by quantity and discount, with many ties."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return ranked(lines, [], {"l_quantity": "desc", "l_discount": "asc"}, "place", "dense_place")


def rank_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ranked(orders, ["o_orderpriority"], {"o_totalprice": "desc"}, "place")


def lag_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with the key of its customer's order before, of the one two before, and of the next."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    wanted = {"before": ("o_orderkey", -1), "two_before": ("o_orderkey", -2), "after": ("o_orderkey", 1)}
    return shifted(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], wanted).drop("o_orderdate")


def _flags(spark: SparkSession, sf_dir: str, flag: str) -> DataFrame:
    lines = filter_rows(table(spark, sf_dir, "lineitem"), f"l_returnflag = '{flag}'")
    return lines.selectExpr("l_suppkey", "if(l_quantity > 40, null, l_quantity) as l_quantity")


def set_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intersect(_flags(spark, sf_dir, "R"), _flags(spark, sf_dir, "A"))


def set_intersect_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intersect(_flags(spark, sf_dir, "R"), _flags(spark, sf_dir, "A"), keep_all=True)


def set_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subtract(_flags(spark, sf_dir, "R"), _flags(spark, sf_dir, "A"))


def set_except_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subtract(_flags(spark, sf_dir, "R"), _flags(spark, sf_dir, "A"), keep_all=True)


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(table(spark, sf_dir, "orders"), {"year": "year(o_orderdate)", "cents": cents_sql("o_totalprice")})


def sales_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["year", "o_orderpriority", "o_orderstatus"]
    measures = {"orders": ("count", "1"), "cents": ("sum", "cents"), "least": ("min", "o_totalprice"), "most": ("max", "o_totalprice")}
    return grouping_sets(_dated_orders(spark, sf_dir), cube_sets(columns), measures)


def sales_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = enrich(_dated_orders(spark, sf_dir), {"month": "month(o_orderdate)"})
    return grouping_sets(orders, rollup_sets(["year", "month"]), {"orders": ("count", "1"), "cents": ("sum", "cents")})


SKETCHES = {"users": ("distinct", "user_id"), "amounts": ("quantiles", "value"), "kinds": ("frequent", "event_type")}


def sketch_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates from daily sketches, loaded in two runs, beside exact values: are they within the stated error?"""
    events = table(spark, sf_dir, "events").select(
        "user_id", "value", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")
    )
    store = scratch_path(spark, "sketches")
    update_sketches(events.filter("day < '2024-01-16'"), store, "day", SKETCHES)
    update_sketches(events, store, "day", SKETCHES)
    guess = merged(read_store(spark, store), SKETCHES).select(
        distinct_estimate("users").alias("users"), quantile_estimates("amounts", [0.5, 0.95]).alias("amounts"),
        F.array_sort(frequent_estimates("kinds", 10)).alias("kinds"), "rows",
    ).first()
    kinds = ", ".join(f"struct('{k.item}' as item, {k['count']}L as count)" for k in guess.kinds or [])
    share = lambda i: f"count_if(value <= {guess.amounts[i] if guess.amounts else 0}D) / count(1)"
    exact = events.groupBy("event_type").agg(F.count("*").alias("n")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("event_type").alias("item"), F.col("n").alias("count")))).alias("k")
    )  # one row
    return events.selectExpr(
        "count(distinct user_id) as exact_users", "count(1) as exact_rows",
        "cast(count(distinct event_type) as int) as exact_kinds", f"count(1) = {guess.rows or 0} as same_rows",
        f"abs({guess.users or 0} - count(distinct user_id)) <= 0.05 * count(distinct user_id) as near_users",
        f"abs({share(0)} - 0.5) <= 0.03 as near_median", f"abs({share(1)} - 0.95) <= 0.03 as near_p95",
    ).withColumn("same_kinds", exact.select(F.col("k") == F.expr(f"array({kinds})")).scalar())


def sample_per_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    return sample_per(orders, ["o_orderpriority"], 100, ["o_orderkey"], seed=11)


def _prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = filter_rows(table(spark, sf_dir, "lineitem"), "l_returnflag = 'N' and l_partkey % 4 > 0")
    return sold.selectExpr("l_partkey", "l_shipdate as since", "l_orderkey as o", "l_linenumber as n", "l_extendedprice as price")


def asof_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned items with the price at which their part was last sold by then; the later order wins a tie."""
    back = filter_rows(table(spark, sf_dir, "lineitem"), "l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    found = as_of_join(back, _prices(spark, sf_dir), ["l_partkey"], "l_shipdate", "since", ["o", "n"])
    return found.select("l_orderkey", "l_linenumber", "price")


def price_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of each part with the times from and until which they hold."""
    spans = validity_intervals(_prices(spark, sf_dir), ["l_partkey"], "since", ["o", "n"])
    clock = "date_format({}, 'yyyy-MM-dd')"
    return spans.selectExpr("l_partkey", "o", "n", f"{clock.format('valid_from')} as valid_from", f"{clock.format('valid_to')} as valid_to")


CENTS = "cast(round(o_totalprice * 100) as bigint)"


def _set_sql(operation: str) -> str:
    side = "select l_suppkey, case when l_quantity <= 40 then l_quantity end as l_quantity from lineitem where l_returnflag = '{}'"
    return f"{side.format('R')} {operation} {side.format('A')}"


QUERIES = {
    "join_interval": (
        join_interval,
        """select e.event_id, o.o_orderkey from events e join orders o
            on e.ts - interval 27 year between o.o_orderdate and o.o_orderdate + interval 1 day * (o.o_orderkey % 5)
        where e.event_type = 'purchase' and o.o_orderpriority = '1-URGENT'""",
    ),
    "join_interval_left": (
        join_interval_left,
        """select p_partkey, s_suppkey from part left join supplier
            on p_size = 1 + s_suppkey % 50 and p_retailprice between s_acctbal and s_acctbal + 10""",
    ),
    "running_totals": (
        running_totals,
        f"""select o_custkey, o_orderkey, cast(sum({CENTS}) over w as bigint) as cents, row_number() over w as nth from orders
        window w as (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding)""",
    ),
    "running_share": (
        running_share,
        f"""select o_orderkey, cast(sum({CENTS}) over (order by o_orderdate, o_orderkey rows unbounded preceding) as bigint) as cents
        from orders""",
    ),
    "rank_overall": (
        rank_overall,
        """select l_orderkey, l_linenumber, l_quantity, l_discount, rank() over w as place, dense_rank() over w as dense_place
        from lineitem window w as (order by l_quantity desc, l_discount)""",
    ),
    "rank_within": (
        rank_within,
        """select o_orderkey, o_orderpriority, o_totalprice,
            rank() over (partition by o_orderpriority order by o_totalprice desc) as place from orders""",
    ),
    "lag_lead": (
        lag_lead,
        """select o_custkey, o_orderkey, lag(o_orderkey) over w as before, lag(o_orderkey, 2) over w as two_before,
            lead(o_orderkey) over w as after
        from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)""",
    ),
    "set_intersect": (set_intersect, _set_sql("intersect")),
    "set_intersect_all": (set_intersect_all, _set_sql("intersect all")),
    "set_except": (set_except, _set_sql("except")),
    "set_except_all": (set_except_all, _set_sql("except all")),
    "sales_cube": (
        sales_cube,
        f"""select cast(year(o_orderdate) as int) as year, o_orderpriority, o_orderstatus,
            cast(grouping_id(year(o_orderdate), o_orderpriority, o_orderstatus) as bigint) as grouping_id,
            count(*) as orders, cast(sum({CENTS}) as bigint) as cents, min(o_totalprice) as least, max(o_totalprice) as most
        from orders group by cube (year(o_orderdate), o_orderpriority, o_orderstatus)""",
    ),
    "sales_rollup": (
        sales_rollup,
        f"""select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
            cast(grouping_id(year(o_orderdate), month(o_orderdate)) as bigint) as grouping_id,
            count(*) as orders, cast(sum({CENTS}) as bigint) as cents
        from orders group by rollup (year(o_orderdate), month(o_orderdate))""",
    ),
    "sketch_estimates": (
        sketch_estimates,
        """select count(distinct user_id) as exact_users, count(*) as exact_rows,
            cast(count(distinct event_type) as int) as exact_kinds, true as same_rows, true as near_users,
            true as near_median, true as near_p95, true as same_kinds
        from events""",
    ),
    "sample_per_priority": (
        sample_per_priority,
        """select o_orderkey, o_orderpriority, o_custkey from orders
        qualify row_number() over (partition by o_orderpriority order by md5('11|=' || o_orderkey)) <= 100""",
    ),
    "asof_price": (
        asof_price,
        """with prices as (
            select l_partkey, l_shipdate as since, l_extendedprice as price,
                row_number() over (partition by l_partkey, l_shipdate order by l_orderkey desc, l_linenumber desc) as nth
            from lineitem where l_returnflag = 'N' and l_partkey % 4 > 0
        ), back as (select l_orderkey, l_linenumber, l_partkey, l_shipdate from lineitem where l_returnflag = 'R')
        select b.l_orderkey, b.l_linenumber, p.price
        from back b asof left join (select * from prices where nth = 1) p
            on b.l_partkey = p.l_partkey and b.l_shipdate >= p.since""",
    ),
    "price_validity": (
        price_validity,
        """select l_partkey, l_orderkey as o, l_linenumber as n, strftime(l_shipdate, '%Y-%m-%d') as valid_from,
            strftime(lead(l_shipdate) over (partition by l_partkey order by l_shipdate, l_orderkey, l_linenumber), '%Y-%m-%d') as valid_to
        from lineitem where l_returnflag = 'N' and l_partkey % 4 > 0""",
    ),
}
