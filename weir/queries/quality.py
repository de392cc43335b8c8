"""Validation reports, quarantine, schema checks and evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators import (
    drop_invalid,
    evolve,
    null_checks,
    orphans,
    quarantine,
    range_checks,
    rule_checks,
    schema_compat,
    schema_profile,
    validate_nulls,
    validate_ranges,
    validate_references,
    validate_rules,
    validate_schema,
    violation_report,
    violation_samples,
)
from weir.queries.tables import table

LINE_RANGES = {"l_quantity": {"min": 1, "max": 40}, "l_discount": [0.02, None]}
LINE_RULES = [
    "l_tax <= l_discount + 0.05",
    "l_returnflag in ('A', 'N') or l_linestatus = 'F'",
    "l_extendedprice >= l_quantity * 900",
]
EVENT_TARGET = {
    "type": "record",
    "name": "Event",
    "namespace": "weir.events",
    "fields": [
        {"name": "event_id", "type": "long"},
        {"name": "event_type", "type": "string"},
        {"name": "user_id", "type": "long"},
        {"name": "value", "type": "double"},
        {"name": "channel", "type": ["null", "string"], "default": None},
        {"name": "schema_version", "type": "int", "default": 2},
    ],
}
COMPAT_TARGET = {
    "type": "record",
    "name": "Event",
    "fields": [
        {"name": "event_id", "type": "long"},
        {"name": "event_type", "type": "int"},
        {"name": "user_id", "type": "string"},
        {"name": "value", "type": {"type": "bytes", "logicalType": "decimal", "precision": 4, "scale": 2}},
        {"name": "channel", "type": ["null", "string"], "default": None},
        {"name": "tenant", "type": "string"},
    ],
}


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and statuses with NULLs, which the tables do not have."""
    return table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')"))


def dq_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_schema(
        table(spark, sf_dir, "orders"),
        [
            {"name": "o_orderkey", "type": "long"},
            {"name": "o_custkey", "type": "int"},
            {"name": "o_orderstatus", "type": "string"},
            {"name": "o_orderpriority", "type": "double"},
            {"name": "o_totalprice", "type": "DOUBLE"},
            {"name": "o_comment", "type": "string"},
        ],
    )


def dq_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_nulls(_with_gaps(spark, sf_dir), ["o_orderkey", "o_custkey", "o_orderstatus"])


def dq_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_ranges(table(spark, sf_dir, "lineitem"), LINE_RANGES)


def dq_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        "o_orderstatus in ('F', 'O')",
        "o_totalprice > 2000",
        "o_orderdate <= date'2001-01-01'",
    ]
    return validate_rules(_with_gaps(spark, sf_dir), rules)


def dq_cross_column_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_rules(table(spark, sf_dir, "lineitem"), LINE_RULES)


def dq_fused_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null, range and rule checks of a table, counted in one scan."""
    checks = null_checks(["l_orderkey", "l_shipdate"]) + range_checks(LINE_RANGES) + rule_checks(LINE_RULES)
    return violation_report(table(spark, sf_dir, "lineitem"), checks)


def dq_referential(spark: SparkSession, sf_dir: str) -> DataFrame:
    building = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    return validate_references(table(spark, sf_dir, "orders"), "o_custkey", building, "c_custkey")


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans(
        table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id"
    )


def dq_composite_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-column foreign key: (part, supplier) pairs never sold in bulk."""
    lines, keys = table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"]
    return validate_references(lines, keys, lines.filter("l_quantity >= 40"), keys)


def dq_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = violation_samples(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount"
        ),
        range_checks(LINE_RANGES),
        ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"],
    )
    return samples.select("rule", "sample", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, failed = quarantine(table(spark, sf_dir, "lineitem"), range_checks(LINE_RANGES))
    return failed.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.array_join(F.sort_array("violations"), "; ").alias("reasons"),
    )


def dq_filter_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL verdicts pass, so rows with a NULL status stay."""
    kept = drop_invalid(
        _with_gaps(spark, sf_dir), rule_checks(["o_orderstatus = 'F'", "o_totalprice < 400000"])
    )
    return kept.select("o_orderkey", "o_orderstatus", "o_totalprice")


def schema_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = schema_profile(_with_gaps(spark, sf_dir), approx_distinct=False)
    return profile.select("column", "spark_type", "avro_type", "rows", "nulls")


def schema_profile_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each estimate of distinct values lies within a sixth of the exact count, for all columns."""
    lines = table(spark, sf_dir, "lineitem")
    exact = lines.agg(*[F.count_distinct(c).alias(c) for c in lines.columns])
    exact = exact.unpivot([], exact.columns, "column", "exact")
    profile = schema_profile(lines).select("column", "nulls", "approx_distinct")
    near = (F.abs(F.col("approx_distinct") - F.col("exact")) * 6 <= F.col("exact")).alias("near")
    return profile.join(exact, "column").select("column", "nulls", "exact", near)


def schema_compat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_compat(table(spark, sf_dir, "events"), COMPAT_TARGET)


def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evolve(table(spark, sf_dir, "events"), EVENT_TARGET)


def schema_evolve_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evolve(
        table(spark, sf_dir, "events").withColumn("user_id", F.col("user_id").cast("string")),
        EVENT_TARGET,
        cast=True,
        target_order=True,
        use_defaults=True,
    )


def report_sql(source: str, checks: list[tuple[str, str, str]]) -> str:
    """One row per (kind, rule, SQL that is true on violating rows)."""
    return " union all ".join(
        f"""select '{kind}' as kind, '{rule.replace("'", "''")}' as rule,
        count(*) filter ({broken}) as violations, count(*) as "rows" from {source}"""
        for kind, rule, broken in checks
    )


_GAPS = "(select * replace (nullif(o_orderstatus, 'P') as o_orderstatus) from orders)"
RANGE_CHECKS_SQL = [
    ("range", "l_quantity >= 1", "l_quantity < 1"),
    ("range", "l_quantity <= 40", "l_quantity > 40"),
    ("range", "l_discount >= 0.02", "l_discount < cast(0.02 as double)"),
]
RULE_CHECKS_SQL = [
    ("rule", LINE_RULES[0], "not (l_tax <= l_discount + cast(0.05 as double))"),
    ("rule", LINE_RULES[1], f"not ({LINE_RULES[1]})"),
    ("rule", LINE_RULES[2], f"not ({LINE_RULES[2]})"),
]

QUERIES = {
    "dq_schema": (
        dq_schema,
        """select * from (values
        ('o_orderkey', 'bigint', 'bigint', 'ok', 0::bigint),
        ('o_custkey', 'int', 'bigint', 'type_differs', 0),
        ('o_orderstatus', 'string', 'string', 'ok', 0),
        ('o_orderpriority', 'double', 'string', 'type_differs',
            (select count(*) from orders where try_cast(o_orderpriority as double) is null)),
        ('o_totalprice', 'double', 'double', 'ok', 0),
        ('o_comment', 'string', null, 'missing', 0)
        ) as t("column", expected, actual, status, uncastable)""",
    ),
    "dq_nulls": (
        dq_nulls,
        report_sql(
            _GAPS,
            [
                ("not_null", f"{c} is not null", f"{c} is null")
                for c in ("o_orderkey", "o_custkey", "o_orderstatus")
            ],
        ),
    ),
    "dq_ranges": (dq_ranges, report_sql("lineitem", RANGE_CHECKS_SQL)),
    "dq_rules": (
        dq_rules,
        report_sql(
            _GAPS,
            [
                ("rule", "o_orderstatus in ('F', 'O')", "not (o_orderstatus in ('F', 'O'))"),
                ("rule", "o_totalprice > 2000", "not (o_totalprice > 2000)"),
                ("rule", "o_orderdate <= date'2001-01-01'", "not (o_orderdate <= date '2001-01-01')"),
            ],
        ),
    ),
    "dq_cross_column_rules": (dq_cross_column_rules, report_sql("lineitem", RULE_CHECKS_SQL)),
    "dq_fused_report": (
        dq_fused_report,
        report_sql(
            "lineitem",
            [
                ("not_null", "l_orderkey is not null", "l_orderkey is null"),
                ("not_null", "l_shipdate is not null", "l_shipdate is null"),
            ]
            + RANGE_CHECKS_SQL
            + RULE_CHECKS_SQL,
        ),
    ),
    "dq_referential": (
        dq_referential,
        """select 'reference' as kind, 'o_custkey in c_custkey' as rule, count(distinct o_custkey) as violations,
        count(*) as "rows" from orders where o_custkey not in
        (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
    ),
    "dq_orphans": (
        dq_orphans,
        """select doc_id, count(*) as "rows" from documents
        where doc_id not in (select doc_id from labels) group by doc_id""",
    ),
    "dq_composite_references": (
        dq_composite_references,
        """select 'reference' as kind, 'l_partkey, l_suppkey in l_partkey, l_suppkey' as rule,
        count(distinct (l_partkey, l_suppkey)) as violations, count(*) as "rows" from lineitem a
        where not exists (select 1 from lineitem b where b.l_quantity >= 40
        and b.l_partkey = a.l_partkey and b.l_suppkey = a.l_suppkey)""",
    ),
    "dq_samples": (
        dq_samples,
        " union all ".join(
            f"""select * from (select '{rule}' as rule,
            cast(row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_quantity) as integer) as sample,
            l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem where {broken}) t where sample <= 5"""
            for _, rule, broken in RANGE_CHECKS_SQL
        ),
    ),
    "dq_quarantine": (
        dq_quarantine,
        """select l_orderkey, l_linenumber, l_partkey, concat_ws('; ',
        case when l_discount < cast(0.02 as double) then 'l_discount >= 0.02' end,
        case when l_quantity > 40 then 'l_quantity <= 40' end,
        case when l_quantity < 1 then 'l_quantity >= 1' end) as reasons
        from lineitem where l_discount < cast(0.02 as double) or l_quantity > 40 or l_quantity < 1""",
    ),
    "dq_filter_valid": (
        dq_filter_valid,
        f"""select o_orderkey, o_orderstatus, o_totalprice from {_GAPS}
        where coalesce(o_orderstatus = 'F', true) and o_totalprice < 400000""",
    ),
    "schema_profile": (
        schema_profile_query,
        """select * from (values
        ('o_orderkey', 'bigint', '["long","null"]', (select count(*) from orders), 0::bigint),
        ('o_custkey', 'bigint', '["long","null"]', (select count(*) from orders), 0),
        ('o_orderstatus', 'string', '["string","null"]', (select count(*) from orders),
            (select count(*) from orders where o_orderstatus = 'P')),
        ('o_totalprice', 'double', '["double","null"]', (select count(*) from orders), 0),
        ('o_orderdate', 'timestamp_ntz', '[{"type":"long","logicalType":"local-timestamp-micros"},"null"]',
            (select count(*) from orders), 0),
        ('o_orderpriority', 'string', '["string","null"]', (select count(*) from orders), 0)
        ) as t("column", spark_type, avro_type, "rows", nulls)""",
    ),
    "schema_profile_distinct": (
        schema_profile_distinct,
        " union all ".join(
            f"""select '{c}' as "column", count(*) - count({c}) as nulls, count(distinct {c}) as exact, true as near
            from lineitem"""
            for c in (
                "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
            )
        ),
    ),
    "schema_compat": (
        schema_compat_query,
        """select * from (values
        ('event_id', 'same', 'bigint', 'bigint', 0::bigint),
        ('event_type', 'type_differs', 'string', 'int',
            (select count(*) from events where try_cast(event_type as integer) is null)),
        ('user_id', 'type_differs', 'bigint', 'string', 0),
        ('value', 'type_differs', 'double', 'decimal(4,2)', (select count(*) from events where value >= 99.995)),
        ('channel', 'default', null, 'string', 0),
        ('tenant', 'missing', null, 'string', 0)
        ) as t(field, verdict, actual, target, failing_rows)""",
    ),
    "schema_evolve": (
        schema_evolve,
        """select event_id, user_id, event_type, value, cast(null as varchar) as channel,
        cast(null as integer) as schema_version from events""",
    ),
    "schema_evolve_defaults": (
        schema_evolve_defaults,
        """select event_id, event_type, user_id, value, cast(null as varchar) as channel,
        cast(2 as integer) as schema_version from events""",
    ),
}
