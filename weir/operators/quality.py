"""Data-quality validation.

A check is a name and a column that is TRUE on rows that break it; NULL
verdicts pass. All checks of a report are counted in one scan. Reports are
DataFrames; ``fail_fast`` turns a report with violations into an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_SIZE = 5
# Fixed value: the largest rank limit that Spark applies before a shuffle.
PUSHED_LIMIT = 1000
SAMPLE_SHARDS = 256


class ValidationFailed(ValueError):
    """Raised by ``fail_fast``; carries the broken checks and sample rows."""

    def __init__(self, failures: list[dict[str, Any]], samples: list[dict[str, Any]]):
        self.failures = failures
        self.samples = samples
        lines = ", ".join(f"{f['rule']}: {f['violations']}" for f in failures)
        super().__init__(f"validation failed ({lines})")


class Check(NamedTuple):
    kind: str
    rule: str
    violated: Column


def null_checks(columns: Sequence[str]) -> list[Check]:
    return [Check("not_null", f"{c} is not null", F.col(c).isNull()) for c in columns]


def range_checks(ranges: Mapping[str, Mapping[str, Any] | Sequence[Any]]) -> list[Check]:
    """Inclusive bounds as ``{"min": a, "max": b}`` or ``[a, b]``; either may be missing."""
    checks = []
    for column, bounds in ranges.items():
        if isinstance(bounds, Mapping):
            low, high = bounds.get("min"), bounds.get("max")
        else:
            low, high = bounds
        if low is not None:
            checks.append(Check("range", f"{column} >= {low}", F.col(column) < F.lit(low)))
        if high is not None:
            checks.append(Check("range", f"{column} <= {high}", F.col(column) > F.lit(high)))
    return checks


def rule_checks(rules: Sequence[str]) -> list[Check]:
    """SQL predicates every row must satisfy, over one or several columns."""
    return [Check("rule", rule, ~F.expr(rule)) for rule in rules]


def violation_report(df: DataFrame, checks: Sequence[Check], fail_fast: bool = False) -> DataFrame:
    """One row per check: kind, rule, violations, rows. One scan for all."""
    if not checks:
        raise ValueError("give at least one check")
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(check.violated).alias(f"_{i}") for i, check in enumerate(checks)],
    )
    lines = [
        F.struct(
            F.lit(check.kind).alias("kind"),
            F.lit(check.rule).alias("rule"),
            F.col(f"_{i}").alias("violations"),
            F.col("_rows").alias("rows"),
        )
        for i, check in enumerate(checks)
    ]
    report = totals.select(F.inline(F.array(*lines)))
    if fail_fast:
        failures = [row.asDict() for row in report.filter("violations > 0").collect()]
        if failures:
            raise ValidationFailed(failures, _first_offenders(df, checks))
    return report


def _first_offenders(df: DataFrame, checks: Sequence[Check]) -> list[dict[str, Any]]:
    return [row.asDict() for row in df.filter(any_violated(checks)).take(SAMPLE_SIZE)]


def validate_nulls(df: DataFrame, columns: Sequence[str], fail_fast: bool = False) -> DataFrame:
    return violation_report(df, null_checks(columns), fail_fast)


def validate_ranges(
    df: DataFrame, ranges: Mapping[str, Mapping[str, Any] | Sequence[Any]], fail_fast: bool = False
) -> DataFrame:
    return violation_report(df, range_checks(ranges), fail_fast)


def validate_rules(df: DataFrame, rules: Sequence[str], fail_fast: bool = False) -> DataFrame:
    return violation_report(df, rule_checks(rules), fail_fast)


def orphans(
    df: DataFrame,
    foreign_key: str | Sequence[str],
    referenced: DataFrame,
    referenced_key: str | Sequence[str],
) -> DataFrame:
    """Foreign-key values without a partner, with the rows that hold each.

    NULL keys are not checked. Rows collapse to counted values before the
    shuffle, so a hot key costs one row per task.
    """
    keys = [foreign_key] if isinstance(foreign_key, str) else list(foreign_key)
    others = [referenced_key] if isinstance(referenced_key, str) else list(referenced_key)
    if len(keys) != len(others):
        raise ValueError("foreign and referenced key need the same number of columns")
    present = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])
    used = df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    known = referenced.select(
        *[F.col(other).alias(key) for key, other in zip(keys, others)]
    ).distinct()
    return used.join(known, keys, "left_anti")


def validate_references(
    df: DataFrame,
    foreign_key: str | Sequence[str],
    referenced: DataFrame,
    referenced_key: str | Sequence[str],
    fail_fast: bool = False,
) -> DataFrame:
    """One row: distinct orphaned values and the rows holding them."""
    lost = orphans(df, foreign_key, referenced, referenced_key)
    keys = [foreign_key] if isinstance(foreign_key, str) else list(foreign_key)
    others = [referenced_key] if isinstance(referenced_key, str) else list(referenced_key)
    report = lost.agg(
        F.lit("reference").alias("kind"),
        F.lit(f"{', '.join(keys)} in {', '.join(others)}").alias("rule"),
        F.count(F.lit(1)).alias("violations"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"),
    )
    if fail_fast:
        failures = [row.asDict() for row in report.filter("violations > 0").collect()]
        if failures:
            samples = lost.orderBy(*keys).limit(SAMPLE_SIZE).collect()
            raise ValidationFailed(failures, [row.asDict() for row in samples])
    return report


def with_violations(df: DataFrame, checks: Sequence[Check], column: str = "violations") -> DataFrame:
    """Add the array of broken rules to every row. Narrow, so it works on streams."""
    if not checks:
        raise ValueError("give at least one check")
    none = F.array().cast("array<string>")
    # Joined arrays stay in generated code; filtering NULLs out of one would not.
    broken = [F.when(check.violated, F.array(F.lit(check.rule))).otherwise(none) for check in checks]
    return df.withColumn(column, F.concat(*broken))


def any_violated(checks: Sequence[Check]) -> Column:
    """TRUE on rows that break a check; FALSE or NULL on the others."""
    return reduce(lambda a, b: a | b, [check.violated for check in checks])


def quarantine(
    df: DataFrame, checks: Sequence[Check], column: str = "violations"
) -> tuple[DataFrame, DataFrame]:
    """Split into rows that pass and rows that fail, the latter with reasons."""
    broken = any_violated(checks)
    clean = df.filter(~F.coalesce(broken, F.lit(False)))
    return clean, with_violations(df.filter(broken), checks, column)


def split_references(
    df: DataFrame, foreign_key: str | Sequence[str], referenced: DataFrame, referenced_key: str | Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is referenced or has a NULL part, and the others."""
    keys = [foreign_key] if isinstance(foreign_key, str) else list(foreign_key)
    others = [referenced_key] if isinstance(referenced_key, str) else list(referenced_key)
    known = referenced.select(*[F.col(o).alias(f"_ref_{i}") for i, o in enumerate(others)]).distinct()
    on = [df[k] == known[f"_ref_{i}"] for i, k in enumerate(keys)]
    partial = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    kept = df.join(known, on, "left_semi").unionByName(df.filter(partial))
    return kept, df.filter(~partial).join(known, on, "left_anti")


def drop_invalid(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Only the rows that pass every check."""
    return quarantine(df, checks)[0]


def violation_samples(
    df: DataFrame, checks: Sequence[Check], key: Sequence[str], limit: int = SAMPLE_SIZE
) -> DataFrame:
    """The first ``limit`` violating rows of each rule, in key order.

    The rank filter is applied in every task before the shuffle, so a rule
    that a third of the table breaks still moves ``limit`` rows per task. Spark
    does so up to ``PUSHED_LIMIT``; beyond, rows are ranked in ``SAMPLE_SHARDS``
    shards of each rule first.
    """
    _, failed = quarantine(df, checks, "_broken")
    broken = failed.withColumn("rule", F.explode("_broken")).drop("_broken")
    if limit > PUSHED_LIMIT:
        shard = F.pmod(F.xxhash64(*key), F.lit(SAMPLE_SHARDS))
        within = F.row_number().over(Window.partitionBy("rule", "_shard").orderBy(*key))
        broken = broken.withColumn("_shard", shard).withColumn("_place", within)
        broken = broken.filter(F.col("_place") <= limit).drop("_shard", "_place")
    rank = F.row_number().over(Window.partitionBy("rule").orderBy(*key))
    return broken.withColumn("sample", rank).filter(F.col("sample") <= limit)
