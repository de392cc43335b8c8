"""JDBC source."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Drivers, URL prefixes and default ports per database.
DATABASES = {
    "postgres": ("org.postgresql.Driver", "jdbc:postgresql", 5432),
    "mysql": ("com.mysql.cj.jdbc.Driver", "jdbc:mysql", 3306),
}
# Bounds and split count of a partitioned read.
LOWER_BOUND, UPPER_BOUND, PARTITIONS = 0, 1_000_000, 10


def jdbc_url(database: str, host: str, name: str, port: int | str | None = None) -> str:
    _, prefix, default_port = DATABASES[database]
    return f"{prefix}://{host}:{port or default_port}/{name}"


def jdbc_read_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    *,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    lower_bound: Any = LOWER_BOUND,
    upper_bound: Any = UPPER_BOUND,
    partitions: int | str = PARTITIONS,
    properties: Mapping[str, Any] | None = None,
) -> dict[str, str]:
    """Options for a table or query read, split when a column is named.

    A query wins over a table. Spark refuses ``query`` together with a
    partition column, so a split query is read as a derived table. Bounds only
    place the splits; rows outside them land in the first and last split, so
    :func:`read_jdbc` asks the database for them where they are not given.
    """
    if not (table or query):
        raise ValueError("either a table or a query is required")
    options: dict[str, Any] = {"url": url, "driver": driver, "user": user, "password": password}
    if query and not partition_column:
        options["query"] = query
    else:
        options["dbtable"] = f"({query}) t" if query else table
    if partition_column:
        options.update(
            partitionColumn=partition_column,
            lowerBound=lower_bound,
            upperBound=upper_bound,
            numPartitions=partitions,
        )
    options.update(properties or {})
    return {key: str(value) for key, value in options.items() if value is not None}


def newer_rows_query(table: str, column: str, mark: str | None) -> str:
    """Query for the rows past a mark, with the mark as a literal that the database sees.

    Give it to :func:`jdbc_read_options` as ``query``; split reads wrap it in ``dbtable``.
    """
    if mark is None:
        return f"select * from {table}"
    quoted = mark.replace("'", "''")
    return f"select * from {table} where {column} > '{quoted}'"


def bounds_query(partition_column: str, table: str | None = None, query: str | None = None) -> str:
    """Query for the least and the highest value of a partition column, one row."""
    source = f"({query}) t" if query else table
    return f"select min({partition_column}) as least, max({partition_column}) as highest from {source}"


def read_jdbc(spark: SparkSession, url: str, **options: Any) -> DataFrame:
    """Table or pushed-down query; see :func:`jdbc_read_options`. Needs the driver jar.

    A split read without bounds first asks the database for them; a table
    without rows, or with NULLs only, is read in one piece.
    """
    column = options.get("partition_column")
    if column and (options.get("lower_bound") is None or options.get("upper_bound") is None):
        source = {key: options.get(key) for key in ("table", "query")}
        access = {key: options.get(key) for key in ("driver", "user", "password", "properties")}
        asked = jdbc_read_options(url, query=bounds_query(column, **source), **access)
        found = spark.read.format("jdbc").options(**asked).load().first()
        options = {**options, **split_bounds(options, found)}
    return spark.read.format("jdbc").options(**jdbc_read_options(url, **options)).load()


def split_bounds(options: Mapping[str, Any], found: Any) -> dict[str, Any]:
    """Bounds given, completed by those found; without any, no split."""
    given = options.get("lower_bound"), options.get("upper_bound")
    least, highest = (own if own is not None else seen for own, seen in zip(given, found or (None, None)))
    if least is None or highest is None:
        return {"partition_column": None}
    return {"lower_bound": least, "upper_bound": highest}
