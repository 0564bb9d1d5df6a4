"""Relational database scan (S1) through Spark's JDBC source.

A SQL text runs as ``query``.  For a big table, a numeric key, its bounds and
a partition count split the read into parallel range queries, one per task;
``query`` and ``partitionColumn`` exclude each other in Spark, so a query is
then wrapped as a derived table in ``dbtable``.  Filters and column
selections applied to the result are pushed into the database's SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULT_FETCH_SIZE = 10_000


def postgres_url(host: str, port: int, database: str) -> str:
    return f"jdbc:postgresql://{host}:{port}/{database}"


def jdbc_options(
    url: str,
    *,
    query: str | None = None,
    table: str | None = None,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = DEFAULT_FETCH_SIZE,
) -> dict[str, str]:
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query= or table=")
    opts: dict[str, str] = {"url": url, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partitioned read needs lower_bound, upper_bound and num_partitions")
        opts["dbtable"] = table if table is not None else f"({query}) AS src"
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    elif query is not None:
        opts["query"] = query
    else:
        opts["dbtable"] = table  # type: ignore[assignment]
    return opts


def key_bounds(spark: SparkSession, url: str, source: str, key: str, **conn) -> tuple[int, int]:
    """min/max of ``key`` computed by the database (one tiny query)."""
    q = f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM ({source}) AS b"
    row = spark.read.format("jdbc").options(**jdbc_options(url, query=q, **conn)).load().first()
    return int(row[0]), int(row[1])


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """Run a query (or scan a table) on a database, optionally in parallel."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()
