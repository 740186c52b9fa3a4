"""Relational sources over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    query: str | None = None,
    table: str | None = None,
    *,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Reader options; a partition column makes executors read ranges of it in parallel."""
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    options = {"url": url, "fetchsize": str(fetch_size), **properties}
    if partition_column is None:
        options["query" if query is not None else "dbtable"] = query or table
        return options
    if lower is None or upper is None or not partitions:
        raise ValueError("a partitioned read needs lower, upper and partitions")
    options.update(
        dbtable=table if table is not None else f"({query}) q",
        partitionColumn=partition_column,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=str(partitions),
    )
    return options


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()
