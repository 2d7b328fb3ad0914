"""Relational lookup scan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Read a table; with a partition column the read is split over tasks.

    The bounds set only the stride of the split, rows outside them are read too.
    """
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=dict(properties or {}))
    if lower is None or upper is None or not partitions:
        raise ValueError("a partitioned read needs lower, upper and partitions")
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=dict(properties or {}),
    )
