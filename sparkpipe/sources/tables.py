"""Table scans and lookups by path."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan a table by path, with zone-less timestamps made instants.

    A zone-less timestamp cannot carry a streaming watermark and does not
    match the declared schemas.
    """
    return instants(spark.read.format(fmt).options(**(options or {})).load(path))


def instants(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in names}) if names else df


def table_exists(
    spark: SparkSession, path: str, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> bool:
    try:
        spark.read.format(fmt).options(**(options or {})).load(path)
    except AnalysisException:
        return False
    return True


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> DataFrame:
    """Replace a table's rows and schema; the table read back.

    The frame must not read from the folder it replaces, unless the format keeps
    earlier versions. ``options`` are the format's own, as ``overwriteSchema``.
    """
    df.write.format(fmt).mode("overwrite").options(**(options or {})).save(path)
    return read_table(df.sparkSession, path, fmt)


@dataclass(frozen=True)
class Bucketed:
    """A table of the catalog that lies bucketed and sorted by its keys."""

    name: str
    keys: tuple[str, ...]
    buckets: int

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


def write_bucketed(
    df: DataFrame,
    folder: str,
    keys: Sequence[str],
    buckets: int,
    name: str | None = None,
    dealt: bool = False,
    fmt: str = "parquet",
) -> Bucketed:
    """Write ``df`` to ``folder`` as a bucketed table, one file per bucket.

    Joins and aggregates on the keys then read it without an exchange. ``dealt`` says
    that the rows already lie by bucket, as those of a join with another table of as many
    buckets do: they are written where they are. Rows that do not are still put into
    their buckets, only in more files. NULL keys share a bucket.
    """
    name = name or f"bucketed_{uuid.uuid4().hex}"
    rows = df if dealt else df.repartition(buckets, *keys)
    out = rows.write.format(fmt).mode("overwrite").option("path", folder)
    out.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return Bucketed(name, tuple(keys), buckets)


def create_if_absent(
    df: DataFrame, path: str, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> bool:
    """Write ``df`` unless the table exists; tell whether it did."""
    if table_exists(df.sparkSession, path, fmt):
        return False
    write_table(df, path, fmt, options)
    return True


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append to a table; read it with ``mergeSchema`` to see columns added later."""
    df.write.format(fmt).mode("append").save(path)


def add_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both; a column only one of them has is NULL for the other's rows."""
    return old.unionByName(new, allowMissingColumns=True)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def lookup_sql(
    spark: SparkSession, path: str, column: str, value: object, fmt: str = "parquet"
) -> DataFrame:
    """Rows of a path-addressed table with ``column = value``, through SQL text."""
    table = path.replace("`", "``")
    name = column.replace("`", "``")
    text = f"SELECT * FROM {fmt}.`{table}` WHERE `{name}` = :value"
    return instants(spark.sql(text, args={"value": value}))


def exists(df: DataFrame, condition) -> DataFrame:
    """One row telling whether any row meets the condition; stops at the first."""
    return df.filter(condition).limit(1).agg((F.count("*") > 0).alias("found"))


def suffix_filter(df: DataFrame, column: str, suffix: str) -> DataFrame:
    return df.filter(F.col(column).endswith(suffix))


def is_empty(df: DataFrame) -> bool:
    """Stop-early test that does not scan the whole input."""
    return df.isEmpty()


def preview(df: DataFrame, rows: int = 5) -> None:
    """Print schema and a few rows. Each call is an action, so it is opt-in."""
    df.printSchema()
    df.show(rows, truncate=False)
