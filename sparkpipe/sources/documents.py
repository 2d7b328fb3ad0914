"""Nested document collections and JSON record files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T


def read_documents(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "json",
    options: Mapping[str, str] | None = None,
    schema: T.StructType | str | None = None,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """Read a collection; without a schema it is inferred.

    Inference reads the input once more, so give a schema or a sampling ratio
    for a large collection.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    elif sampling_ratio is not None:
        reader = reader.option("samplingRatio", sampling_ratio)
    return reader.load(path) if path else reader.load()


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Landing files holding JSON records of a known schema."""
    return spark.read.schema(schema).json(path)


def write_json_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write records as JSON lines; unset fields are left out of the text."""
    df.write.mode(mode).option("ignoreNullFields", True).json(path)
