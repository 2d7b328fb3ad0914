"""Topic and arriving-file streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T


def topic_stream(
    spark: SparkSession,
    brokers: str,
    topic: str,
    fmt: str = "kafka",
    per_trigger: int | None = 1_000_000,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A topic read from its earliest offset; the broker connector is the user's.

    A first run from the earliest offset has a whole topic before it, so a micro-batch
    takes ``per_trigger`` messages at most. ``options`` go to the connector and may
    override all of this.
    """
    given = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **({"maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else {}),
        **(options or {}),
    }
    return spark.readStream.format(fmt).options(**given).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_trigger: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Files under a prefix, each taken in once per checkpoint."""
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)
