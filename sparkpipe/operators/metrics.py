"""Ingest counters, histograms and most-recent reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkpipe.functions.scalars import bucket_index

# Histogram boundaries of the ingest duration instrument.
BOUNDARIES = (
    0.01, 0.05, 0.1, 0.2, 0.5, 1.0, 2.5, 5.0, 10.0, 20.0, 50.0, 100.0,
    200.0, 500.0, 1000.0, 2000.0, 5000.0, 10000.0,
)


def counters(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    return df.groupBy(*attributes).agg(F.count("*").alias("ingested_total"))


def ingest_status(route: Column) -> Column:
    return F.when(route == "curated", "success").otherwise("failed")


def histogram(
    df: DataFrame,
    value: str,
    attributes: Sequence[str],
    boundaries: Sequence[float] = BOUNDARIES,
) -> DataFrame:
    """Count, sum, min and max per attribute set and bucket; NULLs are not recorded.

    Sums are doubles: no fixed number of digits holds both tiny and huge values. Their
    last digits depend on the order of tasks.
    """
    measured = df.filter(F.col(value).isNotNull()).withColumn(
        "bucket", bucket_index(F.col(value), boundaries)
    )
    upper = F.get(F.array(*[F.lit(float(b)) for b in boundaries]), F.col("bucket"))
    return (
        measured.groupBy(*attributes, "bucket")
        .agg(
            F.count("*").alias("count"),
            F.sum(F.col(value).cast("double")).alias("sum"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )
        .withColumn("upper_bound", upper)
    )


def most_recent(df: DataFrame, time: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The k newest rows: a bounded heap per task, no full sort."""
    return df.orderBy(F.col(time).desc(), *[F.col(c) for c in tie_break]).limit(k)
