"""The steps from messages to scored transactions, composed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkpipe.operators.contracts import check, typed_records
from sparkpipe.operators.curate import curate
from sparkpipe.operators.quality import curated_rules, gate_observed, observed
from sparkpipe.operators.score import (
    THRESHOLD,
    TRAINING_ROWS,
    features,
    fit,
    score,
    score_linear,
)
from sparkpipe.sources.tables import write_table


def curated_records(messages: DataFrame, domain: str, value: str = "value") -> DataFrame:
    """Typed records of the messages that meet their contract."""
    return typed_records(check(messages, domain, value).filter(F.col("route") == "curated"))


def messages_to_curated(messages: DataFrame, lookup: DataFrame | None) -> DataFrame:
    return curate(curated_records(messages, "financial"), lookup)


def messages_to_scored(
    spark: SparkSession,
    messages: DataFrame,
    lookup: DataFrame | None,
    curated_path: str,
    must_pass: tuple[str, ...] = ("transaction_id_present", "amount_not_negative", "account_masked"),
    threshold: float = THRESHOLD,
    training_rows: int | None = TRAINING_ROWS,
    weights: tuple[float, dict[str, float]] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Curate, count the rules' failures while writing, gate, then score what is written.

    Messages are decoded once, and the table is not read again for the gate. The written
    table cuts the lineage for fit and scoring. With a given model nothing is fitted.
    """
    rules = curated_rules()
    chosen = {name: rules[name] for name in must_pass}
    rows, seen = observed(messages_to_curated(messages, lookup), chosen)
    curated = write_table(rows, curated_path, fmt)
    gate_observed(seen, chosen)
    featured = features(curated, threshold)
    if weights is not None:
        return score_linear(featured, *weights)
    return score(featured, fit(featured, training_rows))
