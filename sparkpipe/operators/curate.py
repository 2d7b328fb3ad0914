"""Raw transactions to the curated table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkpipe.functions.scalars import amount_or_zero, clean_code, mask, zero_flag
from sparkpipe.operators.joins import keyed_join
from sparkpipe.operators.merge import unique_by_key


def cleanse(df: DataFrame, numeric: str = "double") -> DataFrame:
    """Add ``amount_clean``, ``currency_clean`` and the zero-amount flag."""
    return df.withColumns(
        {
            "amount_clean": amount_or_zero(F.col("amount"), numeric),
            "currency_clean": clean_code(F.col("currency")),
        }
    ).withColumn("is_amount_zero_flag", zero_flag(F.col("amount_clean")))


def enrich(df: DataFrame, lookup: DataFrame | None, small: bool | None = None) -> DataFrame:
    """Add ``enriched_category``: the lookup's category, else the record's own.

    Without a lookup the record's own category is used. A merchant must be in the
    lookup once only; its rows without a merchant match nothing.
    """
    if lookup is None:
        return df.withColumn("enriched_category", F.col("category"))
    side = lookup.select("merchant_id", F.col("category").alias("_lookup_category"))
    side = unique_by_key(side.filter(F.col("merchant_id").isNotNull()), ["merchant_id"])
    known = ["transaction_id"] if "transaction_id" in df.columns else None
    joined = keyed_join(df, side, ["merchant_id"], "left", small, salt_by=known)
    return joined.withColumn(
        "enriched_category", F.coalesce("_lookup_category", "category")
    ).drop("_lookup_category")


def curate(
    raw: DataFrame,
    lookup: DataFrame | None = None,
    numeric: str = "double",
    small: bool | None = None,
) -> DataFrame:
    """The curated columns in order, account masked, exact duplicates removed.

    ``distinct`` collapses copies inside each task before the only shuffle.
    """
    return (
        enrich(cleanse(raw, numeric), lookup, small)
        .select(
            "transaction_id",
            "timestamp",
            mask(F.col("account_id")).alias("hashed_account_id"),
            F.col("amount_clean").alias("amount"),
            F.col("currency_clean").alias("currency"),
            "transaction_type",
            "merchant_id",
            F.col("enriched_category").alias("category"),
            "is_amount_zero_flag",
        )
        .distinct()
    )


def stamped(df: DataFrame, column: str = "processed_at") -> DataFrame:
    """Add the processing time, last, so that it cannot defeat ``distinct``."""
    return df.withColumn(column, F.current_timestamp())
