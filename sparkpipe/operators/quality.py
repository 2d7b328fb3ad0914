"""Rule suites over a table, in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F


class QualityError(Exception):
    """A rule of the suite failed."""


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def rule_suite(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule: ``rule, failed, total, passed``.

    A rule is the condition a good row meets; NULL counts as failed. All rules
    share a single scan and a single aggregate.
    """
    counts = df.agg(
        F.count("*").alias("total"),
        *[
            F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"failed_{i}")
            for i, ok in enumerate(rules.values())
        ],
    )
    rows = [
        F.struct(F.lit(name).alias("rule"), F.col(f"failed_{i}").alias("failed"))
        for i, name in enumerate(rules)
    ]
    return counts.select("total", F.inline(F.array(*rows))).select(
        "rule", "failed", "total", (F.col("failed") == 0).alias("passed")
    )


def observed(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with its rules counted by whatever action runs over it, and those counts.

    Gate and write so share one scan. Counts are exact where the rows are in the action's
    last stage; of a shuffle after them a lost executor may have some counted twice.
    """
    seen = Observation()
    counts = [
        F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"failed_{i}")
        for i, ok in enumerate(rules.values())
    ]
    return df.observe(seen, F.count(F.lit(1)).alias("total"), *counts), seen


def gate_observed(seen: Observation, rules: Mapping[str, Column]) -> dict[str, int]:
    """The failures by rule after the action; raise with every failing rule named."""
    counts = seen.get
    failed = {name: counts[f"failed_{i}"] for i, name in enumerate(rules)}
    faults = [f"{name} ({n} of {counts['total']})" for name, n in failed.items() if n]
    if faults:
        raise QualityError("; ".join(faults))
    return failed


def gate(report: DataFrame) -> None:
    """Raise with every failing rule named; the report has a row per rule."""
    failed = [f"{r.rule} ({r.failed} of {r.total})" for r in report.filter(~F.col("passed")).collect()]
    if failed:
        raise QualityError("; ".join(failed))


def curated_rules() -> dict[str, Column]:
    """Rules over the curated transaction columns."""
    return {
        "transaction_id_present": F.col("transaction_id").isNotNull(),
        "amount_not_negative": F.col("amount") >= 0,
        "amount_not_zero": ~F.col("is_amount_zero_flag"),
        "currency_is_code": F.col("currency").rlike("^[A-Z]{3}$"),
        "account_masked": F.length("hashed_account_id") == 64,
        "category_present": F.col("category").isNotNull(),
    }
