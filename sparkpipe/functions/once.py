"""Keeping an expensive expression from being evaluated more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def evaluated(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression the optimizer will not copy elsewhere.

    A filter on a derived column moves below the projection that makes it and
    takes a copy of the expression along, so a JSON parse would run once for
    the filter and again for the output. A one-element generator stops that
    and still adds exactly one value per row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
