"""Table catalogue: schema rows with column statistics."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T


def profile(
    df: DataFrame, fraction: float | None = None, seed: int = 0, distinct: bool = True
) -> DataFrame:
    """One row per column, from a single aggregate over the table.

    ``fraction`` profiles a sample. The distinct count is a sketch estimate of
    fixed size; without it every statistic is exact.
    """
    rows = df.sample(fraction=fraction, seed=seed) if fraction is not None else df
    measures = [F.count("*").alias("total")]
    for i, field in enumerate(df.schema.fields):
        column = F.col(f"`{field.name}`")
        measures.append(F.count_if(column.isNull()).alias(f"nulls_{i}"))
        if isinstance(field.dataType, T.AtomicType):
            measures += [F.min(column).alias(f"low_{i}"), F.max(column).alias(f"high_{i}")]
            if distinct:
                measures.append(F.approx_count_distinct(column).alias(f"distinct_{i}"))
    measured = rows.agg(*measures)

    def entry(i: int, field: T.StructField):
        none = F.lit(None)
        atomic = isinstance(field.dataType, T.AtomicType)

        def bound(side: str):
            value = F.col(f"{side}_{i}") if atomic else none
            if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
                value = value + F.lit(0).cast(field.dataType)  # -0.0 reads as 0.0
            return value.cast("string").alias(side)

        return F.struct(
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
            F.col("total"),
            F.col(f"nulls_{i}").alias("nulls"),
            bound("low"),
            bound("high"),
            (F.col(f"distinct_{i}") if atomic and distinct else none)
            .cast("long")
            .alias("approx_distinct"),
        )

    entries = [entry(i, f) for i, f in enumerate(df.schema.fields)]
    out = measured.select(F.inline(F.array(*entries)))
    return out if distinct else out.drop("approx_distinct")


def catalog(
    tables: Mapping[str, DataFrame],
    include: str = ".*",
    exclude: str | None = None,
    fraction: float | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Profiles of the tables whose name matches, as one table and one job."""
    chosen = {
        name: df
        for name, df in tables.items()
        if re.fullmatch(include, name) and not (exclude and re.fullmatch(exclude, name))
    }
    profiles = [
        profile(df, fraction, distinct=distinct).select(F.lit(name).alias("table_name"), "*")
        for name, df in chosen.items()
    ]
    if not profiles:
        raise ValueError("no table name matches")
    return reduce(DataFrame.unionByName, profiles)
