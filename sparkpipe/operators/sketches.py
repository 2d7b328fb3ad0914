"""Profiles that add up: sketches of columns, kept per load and merged without a rescan.

A profile row is a column of a table. Its counts and bounds are exact; distinct values
are a HyperLogLog sketch and the order of numbers a KLL sketch, both of a size that does
not grow with the data. Sketches of files that come later are merged with those there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

LG_DISTINCT = 12  # 4,096 registers: about 1.6 % relative standard error
K_ORDER = 400  # about 0.7 % of rows off in rank
QUANTILES = (0.25, 0.5, 0.75)
ORDER = ("position", "column_name", "column_type")


def _hashable(column: Column, kind: T.DataType) -> Column:
    """A value the distinct sketch takes; other types by their text."""
    return column if isinstance(kind, (T.LongType, T.IntegerType, T.StringType)) else column.cast("string")


def column_sketches(df: DataFrame) -> DataFrame:
    """One mergeable row per column, from a single aggregate over ``df``.

    NaN counts as a value of its own and is left out of the order, as NULL is. Columns
    that are no plain values (lists, structs, maps) have counts only.
    """
    measures = [F.count("*").alias("total")]
    for i, field in enumerate(df.schema.fields):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        measures.append(F.count_if(column.isNull()).alias(f"nulls_{i}"))
        if not isinstance(kind, T.AtomicType):
            continue
        measures.append(F.hll_sketch_agg(_hashable(column, kind), LG_DISTINCT).alias(f"hll_{i}"))
        if isinstance(kind, T.NumericType):
            number = column.cast("double")
            number = F.when(~F.isnan(number), number)
            measures.append(F.kll_sketch_agg_double(number, K_ORDER).alias(f"kll_{i}"))
            measures += [F.min(number).alias(f"low_{i}"), F.max(number).alias(f"high_{i}")]
    measured = df.agg(*measures)
    there = set(measured.columns)

    def given(name: str, kind: str) -> Column:
        value = F.col(name) if name in there else F.lit(None)
        return value.cast(kind).alias(name.rsplit("_", 1)[0])

    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.col("total"),
            F.col(f"nulls_{i}").alias("nulls"),
            given(f"low_{i}", "double"),
            given(f"high_{i}", "double"),
            given(f"hll_{i}", "binary"),
            given(f"kll_{i}", "binary"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return measured.select(F.inline(F.array(*entries)))


def merged(sketches: Sequence[DataFrame]) -> DataFrame:
    """The sketches of several loads as those of all their rows together.

    A column that only later loads have counts as NULL in the rows before.
    """
    tagged = [s.withColumn("_load", F.lit(i)) for i, s in enumerate(sketches)]
    rows = reduce(DataFrame.unionByName, tagged)
    loads = rows.groupBy("_load").agg(F.max("total").alias("total"))
    all_rows = loads.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("all"))
    out = rows.groupBy("column_name", "column_type").agg(
        F.min("position").alias("position"),
        F.sum("total").alias("total"),
        F.sum("nulls").alias("nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("hll").alias("hll"),
        F.kll_merge_agg_double("kll", K_ORDER).alias("kll"),
        F.count("hll").alias("_hll"),
        F.count("kll").alias("_kll"),
    )
    out = out.crossJoin(F.broadcast(all_rows))  # one row
    return out.select(
        *ORDER,
        F.col("all").alias("total"),
        (F.col("nulls") + F.col("all") - F.col("total")).alias("nulls"),
        "low",
        "high",
        F.when(F.col("_hll") > 0, F.col("hll")).alias("hll"),
        F.when(F.col("_kll") > 0, F.col("kll")).alias("kll"),
    )


def sketched_profile(sketches: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Counts, bounds, distinct values and quantiles, read off the sketches."""
    filled = F.col("kll").isNotNull() & (F.kll_sketch_get_n_double("kll") > 0)
    points = F.kll_sketch_get_quantile_double("kll", F.array(*[F.lit(float(q)) for q in quantiles]))
    return sketches.select(
        *ORDER,
        "total",
        "nulls",
        "low",
        "high",
        F.hll_sketch_estimate("hll").alias("approx_distinct"),
        F.when(filled, points).alias("approx_quantiles"),
    )
