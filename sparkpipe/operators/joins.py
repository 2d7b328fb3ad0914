"""Equi-joins against a keyed side that hold up under a hot key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024
HOT_SHARE = 0.001


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure whether a side is small enough to broadcast."""
    return measured_small(df, [], max_rows, max_bytes) is not None


def measured_small(
    df: DataFrame,
    also: Sequence[Column],
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> Row | None:
    """The values of the aggregates ``also`` over a small side, None for a large one.

    First asks for the row after ``max_rows``: Spark then reads partition by
    partition and stops early, so a large side costs little. Only a side with
    few rows is read in full, to add up their widths.
    """
    if df.select(F.lit(1)).offset(max_rows).limit(1).collect():
        return None
    widths = [_width(f) for f in df.schema.fields]
    total = F.sum(reduce(lambda a, b: a + b, widths)).alias("_bytes")
    found = df.agg(total, *also).first()
    return found if (found["_bytes"] or 0) <= max_bytes else None


def _width(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        column = F.to_json(F.struct(column))
    elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.lit(16).cast("bigint")
    return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint") + 16


def keyed_join(
    facts: DataFrame,
    keyed: DataFrame,
    on: Sequence[str],
    how: str = "left",
    small: bool | None = None,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join ``facts`` to ``keyed`` on equally named columns of equal types.

    A measured-small ``keyed`` is broadcast and ``facts`` is not shuffled. Any
    larger one goes through :func:`salted_join`. ``small`` carries over the
    result of an earlier measurement.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    same_types(facts, keyed, on)
    if fits_broadcast(keyed) if small is None else small:
        return facts.join(F.broadcast(keyed), list(on), how)
    return salted_join(facts, keyed, on, how, salt_by=salt_by)


def same_types(facts: DataFrame, keyed: DataFrame, on: Sequence[str]) -> None:
    """Refuse keys of two types, at every size: how they would be cast is a guess."""
    for name in on:
        if facts.schema[name].dataType != keyed.schema[name].dataType:
            raise ValueError(f"join column {name} has two types")


def salted_join(
    facts: DataFrame,
    keyed: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salts: int | None = None,
    hot_share: float = HOT_SHARE,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Shuffled join that spreads the rows of hot and NULL keys over all tasks.

    One pass over the key columns counts the rows per key hash and keeps the
    keys holding more than ``hot_share`` of all rows: fewer than
    ``1 / hot_share``, which bounds what is broadcast here. Only their ``keyed``
    rows are repeated, once per salt. Several salts per task even out how they
    happen to fall on the tasks.

    The salt depends on row content and input partition alone, so a task that
    runs again after a lost executor sends each row to the same place. Columns in
    ``salt_by`` that tell rows apart keep it from reading all others. The join is
    hinted, as a side that was measured as too large must not be broadcast after
    all because its files look small.
    """
    on = list(on)
    same_types(facts, keyed, on)
    salts = salts or 4 * int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.xxhash64(*on).alias("_key")
    total = facts.agg(F.count("*")).scalar()
    hot = (
        facts.select(key)
        .groupBy("_key")
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > total * hot_share)
        .select("_key", F.lit(True).alias("_hot"))
    )
    hashable = list(salt_by or without_maps(facts))
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *hashable), F.lit(salts)).cast("int")
    left = (
        facts.withColumn("_key", key)
        .join(F.broadcast(hot), "_key", "left")
        .withColumn("_salt", F.when(F.col("_hot") | null_key, spread).otherwise(F.lit(0)))
        .drop("_key", "_hot")
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    right = (
        keyed.withColumn("_key", key)
        .join(F.broadcast(hot), "_key", "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_key", "_hot")
    )
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")


def without_maps(df: DataFrame) -> list[str]:
    """Columns that can be hashed and ordered."""
    return [f.name for f in df.schema.fields if not _has_map(f.dataType)]


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return False
