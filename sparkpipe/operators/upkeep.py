"""Derived tables kept up by the change feed of the table they derive from.

A feed row counts once: plus for ``insert`` and ``update_postimage``, minus for ``delete``
and ``update_preimage``. A feed of several versions goes in whole; what cancels out does.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sparkpipe.functions.scalars import bucket_index
from sparkpipe.operators.joins import fits_broadcast, keyed_join
from sparkpipe.operators.merge import DELETE, INSERT, POSTIMAGE, PREIMAGE
from sparkpipe.operators.metrics import BOUNDARIES, histogram


def signed(feed: DataFrame) -> Column:
    """1 for a row that came, -1 for one that went; any other kind is an error."""
    kind = F.col("_change_type")
    fault = F.concat(F.lit("unknown change type "), F.coalesce(kind, F.lit("NULL")))
    known = F.when(kind.isin(INSERT, POSTIMAGE), 1).when(kind.isin(DELETE, PREIMAGE), -1)
    return F.coalesce(known, F.raise_error(fault).cast("int")).cast("bigint")


def _of_groups(rows: DataFrame, groups: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows in some groups; NULL is a group like any other."""
    named = groups.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(names)])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(names)])
    side = F.broadcast(named) if fits_broadcast(named) else named.hint("merge")
    return rows.join(side, same, "left_semi")


def maintained_counts(
    counts: DataFrame, feed: DataFrame, attributes: Sequence[str], total: str = "ingested_total"
) -> DataFrame:
    """Counts per attribute set after a feed; sets without rows go.

    The changes are added up before they meet the counts, so what is shuffled are
    attribute sets. A count that would fall below zero is an error: the feed does not
    belong to the table the counts are of.
    """
    attributes = list(attributes)
    changes = feed.groupBy(*attributes).agg(F.sum(signed(feed)).alias(total))
    after = (
        counts.select(*attributes, F.col(total).cast("bigint").alias(total))
        .unionByName(changes)
        .groupBy(*attributes)
        .agg(F.sum(total).alias(total))
    )
    fault = F.concat(F.lit("more rows went than were there for "), F.to_json(F.struct(*attributes)))
    fits = F.assert_true(F.col(total) >= 0, fault).isNull()
    return after.filter(fits & (F.col(total) > 0))


def maintained_histogram(
    before: DataFrame,
    feed: DataFrame,
    rows_after: DataFrame,
    value: str,
    attributes: Sequence[str],
    boundaries: Sequence[float] = BOUNDARIES,
) -> DataFrame:
    """The histogram of ``metrics.histogram`` after a feed.

    Counts and sums follow by plus and minus, and extremes that come are compared with
    those there. Only a group that loses its least or greatest value is counted anew,
    from the rows of ``rows_after`` that are in it: a table laid out by the attributes is
    not read beyond these groups. A value that goes and dwarfs all others in its group is
    its extreme, so no sum is left to cancellation.
    """
    attributes = list(attributes)
    group = [*attributes, "bucket"]
    measured = feed.filter(F.col(value).isNotNull()).withColumns(
        {"bucket": bucket_index(F.col(value), boundaries), "_sign": signed(feed)}
    )
    came, went = F.col("_sign") > 0, F.col("_sign") < 0
    number = F.col(value)
    changes = measured.groupBy(*group).agg(
        F.sum("_sign").alias("count"),
        F.sum(number.cast("double") * F.col("_sign")).alias("sum"),
        F.min(F.when(came, number)).alias("min"),
        F.max(F.when(came, number)).alias("max"),
        F.min(F.when(went, number)).alias("_low"),
        F.max(F.when(went, number)).alias("_high"),
    )
    none = F.lit(None).cast(rows_after.schema[value].dataType)
    there = before.select(
        *group, "count", "sum", "min", "max", none.alias("_low"), none.alias("_high")
    )
    met = there.unionByName(changes).groupBy(*group).agg(
        F.sum("count").alias("count"),
        F.sum("sum").alias("sum"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.min("_low").alias("_low"),
        F.max("_high").alias("_high"),
    )
    # An extreme among the values that came may itself have gone again.
    lost = F.coalesce((F.col("_low") <= F.col("min")) | (F.col("_high") >= F.col("max")), F.lit(False))
    fault = F.concat(F.lit("more rows went than were there for "), F.to_json(F.struct(*group)))
    met = met.filter(F.assert_true(F.col("count") >= 0, fault).isNull()).filter(F.col("count") > 0)
    met = met.withColumn("_lost", lost)
    kept = met.filter(~F.col("_lost"))

    rows = rows_after.filter(F.col(value).isNotNull())
    rows = rows.withColumn("bucket", bucket_index(F.col(value), boundaries))
    affected = _of_groups(rows, met.filter("_lost").select(*group), group)
    anew = histogram(affected.select(*attributes, value), value, attributes, boundaries)
    upper = F.get(F.array(*[F.lit(float(b)) for b in boundaries]), F.col("bucket"))
    columns = [*group, "count", "sum", "min", "max"]
    return kept.select(*columns).withColumn("upper_bound", upper).unionByName(anew)


def maintained_rows(
    derived: DataFrame,
    feed: DataFrame,
    rows_after: DataFrame,
    keys: Sequence[str],
    derive: Callable[[DataFrame], DataFrame],
    more: DataFrame | None = None,
) -> DataFrame:
    """A table of derived rows after a feed: only rows of changed keys are derived anew.

    ``derive`` makes derived rows from source rows and keeps ``keys`` as they are; rows of
    one key must not depend on rows of another. ``more`` names further keys to derive
    anew, for example those of a lookup row that changed.

    The changed keys drop out of ``derived`` and pick their rows out of ``rows_after``;
    neither table is shuffled where the keys are few enough to broadcast.
    """
    keys = list(keys)
    touched = feed.select(*keys)
    if more is not None:
        touched = touched.unionByName(more.select(*keys))
    touched = touched.distinct()
    kept = keyed_join(derived, touched, keys, "left_anti", salt_by=keys)
    anew = keyed_join(rows_after, touched, keys, "left_semi", salt_by=keys)
    return kept.unionByName(derive(anew))
