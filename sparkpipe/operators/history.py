"""Row history: merges that keep what was (type 2), and joins as of a time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkpipe.functions.scalars import changed
from sparkpipe.operators.joins import HOT_SHARE, fits_broadcast, same_types, without_maps
from sparkpipe.operators.merge import DELETE

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def merge_history(
    history: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    time: str,
    order_by: Sequence[str] = (),
    deleted: Column | None = None,
    small: bool | None = None,
) -> DataFrame:
    """A history table after some dated changes (slowly changing dimension, type 2).

    ``history`` holds rows with ``valid_from`` and ``valid_to``; NULL is open. A change
    holds from its ``time`` until the next row of its key, whenever it arrives: one that
    comes late splits the row that held at its time. A change at the start of a row
    replaces it. Of several changes of a key at one time the greatest by ``order_by`` and
    then the remaining columns counts. A change that meets the condition ``deleted`` ends
    the key without a new row. Neighbours that touch and are alike become one row.

    Rows of keys without changes pass as they are; where the keys that change are few,
    they are not shuffled. All others meet in one shuffle by key, where intervals are
    closed and opened by one look at the next row.
    """
    keys = list(keys)
    columns = [c for c in history.columns if c not in (VALID_FROM, VALID_TO)]
    same_types(history, changes, keys)
    for column, name in ((VALID_FROM, "history"), (VALID_TO, "history"), (time, "changes")):
        if column not in (history if name == "history" else changes).columns:
            raise ValueError(f"{name} has no column {column}")
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in [*keys, time]])
    fault = F.concat(F.lit("NULL key or time in change "), F.to_json(F.struct(*keys, time)))
    changes = changes.filter(F.assert_true(~missing, fault).isNull())
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    ranked = [F.col(c) for c in order_by] + [
        F.col(c) for c in without_maps(changes) if c not in (*keys, time, *order_by)
    ]

    touched = changes.select(*keys).distinct()
    small = fits_broadcast(touched) if small is None else small
    if small:
        untouched = history.join(F.broadcast(touched), keys, "left_anti")
        affected = history.join(F.broadcast(touched), keys, "left_semi")
    else:
        untouched, affected = history.limit(0), history

    # Starts of rows; an end that no row follows is a row that is gone; and changes.
    row = F.struct(*columns).alias("_row")
    nothing = F.lit(None).cast(history.select(row).schema[0].dataType).alias("_row")
    held = affected.select(*keys, F.col(VALID_FROM).alias("_at"), row, F.lit(False).alias("_gone"), F.lit(1).alias("_level"))
    ended = affected.filter(F.col(VALID_TO).isNotNull()).select(
        *keys, F.col(VALID_TO).alias("_at"), nothing, F.lit(True).alias("_gone"), F.lit(0).alias("_level")
    )
    at_one_time = Window.partitionBy(*keys, time).orderBy(*([c.desc() for c in ranked] or keys))
    picked = changes.withColumn("_place", F.row_number().over(at_one_time)).filter("_place = 1")
    came = picked.select(*keys, F.col(time).cast(history.schema[VALID_FROM].dataType).alias("_at"), row, gone.alias("_gone"), F.lit(2).alias("_level"))
    events = held.unionByName(ended).unionByName(came)

    by_key = Window.partitionBy(*keys).orderBy("_at", F.col("_level").desc())
    first = F.coalesce(F.lag("_at").over(by_key) != F.col("_at"), F.lit(True))
    events = events.withColumn("_first", first).filter("_first").drop("_first", "_level")
    in_time = Window.partitionBy(*keys).orderBy("_at")
    compared = [c for c in columns if c not in keys]
    plain = set(without_maps(history))

    def value(side: Column, c: str) -> Column:
        return side[c] if c in plain else F.to_json(F.struct(side[c]))

    before = F.lag(F.struct("_row", "_gone")).over(in_time)
    events = events.withColumn("_before", before)
    old = F.col("_before")
    differs = (
        old.isNull()
        | (old["_gone"] != F.col("_gone"))
        | (~F.col("_gone") & changed([(value(F.col("_row"), c), value(old["_row"], c)) for c in compared]))
    )
    events = events.filter(differs).withColumn(VALID_TO, F.lead("_at").over(in_time))
    after = events.filter(~F.col("_gone")).select(
        *[F.col("_row")[c].alias(c) for c in columns], F.col("_at").alias(VALID_FROM), VALID_TO
    )
    return untouched.select(*columns, VALID_FROM, VALID_TO).unionByName(after)


def history_of_feed(feed: DataFrame, time: Column) -> tuple[DataFrame, Column]:
    """The changes and the ``deleted`` condition of a row change feed, dated by ``time``."""
    rows = feed.filter(F.col("_change_type") != "update_preimage")
    rows = rows.withColumn("_time", time)
    return rows, F.col("_change_type") == DELETE


def as_of_join(
    facts: DataFrame,
    side: DataFrame,
    on: Sequence[str],
    time: str,
    side_time: str,
    columns: Sequence[str],
    side_until: str | None = None,
    hot_share: float = HOT_SHARE,
    slices: int | None = None,
) -> DataFrame:
    """Each fact with the side's ``columns`` as they were at its time.

    That is the side's last row of the key at or before the time of the fact, or none if
    that row has ended by then (``side_until``). Of several rows of a key at one time the
    greatest counts. A fact without a key, a time or a row finds NULLs; all facts stay.

    Facts and side are laid together and sorted by key and time in one shuffle, and each
    fact takes the last side row before it; no pairs of facts and rows are made. Facts of
    a key with more than ``hot_share`` of all rows are cut by time into ``slices`` that
    hold about as many facts each; a side row goes to the slices in which it is the last
    one at some time, so its copies are bounded by its rows plus the slices.
    """
    on = list(on)
    same_types(facts, side, on)
    slices = slices or 2 * int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    payload = [F.col(c).alias(c) for c in columns] + ([F.col(side_until).alias("_until")] if side_until else [])
    rows = side.filter(known & F.col(side_time).isNotNull()).select(
        *on, F.col(side_time).alias("_at"), F.struct(*payload).alias("_side")
    )
    # One row per key and time, the greatest.
    rows = rows.groupBy(*on, "_at").agg(F.max("_side").alias("_side"))

    dated = facts.filter(known & F.col(time).isNotNull())
    most = F.greatest(facts.agg(F.count("*")).scalar() * hot_share, F.lit(1.0))
    crowded = dated.groupBy(*on).agg(F.count("*").alias("_n")).filter(F.col("_n") > most)
    # Fewer than 1 / hot_share keys.
    cuts = F.percentile_approx(F.unix_micros(F.col(time).cast("timestamp")), [i / slices for i in range(1, slices)], 1000)
    hot = (
        dated.join(F.broadcast(crowded.select(*on)), on, "left_semi")
        .groupBy(*on)
        .agg(F.array_distinct(cuts).alias("_cuts"))
    )

    def slice_of(at: Column) -> Column:
        """The number of cuts at or before a time; 0 for a key that is not hot."""
        later = F.filter("_cuts", lambda c: c <= F.unix_micros(at.cast("timestamp")))
        return F.coalesce(F.size(later), F.lit(0))

    by_time = Window.partitionBy(*on).orderBy("_at")
    rows = rows.withColumn("_next", F.lead("_at").over(by_time))
    rows = rows.join(F.broadcast(hot), on, "left")
    last_slice = F.when(F.col("_next").isNull(), F.coalesce(F.size("_cuts"), F.lit(0))).otherwise(slice_of(F.col("_next")))
    rows = rows.withColumn("_slice", F.explode(F.sequence(slice_of(F.col("_at")), last_slice)))
    no_fact = F.lit(None).cast(facts.select(F.struct(*facts.columns)).schema[0].dataType)
    rows = rows.select(*on, "_slice", "_at", F.lit(0).alias("_kind"), "_side", no_fact.alias("_fact"))
    placed = facts.join(F.broadcast(hot), on, "left").select(
        *on,
        F.when(F.col("_cuts").isNull() | F.col(time).isNull(), 0).otherwise(slice_of(F.col(time))).alias("_slice"),
        F.col(time).cast(rows.schema["_at"].dataType).alias("_at"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast(rows.schema["_side"].dataType).alias("_side"),
        F.struct(*facts.columns).alias("_fact"),
    )
    ready = known & F.col("_at").isNotNull()
    in_order = Window.partitionBy(*on, "_slice").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    met = rows.unionByName(placed.filter(ready))
    met = met.withColumn("_last", F.last("_side", ignorenulls=True).over(in_order)).filter("_kind = 1")
    last = F.col("_last")
    holds = F.lit(True) if side_until is None else F.coalesce(last["_until"] > F.col("_at"), F.lit(True))
    out = [F.when(holds, last[c]).alias(c) for c in columns]
    found = met.select(*[F.col("_fact")[c].alias(c) for c in facts.columns], *out)
    kinds = met.select(*out).schema
    odd = placed.filter(~F.coalesce(ready, F.lit(False))).select(
        "_fact.*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in kinds]
    )
    return found.unionByName(odd)
