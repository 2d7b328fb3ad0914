"""Keyed merges and row change feeds, as DataFrame to DataFrame functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sparkpipe.functions.scalars import changed
from sparkpipe.operators.joins import fits_broadcast, keyed_join, same_types, without_maps
from sparkpipe.session import work_dir
from sparkpipe.sources.tables import Bucketed, write_bucketed

INSERT, PREIMAGE, POSTIMAGE, DELETE = "insert", "update_preimage", "update_postimage", "delete"


def unique_by_key(
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    what: str = "for merge key",
) -> DataFrame:
    """One row per key, through a single shuffle on the key that a join can build on.

    A NULL key is an error. Two rows for one key are an error too, unless
    ``order_by`` is given: then the greatest wins, ties being settled by the
    remaining columns that have an order (maps have none). Of a crowded key each
    task passes on one row only, or two where a second one is an error.
    """
    by_key = Window.partitionBy(*keys)
    name = F.to_json(F.struct(*keys))
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    fault = F.when(missing, F.concat(F.lit("NULL in merge key "), name))
    if order_by:
        rest = [c for c in without_maps(source) if c not in (*keys, *order_by)]
        last = by_key.orderBy(*[F.col(c).desc() for c in [*order_by, *rest]])
        picked = source.withColumn("_place", F.row_number().over(last)).filter("_place = 1")
    else:
        place = F.row_number().over(by_key.orderBy(*keys))
        picked = source.withColumn("_place", place).filter("_place <= 2")
        fault = fault.when(
            F.col("_place") > 1, F.concat(F.lit(f"more than one row {what} "), name)
        )
    return picked.filter(F.assert_true(fault.isNull(), fault).isNull()).drop("_place")


def _settled(source: DataFrame) -> DataFrame:
    """A written copy, so that every later look sees the same rows and faults show now."""
    folder = work_dir(source.sparkSession, "merge-source")
    source.write.parquet(folder)
    return source.sparkSession.read.schema(source.schema).parquet(folder)


def _sides(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None,
    small: bool | None,
) -> tuple[DataFrame, DataFrame, bool]:
    """The source by key with its other columns prefixed, the target rows it can
    match, and whether it is small.

    For a small source those are the target rows in the range of its keys. The
    range reaches the scan as a filter, so that files and row groups beyond it
    are skipped where the table lies in key order, as it does when keys grow
    with time.
    """
    same_types(target, source, keys)
    small = fits_broadcast(source) if small is None else small
    near, key = target, keys[0]
    src = unique_by_key(source, keys, order_by)
    if small:
        src = _settled(src)
        low, high = src.agg(F.min(key), F.max(key)).first()
        ordered = isinstance(target.schema[key].dataType, (T.IntegralType, T.StringType))
        if low is not None and ordered:
            near = target.filter(F.col(key).between(low, high))
    others = [F.col(c).alias(f"_s_{c}") for c in src.columns if c not in keys]
    return src.select(*keys, *others, F.lit(True).alias("_given")), near, small


def _source_value(name: str, keys: Sequence[str]) -> Column:
    return F.col(name if name in keys else f"_s_{name}")


def _inserted(columns: Sequence[str], insert: Mapping[str, str], keys: Sequence[str]) -> list:
    return [
        (_source_value(insert[c], keys) if c in insert else F.lit(None)).alias(c) for c in columns
    ]


def _updated(columns: Sequence[str], update: Mapping[str, str], keys: Sequence[str]) -> list:
    return [
        (_source_value(update[c], keys) if c in update else F.col(c)).alias(c) for c in columns
    ]


def _fresh(near: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a small source whose key the target lacks.

    The source first picks its own keys out of the target, so the target's keys
    are never shuffled; the picked keys are no more than the source's.
    """
    keys = list(keys)
    found = near.select(*keys).join(F.broadcast(src.select(*keys)), keys, "left_semi")
    return src.join(F.broadcast(found.distinct()), keys, "left_anti")


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, str],
    insert: Mapping[str, str],
    order_by: Sequence[str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """The target after a keyed merge.

    ``update`` and ``insert`` map target columns to source columns. A matched
    row takes the ``update`` columns and keeps the others; an unmatched source
    row is inserted. The target is not shuffled when the source is small; else
    both are shuffled once and one outer join gives updates and inserts together.
    """
    keys, columns = list(keys), target.columns
    src, near, small = _sides(target, source, keys, order_by, small)
    given = F.coalesce("_given", F.lit(False))
    if small:
        matched = target.join(F.broadcast(src), keys, "left")
        kept = matched.select(
            *[
                F.when(given, new).otherwise(F.col(c)).alias(c) if c in update else F.col(c)
                for c, new in zip(columns, _updated(columns, update, keys))
            ]
        )
        fresh = _fresh(near, src, keys).select(*_inserted(columns, insert, keys))
        return kept.unionByName(fresh)
    both = target.withColumn("_there", F.lit(True)).join(src.hint("merge"), keys, "full_outer")
    values = zip(
        columns, _updated(columns, update, keys), _inserted(columns, insert, keys), strict=True
    )
    return both.select(
        *[
            F.when(F.col("_there").isNull(), added)
            .when(given, changed_to)
            .otherwise(F.col(c))
            .alias(c)
            for c, changed_to, added in values
        ]
    )


def merge_bucketed(
    target: Bucketed,
    source: DataFrame,
    folder: str,
    update: Mapping[str, str],
    insert: Mapping[str, str],
    order_by: Sequence[str] | None = None,
) -> Bucketed:
    """A keyed merge whose target stays where it lies; the next state, bucketed alike.

    Only the source is shuffled, once, into the target's buckets; the join's tasks are
    the buckets, and each writes its own again. So a merge costs a read and a write of
    the target however large it is, and the next one finds the same layout.
    """
    keys = list(target.keys)
    dealt = source.repartition(target.buckets, *keys)
    rows = target.rows(source.sparkSession)
    merged = merge(rows, dealt, keys, update, insert, order_by, small=False)
    return write_bucketed(merged, folder, keys, target.buckets, dealt=True)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Merge that replaces every column that is not a key."""
    update, insert = full_row(target.columns, keys)
    return merge(target, source, keys, update, insert, order_by)


def full_row(columns: Sequence[str], keys: Sequence[str]) -> tuple[dict[str, str], dict[str, str]]:
    return {c: c for c in columns if c not in keys}, {c: c for c in columns}


def merge_table(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    update: Mapping[str, str],
    insert: Mapping[str, str],
    order_by: Sequence[str] | None = None,
) -> None:
    """The same merge by the table's own engine, where its format supports one."""
    named = unique_by_key(source, keys, order_by).alias("s")
    condition = reduce(
        lambda a, b: a & b, [F.col(f"{table}.{k}") == F.col(f"s.{k}") for k in keys]
    )
    (
        named.mergeInto(table, condition)
        .whenMatched()
        .update({c: F.col(f"s.{v}") for c, v in update.items()})
        .whenNotMatched()
        .insert({c: F.col(f"s.{v}") for c, v in insert.items()})
        .merge()
    )


def merge_feed(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, str],
    insert: Mapping[str, str],
    order_by: Sequence[str] | None = None,
    compare: Sequence[str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """The change rows of a merge, without computing the merged table.

    Its size follows the source, not the target. With ``compare``, a matched
    row counts as an update only if one of those target columns changes.
    """
    keys, columns = list(keys), target.columns
    src, near, small = _sides(target, source, keys, order_by, small)
    there = near.withColumn("_there", F.lit(True))
    if small:
        matched = there.join(F.broadcast(src), keys)
        missed = _fresh(near, src, keys).select(*_inserted(columns, insert, keys))
        missed = missed.withColumn("_change_type", F.lit(INSERT))
    else:
        matched = src.join(there.hint("merge"), keys, "left")
        missed = None
    differs = F.lit(True)
    if compare is not None:
        differs = changed(
            [(F.col(c), _source_value(update[c], keys)) for c in compare if c in update]
        )
    kind = matched.select(*columns).schema
    before = F.struct(*columns, F.lit(PREIMAGE).alias("_change_type"))
    after = F.struct(*_updated(columns, update, keys), F.lit(POSTIMAGE).alias("_change_type"))
    images = F.when(F.col("_there") & differs, F.array(before, after))
    if missed is None:
        added = [v.cast(kind[c].dataType).alias(c) for c, v in zip(columns, _inserted(columns, insert, keys))]
        new = F.struct(*added, F.lit(INSERT).alias("_change_type"))
        images = images.when(F.col("_there").isNull(), F.array(new))
    rows = matched.select(F.explode(images).alias("image")).select("image.*")
    return rows if missed is None else rows.unionByName(missed)


def change_feed(
    before: DataFrame, after: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """Row changes between two versions of a table.

    Each version is shuffled once, by key, and one outer join compares them; a key
    occurring twice in a version is an error. Columns in ``ignore`` (audit times) do
    not by themselves make a change. Columns that have no order, as maps, are
    compared as JSON.
    """
    keys, columns = list(keys), before.columns
    plain = without_maps(before)
    compared = [c for c in columns if c not in keys and c not in ignore]

    def side(df: DataFrame, name: str) -> DataFrame:
        whole = unique_by_key(df.select(*columns), keys, what="in a version for key")
        return whole.select(*keys, F.struct(*columns).alias(name))

    both = side(before, "_old").join(side(after, "_new").hint("merge"), keys, "full_outer")
    old, new = F.col("_old"), F.col("_new")

    def value(side: str, c: str) -> Column:
        return F.col(f"{side}.{c}") if c in plain else F.to_json(F.struct(f"{side}.{c}"))

    differs = changed([(value("_old", c), value("_new", c)) for c in compared])

    def image(side: str, kind: str) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in columns], F.lit(kind).alias("_change_type")
        )

    images = (
        F.when(new.isNull(), F.array(image("_old", DELETE)))
        .when(old.isNull(), F.array(image("_new", INSERT)))
        .when(differs, F.array(image("_old", PREIMAGE), image("_new", POSTIMAGE)))
    )
    return both.select(F.explode(images).alias("image")).select("image.*")


def feed_of_states(
    states: Sequence[DataFrame],
    keys: Sequence[str],
    ignore: Sequence[str] = (),
    since: int = 0,
) -> DataFrame:
    """Row changes over the consecutive states of a table, each with its ``_commit_version``.

    The rows of the first state are inserts of version 0. ``since`` gives the changes of
    that version and later ones only, and reads no state but the one before it and those
    after. A key occurring twice in a state is an error, and so is a NULL key. Columns in
    ``ignore`` do not by themselves make a change.

    All states meet in one exchange by key; there each key's rows are in order of version,
    and those that differ from the row before, or have none right before, are changes.
    """
    if not states:
        raise ValueError("no state")
    keys, columns = list(keys), states[0].columns
    first = max(0, since - 1)
    plain = without_maps(states[0])
    compared = [c for c in columns if c not in keys and c not in ignore]
    tagged = [
        df.select(F.lit(v).cast("bigint").alias("_version"), *keys, F.struct(*columns).alias("_row"))
        for v, df in enumerate(states[first:], first)
    ]
    in_order = Window.partitionBy(*keys).orderBy("_version")
    met = reduce(DataFrame.unionByName, tagged).select(
        "*",
        F.lag(F.struct("_version", "_row")).over(in_order).alias("_before"),
        F.lead("_version").over(in_order).alias("_next"),
    )
    version, row, before = F.col("_version"), F.col("_row"), F.col("_before")
    name = F.to_json(F.struct(*keys))
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    fault = F.when(missing, F.concat(F.lit("NULL in key "), name)).when(
        version == before["_version"], F.concat(F.lit("more than one row in a version for key "), name)
    )
    met = met.filter(F.assert_true(fault.isNull(), fault).isNull())

    def value(side: Column, c: str) -> Column:
        return side[c] if c in plain else F.to_json(F.struct(side[c]))

    def image(side: Column, kind: str, at: Column) -> Column:
        return F.struct(
            *[side[c].alias(c) for c in columns],
            F.lit(kind).alias("_change_type"),
            at.alias("_commit_version"),
        )

    old = before["_row"]
    follows = F.coalesce(before["_version"] == version - 1, F.lit(False))
    differs = changed([(value(old, c), value(row, c)) for c in compared])
    came = F.when(~follows, F.array(image(row, INSERT, version))).when(
        differs, F.array(image(old, PREIMAGE, version), image(row, POSTIMAGE, version))
    )
    stays = F.coalesce(F.col("_next") == version + 1, F.lit(False)) | (version == len(states) - 1)
    left = F.when(~stays, F.array(image(row, DELETE, version + 1)))
    none = F.array().cast(T.ArrayType(met.select(image(row, DELETE, version)).schema[0].dataType))
    images = F.concat(F.coalesce(came, none), F.coalesce(left, none))
    feed = met.select(F.explode(images).alias("image")).select("image.*")
    # The state before ``since`` is only there to be compared with.
    return feed.filter(F.col("_commit_version") >= since)


def apply_feed(before: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after the changes; later ``_commit_version`` wins per key."""
    columns = before.columns
    version = F.col("_commit_version") if "_commit_version" in feed.columns else F.lit(0)
    changes = feed.filter(F.col("_change_type") != PREIMAGE)
    changes = changes.withColumn("_commit_version", version)
    last = unique_by_key(changes, keys, ["_commit_version", "_change_type"])
    small = fits_broadcast(feed.select(*keys))
    kept = keyed_join(before, last.select(*keys), keys, "left_anti", small, salt_by=keys)
    live = last.filter(F.col("_change_type") != DELETE).select(*columns)
    return kept.unionByName(live)
