"""Mixing sources to target weights by capped water-filling.

Every source has a weight and may be repeated at most ``epochs`` times. The mix is as
large as all sources together. Each source first gets its weight's share; sources whose
share is above their cap are clamped, and what they cannot take is shared again among
the rest by weight, until no share is above its cap. A source then gives each of its
documents a whole number of repetitions, and a fractional one to as many documents, in
a seeded random order, as the rest of the target holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkpipe.llm.frames import WORD, tasks, written

#: Documents of a source fall into this many slices of the seeded order.
SLICES = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Give the sources, by code point and null last, the weights in turn.

    ``sources`` has one row per source. Ranks come from ranges dealt over tasks and the
    number of rows in each range, so no task sees all sources.
    """
    last = F.col("source").isNull().cast("int").alias("last")
    ranged = sources.select("*", last).repartitionByRange(
        tasks(sources.sparkSession), "last", "source"
    )
    ranged = written(ranged.withColumn("part", F.spark_partition_id()), "mix-ranges")
    parts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("last", "source"))
    rank = F.col("before") + within - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.get(table, (rank % len(weights)).cast("int")).alias("weight")
    return ranged.join(F.broadcast(parts), "part").select("source", "source_size", weight)


def water_fill(sources: DataFrame, epochs: float) -> DataFrame:
    """Add ``target`` to rows of (source, source_size, weight).

    Each round is one aggregate over the sources; only its sums reach the driver. A
    round clamps at least one more source or is the last, and clamping all that are
    above their cap at once gives the same end as one by one, since the level only
    rises. Sources without words, or a weight of zero, get 0.
    """
    cap = F.col("source_size") * F.lit(float(epochs))
    level, clamped = 0.0, -1
    while True:
        over = (cap < F.col("weight") * F.lit(level)) | (cap == 0) | (F.col("weight") <= 0)
        total, capped, free, n = sources.agg(
            F.sum("source_size"),
            F.sum(F.when(over & (F.col("weight") > 0), cap)),
            F.sum(F.when(~over, F.col("weight"))),
            F.count_if(over),
        ).first()
        if not total or not free or n == clamped:
            break
        level, clamped = (total - (capped or 0.0)) / free, n
    share = F.when(F.col("weight") > 0, F.least(cap, F.col("weight") * F.lit(level)))
    return sources.withColumn("target", F.coalesce(share, F.lit(0.0)))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1.0, 2.0, 3.0),
    epochs: float = 3.0,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How often each document enters the mix: one row per row of ``docs``.

    Returns doc (all columns as a struct), doc_id, size, source_size, target,
    repetitions (whole ones) and words (taken by a last, partial repetition), both
    null for documents without words. A null text has size 0; a null source is a
    source of its own, last in order; a null or repeated id only decides the place in
    the seeded order, in which equal rows are told apart by their text's hash and are
    otherwise interchangeable. An empty table gives an empty mix. Other columns pass
    through untouched in ``doc``, whatever their names.

    In the seeded order (an md5 of seed and id) the first documents get one more
    repetition, until the source's target is met to the word; the document at the
    border gives a part. The order is cut into slices summed before the shuffle, so
    only the slice at the border is sorted, and no task sees a whole source.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")).cast("binary"))
    rows = docs.select(
        F.struct("*").alias("doc"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        n_words(F.col(text_col)).alias("size"),
        F.xxhash64(F.col(text_col)).alias("tie"),
    ).withColumn("place", key)
    rows = rows.withColumn("slice", F.conv(F.substring("place", 1, 3), 16, 10).cast("int"))

    sums = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    sums = written(sums, "mix-sums")
    sources = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    shares = water_fill(written(cyclic_weights(sources, weights), "mix-sources"), epochs)
    rate = F.col("target") / F.col("source_size")
    whole = F.when(F.col("source_size") > 0, F.floor(rate)).otherwise(0).cast("long")
    rest = F.round(F.col("target") - whole * F.col("source_size")).cast("long")
    shares = shares.withColumns({"whole": whole, "rest": rest}).drop("weight")

    # Where each source's extra repetition ends: a slice, and the words left for it.
    before = F.sum("words").over(
        Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    sums = sums.select("*", F.coalesce(before, F.lit(0)).alias("before"))
    ends = sums.alias("s").join(shares.alias("t"), F.expr("s.source <=> t.source")).where(
        "before < rest AND rest <= before + words"
    )
    ends = ends.select("s.source", "slice", (F.col("rest") - F.col("before")).alias("left"))
    plan = shares.alias("t").join(ends.alias("e"), F.expr("t.source <=> e.source"), "left")
    plan = plan.select(
        "t.source", "source_size", "target", "whole", F.col("slice").alias("end"), "left"
    )
    plan = written(plan, "mix-plan")

    joined = rows.alias("r").join(plan.alias("p"), F.expr("r.source <=> p.source"))
    joined = joined.drop(F.col("p.source"))
    inside = F.sum("size").over(
        Window.partitionBy("source")
        .orderBy("place", "tie", "doc_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    border = joined.where("slice = end").select("*", F.coalesce(inside, F.lit(0)).alias("used"))
    others = joined.where("NOT (slice <=> end)").withColumn("used", F.lit(0).cast("long"))
    size, left = F.col("size"), F.col("left")
    extra = (
        F.when(F.col("end").isNull() | (F.col("slice") > F.col("end")), 0)
        .when(F.col("slice") < F.col("end"), size)
        .otherwise(F.greatest(F.lit(0), F.least(size, left - F.col("used"))))
        .cast("long")
    )
    both = others.unionByName(border).withColumn("extra", extra)
    return both.select(
        "doc",
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("whole") + (F.col("extra") == size).cast("long")).alias("repetitions"),
        F.when(F.col("extra") < size, F.col("extra")).otherwise(0).alias("words"),
    )


def mixed_digest(mixed: DataFrame) -> DataFrame:
    taken = F.col("size") * F.col("repetitions") + F.col("words")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(mixed: DataFrame) -> DataFrame:
    """The mix itself: a row for each repetition, with the columns of the documents.

    Texts are never cut. The document of which a source's last repetition takes a part
    comes once more if that is half of its words or more, so a source is off its target
    by half a document at most. One without words stays once: it costs the mix nothing.
    """
    more = (F.col("words") > 0) & (2 * F.col("words") >= F.col("size"))
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("repetitions") + more.cast("long"))
    copies = F.explode(F.array_repeat(F.lit(0), times.cast("int")))
    rows = mixed.select("doc", copies.alias("copy"))
    return rows.select(*[F.col(f"doc.`{c}`").alias(c) for c in mixed.schema["doc"].dataType.fieldNames()])
