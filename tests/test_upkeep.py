import itertools
import random

import pytest
from pyspark.sql import functions as F

from sparkpipe.operators import merge, metrics, upkeep

SCHEMA = "id long, kind string, value double"


def states(spark, seed, n=4, rows=40):
    draw = random.Random(seed)
    out, held = [], {}
    for _ in range(n):
        for i in range(rows):
            chance = draw.random()
            if chance < 0.3:
                held.pop(i, None)
            elif chance < 0.7:
                held[i] = (i, draw.choice(["a", "b", None]), draw.choice([None, 1.5, 30.0, 30.0, -4.0, 1e9]))
        out.append(spark.createDataFrame(list(held.values()), SCHEMA))
    return out


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("Join")


@pytest.mark.parametrize("seed", range(3))
def test_feed_of_states_is_that_of_each_pair(spark, seed):
    tables = states(spark, seed)
    pairs = [(tables[0].limit(0), tables[0]), *itertools.pairwise(tables)]
    expected = []
    for version, (before, after) in enumerate(pairs):
        feed = merge.change_feed(before, after, ["id"])
        expected += rows(feed.withColumn("_commit_version", F.lit(version).cast("bigint")))
    feed = merge.feed_of_states(tables, ["id"])
    assert rows(feed) == sorted(expected, key=str)
    for since in (1, 2, 3, 4):
        some = merge.feed_of_states(tables, ["id"], since=since)
        assert rows(some) == rows(feed.filter(F.col("_commit_version") >= since))


def test_feed_of_states_shuffles_once(spark):
    assert exchanges(merge.feed_of_states(states(spark, 1), ["id"])) == (1, 0)


def test_feed_of_one_state_is_its_rows(spark):
    (only,) = states(spark, 1, n=1)
    feed = merge.feed_of_states([only], ["id"])
    assert {r._change_type for r in feed.collect()} == {"insert"} and feed.count() == only.count()


def test_feed_of_states_ignores_and_refuses(spark):
    one = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    other = spark.createDataFrame([(1, "a", 2.0)], SCHEMA)
    assert merge.feed_of_states([one, other], ["id"], ignore=["value"], since=1).isEmpty()
    with pytest.raises(Exception, match="more than one row in a version for key"):
        merge.feed_of_states([one, other.union(other)], ["id"]).collect()
    with pytest.raises(Exception, match="NULL in key"):
        merge.feed_of_states([spark.createDataFrame([(None, "a", 1.0)], SCHEMA)], ["id"]).collect()
    with pytest.raises(ValueError):
        merge.feed_of_states([], ["id"])


def test_feed_of_states_compares_maps(spark):
    make = lambda x: spark.sql(f"SELECT 1 AS id, map('a', {x}) AS m")
    kinds = [r._change_type for r in merge.feed_of_states([make(1), make(1), make(2)], ["id"]).collect()]
    assert sorted(kinds) == ["insert", "update_postimage", "update_preimage"]


@pytest.mark.parametrize("seed", range(3))
def test_derived_tables_after_a_feed_are_those_of_a_full_run(spark, seed):
    """The feed of several versions goes in as a whole."""
    tables = states(spark, seed)
    first, last = tables[0], tables[-1]
    feed = merge.feed_of_states(tables, ["id"], since=1)
    counts = upkeep.maintained_counts(metrics.counters(first, ["kind"]), feed, ["kind"])
    assert rows(counts) == rows(metrics.counters(last, ["kind"]))
    before = metrics.histogram(first, "value", ["kind"])
    after = upkeep.maintained_histogram(before, feed, last, "value", ["kind"])
    assert rows(after) == rows(metrics.histogram(last, "value", ["kind"]))

    def derive(df):
        return df.select("id", (F.col("value") * 2).alias("twice")).where("twice IS NOT NULL")

    kept = upkeep.maintained_rows(derive(first), feed, last, ["id"], derive)
    assert rows(kept) == rows(derive(last))


def test_only_groups_that_lost_an_extreme_are_counted_anew(spark):
    first = spark.createDataFrame([(i, "abc"[i % 3], 10.0 + i / 10) for i in range(1, 61)], SCHEMA)
    last = first.filter("id NOT IN (30, 58)")  # within a, greatest of b; c keeps all
    feed = merge.change_feed(first, last, ["id"])
    before = metrics.histogram(first, "value", ["kind"])
    # What is read again is told by rows that do not belong to the table.
    odd = last.withColumn("value", F.col("value") + 0.001)
    after = upkeep.maintained_histogram(before, feed, odd, "value", ["kind"])
    assert {r.kind: r.max for r in after.collect()} == {"a": 16.0, "b": 15.501, "c": 15.9}


def test_a_huge_value_that_goes_leaves_no_rounding_behind(spark):
    first = spark.createDataFrame([(1, "a", 1e17), (2, "a", 12000.5), (3, "a", 12001.25)], SCHEMA)
    last = first.filter("id > 1")
    after = upkeep.maintained_histogram(
        metrics.histogram(first, "value", ["kind"]), merge.change_feed(first, last, ["id"]), last, "value", ["kind"]
    )
    assert [(r["count"], r["sum"], r["max"]) for r in after.collect()] == [(2, 24001.75, 12001.25)]


def test_a_feed_of_another_table_is_refused(spark):
    first, other = states(spark, 5, n=2)
    feed = merge.change_feed(other, other.limit(0), ["id"])
    none = metrics.counters(first.limit(0), ["kind"])
    with pytest.raises(Exception, match="more rows went than were there"):
        upkeep.maintained_counts(none, feed, ["kind"]).collect()
    odd = feed.withColumn("_change_type", F.lit("merge"))
    with pytest.raises(Exception, match="unknown change type merge"):
        upkeep.maintained_counts(none, odd, ["kind"]).collect()


def test_rows_of_a_changed_lookup_are_derived_anew(spark):
    facts = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "a", 3.0)], SCHEMA)
    old = spark.createDataFrame([("a", 10), ("b", 20)], "kind string, weight int")
    new = spark.createDataFrame([("a", 11), ("b", 20)], "kind string, weight int")
    derive = lambda df, lookup: df.join(F.broadcast(lookup), "kind", "left").select("id", "weight")
    changed = merge.change_feed(old, new, ["kind"]).select("kind").distinct()
    touched = facts.join(F.broadcast(changed), "kind", "left_semi")
    no_feed = merge.change_feed(facts, facts, ["id"])
    after = upkeep.maintained_rows(derive(facts, old), no_feed, facts, ["id"], lambda df: derive(df, new), more=touched)
    assert rows(after) == rows(derive(facts, new))
