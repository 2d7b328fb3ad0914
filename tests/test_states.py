"""Tables written through a format, and merges between them."""

import pytest
from pyspark.sql import functions as F

from sparkpipe.operators import merge
from sparkpipe.sources import tables

KEYS = ["id"]
UPDATE, INSERT = {"v": "v"}, {"id": "id", "v": "v"}


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")


@pytest.fixture
def more(spark):
    return spark.createDataFrame([(2, "B"), (4, "d")], "id int, v string")


def content(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_create_and_replace(spark, folder, rows, more, fmt):
    path = f"{folder}/table"
    assert not tables.table_exists(spark, path, fmt)
    assert tables.create_if_absent(rows, path, fmt)
    assert not tables.create_if_absent(more, path, fmt)
    assert tables.read_table(spark, path, fmt).count() == 3
    wider = more.withColumn("extra", F.lit(1))
    assert set(tables.write_table(wider, path, fmt).columns) == {"id", "v", "extra"}


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    return plan.count("Exchange hashpartitioning"), plan.count("FileScan"), plan


@pytest.fixture
def written(spark, folder, rows, more):
    return (
        tables.write_table(rows, f"{folder}/target"),
        tables.write_table(more, f"{folder}/source"),
    )


def test_a_large_merge_shuffles_each_side_once(written):
    target, source = written
    merged = merge.merge(target, source, KEYS, UPDATE, INSERT, small=False)
    shuffles, scans, plan = exchanges(merged)
    assert (shuffles, scans) == (2, 2) and "Aggregate" not in plan
    assert content(merged) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    feed = merge.merge_feed(target, source, KEYS, UPDATE, INSERT, small=False)
    assert exchanges(feed)[:2] == (2, 2)
    assert sorted((r._change_type, r.id, r.v) for r in feed.collect()) == [
        ("insert", 4, "d"),
        ("update_postimage", 2, "B"),
        ("update_preimage", 2, "b"),
    ]


def test_a_change_feed_shuffles_each_version_once(written):
    before, after = written
    shuffles, scans, plan = exchanges(merge.change_feed(before, after, KEYS))
    assert (shuffles, scans) == (2, 2) and "Aggregate" not in plan


def test_maps_can_be_merged_and_compared(spark):
    def table(*pairs):
        df = spark.createDataFrame(list(pairs), "id int, v string")
        return df.select("id", F.create_map(F.lit("k"), "v").alias("m"))

    before, after = table((1, "a"), (2, "b")), table((1, "a"), (2, "c"), (2, "d"))
    source = after.withColumn("order", F.monotonically_increasing_id())
    for small in (True, False):
        merged = merge.merge(
            before, source, KEYS, {"m": "m"}, {"id": "id", "m": "m"}, ["order"], small
        )
        assert {r.id: r.m["k"] for r in merged.collect()} == {1: "a", 2: "d"}
    feed = merge.change_feed(before, table((1, "a"), (2, "c")), KEYS)
    assert sorted((r._change_type, r.m["k"]) for r in feed.collect()) == [
        ("update_postimage", "c"),
        ("update_preimage", "b"),
    ]


def test_a_source_that_changes_is_read_once(spark, rows):
    """Keys that differ at every look still give each row once."""
    new = spark.range(5).select((F.rand() * 1e9 + 10).cast("int").alias("id"), F.lit("n").alias("v"))
    merged = merge.merge(rows, new, KEYS, UPDATE, INSERT)
    assert merged.count() == 8 and merged.filter("v = 'n'").count() == 5


def test_key_types_are_judged_alike_at_every_size(spark, rows):
    text = spark.createDataFrame([("2", "B")], "id string, v string")
    for small in (True, False):
        with pytest.raises(ValueError, match="two types"):
            merge.merge(rows, text, KEYS, UPDATE, INSERT, small=small)
