"""Merges into bucketed tables: layout, plan and result."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from sparkpipe.operators import merge
from sparkpipe.sources import tables

FULL = {"k": "k", "v": "v"}


@pytest.fixture
def parts(spark, folder):
    chance = random.Random(3)
    old = [(k, f"a{k}") for k in range(300)] + [(None, "none"), (None, "more")]
    new = [(k, f"b{k}") for k in chance.sample(range(400), 120)]
    frames = [spark.createDataFrame(rows, "k long, v string") for rows in (old, new)]
    return frames, tables.write_bucketed(frames[0], f"{folder}/old", ["k"], 6)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("Exchange")


def test_merge_equals_the_plain_one(spark, folder, parts):
    (old, new), table = parts
    merged = merge.merge_bucketed(table, new, f"{folder}/new", {"v": "v"}, FULL)
    assert rows(merged.rows(spark)) == rows(merge.merge(old, new, ["k"], {"v": "v"}, FULL))
    assert rows(table.rows(spark)) == rows(old)


def test_target_is_not_shuffled_and_keeps_its_layout(spark, folder, parts):
    (_, new), table = parts
    for turn in range(2):
        dealt = new.repartition(table.buckets, "k")
        plan = merge.merge(table.rows(spark), dealt, ["k"], {"v": "v"}, FULL, small=False)
        assert exchanges(plan) == 1  # the source
        table = merge.merge_bucketed(table, new, f"{folder}/state{turn}", {"v": "v"}, FULL)
        assert len(glob.glob(f"{folder}/state{turn}/*.parquet")) <= table.buckets


def test_empty_source_and_faults(spark, folder, parts):
    (old, new), table = parts
    none = merge.merge_bucketed(table, new.limit(0), f"{folder}/same", {"v": "v"}, FULL)
    assert rows(none.rows(spark)) == rows(old)
    with pytest.raises(Exception, match="more than one row"):
        merge.merge_bucketed(table, new.union(new), f"{folder}/twice", {"v": "v"}, FULL)


def test_aggregates_by_key_need_no_exchange(spark, parts):
    _, table = parts
    assert exchanges(table.rows(spark).groupBy("k").agg(F.count("*"))) == 0
