import pytest
from pyspark.sql import functions as F

from sparkpipe.operators.joins import fits_broadcast, keyed_join, salted_join


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, a sixth without a key, the rest spread."""
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit("hot")).when(i % 6 != 1, (i % 500).cast("string"))
    return spark.range(6000).select(i, key.alias("k"))


@pytest.fixture(scope="module")
def lookup(spark):
    rows = [(str(i), f"name {i}") for i in range(0, 500, 2)] + [("hot", "a"), ("hot", "b")]
    return spark.createDataFrame(rows, "k string, name string")


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_a_plain_join(facts, lookup, how):
    assert rows(salted_join(facts, lookup, ["k"], how, salts=5)) == rows(
        facts.join(lookup, ["k"], how)
    )


def test_hot_and_missing_keys_are_spread(facts, lookup):
    facts = facts.repartition(4, "id")
    joined = salted_join(facts, lookup.dropDuplicates(["k"]), ["k"], salts=16)
    spread = joined.withColumn("task", F.spark_partition_id())
    joined.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    joined.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for condition in (F.col("k") == "hot", F.col("k").isNull()):
            sizes = [r["count"] for r in spread.filter(condition).groupBy("task").count().collect()]
            assert len(sizes) == 4 and max(sizes) < 0.6 * sum(sizes)
    finally:
        joined.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
        joined.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_composite_keys(spark):
    left = spark.range(100).select("id", (F.col("id") % 2).alias("a"), (F.col("id") % 3).alias("b"))
    right = spark.createDataFrame([(0, 0, "x"), (1, 2, "y")], "a long, b long, v string")
    assert rows(salted_join(left, right, ["a", "b"], salts=3)) == rows(
        left.join(right, ["a", "b"], "left")
    )


def test_key_types_must_agree(spark):
    with pytest.raises(ValueError):
        salted_join(spark.range(3), spark.createDataFrame([(1,)], "id int"), ["id"])


def test_size_is_measured(spark):
    assert fits_broadcast(spark.range(10), max_rows=10)
    assert not fits_broadcast(spark.range(11), max_rows=10)
    assert not fits_broadcast(spark.range(10), max_rows=10, max_bytes=50)
    assert fits_broadcast(spark.range(0))
    assert not fits_broadcast(spark.range(1), max_rows=0)


def test_measuring_a_large_side_stops_early(spark):
    probe = spark.range(10_000_000).select(F.lit(1)).offset(10).limit(1)
    plan = probe._jdf.queryExecution().executedPlan().toString()
    assert plan.startswith("CollectLimit 11, 10") and "Exchange" not in plan


def test_a_large_side_is_not_broadcast(facts, lookup):
    plan = keyed_join(facts, lookup, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan and "_salt" not in plan
    plan = keyed_join(facts, lookup, ["k"], small=False)._jdf.queryExecution().optimizedPlan()
    assert "_salt" in plan.toString()
    plan = keyed_join(facts, lookup, ["k"], small=False)._jdf.queryExecution().executedPlan()
    assert "SortMergeJoin" in plan.toString()


def test_the_salt_reads_named_columns_only(spark, folder, lookup):
    wide = spark.range(50).select("id", F.lit("hot").alias("k"), F.lit("x").alias("unused"))
    wide.write.parquet(f"{folder}/wide")
    joined = salted_join(spark.read.parquet(f"{folder}/wide"), lookup, ["k"], salt_by=["id"])
    plan = joined.select("k", "name")._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in plan


def test_types_are_judged_before_the_choice(spark):
    small = spark.createDataFrame([("1",)], "id string")
    for choice in (None, True, False):
        with pytest.raises(ValueError):
            keyed_join(spark.range(3), small, ["id"], small=choice)
