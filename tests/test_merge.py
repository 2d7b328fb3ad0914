import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkpipe.operators import joins, merge

UPDATE = {"amount": "amount", "currency": "currency", "updated_at": "updated_at_incoming"}
INSERT = {
    **{c: c for c in ("transaction_id", "account_id", "amount", "currency")},
    "created_at": "updated_at_incoming",
    "updated_at": "updated_at_incoming",
}
KEY = ["transaction_id"]


@pytest.fixture
def target(spark):
    rows = [
        ("T001", "ACC-001", 100.0, "USD", 0, 0),
        ("T002", "ACC-002", 200.0, "EUR", 0, 0),
        ("T003", "ACC-003", 50.0, "GBP", 0, 0),
    ]
    return spark.createDataFrame(
        rows,
        "transaction_id string, account_id string, amount double, currency string, "
        "created_at int, updated_at int",
    )


@pytest.fixture
def source(spark):
    rows = [
        ("T002", "OTHER", 250.0, "GBP", 1),
        ("T004", "ACC-004", 75.0, "USD", 1),
        ("T005", "ACC-005", 1200.5, "JPY", 1),
    ]
    return spark.createDataFrame(
        rows,
        "transaction_id string, account_id string, amount double, currency string, "
        "updated_at_incoming int",
    )


@pytest.fixture(params=["broadcast", "salted"])
def path(request, monkeypatch):
    if request.param == "salted":
        monkeypatch.setattr(merge, "fits_broadcast", lambda df: False)
        monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    return request.param


def rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_merge(target, source, path):
    merged = merge.merge(target, source, KEY, UPDATE, INSERT)
    by_key = {r.transaction_id: r for r in merged.collect()}
    assert len(by_key) == merged.count() == 5
    assert tuple(by_key["T001"]) == ("T001", "ACC-001", 100.0, "USD", 0, 0)
    assert tuple(by_key["T002"]) == ("T002", "ACC-002", 250.0, "GBP", 0, 1)
    assert tuple(by_key["T004"]) == ("T004", "ACC-004", 75.0, "USD", 1, 1)
    assert merged.schema.fieldNames() == target.schema.fieldNames()


def test_merging_twice_is_merging_once(target, source, path):
    once = merge.merge(target, source, KEY, UPDATE, {**INSERT})
    assert rows(merge.merge(once, source, KEY, UPDATE, INSERT)) == rows(once)


def test_a_null_in_the_source_overwrites(spark, target, path):
    source = spark.createDataFrame([("T001", None)], "transaction_id string, amount double")
    merged = merge.merge(target, source, KEY, {"amount": "amount"}, {c: c for c in source.columns})
    assert {r.transaction_id: r.amount for r in merged.collect()}["T001"] is None


def test_two_source_rows_for_a_key(target, source, path):
    twice = source.unionByName(source.withColumn("updated_at_incoming", F.lit(2)))
    with pytest.raises(PySparkException, match="more than one row for merge key"):
        merge.merge(target, twice, KEY, UPDATE, INSERT).collect()
    merged = merge.merge(target, twice, KEY, UPDATE, INSERT, order_by=["updated_at_incoming"])
    assert {r.updated_at for r in merged.collect()} == {0, 2}


def test_a_missing_key_is_an_error(target, source, path):
    bad = source.withColumn("transaction_id", F.lit(None).cast("string"))
    with pytest.raises(PySparkException, match="NULL in merge key"):
        merge.merge(target, bad, KEY, UPDATE, INSERT).collect()
    with pytest.raises(PySparkException, match="NULL in merge key"):
        merge.merge_feed(target, bad, KEY, UPDATE, INSERT).collect()


def test_duplicate_target_rows_are_all_updated(target, source, path):
    merged = merge.merge(target.unionByName(target), source, KEY, UPDATE, INSERT)
    assert merged.filter("transaction_id = 'T002' AND amount = 250").count() == 2
    assert merged.count() == 8


def test_feed_from_creation(spark, target, source, path):
    feed = merge.merge_feed(target, source, KEY, UPDATE, INSERT)
    kinds = {(r.transaction_id, r._change_type, r.amount) for r in feed.collect()}
    assert kinds == {
        ("T002", "update_preimage", 200.0),
        ("T002", "update_postimage", 250.0),
        ("T004", "insert", 75.0),
        ("T005", "insert", 1200.5),
    }


def test_feed_of_a_merge_is_the_difference_of_versions(target, source, path):
    merged = merge.merge(target, source, KEY, UPDATE, INSERT)
    assert rows(merge.merge_feed(target, source, KEY, UPDATE, INSERT)) == rows(
        merge.change_feed(target, merged, KEY)
    )


def test_feed_leaves_out_what_did_not_change(target, source, path):
    once = merge.merge(target, source, KEY, UPDATE, INSERT)
    again = source.withColumn("updated_at_incoming", F.lit(9))
    compare = ["amount", "currency"]
    assert merge.merge_feed(once, again, KEY, UPDATE, INSERT, compare=compare).isEmpty()
    later = merge.merge(once, again, KEY, UPDATE, INSERT)
    assert merge.change_feed(once, later, KEY, ignore=["updated_at"]).isEmpty()
    assert merge.change_feed(once, later, KEY).count() == 6


def test_applying_a_feed_gives_the_later_version(target, source, path):
    after = merge.upsert(
        target.filter("transaction_id <> 'T003'"),
        source.select("transaction_id", "account_id", "amount", "currency").withColumns(
            {"created_at": F.lit(3), "updated_at": F.lit(3)}
        ),
        KEY,
    )
    feed = merge.change_feed(target, after, KEY)
    assert "delete" in {r._change_type for r in feed.collect()}
    assert rows(merge.apply_feed(target, feed, KEY)) == rows(after)


def test_the_last_change_of_a_key_wins(spark, target):
    image = target.filter("transaction_id = 'T001'")
    steps = [("delete", 1, 100.0), ("insert", 2, 5.0), ("update_postimage", 3, 6.0)]
    feed = None
    for kind, version, amount in steps:
        part = image.withColumns(
            {
                "amount": F.lit(amount),
                "_change_type": F.lit(kind),
                "_commit_version": F.lit(version).cast("long"),
            }
        )
        feed = part if feed is None else feed.unionByName(part)
    state = {r.transaction_id: r.amount for r in merge.apply_feed(target, feed, KEY).collect()}
    assert state == {"T001": 6.0, "T002": 200.0, "T003": 50.0}


def test_change_feed_rejects_duplicate_keys(target):
    with pytest.raises(PySparkException, match="more than one row in a version"):
        merge.change_feed(target, target.unionByName(target), KEY).collect()


def test_nulls_compare_as_equal(target):
    blank = target.withColumn("currency", F.lit(None).cast("string"))
    assert merge.change_feed(blank, blank, KEY).isEmpty()
    assert merge.change_feed(target, blank, KEY).count() == 6


def test_a_small_source_leaves_the_target_unshuffled(spark, folder, source):
    spark.range(1000).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.lit("a").alias("account_id"),
        F.lit(1.0).alias("amount"),
        F.lit("USD").alias("currency"),
        F.lit(0).alias("created_at"),
        F.lit(0).alias("updated_at"),
    ).write.parquet(f"{folder}/big")
    merged = merge.merge(spark.read.parquet(f"{folder}/big"), source, KEY, UPDATE, INSERT)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_the_range_of_the_source_reaches_the_scan(spark, folder, source):
    target = spark.range(100).select(F.col("id"), F.lit(0).alias("v"))
    target.write.parquet(f"{folder}/t")
    scanned = spark.read.parquet(f"{folder}/t")
    changes = spark.createDataFrame([(98, 1), (99, 1), (200, 1)], "id long, v int")
    feed = merge.merge_feed(scanned, changes, ["id"], {"v": "v"}, {"id": "id", "v": "v"})
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,98), LessThanOrEqual(id,200)" in plan
    assert feed.count() == 5
    assert merge.merge(scanned, changes, ["id"], {"v": "v"}, {"id": "id", "v": "v"}).count() == 101


@pytest.mark.parametrize("seed", range(3))
def test_random_tables_against_a_plain_model(spark, path, seed):
    pick = random.Random(seed)

    def table(n):
        return {k: (k, pick.choice([None, "a", "b"]), pick.randint(0, 3)) for k in pick.sample(range(40), n)}

    schema = "k int, s string, v int"
    old, new = table(25), table(20)
    target = spark.createDataFrame(list(old.values()), schema)
    source = spark.createDataFrame(list(new.values()), schema)
    model = sorted(({**old, **new}).values(), key=str)
    upserted = merge.upsert(target, source, ["k"])
    assert sorted(map(tuple, upserted.collect()), key=str) == model
    feed = merge.change_feed(target, upserted, ["k"])
    assert sorted(map(tuple, merge.apply_feed(target, feed, ["k"]).collect()), key=str) == model
    back = merge.change_feed(upserted, target, ["k"])
    assert sorted(map(tuple, merge.apply_feed(upserted, back, ["k"]).collect()), key=str) == sorted(
        old.values(), key=str
    )
    kinds = {kind: 0 for kind in ("insert", "update_postimage", "update_preimage")}
    for row in feed.collect():
        kinds[row._change_type] += 1
    differing = sum(k in old and old[k] != v for k, v in new.items())
    assert kinds == {
        "insert": len(set(new) - set(old)),
        "update_postimage": differing,
        "update_preimage": differing,
    }


def test_a_target_row_without_key_is_kept(target, source, path):
    blank = target.limit(1).withColumn("transaction_id", F.lit(None).cast("string"))
    wider = target.unionByName(blank)
    assert merge.merge(wider, source, KEY, UPDATE, INSERT).count() == 6
    assert merge.merge_feed(wider, source, KEY, UPDATE, INSERT).count() == 4
