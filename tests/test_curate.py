import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkpipe.operators import curate
from sparkpipe.sources.jdbc import read_jdbc

SCHEMA = (
    "transaction_id string, timestamp timestamp, account_id string, amount double, "
    "currency string, transaction_type string, merchant_id string, category string"
)


@pytest.fixture
def raw(spark):
    rows = [
        ("1", None, "a", None, " usd ", "sale", "m1", "own"),
        ("1", None, "a", 0.0, "USD", "sale", "m1", "own"),
        ("2", None, "b", 5.5, "\teur", "sale", "m2", "own"),
        ("3", None, None, 7.0, None, "sale", None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame([("m1", "food"), ("m3", "cars")], "merchant_id string, category string")


def test_curated_rows(raw, lookup):
    curated = curate.curate(raw, lookup)
    assert curated.columns == [
        "transaction_id",
        "timestamp",
        "hashed_account_id",
        "amount",
        "currency",
        "transaction_type",
        "merchant_id",
        "category",
        "is_amount_zero_flag",
    ]
    rows = {r.transaction_id: r for r in curated.collect()}
    assert curated.count() == 3
    assert rows["1"].amount == 0.0 and rows["1"].is_amount_zero_flag
    assert rows["1"].currency == "USD" and rows["1"].category == "food"
    assert rows["1"].hashed_account_id == hashlib.sha256(b"a").hexdigest()
    assert rows["2"].category == "own" and rows["2"].currency == "\tEUR"
    assert rows["3"].category is None and rows["3"].hashed_account_id is None


def test_salted_enrichment_is_the_same(raw, lookup):
    assert sorted(map(str, curate.curate(raw, lookup, small=False).collect())) == sorted(
        map(str, curate.curate(raw, lookup, small=True).collect())
    )


def test_without_lookup(raw):
    assert {r.category for r in curate.curate(raw).collect()} == {"own", None}


def test_text_amounts(spark):
    df = spark.createDataFrame([("12.5",), ("x",), (None,)], "amount string")
    out = curate.cleanse(df.withColumn("currency", F.lit("usd")))
    assert [r.amount_clean for r in out.collect()] == [12.5, None, 0.0]


def test_narrow_amounts_on_request(raw):
    assert dict(curate.cleanse(raw, "float").dtypes)["amount_clean"] == "double"


def test_stamp_is_added_last(raw):
    assert curate.stamped(curate.curate(raw)).columns[-1] == "processed_at"
    assert curate.stamped(curate.curate(raw)).count() == 3


def test_curation_shuffles_transactions_once(raw, lookup):
    """And the lookup once, by merchant, to make sure that each is there once."""
    plan = curate.curate(raw, lookup)._jdf.queryExecution().executedPlan().toString()
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(shuffles) == 2 and sum("(merchant_id#" in x for x in shuffles) == 1


def test_a_merchant_twice_in_the_lookup_is_an_error(raw, lookup):
    for small in (True, False):
        with pytest.raises(PySparkException, match="more than one row for merge key"):
            curate.enrich(raw, lookup.unionByName(lookup), small).collect()


def test_lookup_over_jdbc(spark, raw, lookup):
    """The in-process database that ships with Spark; nothing listens anywhere."""
    url = "jdbc:derby:memory:lookup;create=true"
    numbered = lookup.withColumn("id", F.when(F.col("merchant_id") == "m1", 1).otherwise(90))
    numbered.write.jdbc(url, "merchant_lookup")
    whole = read_jdbc(spark, url, "merchant_lookup")
    split = read_jdbc(
        spark, url, "merchant_lookup", partition_column="id", lower=0, upper=60, partitions=3
    )
    assert split.rdd.getNumPartitions() == 3
    assert sorted(split.collect()) == sorted(whole.collect()) and whole.count() == 2
    assert "food" in {r.category for r in curate.curate(raw, split).collect()}
    with pytest.raises(ValueError):
        read_jdbc(spark, url, "merchant_lookup", partition_column="id")
