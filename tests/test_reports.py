import json

import pytest
from pyspark.sql import functions as F

from sparkpipe.operators import metrics, profile, quality, records, score


def test_rules_in_one_pass(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (-1, None)], "x int, y string")
    report = quality.rule_suite(df, {"x positive": F.col("x") > 0, "y there": F.col("y").isNotNull()})
    assert sorted(map(tuple, report.collect())) == [
        ("x positive", 2, 3, False),
        ("y there", 1, 3, False),
    ]
    with pytest.raises(quality.QualityError, match="x positive \\(2 of 3\\)"):
        quality.gate(report)
    quality.gate(quality.rule_suite(df.filter("x = 1"), {"x positive": F.col("x") > 0}))
    assert quality.row_count(df).first().total == 3


def test_rules_on_no_rows_pass(spark):
    empty = spark.createDataFrame([], "x int")
    assert quality.rule_suite(empty, {"r": F.col("x") > 0}).first().passed


def test_histogram_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(5.0,), (5.1,), (10.0,), (99.0,), (None,)], "v double")
    rows = metrics.histogram(df, "v", [], [5.0, 10.0]).collect()
    assert {r.bucket: (r["count"], r.sum, r.min, r.max, r.upper_bound) for r in rows} == {
        0: (1, 5.0, 5.0, 5.0, 5.0),
        1: (2, 15.1, 5.1, 10.0, 10.0),
        2: (1, 99.0, 99.0, 99.0, None),
    }


def test_top_k_does_not_sort_everything(spark):
    top = metrics.most_recent(spark.range(100).withColumn("t", F.col("id") % 7), "t", 3, ["id"])
    assert [r.id for r in top.collect()] == [6, 13, 20]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", [1]), (2, None, None)], "x int, y string, z array<int>")
    rows = {r.column_name: r for r in profile.profile(df).collect()}
    assert (rows["x"].low, rows["x"].high, rows["x"].nulls, rows["x"].total) == ("1", "2", 0, 2)
    assert rows["y"].nulls == 1 and rows["y"].approx_distinct == 1
    assert rows["z"].low is None and rows["z"].column_type == "array<int>"
    sampled = profile.profile(spark.range(10_000), fraction=0.1, seed=1).first()
    assert 800 < sampled.total < 1200


@pytest.mark.parametrize(
    "text, code, result",
    [
        ('{"a": 1}', 200, {"a": 1, "processed_timestamp": "2024-06-01T00:00:00.000000Z"}),
        (" {} ", 200, {"processed_timestamp": "2024-06-01T00:00:00.000000Z"}),
        (
            '{"processed_timestamp": "old"}',
            200,
            {"processed_timestamp": "2024-06-01T00:00:00.000000Z"},
        ),
        ('{"a": {"b": "}"} }', 200, {"a": {"b": "}"}, "processed_timestamp": "2024-06-01T00:00:00.000000Z"}),
        ('{"a": 1}\t\n', 200, {"a": 1, "processed_timestamp": "2024-06-01T00:00:00.000000Z"}),
        ("not json", 400, None),
        ("[1]", 400, None),
        ('"text"', 400, None),
        ("3", 400, None),
        ("null", 400, None),
        ('{"a": 1} x', 400, None),
        ("", 400, None),
        (None, 400, None),
    ],
)
def test_stamped_records(spark, text, code, result):
    df = spark.createDataFrame([(text,)], "value string")
    row = records.stamp_json(df, "value", F.lit("2024-06-01 00:00:00").cast("timestamp")).first()
    assert row.status_code == code
    assert (json.loads(row.stamped) if row.stamped else None) == result


def test_a_record_stamped_before_keeps_its_numbers_and_strings(spark):
    text = (
        '{"a": 1.10, "b": 11.0, "c": 1e2, "processed_timestamp": {"x": [1, "}"]}, '
        '"d": "q\\"u, \\u00e9{", "e": null, "f": [1.0, {"g": 2.50, "processed_timestamp": 1}], "h": true}'
    )
    row = records.stamp_json(
        spark.createDataFrame([(text,)], "value string"), "value", F.lit("2024-06-01").cast("timestamp")
    ).first()
    assert row.stamped == (
        '{"a":1.10,"b":11.0,"c":1e2,"d":"q\\"u, \\u00e9{","e":null,'
        '"f":[1.0,{"g":2.50,"processed_timestamp":1}],"h":true,'
        '"processed_timestamp":"2024-06-01T00:00:00.000000Z"}'
    )


def test_object_events_read_every_record(spark):
    record = {
        "eventName": "s3:ObjectCreated:Put",
        "s3": {"bucket": {"name": "b"}, "object": {"key": "k.parquet", "eTag": "e", "size": 3}},
    }
    other = {"s3": {"bucket": {"name": "b"}, "object": {"key": "k.csv", "eTag": "e", "size": 4}}}
    payloads = [json.dumps({"Records": [record, other]}), json.dumps({"Records": []}), "x"]
    df = spark.createDataFrame([(p,) for p in payloads], "value string")
    none = (None,) * 5
    assert sorted(map(tuple, records.object_events(df).collect()), key=str) == [
        ("N/A", "b", "k.csv", "e", 4, None),
        ("s3:ObjectCreated:Put", "b", "k.parquet", "e", 3, None),
        (*none, "no records"),
        (*none, "unreadable"),
    ]


def test_messages_round_trip(spark, folder):
    df = spark.createDataFrame([("1", 2.5, None)], "id string, amount double, note string")
    out = records.to_messages(
        df.withColumn("route", F.lit("dlq")), "id", df.columns, records.topic_of(F.col("route"), "insurance")
    )
    row = out.first()
    assert (row.key, row.topic) == ("1", "dlq_insurance_claims")
    assert json.loads(row.value) == {"id": "1", "amount": 2.5}
    records.publish_messages(out, "json", path=f"{folder}/topic")
    assert spark.read.json(f"{folder}/topic").count() == 1


@pytest.fixture(scope="module")
def amounts(spark):
    return spark.range(400).select(
        F.col("id").cast("string").alias("transaction_id"),
        (F.col("id") * 1.0).alias("amount"),
        F.lit("c").alias("category"),
    )


def test_scoring_recovers_the_rule(amounts):
    featured = score.features(amounts, 200.0)
    model = score.fit(featured, None, {"maxIter": 100, "regParam": 0.0, "elasticNetParam": 0.0})
    wrong = score.score(featured, model).filter(
        (F.col("fraud_prediction") == 1) != (F.col("amount") > 200)
    )
    assert wrong.isEmpty()


def test_scoring_with_fixed_settings(amounts):
    featured = score.features(amounts, 200.0)
    model = score.fit(featured)
    scored = score.score(featured, model)
    assert tuple(scored.columns) == score.OUTPUT and scored.count() == 400
    assert scored.filter("fraud_probability BETWEEN 0 AND 1").count() == 400
    assert sorted(scored.collect()) == sorted(score.score(featured, score.fit(featured)).collect())


def test_rows_without_an_amount_are_scored(amounts):
    featured = score.features(amounts.withColumn("amount", F.when(F.col("amount") > 9, F.col("amount"))), 200.0)
    scored = score.score(featured, score.fit(featured, None))
    blank = scored.filter("amount IS NULL").collect()
    assert len(blank) == 10
    assert {(r.fraud_prediction, r.fraud_probability) for r in blank} == {(0.0, None)}


def test_nothing_to_learn_from(spark, amounts):
    featured = score.features(amounts, 1e9)
    assert score.fit(featured) is None
    assert score.fit(featured.limit(0)) is None
    fallback = score.score(featured, None)
    assert fallback.dtypes == score.score(featured, None).dtypes
    assert fallback.filter("fraud_prediction <> 0 OR fraud_probability IS NOT NULL").isEmpty()


def test_training_subset_is_replayable(amounts):
    first = score.training_subset(amounts, "transaction_id", 7).collect()
    again = score.training_subset(amounts.repartition(5), "transaction_id", 7).collect()
    assert first == again and len(first) == 7


def test_catalog_by_name(spark):
    tables = {"raw_a": spark.range(3), "raw_b": spark.range(4), "tmp": spark.range(1)}
    rows = profile.catalog(tables, include="raw_.*", exclude=".*_b").collect()
    assert [(r.table_name, r.column_name, r.total) for r in rows] == [("raw_a", "id", 3)]
    with pytest.raises(ValueError):
        profile.catalog(tables, include="none")


@pytest.mark.parametrize(
    "text, result",
    [
        ('{"body": "{\\"a\\": 1}"}', '{"a": 1}'),
        ('{"body": "text", "x": 1}', "text"),
        ('{"body": {"a": 1}}', '{"body": {"a": 1}}'),
        ('{"body": null}', '{"body": null}'),
        ('{"a": 1}', '{"a": 1}'),
        ("not json", "not json"),
        (None, None),
    ],
)
def test_request_envelopes_are_opened(spark, text, result):
    df = spark.createDataFrame([(text,)], "value string")
    assert records.request_body(df, "value").first().value == result
