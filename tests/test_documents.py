import pytest
from pyspark.sql import functions as F

from sparkpipe.operators import flatten
from sparkpipe.sources import documents, tables


@pytest.fixture
def claims(spark):
    schema = (
        "claim_id string, policy_id string, claim_date string, status string, "
        "details struct<type: string, incident_date: string, vehicle_vin: string, "
        "damages: array<struct<part: string, cost: double>>>"
    )
    rows = [
        ("c1", "p", "d", "open", ("auto", "i", "v", [("door", 1.0), ("hood", 2.0)])),
        ("c2", "p", "d", "open", ("auto", "i", "v", [])),
        ("c3", "p", "d", "open", ("auto", "i", "v", None)),
        ("c4", "p", "d", "open", None),
    ]
    return spark.createDataFrame(rows, schema)


def test_claims(claims):
    flat = flatten.transform_documents(claims, "claims")
    assert [(r.claim_id, r.claim_type, r.damage_item.part) for r in flat.collect()] == [
        ("c1", "auto", "door"),
        ("c1", "auto", "hood"),
    ]
    assert flatten.transform_documents(claims, "claims", outer=True).count() == 5


def test_optional_fields(spark, claims):
    out = claims.select(
        flatten.optional(claims, "details.type").alias("a"),
        flatten.optional(claims, "details.missing").alias("b"),
        flatten.optional(claims, "status.deep", "int").alias("c"),
    )
    assert out.dtypes == [("a", "string"), ("b", "string"), ("c", "int")]
    assert out.first().b is None


def test_events_with_and_without_optional_fields(spark):
    base = spark.range(1).select(
        F.col("id").alias("event_id"),
        *[F.lit("x").alias(c) for c in ("type", "user_id", "timestamp", "ip_address", "status")],
    )
    row = flatten.transform_documents(base, "financial_events").first()
    assert row.failure_reason is None and row.login_attempts is None
    full = base.withColumns({"reason": F.lit("pw"), "attempts": F.lit(3)})
    row = flatten.transform_documents(full, "financial_events").first()
    assert (row.failure_reason, row.login_attempts) == ("pw", 3)


def test_unknown_collections_pass_through(claims):
    assert flatten.transform_documents(claims, "other").columns == claims.columns


def test_json_records_leave_out_unset_fields(spark, folder):
    df = spark.createDataFrame([("1", None), ("2", "x")], "id string, note string")
    documents.write_json_records(df, f"{folder}/out")
    assert sorted(r.value for r in spark.read.text(f"{folder}/out").collect()) == [
        '{"id":"1"}',
        '{"id":"2","note":"x"}',
    ]
    back = documents.read_json_records(spark, f"{folder}/out", df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_inferred_and_given_schemas(spark, folder, claims):
    documents.write_json_records(claims, f"{folder}/docs")
    inferred = documents.read_documents(spark, f"{folder}/docs")
    given = documents.read_documents(spark, f"{folder}/docs", schema=claims.schema)
    sampled = documents.read_documents(spark, f"{folder}/docs", sampling_ratio=1.0)
    for df in (inferred, given, sampled):
        assert flatten.transform_documents(df, "claims").count() == 2


def test_table_helpers(spark, folder, capsys):
    df = tables.literal_rows(spark, [(1, "a.parquet"), (2, "b.csv")], "id int, name string")
    df.write.parquet(f"{folder}/t`x")
    assert tables.lookup_sql(spark, f"{folder}/t`x", "id", 2).first().name == "b.csv"
    assert tables.exists(df, "id = 2").first().found
    assert not tables.exists(df, "id = 3").first().found
    assert tables.suffix_filter(df, "name", ".parquet").count() == 1
    assert tables.is_empty(df.filter("id > 5")) and not tables.is_empty(df)
    tables.preview(df, 1)
    assert "a.parquet" in capsys.readouterr().out


def test_columns_added_later(spark, folder):
    old = spark.createDataFrame([(1,)], "id int")
    new = spark.createDataFrame([(2, True)], "id int, is_flagged boolean")
    tables.append_rows(old, f"{folder}/t")
    tables.append_rows(new, f"{folder}/t")
    merged = tables.read_table(spark, f"{folder}/t", options={"mergeSchema": "true"})
    assert sorted(map(tuple, merged.collect())) == [(1, None), (2, True)]
    assert sorted(map(tuple, tables.add_columns(old, new).collect())) == [(1, None), (2, True)]


def test_zone_less_times_become_instants(spark, folder):
    spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00' AS t").write.parquet(f"{folder}/t")
    assert tables.read_table(spark, f"{folder}/t").dtypes == [("t", "timestamp")]
