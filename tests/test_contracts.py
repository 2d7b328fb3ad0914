import json

import pytest

from sparkpipe.operators.contracts import check, typed_records
from sparkpipe.operators.decode import decode
from sparkpipe.schemas import domain_of, schema_of

GOOD = {
    "transaction_id": "FT-1",
    "timestamp": "2023-10-26T14:30:00Z",
    "account_id": "ACC-1",
    "amount": 150.75,
    "currency": "USD",
    "transaction_type": "debit",
}


def verdicts(spark, payloads, domain="financial"):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "id int, value string")
    rows = check(df, domain).select("id", "route", "reasons").collect()
    return [(r.route, r.reasons) for r in sorted(rows)]


def changed(**fields):
    return json.dumps({k: v for k, v in {**GOOD, **fields}.items() if v is not ...})


@pytest.mark.parametrize(
    "fields, reasons",
    [
        ({}, []),
        ({"merchant_id": "M", "category": "food", "is_flagged": True}, []),
        ({"amount": "12.5"}, []),
        ({"amount": "1e2"}, []),
        ({"timestamp": "2023-10-26T14:30:00.123456+02:00"}, []),
        ({"timestamp": "2023-10-26"}, []),
        ({"amount": "12d"}, ["amount:type"]),
        ({"amount": "NaN"}, ["amount:type"]),
        ({"amount": 0}, ["amount:gt"]),
        ({"amount": -1}, ["amount:gt"]),
        ({"amount": None}, ["amount:required"]),
        ({"currency": "USDX"}, ["currency:max_length"]),
        ({"currency": ""}, []),
        ({"timestamp": "invalid-date", "amount": "not-a-number"}, ["timestamp:type", "amount:type"]),
        ({"timestamp": "12:30"}, ["timestamp:type"]),
        ({"timestamp": "2023-13-45T00:00:00Z"}, ["timestamp:type"]),
        ({"transaction_id": ..., "account_id": ...}, ["transaction_id:required", "account_id:required"]),
        ({"is_flagged": "maybe"}, ["is_flagged:type"]),
    ],
)
def test_every_failing_field_is_named(spark, fields, reasons):
    route = "dlq" if reasons else "curated"
    assert verdicts(spark, [changed(**fields)]) == [(route, reasons)]


@pytest.mark.parametrize(
    "payload",
    [
        None,
        "",
        "not json",
        "[]",
        '"text"',
        "[" + json.dumps(GOOD) + "]",
        json.dumps(GOOD) + " trailing",
        json.dumps(GOOD) + "," + json.dumps(GOOD),
        '{"bad_field": "x", "timestamp": "2024-01-01T00:00:00Z"}',
    ],
)
def test_what_is_no_record_is_malformed(spark, payload):
    assert verdicts(spark, [payload])[0][0] == "malformed"


def test_insurance_needs_its_amount(spark):
    claim = {
        "claim_id": "IC-002",
        "timestamp": "2023-10-26T15:00:00Z",
        "policy_number": "POL-456",
        "claim_type": "home",
        "claim_status": "in_progress",
        "customer_id": "CUST-002",
        "incident_date": "2023-01-01T00:00:00Z",
    }
    good = json.dumps({**claim, "claim_amount": 1500.0})
    assert verdicts(spark, [json.dumps(claim), good], "insurance") == [
        ("dlq", ["claim_amount:required"]),
        ("curated", []),
    ]


def test_sports_scores_are_optional_whole_numbers(spark):
    event = {
        "event_id": "SE-1",
        "timestamp": "2023-10-26T18:00:00Z",
        "sport": "soccer",
        "team_a": "A",
        "team_b": "B",
        "status": "finished",
    }
    payloads = [json.dumps({**event, "score_a": s}) for s in (2, 2.0, 2.5, "3")]
    assert [r for _, r in verdicts(spark, [json.dumps(event), *payloads], "sports")] == [
        [],
        [],
        [],
        ["score_a:type"],
        [],
    ]


def test_typed_records(spark):
    df = spark.createDataFrame([(changed(amount="12.5"),)], "value string")
    row = typed_records(check(df, "financial")).first()
    assert (row.transaction_id, row.amount, row.category) == ("FT-1", 12.5, None)
    assert row.timestamp.isoformat() == "2023-10-26T14:30:00"


def test_decode_reads_bytes_and_keeps_bad_rows(spark):
    rows = [(json.dumps(GOOD).encode(),), (b"not json",), (changed(amount="x").encode(),)]
    df = decode(spark.createDataFrame(rows, "value binary"), "financial")
    assert df.schema.fieldNames() == schema_of("financial").fieldNames()
    assert [(r.transaction_id, r.amount) for r in df.collect()] == [
        ("FT-1", 150.75),
        (None, None),
        ("FT-1", None),
    ]


def test_domain_by_topic():
    assert domain_of("raw_financial_events") == "financial"
    assert domain_of("raw_insurance_claims") == "insurance"
    assert domain_of("raw_sports_events") == "sports"
    with pytest.raises(ValueError):
        domain_of("raw_weather")


def test_the_payload_is_parsed_once(spark):
    df = spark.createDataFrame([(changed(),)], "value string")
    curated = check(df, "financial").filter("route = 'curated'").select("record.*")
    plan = curated._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
