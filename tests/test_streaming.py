import datetime
import json

import pytest
from pyspark.sql import functions as F

from sparkpipe.operators import metrics, records, upkeep
from sparkpipe.operators.contracts import check
from sparkpipe.operators.decode import decode
from sparkpipe.schemas import topics_of
from sparkpipe.sources import streams
from sparkpipe.streaming import ingest, keyed


def record(i, **fields):
    base = {
        "transaction_id": f"T{i}",
        "timestamp": "2024-01-01T00:00:00Z",
        "account_id": "a",
        "amount": 10.0 + i,
        "currency": "USD",
        "transaction_type": "sale",
    }
    return json.dumps({**base, **fields})


def arrive(spark, folder, *payloads):
    df = spark.createDataFrame([(p,) for p in payloads], "value string").coalesce(1)
    df.write.mode("append").parquet(f"{folder}/in")


def messages(spark, folder, per_trigger=None):
    return streams.file_stream(
        spark, f"{folder}/in", "value string", files_per_trigger=per_trigger
    )


def rows(df):
    return sorted(map(str, df.collect()))


def test_append_takes_each_message_once(spark, folder):
    def run():
        query = ingest.ingest_raw(
            messages(spark, folder), "financial", f"{folder}/out", f"{folder}/check", None
        )
        ingest.run_available(query)

    arrive(spark, folder, record(1), "not json")
    run()
    run()
    assert spark.read.parquet(f"{folder}/out").count() == 2
    arrive(spark, folder, record(2))
    run()
    out = spark.read.parquet(f"{folder}/out")
    assert out.filter("processing_timestamp IS NULL").isEmpty()
    batch = decode(spark.read.parquet(f"{folder}/in"), "financial")
    assert rows(out.drop("processing_timestamp")) == rows(batch)


def test_routes_are_partitions(spark, folder):
    arrive(spark, folder, record(1), record(2, amount=-1), "not json")
    query = ingest.ingest_routed(
        messages(spark, folder), "financial", f"{folder}/out", f"{folder}/check", None
    )
    ingest.run_available(query)
    out = spark.read.parquet(f"{folder}/out").select("value", "route", "reasons")
    batch = check(spark.read.parquet(f"{folder}/in"), "financial")
    assert rows(out) == rows(batch.select(*out.columns))
    assert {r.route for r in out.collect()} == {"curated", "dlq", "malformed"}


def test_checkpoint_must_be_outside(spark, folder):
    arrive(spark, folder, record(1))
    with pytest.raises(ValueError):
        ingest.ingest_raw(
            messages(spark, folder), "financial", f"{folder}/out", f"{folder}/out/check", None
        )


def upserts(spark, folder, per_trigger=None):
    rows = decode(messages(spark, folder, per_trigger), "financial").select("transaction_id", "amount")
    return ingest.upsert_stream(
        rows, f"{folder}/table", f"{folder}/check", ["transaction_id"], ["amount"], None
    )


def state(spark, folder):
    start = spark.createDataFrame([("T1", 1.0)], "transaction_id string, amount double")
    table = ingest.upserted(start, f"{folder}/table", ["transaction_id"])
    return {r.transaction_id: r.amount for r in table.collect()}


def batches(spark, folder):
    return spark.read.parquet(f"{folder}/table").select("query", "batch").distinct().count()


def test_upserts_over_several_batches(spark, folder):
    arrive(spark, folder, record(1), record(2))
    arrive(spark, folder, record(2, amount=20.0), record(2, amount=21.0), record(3))
    ingest.run_available(upserts(spark, folder, 1))
    final = state(spark, folder)
    assert final.pop("T2") in (12.0, 21.0)
    assert final == {"T1": 11.0, "T3": 13.0}
    ingest.run_available(upserts(spark, folder, 1))
    assert batches(spark, folder) == 2


def test_a_repeated_batch_changes_nothing(spark, folder):
    arrive(spark, folder, record(1))
    ingest.run_available(upserts(spark, folder))
    before = state(spark, folder)
    # The batch's commit is lost, as after a crash right before it was written.
    import pathlib

    commit = pathlib.Path(f"{folder}/check/commits/0")
    commit.rename(f"{folder}/lost")
    pathlib.Path(f"{folder}/check/commits/.0.crc").rename(f"{folder}/lost.crc")
    ingest.run_available(upserts(spark, folder))
    assert state(spark, folder) == before
    assert batches(spark, folder) == 1


def test_a_new_checkpoint_at_the_old_path_loses_nothing(spark, folder):
    import pathlib

    for i in (1, 2, 3):
        arrive(spark, folder, record(i))
    ingest.run_available(upserts(spark, folder, 1))
    pathlib.Path(f"{folder}/check").rename(f"{folder}/old-check")
    pathlib.Path(f"{folder}/in").rename(f"{folder}/old-in")
    arrive(spark, folder, record(4), record(2, amount=99.0))
    ingest.run_available(upserts(spark, folder, 1))
    assert state(spark, folder) == {"T1": 11.0, "T2": 99.0, "T3": 13.0, "T4": 14.0}
    assert batches(spark, folder) == 4


def count(spark, folder, per_trigger=None):
    rows = decode(messages(spark, folder, per_trigger), "financial")
    ingest.run_available(
        ingest.counter_stream(rows, ["currency"], f"{folder}/counts", f"{folder}/check", None)
    )


def settled(df):
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def totals(df):
    return {r.currency: r.ingested_total for r in df.collect()}


def test_running_counts(spark, folder):
    arrive(spark, folder, record(1), record(2), record(3, currency="EUR"), "not json")
    count(spark, folder)
    before = settled(ingest.latest_totals(spark, f"{folder}/counts"))
    arrive(spark, folder, record(4))
    count(spark, folder)
    table = ingest.latest_totals(spark, f"{folder}/counts")
    assert totals(table) == {"USD": 3, "EUR": 1, None: 1}
    # A batch writes what it changes, and what was read before needs that batch only.
    later = ingest.batches_after(spark, f"{folder}/counts", (0, 0))
    assert totals(later) == {"USD": 3}
    assert ingest.newest_batch(spark, f"{folder}/counts") == (0, 1)
    assert totals(ingest.latest_totals(spark, f"{folder}/counts", before, (0, 0))) == totals(table)


def test_a_new_run_counts_from_nothing(spark, folder):
    import pathlib

    arrive(spark, folder, record(1), record(2, currency="EUR"))
    count(spark, folder)
    old = settled(ingest.latest_totals(spark, f"{folder}/counts"))
    pathlib.Path(f"{folder}/check").rename(f"{folder}/old-check")
    arrive(spark, folder, record(3))
    count(spark, folder)
    for table in (
        ingest.latest_totals(spark, f"{folder}/counts"),
        ingest.latest_totals(spark, f"{folder}/counts", old, (0, 0)),
    ):
        assert totals(table) == {"USD": 2, "EUR": 1}
    assert ingest.newest_batch(spark, f"{folder}/counts") == (1, 0)


def test_a_second_run_reads_no_batch_written_before(spark, folder):
    """The state holds what it needs; the folders of earlier batches may be gone."""
    import pathlib

    arrive(spark, folder, record(1, amount=5.0), record(2, amount=7.0))
    ingest.run_available(upserts(spark, folder))
    whole = state(spark, folder)
    (first,) = pathlib.Path(f"{folder}/table").glob("run=0/query=*/batch=0")
    first.rename(f"{folder}/moved")
    arrive(spark, folder, record(1, amount=4.0), record(2, amount=9.0))
    ingest.run_available(upserts(spark, folder))
    second = ingest.batches_after(spark, f"{folder}/table", (0, 0))
    assert {(r.transaction_id, r.amount) for r in second.collect()} == {("T1", 5.0), ("T2", 9.0)}
    assert whole == {"T1": 5.0, "T2": 7.0}
    base = spark.createDataFrame(list(whole.items()), "transaction_id string, amount double")
    after = ingest.upserted(base, f"{folder}/table", ["transaction_id"], (0, 0))
    assert {r.transaction_id: r.amount for r in after.collect()} == {"T1": 5.0, "T2": 9.0}


def test_without_an_order_a_later_batch_wins_and_two_rows_fail(spark, folder):
    def run():
        rows = decode(messages(spark, folder), "financial").select("transaction_id", "amount")
        query = ingest.upsert_stream(rows, f"{folder}/table", f"{folder}/check", ["transaction_id"], None, None)
        ingest.run_available(query)

    for amount in (8.0, 2.0):
        arrive(spark, folder, record(1, amount=amount))
        run()
    assert state(spark, folder) == {"T1": 2.0}
    arrive(spark, folder, record(2), record(2))
    with pytest.raises(Exception, match="more than one row"):
        run()


def test_a_null_key_is_refused(spark, folder):
    arrive(spark, folder, "not json")
    with pytest.raises(Exception, match="NULL in merge key"):
        ingest.run_available(upserts(spark, folder))


def changes(spark, folder, order_by=("amount",)):
    rows = decode(messages(spark, folder), "financial").select("transaction_id", "amount", "category")
    ingest.run_available(
        ingest.change_stream(
            rows, f"{folder}/table", f"{folder}/check", ["transaction_id"], order_by, None
        )
    )


def test_changes_name_the_rows_they_replace(spark, folder):
    arrive(spark, folder, record(1, amount=5.0), record(2, amount=7.0), record(2, amount=6.0))
    changes(spark, folder)
    arrive(spark, folder, record(1, amount=4.0), record(2, amount=9.0), record(3, amount=1.0))
    changes(spark, folder)
    arrive(spark, folder, record(2, amount=9.0), record(3, amount=1.0, category="late"))
    changes(spark, folder)
    feed = ingest.batches_after(spark, f"{folder}/table")
    found = sorted((r.batch, r.transaction_id, r._change_type, r.amount, r.category) for r in feed.collect())
    assert found == [
        (0, "T1", "insert", 5.0, None),
        (0, "T2", "insert", 7.0, None),
        (1, "T2", "update_postimage", 9.0, None),
        (1, "T2", "update_preimage", 7.0, None),
        (1, "T3", "insert", 1.0, None),
        (2, "T3", "update_postimage", 1.0, "late"),
        (2, "T3", "update_preimage", 1.0, None),
    ]
    counts = upkeep.maintained_counts(
        metrics.counters(feed.limit(0), ["amount"]), feed, ["amount"]
    )
    assert {(r.amount, r.ingested_total) for r in counts.collect()} == {(5.0, 1), (9.0, 1), (1.0, 1)}


def test_state_of_untouched_keys_goes_after_a_while(spark, folder):
    arrive(spark, folder, record(1, amount=5.0))
    rows = decode(messages(spark, folder), "financial").select("transaction_id", "amount")
    keep = datetime.timedelta(milliseconds=1)
    given = (f"{folder}/table", f"{folder}/check", ["transaction_id"], ["amount"])
    with pytest.raises(ValueError):
        ingest.change_stream(rows, *given, None, keep)
    ingest.run_bounded(ingest.change_stream(rows, *given, "1 second", keep), 10)
    arrive(spark, folder, record(1, amount=9.0))
    ingest.run_bounded(ingest.change_stream(rows, *given, "1 second", keep), 10)
    feed = ingest.batches_after(spark, f"{folder}/table")
    assert [r._change_type for r in feed.collect()] == ["insert", "insert"]


def test_keys_of_a_bucket_are_told_apart(spark, folder, monkeypatch):
    """Keys go to Python together, and are no one else's for it."""
    monkeypatch.setattr(keyed, "BUCKETS", 2)
    schema = "a double, b binary, v int"
    nan, none = float("nan"), None
    batches = [
        [(0.0, b"x", 1), (nan, b"x", 2), (none, none, 3), *[(float(i), b"y", i) for i in range(9)]],
        [(-0.0, b"x", 4), (nan, b"x", 5), (none, none, 0), (3.0, b"y", 7), (3.0, b"z", 8)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        ingest.run_available(
            ingest.change_stream(stream, f"{folder}/out", f"{folder}/check", ["a", "b"], ["v"], None)
        )
    plan = keyed.latest_images(stream, ["a", "b"], ["v"])._jdf.queryExecution().analyzed().toString()
    assert "pmod(hash(a#" in plan and "TransformWithState" in plan  # not one group per key
    feed = ingest.batches_after(spark, f"{folder}/out")
    assert feed.where("batch = 0").count() == 12
    found = sorted((r._change_type, r.v) for r in feed.where("batch = 1").collect())
    assert found == [
        ("insert", 8),
        ("update_postimage", 4),
        ("update_postimage", 5),
        ("update_postimage", 7),
        ("update_preimage", 1),
        ("update_preimage", 2),
        ("update_preimage", 3),
    ]


def test_interval_and_bounded_run(spark, folder):
    arrive(spark, folder, record(1))
    query = ingest.ingest_raw(
        messages(spark, folder), "financial", f"{folder}/out", f"{folder}/check", "1 second"
    )
    query.processAllAvailable()
    ingest.run_bounded(query, 1)
    assert not query.isActive
    assert spark.read.parquet(f"{folder}/out").count() == 1


def test_topic_stream_asks_for_the_connector(spark):
    """The stand-in source takes the options a topic source would."""
    stream = streams.topic_stream(spark, "broker:9092", "raw_financial_events", fmt="rate")
    assert stream.isStreaming
    assert decode(stream.select(F.col("value").cast("string")), "financial").isStreaming


def test_an_interrupt_stops_query_and_session():
    class Query:
        stopped = False

        def awaitTermination(self):
            raise KeyboardInterrupt

        def stop(self):
            self.stopped = True

    query, session = Query(), Query()
    ingest.run_forever(query, session)
    assert query.stopped and session.stopped


def test_every_message_is_published_to_its_topic(spark, folder):
    arrive(spark, folder, record(1), record(2, amount=-1), "not json")
    checked = check(messages(spark, folder), "financial")
    topic = records.topic_of(F.col("route"), "financial")
    out = checked.select(F.lit("k").alias("key"), "value", topic.alias("topic"))
    options = {"path": f"{folder}/topics"}
    ingest.run_available(
        ingest.publish_stream(out, f"{folder}/check", "json", interval=None, **options)
    )
    topics = {r.topic for r in spark.read.json(f"{folder}/topics").collect()}
    assert topics == set(topics_of("financial")) - {"raw_financial_events"}
