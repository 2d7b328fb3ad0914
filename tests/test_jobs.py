import json

import pytest
from pyspark.sql import functions as F

from sparkpipe import jobs
from sparkpipe.operators.quality import QualityError
from sparkpipe.session import work_dir
from sparkpipe.sources import tables


def test_wrong_arguments_are_a_usage_error(capsys):
    for argv in ([], ["curate", "only-one"], ["nothing"], ["merge", "a", "b"]):
        with pytest.raises(SystemExit) as stop:
            jobs.parser().parse_args(argv)
        assert stop.value.code == 2
    assert "usage" in capsys.readouterr().err


def test_from_topic_to_scores(spark, folder):
    messages = [
        json.dumps(
            {
                "transaction_id": f"T{i}",
                "timestamp": "2024-01-01T00:00:00Z",
                "account_id": "a",
                "amount": 100.0 * i,
                "currency": "usd",
                "transaction_type": "sale",
                "merchant_id": f"m{i % 3}",
            }
        )
        for i in range(1, 21)
    ]
    spark.createDataFrame([(m,) for m in messages], "value string").write.text(f"{folder}/topic")
    spark.createDataFrame([("m1", "food")], "merchant_id string, category string").write.parquet(
        f"{folder}/merchants"
    )
    run = lambda *argv: jobs.main([str(a) for a in argv], spark)
    raw, curated, scored = f"{folder}/raw", f"{folder}/curated", f"{folder}/scored"
    ingest = ("ingest", "raw_financial_events", f"{folder}/topic")
    run(*ingest, raw, "--format", "text", "--available-now")
    run(*ingest, f"{folder}/routed", "--format", "text", "--available-now", "--routed")
    assert {r.route for r in spark.read.parquet(f"{folder}/routed").collect()} == {"curated"}
    run("curate", raw, curated, "--lookup", f"{folder}/merchants")
    run("gate", curated, "--rule", "currency_is_code", "--rule", "amount_not_zero")
    with pytest.raises(QualityError, match="category_present"):
        run("gate", curated)
    run("score", curated, scored)
    rows = spark.read.parquet(scored).collect()
    assert len(rows) == 20 and all(r.inference_timestamp for r in rows)


def test_messages_to_scores_in_one_job(spark, folder):
    record = '{"transaction_id": "T%d", "timestamp": "2024-01-01T00:00:00Z", "account_id": "a", '
    record += '"amount": %d, "currency": "usd", "transaction_type": "sale"}'
    messages = [record % (i, 100 * i) for i in range(1, 13)] + ["not json", record % (99, -5)]
    spark.createDataFrame([(m,) for m in messages], "value string").write.text(f"{folder}/in")
    paths = [f"{folder}/{name}" for name in ("in", "curated", "scored")]
    jobs.main(["pipeline", *paths, "--format", "text", "--table-format", "orc"], spark)
    assert spark.read.orc(paths[1]).count() == 12
    assert spark.read.orc(paths[2]).filter("inference_timestamp IS NOT NULL").count() == 12


def test_merge_and_feed(spark, folder):
    schema = "transaction_id string, account_id string, amount double, currency string"
    seed = [("T001", "A1", 100.0, "USD"), ("T002", "A2", 200.0, "EUR"), ("T003", "A3", 50.0, "GBP")]
    new = [("T002", "XX", 250.0, "GBP"), ("T004", "A4", 75.0, "USD"), ("T005", "A5", 1200.5, "JPY")]
    spark.createDataFrame(seed, schema).write.parquet(f"{folder}/seed")
    spark.createDataFrame(new, schema).write.parquet(f"{folder}/new")
    table = f"{folder}/table"
    after = f"{folder}/after"
    merge = ["merge", table, f"{folder}/new", "--key", "transaction_id", "--seed", f"{folder}/seed"]
    with pytest.raises(ValueError, match="--output"):
        jobs.main(merge, spark)
    jobs.main([*merge, "--output", after, "--update", "amount", "--update", "currency"], spark)
    rows = {r.transaction_id: r for r in spark.read.parquet(after).collect()}
    assert len(rows) == 5
    assert (rows["T002"].account_id, rows["T002"].amount, rows["T002"].currency) == ("A2", 250.0, "GBP")
    assert rows["T002"].updated_at > rows["T002"].created_at
    assert rows["T004"].updated_at == rows["T004"].created_at
    jobs.main(["feed", table, after, f"{folder}/feed", "--key", "transaction_id"], spark)
    kinds = spark.read.parquet(f"{folder}/feed").groupBy("_change_type").count()
    assert sorted(map(tuple, kinds.collect())) == [
        ("insert", 2),
        ("update_postimage", 1),
        ("update_preimage", 1),
    ]


def test_documents(spark, folder, capsys):
    docs = spark.range(2).select("id", F.array(F.lit(1)).alias("tags"))
    docs.write.json(f"{folder}/docs")
    jobs.main(["documents", f"{folder}/docs", "misc", f"{folder}/flat"], spark)
    flat = spark.read.parquet(f"{folder}/flat")
    assert flat.columns[-1] == "processing_timestamp" and flat.count() == 2
    spark.createDataFrame([], "value string").write.text(f"{folder}/none")
    jobs.main(["documents", f"{folder}/none", "misc", f"{folder}/out", "--format", "text"], spark)
    assert "no documents" in capsys.readouterr().out
    assert not tables.table_exists(spark, f"{folder}/out")


def test_work_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(f"{base}/sparkpipe/x-") and first != second


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.sparkContext.appName == "tests"
