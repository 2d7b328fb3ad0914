import random

import pytest
from pyspark.sql import functions as F

from sparkpipe.operators import quality, score, sketches
from sparkpipe.streaming import ingest

SCHEMA = "id long, name string, price double, when timestamp, tags array<string>"


def table(spark, n, seed):
    draw = random.Random(seed)
    rows = [
        (draw.randrange(5000), draw.choice([None, "x", "y"]), draw.choice([None, float("nan"), draw.gauss(0, 1)]), None, ["t"])
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def profile(df):
    return {r.column_name: r.asDict() for r in df.collect()}


def test_merged_sketches_are_those_of_one_pass(spark):
    parts = [table(spark, 3000, seed) for seed in range(3)]
    whole = parts[0].union(parts[1]).union(parts[2])
    together = profile(sketches.sketched_profile(sketches.merged([sketches.column_sketches(p) for p in parts])))
    once = profile(sketches.sketched_profile(sketches.column_sketches(whole)))
    for name, row in once.items():
        found = together[name]
        for exact in ("position", "column_type", "total", "nulls", "low", "high"):
            assert found[exact] == row[exact]
        assert (found["approx_distinct"] or 0) == pytest.approx(row["approx_distinct"] or 0, rel=0.02)
    distinct = whole.select(F.count_distinct("id")).first()[0]
    assert abs(together["id"]["approx_distinct"] - distinct) < 0.05 * distinct
    ids = sorted(r.id for r in whole.collect())
    for q, value in zip(sketches.QUANTILES, together["id"]["approx_quantiles"]):
        rank = sum(i <= value for i in ids) / len(ids)
        assert abs(rank - q) < 0.02


def test_odd_columns(spark):
    found = profile(sketches.sketched_profile(sketches.column_sketches(table(spark, 200, 1))))
    assert found["tags"]["approx_distinct"] is None and found["tags"]["nulls"] == 0
    assert found["when"]["approx_distinct"] == 0 and found["when"]["nulls"] == 200
    assert found["name"]["low"] is None and found["name"]["approx_quantiles"] is None
    empty = profile(sketches.sketched_profile(sketches.column_sketches(table(spark, 1, 1).limit(0))))
    assert empty["id"]["total"] == 0 and empty["id"]["approx_quantiles"] is None
    again = sketches.merged([sketches.column_sketches(table(spark, 1, 1).limit(0))] * 2)
    assert profile(sketches.sketched_profile(again)) == empty


def test_a_later_column_is_null_before(spark):
    old = spark.createDataFrame([(1,), (2,)], "id long")
    new = spark.createDataFrame([(3, "a")], "id long, name string")
    found = profile(sketches.merged([sketches.column_sketches(old), sketches.column_sketches(new)]))
    assert (found["name"]["total"], found["name"]["nulls"]) == (3, 2)
    assert (found["id"]["total"], found["id"]["nulls"]) == (3, 0)


def rules():
    return {"id_present": F.col("id").isNotNull(), "price_positive": F.col("price") > 0}


def test_rules_are_counted_by_the_write(spark, folder):
    df = spark.createDataFrame([(1, 2.0), (None, -1.0), (3, None)], "id long, price double").repartition(3)
    seen_rows, seen = quality.observed(df, rules())
    seen_rows.write.parquet(f"{folder}/out")
    with pytest.raises(quality.QualityError, match=r"id_present \(1 of 3\); price_positive \(2 of 3\)"):
        quality.gate_observed(seen, rules())
    assert spark.read.parquet(f"{folder}/out").count() == 3


def test_no_rows_break_no_rule(spark, folder):
    df = spark.createDataFrame([], "id long, price double")
    rows, seen = quality.observed(df, rules())
    rows.write.parquet(f"{folder}/out")
    assert quality.gate_observed(seen, rules()) == {"id_present": 0, "price_positive": 0}


def test_a_batch_that_breaks_a_rule_fails_its_query(spark, folder):
    schema = "id long, price double"

    def arrive(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        ingest.run_available(
            ingest.gated_stream(stream, f"{folder}/out", f"{folder}/check", rules(), None)
        )

    arrive((1, 2.0))
    run()
    arrive((2, -2.0))
    for _ in range(2):  # not committed, so it comes again
        with pytest.raises(Exception, match="price_positive"):
            run()
    kept = ingest.batches_after(spark, f"{folder}/out")
    assert [(r.id, r.batch) for r in kept.collect()] == [(1, 0)]


def test_every_label_is_in_a_stratified_subset(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 1000 == 0, "rare").when(F.col("id") > 9, "often").alias("label"))
    subset = score.stratified_subset(df, "id", "label", 4)
    found = {r.label: r["count"] for r in subset.groupBy("label").count().collect()}
    assert found == {"rare": 4, "often": 4, None: 4}
    often = [r.id for r in subset.filter("label = 'often'").orderBy(F.md5(F.col("id").cast("string"))).collect()]
    alone = score.training_subset(df.filter("label = 'often'"), "id", 4)
    assert often == [r.id for r in alone.collect()]
    plan = subset._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")
