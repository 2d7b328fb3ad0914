"""Every registered query: a callable of (session, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkpipe.operators import (
    contracts,
    curate,
    decode,
    flatten,
    history,
    merge,
    metrics,
    profile,
    quality,
    records,
    score,
    sketches,
    upkeep,
)
from sparkpipe.plans import flow, inputs
from sparkpipe.session import work_dir
from sparkpipe.sources import documents, streams, tables
from sparkpipe.streaming import ingest

AS_OF = "2024-06-01 00:00:00"
THRESHOLD = 35.0
KEYS = ["o_orderkey"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _transactions(spark, sf):
    return inputs.transactions(inputs.table(spark, sf, "events"))


def _payloads(spark, sf):
    return inputs.payloads(inputs.table(spark, sf, "events"))


def _merchants(spark, sf):
    return inputs.merchants(inputs.table(spark, sf, "customer"))


def _orders(spark, sf):
    return inputs.table(spark, sf, "orders")


def _updates(spark, sf):
    return inputs.order_updates(_orders(spark, sf))


def _curated(spark, sf):
    return curate.curate(_transactions(spark, sf), _merchants(spark, sf))


# Curation


@query
def cleanse_transactions(spark, sf):
    return curate.cleanse(_transactions(spark, sf))


@query
def enrich_category(spark, sf):
    return curate.enrich(_transactions(spark, sf), _merchants(spark, sf))


@query
def enrich_category_salted(spark, sf):
    """The same enrichment the way it goes when the lookup is too large to broadcast."""
    return curate.enrich(_transactions(spark, sf), _merchants(spark, sf), small=False)


@query
def enrich_without_lookup(spark, sf):
    return curate.enrich(_transactions(spark, sf), None)


@query
def curate_transactions(spark, sf):
    return _curated(spark, sf)


# Decoding, contracts, routes


@query
def decode_payload(spark, sf):
    return decode.decode(_payloads(spark, sf), "financial", keep=("event_id",))


@query
def typed_payload(spark, sf):
    checked = contracts.check(_payloads(spark, sf), "financial")
    return contracts.typed_records(checked, keep=("event_id", "route"))


def _verdict(checked: DataFrame, key: str) -> DataFrame:
    return checked.select(key, "route", F.array_join("reasons", ",").alias("reasons"))


@query
def contract_financial(spark, sf):
    return _verdict(contracts.check(_payloads(spark, sf), "financial"), "event_id")


@query
def contract_insurance(spark, sf):
    claims = inputs.claim_payloads(_orders(spark, sf))
    return _verdict(contracts.check(claims, "insurance"), "o_orderkey")


@query
def contract_sports(spark, sf):
    events = inputs.sports_payloads(inputs.table(spark, sf, "events"))
    return _verdict(contracts.check(events, "sports"), "event_id")


@query
def route_counts(spark, sf):
    return contracts.route_counts(contracts.check(_payloads(spark, sf), "financial"))


# Documents


def _damages(flat: DataFrame) -> DataFrame:
    return flat.select(
        *[c for c in flat.columns if c != "damage_item"],
        F.col("damage_item.part").alias("damage_part"),
        F.col("damage_item.amount").alias("damage_amount"),
    )


@query
def flatten_claims(spark, sf):
    claims = inputs.claim_documents(inputs.table(spark, sf, "lineitem"))
    return _damages(flatten.transform_documents(claims, "claims"))


@query
def flatten_claims_outer(spark, sf):
    claims = inputs.claim_documents(inputs.table(spark, sf, "lineitem"))
    return _damages(flatten.transform_documents(claims, "claims", outer=True))


@query
def flatten_profiles(spark, sf):
    profiles = inputs.profile_documents(inputs.table(spark, sf, "customer"))
    return flatten.transform_documents(profiles, "customer_profiles")


@query
def rename_events(spark, sf):
    events = inputs.event_documents(inputs.table(spark, sf, "events"))
    return flatten.transform_documents(events, "financial_events")


@query
def documents_inferred(spark, sf):
    path = work_dir(spark, "profiles")
    profiles = inputs.profile_documents(inputs.table(spark, sf, "customer"))
    documents.write_json_records(profiles, path)
    return flatten.transform_documents(
        documents.read_documents(spark, path), "customer_profiles"
    )


@query
def json_records(spark, sf):
    path = work_dir(spark, "records")
    rows = _transactions(spark, sf)
    documents.write_json_records(rows.withColumn("timestamp", F.date_format("timestamp", inputs.JSON_TIME)), path)
    return documents.read_json_records(spark, path, rows.schema)


# Lookups, limits, filters


@query
def point_lookup(spark, sf):
    return tables.lookup_sql(spark, f"{sf}/orders.parquet", "o_orderkey", 7)


@query
def lookup_exists(spark, sf):
    return tables.exists(_orders(spark, sf), F.col("o_orderkey") == 7)


@query
def topk_recent(spark, sf):
    return metrics.most_recent(inputs.table(spark, sf, "events"), "ts", 5, ["event_id"])


@query
def bounded_subset(spark, sf):
    return score.training_subset(_orders(spark, sf), "o_orderkey")


@query
def stratified_subset(spark, sf):
    return score.stratified_subset(_orders(spark, sf), "o_orderkey", "o_orderstatus")


@query
def filter_suffix(spark, sf):
    pages = inputs.table(spark, sf, "pages")
    return tables.suffix_filter(pages, "url", "#top").select("page_id", "url")


# Merges, change feeds, versions

UPDATE = {"o_totalprice": "o_totalprice", "o_orderpriority": "o_orderpriority"}
INSERT = {c: c for c in ["o_orderkey", "o_custkey", "o_orderstatus", *UPDATE, "o_orderdate"]}


@query
def merge_upsert(spark, sf):
    return merge.merge(_orders(spark, sf), _updates(spark, sf), KEYS, UPDATE, INSERT)


@query
def upsert_full_row(spark, sf):
    return merge.upsert(_orders(spark, sf), _updates(spark, sf), KEYS)


@query
def upsert_last_wins(spark, sf):
    """Line items in duplicate: per key the latest shipped row counts."""
    lines = inputs.table(spark, sf, "lineitem")
    return merge.unique_by_key(lines, ["l_orderkey", "l_linenumber"], order_by=["l_shipdate"])


@query
def merge_feed(spark, sf):
    return merge.merge_feed(_orders(spark, sf), _updates(spark, sf), KEYS, UPDATE, INSERT)


@query
def change_feed(spark, sf):
    """Between the orders not pending and all orders with their updates."""
    orders = _orders(spark, sf)
    before = orders.filter(F.col("o_orderpriority") != "5-LOW")
    after = merge.upsert(orders, _updates(spark, sf), KEYS).filter(F.col("o_orderstatus") != "F")
    return merge.change_feed(before, after, KEYS)


@query
def apply_feed(spark, sf):
    orders = _orders(spark, sf)
    update, insert = merge.full_row(orders.columns, KEYS)
    feed = merge.merge_feed(orders, _updates(spark, sf), KEYS, update, insert)
    return merge.apply_feed(orders, feed, KEYS)


@query
def merge_audited(spark, sf):
    """A merge that also sets audit times: of creation once, of the last change always."""
    long_ago, now = (F.lit(t).cast("timestamp") for t in ("2020-01-01 00:00:00", AS_OF))
    times = {"created_at": long_ago, "updated_at": long_ago}
    target = _orders(spark, sf).withColumns(times)
    source = _updates(spark, sf).withColumn("at", now)
    update = UPDATE | {"updated_at": "at"}
    insert = INSERT | {"created_at": "at", "updated_at": "at"}
    return merge.merge(target, source, KEYS, update, insert)


@query
def merge_upsert_large(spark, sf):
    """The same merge the way it goes when the source is too large to broadcast."""
    return merge.merge(_orders(spark, sf), _updates(spark, sf), KEYS, UPDATE, INSERT, small=False)


@query
def merge_feed_large(spark, sf):
    return merge.merge_feed(
        _orders(spark, sf), _updates(spark, sf), KEYS, UPDATE, INSERT, small=False
    )


@query
def merge_bucketed(spark, sf):
    """Two merges in a row into a table that keeps its buckets."""
    first = tables.write_bucketed(_orders(spark, sf), work_dir(spark, "bucketed"), KEYS, 8)
    updates = _updates(spark, sf)
    for half in (F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 2 != 0):
        folder = work_dir(spark, "bucketed-merged")
        first = merge.merge_bucketed(first, updates.where(half), folder, UPDATE, INSERT)
    return first.rows(spark)


def _written_states(spark, sf) -> tuple[DataFrame, DataFrame]:
    """A table created once, and the state a merge writes beside it."""
    first, second = work_dir(spark, "orders"), work_dir(spark, "orders-merged")
    tables.create_if_absent(_orders(spark, sf), first)
    before = tables.read_table(spark, first)
    merged = merge.merge(before, _updates(spark, sf), KEYS, UPDATE, INSERT)
    return before, tables.write_table(merged, second)


@query
def read_latest_version(spark, sf):
    return _written_states(spark, sf)[1]


@query
def version_change_feed(spark, sf):
    """The rows of the first state as inserts, then the changes to the second."""
    return merge.feed_of_states(_written_states(spark, sf), KEYS)


def _states(spark, sf) -> list[DataFrame]:
    """Four states of the orders: without the urgent ones, with their updates, without
    the finished ones, and as they were again."""
    orders = _orders(spark, sf)
    first = orders.filter(F.col("o_orderpriority") != "1-URGENT")
    second = merge.upsert(orders, _updates(spark, sf), KEYS)
    return [first, second, second.filter(F.col("o_orderstatus") != "F"), orders]


@query
def feed_of_states(spark, sf):
    return merge.feed_of_states(_states(spark, sf), KEYS)


@query
def feed_since_version(spark, sf):
    """The changes of the last two states only."""
    return merge.feed_of_states(_states(spark, sf), KEYS, since=2)


@query
def feed_replayed(spark, sf):
    """The first state after the changes of all others: the last one."""
    states = _states(spark, sf)
    return merge.apply_feed(states[0], merge.feed_of_states(states, KEYS, since=1), KEYS)


@query
def schema_evolution(spark, sf):
    """Rows with a flag appended to a table written without one."""
    path = work_dir(spark, "evolving")
    rows = _transactions(spark, sf)
    tables.append_rows(rows.filter(F.col("transaction_type") != "purchase"), path)
    flagged = rows.filter(F.col("transaction_type") == "purchase")
    tables.append_rows(flagged.withColumn("is_flagged", F.col("amount") > THRESHOLD), path)
    return tables.read_table(spark, path, options={"mergeSchema": "true"})


# History


def _history(spark, sf, small):
    orders = _orders(spark, sf)
    changes = inputs.order_changes(orders)
    return history.merge_history(
        inputs.order_history(orders), changes, KEYS, "changed_at", ["is_gone", "o_totalprice"], F.col("is_gone"), small
    )


@query
def merge_history(spark, sf):
    return _history(spark, sf, None)


@query
def merge_history_large(spark, sf):
    """The same the way it goes when too many keys change to broadcast them."""
    return _history(spark, sf, False)


@query
def enrich_as_of(spark, sf):
    facts = inputs.timed_facts(inputs.table(spark, sf, "events"))
    side = inputs.category_history(inputs.table(spark, sf, "customer"))
    return history.as_of_join(facts, side, ["merchant"], "ts", "since", ["category", "since"], "until")


# Derived tables kept up by a change feed


def _later_events(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The events, what they are later, and the changes in between, written once."""
    events = inputs.table(spark, sf, "events")
    later = inputs.later_events(events)
    feed = merge.change_feed(events, later, ["event_id"])
    return events, later, tables.write_table(feed, work_dir(spark, "feed"))


@query
def upkeep_counters(spark, sf):
    events, _, feed = _later_events(spark, sf)
    attributes = ["event_type", "user_id"]
    return upkeep.maintained_counts(metrics.counters(events, attributes), feed, attributes)


@query
def upkeep_histogram(spark, sf):
    """Sums rounded, as in ``amount_histogram``."""
    events, later, feed = _later_events(spark, sf)
    before = metrics.histogram(events, "value", ["event_type"])
    after = upkeep.maintained_histogram(before, feed, later, "value", ["event_type"])
    return after.withColumn("sum", F.round("sum", 4))


@query
def upkeep_curated(spark, sf):
    events, later, feed = _later_events(spark, sf)
    key = F.col("event_id").cast("string")
    return upkeep.maintained_rows(
        _curated(spark, sf),
        feed.withColumn("transaction_id", key),
        later.withColumn("transaction_id", key),
        ["transaction_id"],
        lambda rows: curate.curate(inputs.transactions(rows), _merchants(spark, sf)),
    )


# Quality, metrics, profile


@query
def row_count(spark, sf):
    return quality.row_count(inputs.table(spark, sf, "lineitem"))


@query
def dq_rule_suite(spark, sf):
    return quality.rule_suite(_curated(spark, sf), quality.curated_rules())


@query
def ingest_counters(spark, sf):
    checked = contracts.check(_payloads(spark, sf), "financial").select(
        F.col("record.transaction_type").alias("transaction_type"),
        F.col("record.currency").alias("currency"),
        metrics.ingest_status(F.col("route")).alias("status"),
    )
    return metrics.counters(checked, ["transaction_type", "currency", "status"])


@query
def claim_counters(spark, sf):
    claims = inputs.claim_payloads(_orders(spark, sf))
    checked = contracts.check(claims, "insurance").select(
        F.col("record.claim_type").alias("claim_type"),
        F.col("record.claim_status").alias("claim_status"),
        metrics.ingest_status(F.col("route")).alias("status"),
    )
    return metrics.counters(checked, ["claim_type", "claim_status", "status"])


@query
def amount_histogram(spark, sf):
    """Sums rounded, as their last digits depend on the order of tasks."""
    found = metrics.histogram(_transactions(spark, sf), "amount", ["transaction_type", "currency"])
    return found.withColumn("sum", F.round("sum", 4))


@query
def profile_table(spark, sf):
    return profile.profile(_orders(spark, sf), distinct=False)


@query
def merged_profile(spark, sf):
    """Sketches of two loads, written apart and merged; exact columns, and whether the
    estimates are within five in a hundred of what one scan counts."""
    orders = _orders(spark, sf)
    newer = F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp")
    loads = [
        tables.write_table(sketches.column_sketches(part), work_dir(spark, "sketches"))
        for part in (orders.filter(~newer), orders.filter(newer))
    ]
    found = sketches.sketched_profile(sketches.merged(loads))
    exact = orders.agg(
        *[F.count_distinct(c).alias(f"n_{c}") for c in orders.columns],
        F.percentile_approx("o_totalprice", 0.55, 100_000).alias("above"),
        F.percentile_approx("o_totalprice", 0.45, 100_000).alias("below"),
    )
    n = reduce(lambda a, c: F.when(F.col("column_name") == c, F.col(f"n_{c}")).otherwise(a), orders.columns, F.lit(None))
    median = F.get("approx_quantiles", F.lit(1))
    priced = F.col("column_name") == "o_totalprice"
    return found.crossJoin(F.broadcast(exact)).select(
        *sketches.ORDER, "total", "nulls", "low", "high",
        (F.abs(F.col("approx_distinct") - n) <= 0.05 * n).alias("distinct_close"),
        F.when(priced, median.between(F.col("below"), F.col("above"))).alias("median_close"),
    )


@query
def catalog_tables(spark, sf):
    named = {name: inputs.table(spark, sf, name) for name in inputs.TABLES}
    return profile.catalog(named, distinct=False)


# Records


@query
def stamp_json_status(spark, sf):
    as_of = F.lit(AS_OF).cast("timestamp")
    return records.stamp_json(_payloads(spark, sf), "value", as_of).drop("value")


@query
def stamp_request_bodies(spark, sf):
    requests = inputs.requests(inputs.table(spark, sf, "events"))
    as_of = F.lit(AS_OF).cast("timestamp")
    return records.stamp_json(records.request_body(requests, "value"), "value", as_of)


@query
def publish_json(spark, sf):
    checked = contracts.check(_payloads(spark, sf), "financial")
    typed = contracts.typed_records(checked, keep=("event_id", "route"))
    columns = [c for c in typed.columns if c not in ("event_id", "route")]
    return records.to_messages(
        typed, "event_id", columns, records.topic_of(F.col("route"), "financial")
    )


@query
def object_events(spark, sf):
    return records.object_events(inputs.notifications(inputs.table(spark, sf, "pages")))


@query
def new_parquet_objects(spark, sf):
    events = records.object_events(inputs.notifications(inputs.table(spark, sf, "pages")))
    return tables.suffix_filter(events, "object_key", ".parquet")


# Scoring


@query
def label_rule(spark, sf):
    return score.label(_curated(spark, sf), THRESHOLD).select("transaction_id", "amount", "label")


@query
def score_fallback(spark, sf):
    return score.score(score.features(_curated(spark, sf), THRESHOLD), None)


WEIGHTS = (-2.0, {"amount": 0.05, "label": 0.5})


def _rounded(scored: DataFrame) -> DataFrame:
    return scored.withColumn("fraud_probability", F.round("fraud_probability", 9))


@query
def score_transactions(spark, sf):
    """With given coefficients; fitting them is iterative and tested apart."""
    featured = score.features(_curated(spark, sf), THRESHOLD)
    return _rounded(score.score_linear(featured, *WEIGHTS))


@query
def label_features(spark, sf):
    featured = score.features(_curated(spark, sf), THRESHOLD)
    return featured.select("transaction_id", "label", F.round("feature_1", 9).alias("feature_1"))


def _fit_inputs(spark, sf) -> DataFrame:
    featured = score.features(_curated(spark, sf), THRESHOLD)
    return featured.withColumn("amount_share", F.col("amount") / 100)


FIT = ("amount_share", "feature_1")


@query
def fit_weights(spark, sf):
    """The weights of the label's model, by eight Newton steps over all rows."""
    fitted = score.fit_newton(_fit_inputs(spark, sf), FIT, rounds=8, penalty=0.01)
    if fitted is None:
        return spark.createDataFrame([], "term string, weight double")
    rows = [("intercept", fitted[0]), *fitted[1].items()]
    return spark.createDataFrame([(t, round(w, 6)) for t, w in rows], "term string, weight double")


# From messages to curated and scored rows


@query
def messages_to_curated(spark, sf):
    return flow.messages_to_curated(_payloads(spark, sf), _merchants(spark, sf))


@query
def messages_to_scored(spark, sf):
    path = work_dir(spark, "curated")
    scored = flow.messages_to_scored(
        spark, _payloads(spark, sf), _merchants(spark, sf), path, threshold=THRESHOLD, weights=WEIGHTS
    )
    return _rounded(scored)


# Streams, each over what is there now


def _event_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return tables.instants(streams.file_stream(spark, sf, schema, glob="events.parquet"))


@query
def stream_append(spark, sf):
    out = work_dir(spark, "raw")
    stream = inputs.payloads(_event_stream(spark, sf))
    ingest.run_available(ingest.ingest_raw(stream, "financial", out, f"{out}-checkpoint", None))
    return spark.read.parquet(out).drop("processing_timestamp")


@query
def stream_route(spark, sf):
    out = work_dir(spark, "routed")
    stream = inputs.payloads(_event_stream(spark, sf))
    ingest.run_available(ingest.ingest_routed(stream, "financial", out, f"{out}-checkpoint", None))
    return _verdict(spark.read.parquet(out), "event_id")


@query
def stream_incremental(spark, sf):
    """Two runs on one checkpoint; the second finds nothing new."""
    out = work_dir(spark, "arrivals")
    for _ in range(2):
        rows = inputs.transactions(_event_stream(spark, sf))
        ingest.run_available(ingest.append_stream(rows, out, f"{out}-checkpoint", None))
    return spark.read.parquet(out)


@query
def stream_upsert(spark, sf):
    root = work_dir(spark, "upserted")
    schema = spark.read.parquet(f"{sf}/orders.parquet").schema
    stream = tables.instants(streams.file_stream(spark, sf, schema, glob="orders.parquet"))
    ingest.run_available(
        ingest.upsert_stream(
            inputs.order_updates(stream), root, f"{root}-checkpoint", KEYS, ["o_totalprice"], None
        )
    )
    return ingest.upserted(_orders(spark, sf), root, KEYS)


@query
def stream_gated(spark, sf):
    """Transactions whose batch keeps its rules; they are counted by the write."""
    root = work_dir(spark, "gated")
    rules = {"id_present": F.col("transaction_id").isNotNull(), "not_negative": ~(F.col("amount") < 0)}
    stream = inputs.transactions(_event_stream(spark, sf)).fillna({"amount": 0.0})
    ingest.run_available(ingest.gated_stream(stream, root, f"{root}-checkpoint", rules, None))
    return ingest.batches_after(spark, root).drop("run", "query", "batch")


@query
def stream_change_feed(spark, sf):
    """Customers in two batches: all of them, then newer and older rows of some.

    Each batch is all that is there when the query is started, in any number of files.
    """
    root, arrivals = work_dir(spark, "changes"), work_dir(spark, "customers")
    customers = inputs.table(spark, sf, "customer")
    for rows in (customers, inputs.customer_moves(customers)):
        rows.write.mode("append").parquet(arrivals)
        stream = streams.file_stream(spark, arrivals, customers.schema)
        ingest.run_available(
            ingest.change_stream(stream, root, f"{root}-checkpoint", ["c_custkey"], ["c_acctbal"], None)
        )
    return ingest.batches_after(spark, root).drop("run", "query")


@query
def stream_counters(spark, sf):
    root = work_dir(spark, "counters")
    rows = inputs.transactions(_event_stream(spark, sf))
    attributes = ["transaction_type", "currency"]
    ingest.run_available(
        ingest.counter_stream(rows, attributes, root, f"{root}-checkpoint", None)
    )
    return ingest.latest_totals(spark, root)
