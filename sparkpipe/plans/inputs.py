"""The pipeline's inputs, derived row by row from the given tables.

No derivation groups or joins, so each scales as a plain scan does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkpipe.functions.scalars import JSON_TIME
from sparkpipe.sources.tables import instants, read_table

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def _currency(key: Column) -> Column:
    return F.element_at(F.array(F.lit("USD"), F.lit("EUR"), F.lit("GBP")), (key % 3 + 1).cast("int"))


def transactions(events: DataFrame) -> DataFrame:
    """Uncleansed transactions: missing and zero amounts, padded lower-case codes.

    Some come twice, some without a merchant, some with one nobody knows.
    """
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    merchant = F.when(F.col("event_id") % 11 == 0, None).when(
        F.col("event_id") % 13 == 0, F.concat(F.lit("M"), user)
    )
    times = F.when(F.col("event_id") % 17 == 0, 2).otherwise(1)
    twice = events.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times)))
    return twice.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("account_id"),
        F.when(kind == "error", None).when(kind == "view", 0.0).otherwise(F.col("value")).alias("amount"),
        F.concat(F.lit(" "), F.lower(_currency(F.col("event_id"))), F.lit(" ")).alias("currency"),
        kind.alias("transaction_type"),
        merchant.otherwise(user).alias("merchant_id"),
        F.when(F.col("event_id") % 4 != 0, kind).alias("category"),
    )


def merchants(customer: DataFrame) -> DataFrame:
    """Every customer as a merchant."""
    return customer.select(
        F.col("c_custkey").cast("string").alias("merchant_id"),
        F.col("c_mktsegment").alias("category"),
    )


#: A stamp that a record may already carry.
STAMPED_BEFORE = '"processed_timestamp": "2020-01-01T00:00:00.000000Z"'


def payloads(events: DataFrame) -> DataFrame:
    """JSON messages, some of them broken or odd in a way that ``event_id`` decides."""
    events = instants(events)
    fault = F.col("event_id") % 50
    amount = (
        F.when(fault == 1, '"not-a-number"')
        .when(fault == 4, "-1")
        .when(fault == 6, F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"')))
        .otherwise(F.col("value").cast("string"))
    )
    time = F.date_format("ts", JSON_TIME)
    record = F.concat(
        F.lit("{"),
        F.when(fault == 2, "").otherwise(
            F.concat(F.lit('"transaction_id": "'), F.col("event_id").cast("string"), F.lit('", '))
        ),
        F.lit('"timestamp": "'),
        F.when(fault == 11, F.concat(F.substring(time, 1, 26), F.lit("789Z"))).otherwise(time),
        F.lit('", "account_id": '),
        F.when(fault == 7, "5")
        .when(fault == 8, "true")
        .when(fault == 9, '{"x":1}')
        .otherwise(F.concat(F.lit('"'), F.col("user_id").cast("string"), F.lit('"'))),
        F.when(fault == 12, f', "category": "gift", "is_flagged": true, {STAMPED_BEFORE}').otherwise(""),
        F.lit(', "amount": '),
        amount,
        F.lit(', "currency": "'),
        F.when(fault == 5, "USDX").otherwise(_currency(F.col("event_id"))),
        F.lit('", "transaction_type": "'),
        F.col("event_type"),
        F.lit('", "merchant_id": "'),
        F.col("user_id").cast("string"),
        F.lit('"}'),
    )
    malformed = F.concat(
        F.lit('{"bad_field": "not a real transaction", "timestamp": "'), time, F.lit('"}')
    )
    return events.select(
        "event_id",
        F.when(fault == 0, "not json")
        .when(fault == 3, malformed)
        .when(fault == 10, F.replace(record, F.lit('"'), F.lit("'")))
        .otherwise(record)
        .alias("value"),
    )


def requests(events: DataFrame) -> DataFrame:
    """The events' JSON properties as text bodies of request envelopes."""
    return events.select("event_id", F.to_json(F.struct(F.col("props").alias("body"))).alias("value"))


def claim_payloads(orders: DataFrame) -> DataFrame:
    """Claims, some with an amount that is missing, negative or no number, some with a
    number for text, some no JSON."""
    fault = F.col("o_orderkey") % 20
    time = F.date_format(F.col("o_orderdate").cast("timestamp"), JSON_TIME)
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("claim_id"),
        time.alias("timestamp"),
        F.col("o_custkey").cast("string").alias("policy_number"),
        F.when(fault == 1, -F.col("o_totalprice"))
        .when(fault != 0, F.col("o_totalprice"))
        .alias("claim_amount"),
        F.col("o_orderpriority").alias("claim_type"),
        F.col("o_orderstatus").alias("claim_status"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        time.alias("incident_date"),
    )
    no_number = record.withField("claim_amount", F.lit("much"))
    no_text = record.withField("policy_number", F.col("o_custkey"))
    value = (
        F.when(fault == 2, F.to_json(no_number))
        .when(fault == 3, "not json")
        .when(fault == 4, F.to_json(no_text))
        .otherwise(F.to_json(record))
    )
    return orders.select("o_orderkey", value.alias("value"))


def sports_payloads(events: DataFrame) -> DataFrame:
    """Results, some without a status, with text for a score, a number for a team, or
    no JSON."""
    odd, fault = F.col("event_id") % 2 == 1, F.col("event_id") % 30
    user = F.col("user_id")
    record = F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format(F.col("ts").cast("timestamp"), JSON_TIME).alias("timestamp"),
        F.col("event_type").alias("sport"),
        F.concat(F.lit("Team "), user.cast("string")).alias("team_a"),
        F.concat(F.lit("Team "), (user + 1).cast("string")).alias("team_b"),
        F.when(~odd, (user % 7).cast("int")).alias("score_a"),
        F.when(~odd, (user % 5).cast("int")).alias("score_b"),
        F.when(fault != 0, "finished").alias("status"),
    )
    value = (
        F.when(fault == 1, F.to_json(record.withField("score_a", F.lit("two"))))
        .when(fault == 2, "not json")
        .when(fault == 3, F.to_json(record.withField("team_a", user)))
        .otherwise(F.to_json(record))
    )
    return events.select("event_id", value.alias("value"))


def claim_documents(lineitem: DataFrame) -> DataFrame:
    """One document per line; its damages are 0 to 3 items, or a missing array."""

    def item(name: str, amount: Column, present: Column) -> Column:
        return F.when(present, F.struct(F.lit(name).alias("part"), amount.alias("amount")))

    price = F.col("l_extendedprice")
    damages = F.array_compact(
        F.array(
            item("body", price, F.col("l_quantity") > 10),
            item("glass", price * F.col("l_discount"), F.col("l_discount") > 0),
            item("paint", price * F.col("l_tax"), F.col("l_tax") > 0),
        )
    )
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("claim_id"),
        F.col("l_partkey").cast("string").alias("policy_id"),
        F.col("l_shipdate").alias("claim_date"),
        F.col("l_linestatus").alias("status"),
        F.struct(
            F.col("l_returnflag").alias("type"),
            F.col("l_shipdate").alias("incident_date"),
            F.col("l_suppkey").cast("string").alias("vehicle_vin"),
            F.when(F.col("l_quantity") > 1, damages).alias("damages"),
        ).alias("details"),
    )


def profile_documents(customer: DataFrame) -> DataFrame:
    """One document per customer, with none, one or two addresses."""

    def address(kind: str, present: Column) -> Column:
        parts = F.struct(
            F.concat(F.col("c_custkey").cast("string"), F.lit(" Main St")).alias("street"),
            F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("city"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("zip"),
            F.lit(kind).alias("type"),
        )
        return F.when(present, parts)

    return customer.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.struct(
            F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"),
            F.concat(F.lit("555-"), F.col("c_custkey").cast("string")).alias("phone"),
        ).alias("contact"),
        F.array_compact(
            F.array(
                address("home", F.col("c_acctbal") >= 0),
                address("billing", F.col("c_acctbal") > 5000),
            )
        ).alias("addresses"),
    )


def event_documents(events: DataFrame) -> DataFrame:
    """Documents without the optional ``attempts`` field."""
    return events.select(
        "event_id",
        F.col("event_type").alias("type"),
        "user_id",
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")).alias("ip_address"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("reason"),
    )


def order_updates(orders: DataFrame) -> DataFrame:
    """Pending orders at a higher price and as low priority, and urgent ones again
    under new keys."""
    pending = orders.filter(F.col("o_orderstatus") == "P").withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1, "o_orderpriority": F.lit("5-LOW")}
    )
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT").withColumn(
        "o_orderkey", F.col("o_orderkey") + 1_000_000_000
    )
    return pending.unionByName(urgent)


def notifications(pages: DataFrame) -> DataFrame:
    """Object-store events of two records: a page's text, and its parquet copy.

    Some notifications cannot be read and some hold no records.
    """

    def entry(event: str, bucket: str, key: Column) -> Column:
        return F.struct(
            F.lit(event).alias("eventName"),
            F.struct(
                F.struct(F.lit(bucket).alias("name")).alias("bucket"),
                F.struct(
                    key.alias("key"),
                    F.md5("html").alias("eTag"),
                    F.length("html").cast("bigint").alias("size"),
                ).alias("object"),
            ).alias("s3"),
        )

    copied = F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".parquet"))
    event = F.struct(
        F.array(
            entry("s3:ObjectCreated:Put", "raw-zone", F.col("url")),
            entry("s3:ObjectCreated:Copy", "curated-zone", copied),
        ).alias("Records")
    )
    value = (
        F.when(F.col("page_id") % 40 == 0, "no notification")
        .when(F.col("page_id") % 40 == 1, '{"Records": []}')
        .otherwise(F.to_json(event))
    )
    return pages.select(value.alias("value"))


def later_events(events: DataFrame) -> DataFrame:
    """The events some time later: some gone, some of another value or type, some new.

    The largest values are among those that go.
    """
    number = F.col("event_id")
    stays = (number % 7 != 0) & (F.col("value") < 200)
    kept = events.filter(F.coalesce(stays, F.lit(True))).withColumns(
        {
            "value": F.when(number % 5 == 0, F.col("value") / 2).otherwise(F.col("value")),
            "event_type": F.when(number % 9 == 0, "view").otherwise(F.col("event_type")),
        }
    )
    new = events.filter(number % 6 == 0).withColumn("event_id", number + 1_000_000_000)
    return kept.unionByName(new)


def customer_moves(customer: DataFrame) -> DataFrame:
    """Some customers in another country: of a higher balance, or of a lower one."""
    moved = customer.withColumn("c_nationkey", (F.col("c_nationkey") + 1) % 25)
    higher = F.when(F.col("c_custkey") % 3 == 0, 1).when(F.col("c_custkey") % 3 == 1, -1)
    return moved.withColumn("c_acctbal", F.col("c_acctbal") + higher).filter(higher.isNotNull())


def _days(at: Column, number: Column) -> Column:
    return at.cast("timestamp") + F.make_dt_interval(number)


def order_history(orders: DataFrame) -> DataFrame:
    """Every order as a row that holds from its date on; returned ones for 90 days."""
    placed = F.col("o_orderdate").cast("timestamp")
    until = F.when(F.col("o_orderstatus") == "F", _days(placed, F.lit(90)))
    return orders.select(
        "o_orderkey", "o_orderstatus", "o_totalprice", placed.alias("valid_from"), until.alias("valid_to")
    )


def order_changes(orders: DataFrame) -> DataFrame:
    """Dated changes of orders: new prices, of which some come late and date from before
    the order, some that change nothing, two at one time, and orders that are gone."""
    number = F.col("o_orderkey")
    some = orders.filter(number % 4 != 3)
    price = F.when(number % 4 != 2, F.col("o_totalprice") + F.col("n")).otherwise(F.col("o_totalprice"))
    days = (number % 60 - 20 + F.when(number % 12 == 0, 0).otherwise(F.col("n") * 50)).cast("int")
    return some.select("*", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("n")).select(
        "o_orderkey",
        "o_orderstatus",
        price.alias("o_totalprice"),
        _days(F.col("o_orderdate"), days).alias("changed_at"),
        ((number % 5 == 0) & (F.col("n") == 2)).alias("is_gone"),
    )


def category_history(customer: DataFrame) -> DataFrame:
    """Three categories per merchant, one after the other; those of some end before."""
    number, n = F.col("c_custkey"), F.col("n")
    begin = F.lit("2024-01-01").cast("timestamp")
    since = _days(begin, (number % 10 + 10 * n).cast("int"))
    return customer.select("*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("n")).select(
        number.alias("merchant"),
        since.alias("since"),
        F.when(number % 3 == 0, _days(since, F.lit(6))).alias("until"),
        F.concat_ws("-", "c_mktsegment", "n").alias("category"),
    )


def timed_facts(events: DataFrame) -> DataFrame:
    """Events by merchant; a third are of one merchant, and some of none or no time."""
    number = F.col("event_id")
    merchant = F.when(number % 3 == 0, 7).when(number % 11 != 0, F.col("user_id"))
    return events.select(
        "event_id",
        merchant.cast("bigint").alias("merchant"),
        F.when(number % 13 != 0, F.col("ts").cast("timestamp")).alias("ts"),
        "value",
    )
