"""JSON records: stamping, publishing, and object-store notifications."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkpipe.functions.once import evaluated
from sparkpipe.functions.scalars import JSON_TIME
from sparkpipe.operators.decode import STRICT
from sparkpipe.schemas import TOPIC_NOUNS

# Layout of an object-store notification.
OBJECT_EVENT = """
    Records array<struct<
        eventName: string,
        s3: struct<
            bucket: struct<name: string>,
            object: struct<key: string, eTag: string, size: bigint>>>>
"""


# Fixed value: the field a stamped record carries.
STAMP = "processed_timestamp"


def request_body(df: DataFrame, value: str) -> DataFrame:
    """Replace a request envelope by its ``body`` where that is text.

    Any other record, also one whose ``body`` is an object, stays as it is.
    """
    body = F.from_json(F.col(value), "body variant")["body"]
    inner = F.when(F.schema_of_variant(body) == "STRING", F.variant_get(body, "$", "string"))
    return df.withColumn(value, F.coalesce(inner, F.col(value)))


# A string, a bracket, comma or colon, or anything else without blanks.
TOKEN = r'"(?:[^"\\]|\\.)*"|[{}\[\],:]|[^\s{}\[\],:"]+'
FIRST_STRING = r'^"(?:[^"\\]|\\.)*"'


def _members(text: Column) -> Column:
    """The members of a JSON object as they are written, but without blanks."""
    start = F.struct(
        F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("depth")
    )

    def read(state: Column, token: Column) -> Column:
        depth, held = state["depth"], state["open"]
        opens, closes = token.isin("{", "["), token.isin("}", "]")
        ends = ((depth == 1) & (closes | (token == ","))) & (held != "")
        return F.struct(
            F.when(ends, F.concat(state["done"], F.array(held))).otherwise(state["done"]).alias("done"),
            F.when(ends | (depth == 0), "").otherwise(F.concat(held, token)).alias("open"),
            (depth + opens.cast("int") - closes.cast("int")).alias("depth"),
        )

    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return F.aggregate(tokens, start, read, lambda state: state["done"])


def _without_stamp(text: Column) -> Column:
    """The members of an object but the old stamp; numbers and strings keep their text."""

    def other(member: Column) -> Column:
        key = F.concat(F.lit("["), F.regexp_extract(member, FIRST_STRING, 0), F.lit("]"))
        return F.get(F.from_json(key, "array<string>"), F.lit(0)) != STAMP

    return F.filter(_members(text), other)


def stamp_json(df: DataFrame, value: str, as_of: Column) -> DataFrame:
    """Add ``stamped`` and ``status_code`` to JSON text records.

    An object in strict JSON gets a ``processed_timestamp`` and 200, anything else
    400. A field of that name already there is replaced; only such a record is written
    anew, without blanks, its numbers as they were. All others keep their text.
    """
    text = F.trim(F.col(value))
    items = F.concat(F.lit("["), text, F.lit("]"))
    strict = F.from_json(items, "array<map<string,string>>", STRICT)
    read = evaluated(df, "_members", F.when(F.size(strict) == 1, F.get(strict, F.lit(0))))
    members = F.col("_members")
    time = F.date_format(as_of, JSON_TIME)
    stamp = F.concat(F.lit(f'"{STAMP}":"'), time, F.lit('"'))
    kept = F.concat(_without_stamp(text), F.array(stamp))
    anew = F.concat(F.lit("{"), F.array_join(kept, ","), F.lit("}"))
    added = F.concat(
        F.regexp_replace(text, r"\s*\}\s*$", ""),
        F.when(F.size(members) > 0, ", ").otherwise(""),
        F.lit(f'"{STAMP}": "'),
        time,
        F.lit('"}'),
    )
    stamped = F.when(F.map_contains_key(members, STAMP), anew).otherwise(added)
    return read.select(
        *df.columns,
        F.when(members.isNotNull(), stamped).alias("stamped"),
        F.when(members.isNotNull(), 200).otherwise(400).alias("status_code"),
    )


def to_messages(
    df: DataFrame, key: str, columns: Sequence[str] | None = None, topic: Column | None = None
) -> DataFrame:
    """Rows as ``key`` and JSON ``value``; a ``topic`` column routes each row.

    One write can so feed every topic of a domain.
    """
    value = F.to_json(F.struct(*(columns or df.columns)), {"timestampFormat": JSON_TIME})
    out = [F.col(key).cast("string").alias("key"), value.alias("value")]
    return df.select(*out, *([topic.alias("topic")] if topic is not None else []))


def topic_of(route: Column, domain: str) -> Column:
    """The topic of a route, by the naming all domains share."""
    return F.concat(route, F.lit(f"_{domain}_{TOPIC_NOUNS[domain]}"))


def publish_messages(messages: DataFrame, fmt: str = "kafka", **options: str) -> None:
    messages.write.format(fmt).options(**options).save()


def object_events(df: DataFrame, value: str = "value") -> DataFrame:
    """One row per record of each notification, not only the first record.

    A notification that is no JSON, or has no records, stays as one row with a
    ``reason`` and nothing else; all other rows have none.
    """
    event = F.from_json(F.col(value).cast("string"), OBJECT_EVENT, STRICT)
    read = evaluated(df.select(value), "event", event).select(
        F.explode_outer("event.Records").alias("r"), F.col(value).alias("_value")
    )
    members = F.from_json("_value", "map<string,variant>", STRICT)
    why = F.when(members.isNull(), F.lit("unreadable")).otherwise(F.lit("no records"))
    return read.select(
        F.when(F.col("r").isNotNull(), F.coalesce("r.eventName", F.lit("N/A"))).alias("event_name"),
        F.col("r.s3.bucket.name").alias("bucket"),
        F.col("r.s3.object.key").alias("object_key"),
        F.col("r.s3.object.eTag").alias("etag"),
        F.col("r.s3.object.size").alias("size"),
        F.when(F.col("r").isNull(), why).alias("reason"),
    )
