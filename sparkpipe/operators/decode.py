"""JSON payloads to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkpipe.functions.once import evaluated
from sparkpipe.schemas import schema_of, text_schema_of


# Reader options for JSON proper.
STRICT = {"allowSingleQuotes": "false"}


def decode(df: DataFrame, domain: str, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse ``value`` (bytes or text) against the declared schema.

    A field of the wrong type becomes NULL and its row stays, as does a row
    whose payload cannot be parsed at all.
    """
    data = F.from_json(F.col(value).cast("string"), schema_of(domain))
    return df.select(*keep, data.alias("data")).select(*keep, "data.*")


def decode_text(df: DataFrame, domain: str, value: str = "value") -> DataFrame:
    """Add a struct ``fields`` with every field as it came; NULL means absent.

    The payload is read as strict JSON and as the only element of an array, so single
    quotes, or text after the closing brace, make it unparseable.
    """
    schema = f"array<{text_schema_of(domain).simpleString()}>"
    items = F.from_json(F.concat(F.lit("["), F.col(value).cast("string"), F.lit("]")), schema, STRICT)
    fields = F.when(F.size("_items") == 1, F.get("_items", F.lit(0)))
    return evaluated(df, "_items", items).withColumn("fields", fields).drop("_items")
