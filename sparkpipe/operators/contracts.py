"""Record contracts: reasons for rejection, and the route that follows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sparkpipe.functions.once import evaluated
from sparkpipe.functions.scalars import typed
from sparkpipe.operators.decode import decode_text
from sparkpipe.schemas import Field, fields_of


def present(field: Field, given: Column) -> Column:
    """Whether the field is there; a JSON null counts as absent."""
    if field.type != "string":
        return given.isNotNull()
    return given.isNotNull() & ~F.is_variant_null(given)


def text_of(field: Field, given: Column) -> Column:
    """The field as text; of a text field only what is text in the JSON."""
    if field.type != "string":
        return given
    is_text = F.schema_of_variant(given) == "STRING"
    return F.when(is_text, F.variant_get(given, "$", "string"))


def reason(field: Field, there: Column, text: Column, value: Column) -> Column:
    """The first rule the field breaks, as ``name:rule``, or NULL."""
    broken = F.lit(None).cast("string")
    if field.max_length is not None:
        broken = F.when(
            F.char_length(text) > field.max_length, F.lit(f"{field.name}:max_length")
        ).otherwise(broken)
    if field.gt is not None:
        broken = F.when(~(value > field.gt), F.lit(f"{field.name}:gt")).otherwise(broken)
    broken = F.when(there & value.isNull(), F.lit(f"{field.name}:type")).otherwise(broken)
    if field.required:
        broken = F.when(~there, F.lit(f"{field.name}:required")).otherwise(broken)
    return broken


def check(df: DataFrame, domain: str, value: str = "value") -> DataFrame:
    """Add the typed ``record``, its ``reasons`` and its ``route``.

    There is one reason per failing field. ``malformed``: nothing of the record
    but perhaps its time is there. ``dlq``: some rule fails. ``curated``: the
    record meets its contract.
    """
    fields = fields_of(domain)
    given = {f: F.col(f"fields.{f.name}") for f in fields}
    parsed = evaluated(
        decode_text(df, domain, value),
        "record",
        F.struct(*[typed(text_of(f, g), f.type).alias(f.name) for f, g in given.items()]),
    )
    absent = reduce(
        lambda a, b: a & b,
        [
            ~present(f, g)
            for f, g in given.items()
            if f.required and f.name != "timestamp"
        ],
    )
    broken = [
        reason(f, present(f, g), text_of(f, g), F.col(f"record.{f.name}"))
        for f, g in given.items()
    ]
    reasons = F.array_except(F.array(*broken), F.array(F.lit(None).cast("string")))
    return (
        parsed.withColumn("reasons", reasons)
        .withColumn(
            "route",
            F.when(absent, "malformed").when(F.size("reasons") > 0, "dlq").otherwise("curated"),
        )
        .drop("fields")
    )


def typed_records(checked: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The record's fields as typed columns, from a checked frame."""
    return checked.select(*keep, "record.*")


def route_counts(checked: DataFrame) -> DataFrame:
    return checked.groupBy("route").agg(F.count("*").alias("records"))
