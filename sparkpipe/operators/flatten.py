"""Nested documents to flat rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T


def optional(df: DataFrame, path: str, kind: str = "string") -> Column:
    """The column at a dotted path, or a typed NULL where the schema lacks it."""
    level: T.DataType = df.schema
    for name in path.split("."):
        if not isinstance(level, T.StructType) or name not in level.names:
            return F.lit(None).cast(kind)
        level = level[name].dataType
    return F.col(path)


@dataclass(frozen=True)
class Shape:
    """How a collection's documents become flat rows.

    ``paths`` go from output name to dotted path. ``items`` names an array that gives
    a row per element, under ``item``, or spread by ``parts`` in turn. ``extra`` are
    fields a document may lack, with their type.
    """

    paths: dict[str, str]
    items: str | None = None
    item: str | None = None
    parts: dict[str, str] = field(default_factory=dict)
    extra: dict[str, tuple[str, str]] = field(default_factory=dict)


# Output names and paths of the three collections.
SHAPES = {
    "claims": Shape(
        paths={
            "claim_id": "claim_id",
            "policy_id": "policy_id",
            "claim_date": "claim_date",
            "status": "status",
            "claim_type": "details.type",
            "incident_date": "details.incident_date",
            "vehicle_vin": "details.vehicle_vin",
        },
        items="details.damages",
        item="damage_item",
    ),
    "customer_profiles": Shape(
        paths={
            "customer_id": "customer_id",
            "name": "name",
            "email": "contact.email",
            "phone": "contact.phone",
        },
        items="addresses",
        parts={
            "address_street": "street",
            "address_city": "city",
            "address_zip": "zip",
            "address_type": "type",
        },
    ),
    "financial_events": Shape(
        paths={
            "event_id": "event_id",
            "type": "type",
            "user_id": "user_id",
            "timestamp": "timestamp",
            "ip_address": "ip_address",
            "status": "status",
        },
        extra={"failure_reason": ("reason", "string"), "login_attempts": ("attempts", "int")},
    ),
}


def flatten(df: DataFrame, shape: Shape, outer: bool = False) -> DataFrame:
    """Flat rows of documents; one without array elements goes, unless ``outer``."""
    columns = [F.col(path).alias(name) for name, path in shape.paths.items()]
    columns += [optional(df, path, kind).alias(name) for name, (path, kind) in shape.extra.items()]
    if shape.items is None:
        return df.select(*columns)
    name = shape.item or "_item"
    element = F.explode_outer(shape.items) if outer else F.explode(shape.items)
    rows = df.select(*columns, element.alias(name))
    parts = [F.col(f"{name}.{path}").alias(out) for out, path in shape.parts.items()]
    return rows.select(*shape.paths, *parts) if parts else rows


def transform_documents(df: DataFrame, collection: str, outer: bool = False) -> DataFrame:
    """The collection's flat rows, or for another collection the documents as they are."""
    shape = SHAPES.get(collection)
    return flatten(df, shape, outer) if shape else df
