"""Record contracts per domain and the schemas that follow from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = True
    gt: float | None = None
    max_length: int | None = None


# Field names, types and limits of the three record contracts.
DOMAINS: dict[str, tuple[Field, ...]] = {
    "financial": (
        Field("transaction_id", "string"),
        Field("timestamp", "timestamp"),
        Field("account_id", "string"),
        Field("amount", "double", gt=0),
        Field("currency", "string", max_length=3),
        Field("transaction_type", "string"),
        Field("merchant_id", "string", required=False),
        Field("category", "string", required=False),
        Field("is_flagged", "boolean", required=False),
    ),
    "insurance": (
        Field("claim_id", "string"),
        Field("timestamp", "timestamp"),
        Field("policy_number", "string"),
        Field("claim_amount", "double", gt=0),
        Field("claim_type", "string"),
        Field("claim_status", "string"),
        Field("customer_id", "string"),
        Field("incident_date", "timestamp"),
    ),
    "sports": (
        Field("event_id", "string"),
        Field("timestamp", "timestamp"),
        Field("sport", "string"),
        Field("team_a", "string"),
        Field("team_b", "string"),
        Field("score_a", "int", required=False),
        Field("score_b", "int", required=False),
        Field("location", "string", required=False),
        Field("status", "string"),
    ),
}

# A domain's four topics are named route_domain_noun.
ROUTES = ("raw", "malformed", "curated", "dlq")
TOPIC_NOUNS = {"financial": "events", "insurance": "claims", "sports": "events"}


def topics_of(domain: str) -> list[str]:
    fields_of(domain)
    return [f"{route}_{domain}_{TOPIC_NOUNS[domain]}" for route in ROUTES]


def fields_of(domain: str) -> tuple[Field, ...]:
    try:
        return DOMAINS[domain]
    except KeyError:
        raise ValueError(f"unknown domain: {domain}") from None


def domain_of(topic: str) -> str:
    """The domain whose name occurs in a topic name."""
    for domain in DOMAINS:
        if domain in topic:
            return domain
    raise ValueError(f"cannot tell the schema of topic: {topic}")


def schema_of(domain: str) -> T.StructType:
    """Declared schema with every field nullable."""
    return T.StructType.fromDDL(", ".join(f"`{f.name}` {f.type}" for f in fields_of(domain)))


def text_schema_of(domain: str) -> T.StructType:
    """The same fields for untrusted input: typed ones as text, text ones as they come.

    A variant keeps apart what is text in the JSON and what only looks like it.
    """
    kinds = {f.name: "variant" if f.type == "string" else "string" for f in fields_of(domain)}
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in kinds.items()))
