"""Column expressions; all built in, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER = r"^\s*[+-]?\d+(\.0*)?\s*$"
ISO_TIME = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def amount_or_zero(amount: Column, numeric: str = "double") -> Column:
    """An absent amount is zero; one that is no number is NULL."""
    return F.coalesce(amount.try_cast(numeric), F.when(amount.isNull(), F.lit(0.0)))


def clean_code(text: Column) -> Column:
    return F.trim(F.upper(text))


def zero_flag(amount: Column) -> Column:
    return F.coalesce(amount == 0.0, F.lit(False))


def mask(identifier: Column) -> Column:
    return F.sha2(identifier.cast("string"), 256)


def typed(text: Column, kind: str) -> Column:
    """Text to a typed value, NULL when the text does not have that form.

    Digits of a second beyond the sixth are cut off.

    Spark's cast reads more forms than a contract should allow ("1d", a bare
    year, a time of day that takes on today's date), hence the patterns.
    """
    if kind == "string":
        return text
    if kind == "boolean":
        return F.trim(text).try_cast("boolean")
    pattern = {"double": NUMBER, "int": INTEGER, "timestamp": ISO_TIME}[kind]
    value = text.try_cast("double").try_cast("int") if kind == "int" else text.try_cast(kind)
    return F.when(text.rlike(pattern), value)


def hash_fraction(key: Column) -> Column:
    """A replayable stand-in for a uniform random number in [0, 1): 32 bits of an md5."""
    digits = F.substring(F.md5(key.cast("string").cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))


def bucket_index(value: Column, boundaries: Sequence[float]) -> Column:
    """Number of boundaries below the value: upper bounds are inclusive."""
    return reduce(lambda a, b: a + b, [(value > F.lit(float(b))).cast("int") for b in boundaries])


def changed(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True where any pair differs, NULL being equal to NULL."""
    return reduce(lambda a, b: a | b, [~x.eqNullSafe(y) for x, y in pairs], F.lit(False))
