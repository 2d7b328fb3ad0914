"""Secret scan: keyword automaton, anchored patterns at its hits, checksum validation.

One Aho-Corasick automaton runs over the lower-cased bytes of a text. Only where it
finds a keyword is a pattern tried, anchored at that place, and kinds of secret that
carry a checksum must pass it. The keywords of a run of hex digits are all groups of
four: the first group found in a run is its start.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkpipe.llm.frames import id_and_text

# Kinds in order, keywords and patterns of well-known secret formats.
KINDS = ("assign", "access", "hex", "github", "npm", "card", "iban")
BASE = KINDS[:3]
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "hex": tuple(map("".join, itertools.product("0123456789abcdef", repeat=4))),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "card": ("card",),
    "iban": ("iban",),
}
PATTERNS = {
    "assign": re.compile(
        rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        re.IGNORECASE,
    ),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "hex": re.compile(rb"[0-9a-f]+"),
    "github": re.compile(rb"gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
    "npm": re.compile(rb"npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
    "card": re.compile(rb"card[^0-9\n]{0,24}((?:[0-9][ -]?){12,18}[0-9])(?![0-9])", re.IGNORECASE),
    "iban": re.compile(
        rb"iban[^A-Z0-9\n]{0,8}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Z0-9])"
        rb"|IBAN[^A-Z0-9\n]{0,8}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Z0-9])"
    ),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SPANS = "doc_id long, spans array<struct<kind:string,start:int,end:int>>"
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def crc_holds(token: bytes) -> bool:
    """The last six characters are the base-62 CRC-32 of those before."""
    body, check = token[:-6], token[-6:].decode()
    value, digits = zlib.crc32(body), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits == check


def luhn_holds(number: bytes) -> bool:
    digits = [x - 48 for x in reversed(number) if 48 <= x <= 57]
    doubled = (2 * x - 9 * (x > 4) for x in digits[1::2])
    return any(digits) and (sum(digits[::2]) + sum(doubled)) % 10 == 0


def iban_holds(number: bytes) -> bool:
    text = number.replace(b" ", b"").decode()
    return int("".join(str(int(x, 36)) for x in text[4:] + text[:4])) % 97 == 1


def accepted(kind: str, match: re.Match) -> tuple[int, int] | None:
    """The span of a match that passes its kind's test."""
    if kind == "assign":
        good, group = len(match[2]) >= 6, 0
    elif kind == "access":
        good, group = len(match[0]) >= 20, 0
    elif kind == "hex":
        good, group = len(match[0]) >= 24, 0
    elif kind in ("github", "npm"):
        good, group = crc_holds(match[1]), 0
    elif kind == "card":
        good, group = luhn_holds(match[1]), 1
    else:
        group = match.lastindex
        good = iban_holds(match[group])
    return match.span(group) if good else None


_automaton = []


def automaton():
    """One automaton per worker process."""
    if not _automaton:
        import ahocorasick

        made = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for word in words:
                made.add_word(word, (kind, len(word)))
        made.make_automaton()
        _automaton.append(made)
    return _automaton[0]


@dataclass
class _Kind:
    at: int = 0  # where the next match may start
    found: list[tuple[int, int]] = field(default_factory=list)


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points by start, then kind; per kind leftmost first."""
    data = text.encode()
    kinds: dict[str, _Kind] = {}
    # Folding touches ASCII only, and a character per byte keeps offsets.
    for last, (kind, length) in automaton().iter(data.lower().decode("latin-1")):
        start, state = last + 1 - length, kinds.setdefault(kind, _Kind())
        if start >= state.at and (match := PATTERNS[kind].match(data, start)):
            state.at = match.end()
            if span := accepted(kind, match):
                state.found.append(span)
    spans = [(s, KINDS.index(k), e) for k, x in kinds.items() for s, e in x.found]
    if len(data) > len(text):
        spans = _in_code_points(data, spans)
    return [(KINDS[k], s, e) for s, k, e in sorted(spans)]


def _in_code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    at = {0: 0}
    done = chars = 0
    for place in sorted({x for s, _, e in spans for x in (s, e)}):
        chars += len(data[done:place].decode())
        at[place], done = chars, place
    return [(at[s], k, at[e]) for s, k, e in spans]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and all spans.

    A null text has no spans, a null id stays null, equal rows give equal rows, an
    empty table an empty result. Other columns are ignored. Time is linear in the
    text, and a task holds one batch of texts.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end")
        for batch in batches:
            spans = [
                [dict(zip(names, x)) for x in scan(text or "")]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, pa.list_(SPAN))], ["doc_id", "spans"]
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(find, SPANS)


def secrets_digest(found: DataFrame) -> DataFrame:
    def of(kinds: tuple[str, ...]) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    return found.select(
        "doc_id",
        *[F.size(of((k,))).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(of(BASE)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
