"""Vector codes: one codebook per part of a vector, fitted and applied in exact integers.

Components become integers, floor(scale * x). A part's code is the codebook entry at the
least squared distance, |v|^2 - 2 v.c + |c|^2. The dot products go through float64 matrix
multiplication, which is exact as long as no sum reaches 2^53: integers are broken into
limbs of so few bits that products of two limbs, summed over a part, stay below that.
The products of limbs are put together in int64, or, where the numbers are too large for
it, in Python's own integers. The first of equal least distances wins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkpipe.llm.frames import written
from sparkpipe.llm.vectors import finite, matrix
from sparkpipe.operators.joins import keyed_join

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
ROWS = 4096  # vectors coded at a time
SUM_BITS = 32  # of a limb of sums: an int64 adds up two billion of them
LARGEST = (1 << 63) - 1


@dataclass
class Codebooks:
    """``entries[part][entry][position]`` as Python integers; the scale and width used."""

    entries: list[list[list[int]]]
    scale: int
    width: int  # of a vector, a multiple of the number of parts

    def sha256(self) -> str:
        values = (str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(values).encode()).hexdigest()


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles: int64, or Python integers if one needs more bits."""
    if np.abs(values).max(initial=0) * scale < 1 << 53:
        return np.floor(values * scale).astype(np.int64)
    flat = [_whole(x, scale) for x in values.ravel().tolist()]
    out = np.empty(len(flat), object)
    out[:] = flat
    return out.reshape(values.shape)


def _whole(x: float, scale: int) -> int:
    top, bottom = x.as_integer_ratio()
    return top * scale // bottom


def _limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Limbs from the lowest; all but the last are not negative."""
    out = []
    while True:
        rest = values >> bits
        if ((rest == 0) | (rest == -1)).all():
            return [*out, values]
        out.append(values & ((1 << bits) - 1))
        values = rest


def _size(values: np.ndarray) -> int:
    return int(max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0)))))


def exact_dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All dot products of the rows of two integer matrices, exactly."""
    width = a.shape[1]
    bits = (53 - max(1, width).bit_length()) // 2
    fits = width * _size(a) * _size(b) < 1 << 62
    total = np.zeros((len(a), len(b)), np.int64 if fits else object)
    right = [x.astype(np.float64) for x in _limbs(b, bits)]
    for i, x in enumerate(_limbs(a, bits)):
        x = x.astype(np.float64)
        for j, y in enumerate(right):
            product = (x @ y.T).astype(np.int64)
            if not fits:
                product = product.astype(object)
            # In int64 a shift may drop high bits that further terms cancel.
            total += product << (bits * (i + j))
    return total


def nearest(values: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the first nearest entry and its squared distance."""
    if values.shape[1] * 4 * max(_size(values), _size(entries)) ** 2 >= 1 << 62:
        values, entries = values.astype(object), entries.astype(object)
    distance = (entries * entries).sum(axis=1) - 2 * exact_dots(values, entries)
    best = distance.argmin(axis=1)
    own = (values * values).sum(axis=1)
    return best, distance[np.arange(len(best)), best] + own


def _usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    return vectors.where(finite(vector_col))


def _blocks(column: pa.ListArray, books: Codebooks) -> Iterator[tuple[int, np.ndarray]]:
    for begin in range(0, len(column), ROWS):
        some = column.slice(begin, ROWS)
        yield begin, integers(matrix(some, books.width), books.scale)


def _arrays(books: Codebooks) -> list[np.ndarray]:
    wide = max((abs(x) for part in books.entries for entry in part for x in entry), default=0) >= 1 << 62
    return [np.array(part, object if wide else np.int64) for part in books.entries]


def _means(rows: DataFrame, books: Codebooks, limbs: int) -> Codebooks:
    """One round: every part goes to its nearest entry, entries become floored means.

    A task sends one row of sums per part and entry; Spark adds them up, in limbs.
    """
    parts, part_width = len(books.entries), books.width // len(books.entries)
    entries = len(books.entries[0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _arrays(books)
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((limbs, parts, entries, part_width), np.int64)
        for batch in batches:
            for _, values in _blocks(batch.column(0), books):
                for p in range(parts):
                    own = values[:, p * part_width : (p + 1) * part_width]
                    best = nearest(own, arrays[p])[0]
                    count[p] += np.bincount(best, minlength=entries)
                    for k in range(limbs):
                        limb = own & ((1 << SUM_BITS) - 1) if k < limbs - 1 else own
                        np.add.at(total[k, p], best, limb.astype(np.int64))
                        own = own >> SUM_BITS
        used = np.argwhere(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used[:, 0], pa.int32()),
                pa.array(used[:, 1], pa.int32()),
                pa.array(count[count > 0]),
                pa.array([total[:, p, e].ravel().tolist() for p, e in used], pa.list_(pa.int64())),
            ],
            ["part", "entry", "n", "totals"],
        )

    sent = rows.mapInArrow(sums, "part int, entry int, n long, totals array<long>")
    added = [F.sum(F.get("totals", F.lit(i))).alias(f"t{i}") for i in range(limbs * part_width)]
    new = [list(part) for part in books.entries]
    # At most one row per part and entry.
    for part, entry, n, *totals in sent.groupBy("part", "entry").agg(F.sum("n"), *added).collect():
        whole = [
            sum(totals[k * part_width + i] << (SUM_BITS * k) for k in range(limbs))
            for i in range(part_width)
        ]
        new[part][entry] = [x // n for x in whole]
    return Codebooks(new, books.scale, books.width)


def fit_codebooks(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebooks:
    """Codebooks that start as the parts of the vectors of smallest id.

    Only the books themselves, of a size the parameters fix, and sums of tasks pass
    through the driver. Null ids come last in order, and equal ids by their vectors.
    An empty table gives books without entries.
    """
    rows = _usable(vectors, vector_col).select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    largest = F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x))))
    longest, largest = rows.agg(F.max(F.size("vector")), largest).first()
    width = -(-(longest or 0) // parts) * parts
    bits = int(largest or 0).bit_length() + scale.bit_length() + 1
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    filled = [[*seed.vector, *[0.0] * (width - len(seed.vector))] for seed in seeds]
    start = integers(np.array(filled).reshape(len(seeds), width), scale).tolist()
    at = width // parts
    books = Codebooks([[v[p * at : (p + 1) * at] for v in start] for p in range(parts)], scale, width)
    for _ in range(rounds if seeds else 0):
        books = _means(rows.select("vector"), books, -(-bits // SUM_BITS))
    return books


def encode(
    vectors: DataFrame,
    books: Codebooks,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per kept row: the id, the label, code (a byte per part), error.

    Rows whose vector is null or holds a null or non-finite component are left out.
    Shorter vectors count as filled up with zeros to a multiple of the number of parts;
    rows with null or repeated ids are coded like any other. An error beyond a long is
    given as the largest long. Other columns are ignored; their names do not matter.
    """
    rows = _usable(vectors, vector_col).select(
        F.col(id_col).alias("vec_id"),
        F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    parts = len(books.entries)
    part_width = books.width // parts
    kind = rows.schema

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _arrays(books)
        for batch in batches:
            for begin, values in _blocks(batch.column(2), books):
                codes = np.zeros((len(values), parts), np.uint8)
                error = np.zeros(len(values), object)
                for p in range(parts):
                    own = values[:, p * part_width : (p + 1) * part_width]
                    codes[:, p], distance = nearest(own, arrays[p])
                    error = error + distance
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, len(values)),
                        batch.column(1).slice(begin, len(values)),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array([min(int(e), LARGEST) for e in error], pa.int64()),
                    ],
                    ["vec_id", "label", "code", "error"],
                )

    given = ", ".join(f"{n} {kind[n].dataType.simpleString()}" for n in ("vec_id", "label"))
    return rows.mapInArrow(code, f"{given}, code binary, error long")


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add the error summed over equal labels; null labels are equal to each other.

    Errors are added up before the join, which spreads a label that many rows have.
    """
    coded = written(coded.withColumn("_label", F.to_json(F.struct("label"))), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy("_label").agg(F.least(total, F.lit(LARGEST)).cast("long").alias("label_error"))
    return keyed_join(coded, sums, ["_label"], salt_by=["vec_id"]).drop("_label")


def codes_digest(coded: DataFrame, books: Codebooks) -> DataFrame:
    return coded.select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )
