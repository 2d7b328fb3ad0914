"""Nearest vectors by inner product, found by counting collisions on random lines.

All vectors are divided by the largest norm and get one more component that puts them on
the unit sphere; a query is scaled to length one and gets 0 there. Its distance to a
vector then falls as their inner product rises. Vectors are projected on random lines,
and each line keeps its projections as one sorted array. Around the query's own
projection a window of half width ``HALF`` times a radius is open on every line, and
virtual rehashing widens all windows with the radius, step by step, over the same
arrays. A vector at the distance of the radius or nearer lies in a window with a
probability of at least erf(HALF / sqrt 2), independently on each line; one that collides
on so many lines that all but ``MISSED`` of such vectors would is verified exactly. The
search ends when the k-th best verified vector is no further away than the radius.

Nothing caps candidates: the last radius spans the sphere, and a query that still has
fewer than k verified vectors verifies all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from sparkpipe.llm.frames import tasks
from sparkpipe.llm.vectors import finite, matrix

LINES = 32
HALF = 1.0
MISSED = 0.03  # share of true neighbours on the radius that too few lines show
RADII = [0.4 * 1.15**k for k in range(12)]  # up to 1.86; then 2, the sphere's diameter
SHARD = 16_384, 131_072  # fewest and most vectors searched together
ROUNDING = 1e-9  # of scores, relative to the norms; those nearer are compared again
QUERIES = 1024  # that search a shard together
BLOCK = 256  # whose windows are laid out at a time


def threshold(lines: int, half: float, missed: float) -> int:
    """The most collisions that all but ``missed`` of the vectors on the radius reach."""
    p = math.erf(half / math.sqrt(2))
    below = 0.0
    for count in range(lines + 1):
        below += math.comb(lines, count) * p**count * (1 - p) ** (lines - count)
        if below > missed:
            return count
    return lines


class Lines:
    """The sorted projections of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float, lines: int):
        self.ids, self.vectors, self.norm = ids, vectors, norm
        unit = vectors / norm
        left = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", unit, unit)))
        # Rows are drawn one after the other, so every shard draws the same lines.
        self.directions = np.random.default_rng(7).standard_normal((lines, vectors.shape[1] + 1))
        spots = self.directions[:, :-1] @ unit.T + np.outer(self.directions[:, -1], left)
        self.order = np.argsort(spots, axis=1).astype(np.int32)
        self.spots = np.take_along_axis(spots, self.order, 1)
        self.least = threshold(lines, HALF, MISSED)

    def search(
        self, ids: np.ndarray, queries: np.ndarray, k: int
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its number, and rows and scores of the k best found."""
        half = np.array([HALF * r for r in [*RADII, 2.0]])
        for begin in range(0, len(queries), BLOCK):
            some = queries[begin : begin + BLOCK]
            sizes = np.sqrt(np.einsum("ij,ij->i", some, some))
            own = (some / sizes[:, None]) @ self.directions[:, :-1].T
            low = np.empty((len(some), len(half), len(self.order)), np.int64)
            high = np.empty_like(low)
            for line, spots in enumerate(self.spots):
                low[:, :, line] = np.searchsorted(spots, own[:, line, None] - half)
                high[:, :, line] = np.searchsorted(spots, own[:, line, None] + half, "right")
            for i, query in enumerate(some):
                at = begin + i
                yield at, *self._one(ids[at], query, sizes[i], low[i], high[i], k)

    def _one(self, own_id, query, size, low, high, k) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        counts = np.zeros(n, np.int64)
        open_ = self.ids != own_id
        rows, scores = [np.zeros(0, np.int64)], [np.zeros(0)]
        best: np.ndarray = np.zeros(0)

        def verify(found: np.ndarray) -> None:
            nonlocal best
            open_[found] = False
            value = self.vectors[found] @ query
            rows.append(found)
            scores.append(value)
            best = np.concatenate([best, value])
            if len(best) > k:
                best = np.partition(best, len(best) - k)[-k:]

        left, right = low[0], low[0]
        for step, radius in enumerate([*RADII, 2.0]):
            new = [
                self.order[line, a:b]
                for line in range(len(self.order))
                for a, b in ((low[step, line], left[line]), (right[line], high[step, line]))
                if b > a
            ]
            if new:
                counts += np.bincount(np.concatenate(new), minlength=n)
            left, right = low[step], high[step]
            found = np.flatnonzero((counts >= self.least) & open_)
            if len(found):
                verify(found)
            near_enough = size * self.norm * (1 - radius * radius / 2)
            if len(best) == k and best.min() >= near_enough:
                break
        else:
            if len(best) < k:
                verify(np.flatnonzero(open_))
        row, score = np.concatenate(rows), np.concatenate(scores)
        if len(best):
            row = row[score >= best.min() - ROUNDING * size * self.norm]
        # Summed row by row in one fixed order: equal vectors get equal scores.
        score = (self.vectors[row] * query).sum(axis=1)
        top = np.lexsort((self.ids[row], -score))[:k]
        return row[top], score[top]


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    lines: int = LINES,
) -> DataFrame:
    """The k vectors of largest inner product found for each query.

    Columns: query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id. A
    query does not find vectors of its own id; with fewer than k others it finds all.

    Rows whose id or vector is null, and vectors that are zero or hold a null or
    non-finite component, take no part. Equal rows count once; two vectors of one id are
    two vectors, and two queries if they are queries. Shorter vectors count as filled up
    with zeros. Empty tables give an empty result; other columns are ignored.

    Vectors and queries are dealt by hashes of their ids into blocks of bounded size, and
    every block of queries meets every block of vectors; only the k best of each meeting
    are shuffled on.
    """

    def usable(df: DataFrame) -> DataFrame:
        rows = df.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
        )
        zero = F.forall("vector", lambda x: x == 0.0)
        return rows.where(F.col("id").isNotNull() & finite("vector") & ~zero)

    base, asked = usable(vectors), usable(queries)
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    n, norm, width = base.agg(F.count("*"), F.sqrt(F.max(square)), F.max(F.size("vector"))).first()
    n_asked, width_asked = asked.agg(F.count("*"), F.max(F.size("vector"))).first()
    width = max(width or 1, width_asked or 1)
    shard = min(SHARD[1], max(SHARD[0], n // tasks(vectors.sparkSession)))
    shards, blocks = max(1, -(-n // shard)), max(1, -(-n_asked // QUERIES))

    def dealt(count: int):
        return F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    held = base.select(dealt(shards).alias("shard"), every(blocks).alias("block"), F.lit(False).alias("asks"), "id", "vector")
    asks = asked.select(every(shards).alias("shard"), dealt(blocks).alias("block"), F.lit(True).alias("asks"), "id", "vector")

    def meet(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        ids: dict[bool, list[np.ndarray]] = {False: [], True: []}
        values: dict[bool, list[np.ndarray]] = {False: [], True: []}
        for batch in batches:
            asking = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            own, rows = batch.column("id").to_numpy(), matrix(batch.column("vector"), width)
            for side in (False, True):
                ids[side].append(own[asking == side])
                values[side].append(rows[asking == side])
        sides = {s: _distinct(np.concatenate(ids[s]), np.concatenate(values[s])) for s in ids}
        if not len(sides[False][0]) or not len(sides[True][0]):
            return
        index = Lines(*sides[False], norm, lines)
        ask_ids, ask_values = sides[True]
        found: list[tuple[np.ndarray, ...]] = []
        for at, row, score in index.search(ask_ids, ask_values, k):
            own = np.full(len(row), ask_ids[at])
            # Every shard has the same block of queries in the same order.
            found.append((own, np.full(len(row), at), index.ids[row], score))
        own, mark, ids_found, score = (np.concatenate(x) for x in zip(*found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(own), pa.array(mark), pa.array(ids_found), pa.array(score)],
            ["query_id", "mark", "vec_id", "score"],
        )

    met = held.unionByName(asks).groupBy("shard", "block")
    found = met.applyInArrow(meet, "query_id long, mark long, vec_id long, score double")
    by_query = Window.partitionBy("query_id", "mark").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _distinct(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows once, in an order that does not depend on the one they come in."""
    marks = np.fromiter((xxhash.xxh3_64_intdigest(v.tobytes()) for v in vectors), np.uint64, len(ids))
    order = np.lexsort((marks, ids))
    ids, vectors = ids[order], vectors[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (vectors[1:] != vectors[:-1]).any(axis=1)
    return ids[new], vectors[new]
