"""N-gram Jaccard self-join by universe partition and pigeonhole.

Two sets whose Jaccard similarity is 0.8 or more differ in few elements. All sets of a
size band hash their elements into the same number of segments. If sets r and s differ
in at most H elements, at most H segments differ, so each set needs to show only some
of its segments: with all possible segment contents in one fixed order, the H + 1 first
segments of either set have one in common. The order goes by cost, the frequency of the
rarest element a segment holds, so the segments shown are those that few other sets
have; empty ones cost most. A segment may instead be shown with its one-deletion
neighbourhood (its content, and its content without any one element); two such segments
still meet if they differ in one element, so each saves two others. How many segments
get one is decided per band, by the cost of the signatures and of the frequent ones that
would be needed without. Sets that show a signature in common are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkpipe.llm import sieve
from sparkpipe.llm.components import components
from sparkpipe.llm.frames import (
    discard, id_and_text, mixed, slices, window_hashes, word_hashes, written,
)

BAND = 8  # ratio of the sizes at which bands begin
COUNT_BITS = 18  # cells of the element counts
COUNT_PARTS = 16
BITMAP = 8  # longs of a set's parity bitmap
WIDE = 4  # bits per element of its wide one, rounded up to a power of two
BLOCKS = 4  # of a set's signatures, in each of which a pair is made once
CROWD = 16  # sets that show a signature, above which its group is led from the middle
FREQUENT_COST = 1000.0
TOGETHER = 1 << 18  # characters that are hashed at a time; their hashes stay in the cache
NO_ID = (1 << 63) - 1  # stands for a null id where rows are picked by it

SHINGLES = "doc_id long, text_hash long, n_shingles long, sid long, part int, counts binary"


@dataclass
class Sets:
    """The shingle sets of some rows, one after the other, each sorted."""

    elements: np.ndarray
    owner: np.ndarray  # of each element, by row
    sizes: np.ndarray

    def ids(self) -> np.ndarray:
        """A set's identity, together with its size."""
        ends = np.cumsum(self.sizes)
        data = memoryview(self.elements.tobytes())
        spans = zip((8 * (ends - self.sizes)).tolist(), (8 * ends).tolist())
        return np.array([xxhash.xxh3_64_intdigest(data[a:b]) for a, b in spans], np.uint64)

    def only(self, rows: np.ndarray) -> Sets:
        """The sets of the rows marked, renumbered."""
        inside = rows[self.owner]
        return Sets(
            self.elements[inside], (np.cumsum(rows) - 1)[self.owner[inside]], self.sizes[rows]
        )


def shingle_sets(texts: list[str], width: int) -> Sets:
    """The sets of distinct hashes of ``width`` consecutive words, ASCII lower case.

    A text of fewer words is one shingle, and one without words none.
    """
    words = [t.encode().lower().split() for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(n)
    hashes = word_hashes([w for ws in words for w in ws])
    windows = window_hashes(hashes, width)
    owner = np.repeat(np.arange(len(texts)), n)[: len(windows)]
    whole = np.arange(len(windows)) + width <= ends[owner]
    elements, owner = [windows[whole]], [owner[whole]]
    for row in np.flatnonzero((n > 0) & (n < width)).tolist():
        elements.append(window_hashes(hashes[ends[row] - n[row] : ends[row]], int(n[row])))
        owner.append(np.array([row]))
    elements, owner = np.concatenate(elements), np.concatenate(owner)
    order = np.argsort(elements)
    order = order[np.argsort(owner[order].astype(np.uint32), kind="stable")]
    elements, owner = elements[order], owner[order]
    new = np.ones(len(elements), bool)
    new[1:] = (elements[1:] != elements[:-1]) | (owner[1:] != owner[:-1])
    elements, owner = elements[new], owner[new]
    return Sets(elements, owner, np.bincount(owner, minlength=len(texts)))


def band_of(n: int) -> int:
    band = 0
    while n >= BAND ** (band + 1):
        band += 1
    return band


def most_different(n, other, percent: int):
    """How many elements linked sets of these sizes may differ in."""
    return (n + other) * (100 - percent) // (100 + percent)


def roles(sizes: np.ndarray, percent: int) -> list[tuple[int, bool, np.ndarray]]:
    """(band, upper, H of each set) of every band the sets take part in; H 0 is no part.

    A set meets sets of its own band there, and as an upper set the largest ones of the
    band below. Sets that can only link with equal ones take no part.
    """
    out = []
    for band in range(band_of(int(sizes.max(initial=1))) + 1):
        low, high = BAND**band, BAND ** (band + 1) - 1
        own = (sizes >= low) & (sizes <= high)
        out.append((band, False, own * most_different(sizes, sizes * 100 // percent, percent)))
        above = (sizes > high) & (high * 100 >= sizes * percent)
        out.append((band, True, above * most_different(sizes, high, percent)))
    return out


def allocation(band: int, frequent: float, percent: int) -> tuple[int, int]:
    """(segments, those with a one-deletion neighbourhood) of a band, by cost.

    ``frequent`` is the share of the band's elements that are frequent. The cost of a
    set is the number of its signatures, and a fine for every one that would have to be
    an empty or frequent segment, or an emptied neighbourhood.
    """
    low, high = BAND**band, BAND ** (band + 1) - 1
    n = math.sqrt(low * high)
    most = max(1, most_different(high, high * 100 // percent, percent))
    best = None
    for segments in {1, max(1, high // 4), max(1, high // 2)}:
        for deleted in range(0, min(segments, 3) + 1):
            if segments + deleted < most + 1:
                continue  # too few to promise a common one
            each = n / segments
            needed = max(0.0, n * 2 / 9 + 1 - 2 * deleted)
            shown = (segments - deleted) * (1 - math.exp(-each * (1 - frequent)))
            short = max(0.0, needed - shown) + deleted * (1 + each) * math.exp(-each)
            cost = needed + deleted * (1 + each) + FREQUENT_COST * short
            if best is None or (cost, segments, deleted) < best:
                best = (cost, segments, deleted)
    return best[1], best[2]


def signatures(
    sets: Sets, band: int, most: np.ndarray, plan: tuple[int, int], levels: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(signature, row) of what the sets show in a band; ``most`` is H of each set."""
    segments, deleted = plan
    inside = (most > 0)[sets.owner]
    elements, owner = sets.elements[inside], sets.owner[inside]
    value = mixed(elements ^ np.uint64(0x9E3779B97F4A7C15 * (band + 1) & (1 << 64) - 1))
    place = owner * segments + ((value >> np.uint64(33)) % np.uint64(segments)).astype(np.int64)
    order = np.argsort(place)
    place, value, elements = place[order], value[order], elements[order]
    starts = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else order
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    content = np.add.reduceat(value, starts)
    level = levels[elements >> np.uint64(64 - COUNT_BITS)].astype(np.int64)
    cost = np.minimum.reduceat(level, starts)
    row, held = np.divmod(place[starts], segments)
    shown, rows = [], []
    if deleted:  # their content, and their content without one element
        sizes = np.diff(np.append(starts, len(place)))
        near = held < deleted
        shown.append((content + held.astype(np.uint64))[near])
        rows.append(row[near])
        each = np.repeat(near, sizes)
        group = np.repeat(np.arange(len(starts)), sizes)[each]
        shown.append(content[group] - value[each] + held[group].astype(np.uint64))
        rows.append(row[group])
        empty = np.ones((len(most), deleted), bool)
        empty[row[near], held[near]] = False
        empty[most == 0] = False
        at, which = np.nonzero(empty)
        shown.append(which.astype(np.uint64))
        rows.append(at)
    exact = held >= deleted
    row, held, content, cost = row[exact], held[exact], content[exact], cost[exact]
    need = np.where(most > 0, np.maximum(0, most + 1 - 2 * deleted), 0)
    value = content + held.astype(np.uint64)
    order = np.lexsort((mixed(value), cost, row))
    row, value, held = row[order], value[order], held[order]
    n = np.bincount(row, minlength=len(most))
    rank = np.arange(len(row)) - (np.cumsum(n) - n)[row]
    chosen = rank < need[row]
    shown.append(value[chosen])
    rows.append(row[chosen])
    for short in np.flatnonzero(need > n).tolist():  # empty segments, in a fixed order
        empty = np.setdiff1d(np.arange(deleted, segments), held[row == short]).astype(np.uint64)
        empty = empty[np.argsort(mixed(empty), kind="stable")][: need[short] - n[short]]
        shown.append(empty)
        rows.append(np.full(len(empty), short))
    seed = np.uint64(0xD1B54A32D192ED03 * (band + 1) & (1 << 64) - 1)
    return mixed(mixed(np.concatenate(shown)) ^ seed), np.concatenate(rows)


def bitmaps(sets: Sets) -> np.ndarray:
    """Parity bits: two sets' bitmaps differ in no more bits than the sets in elements."""
    bits = 64 * BITMAP
    cell = ((sets.elements >> np.uint64(7)) % np.uint64(bits)).astype(np.int64)
    table = np.bincount(sets.owner * bits + cell, minlength=len(sets.sizes) * bits) & 1
    return np.packbits(table.astype(np.uint8)).view(np.int64).reshape(-1, BITMAP)


def wide_bitmap(elements: np.ndarray) -> bytes:
    """Parity bits of one set in a table as large as the set asks for."""
    bits = 64
    while bits < WIDE * len(elements):
        bits *= 2
    cell = ((elements >> np.uint64(7)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(cell, minlength=bits) & 1).astype(np.uint8)).tobytes()


def least_different(a: bytes, b: bytes) -> int:
    """In how many elements two sets differ at least, by their wide bitmaps.

    The halves of a bitmap laid over each other are the bitmap of half the size.
    """
    a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(a) != len(b):
        if len(a) < len(b):
            a, b = b, a
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _some(batch: pa.RecordBatch, width: int) -> Iterator[tuple[list, Sets]]:
    """Ids and sets of a batch's rows, about ``TOGETHER`` characters at a time."""
    ids, texts = batch.column(0).to_pylist(), batch.column(1)
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
    for rows in slices(list(range(len(ids))), sizes, TOGETHER):
        # Only these texts become objects.
        some = texts.slice(rows[0], len(rows)).to_pylist()
        yield [ids[i] for i in rows], shingle_sets([t or "" for t in some], width)


def _distinct(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, Sets]]:
    """Set ids and sets of a batch, each distinct non-empty set once."""
    seen = set()
    for _, sets in _some(batch, width):
        sids = sets.ids()
        new = np.zeros(len(sids), bool)
        for i, key in enumerate(zip(sids.tolist(), sets.sizes.tolist())):
            if key[1] and key not in seen:
                seen.add(key)
                new[i] = True
        yield sids[new], sets.only(new)


def _identities(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text hash, size and set id of every row, and counts of elements by cell."""

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_hash", "n_shingles", "sid", "part", "counts"]
        kinds = [*[pa.int64()] * 4, pa.int32(), pa.binary()]
        cells = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            hashes = iter(batch.column(2).to_pylist())
            for ids, sets in _some(batch, width):
                cell = (sets.elements >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
                cells += np.bincount(cell, minlength=len(cells))
                none = [None] * len(ids)
                sids = pa.array(sets.ids().view(np.int64), mask=sets.sizes == 0)
                columns = (ids, [next(hashes) for _ in ids], sets.sizes, sids, none, none)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names
                )
        if cells.any():
            parts = cells.reshape(COUNT_PARTS, -1)
            table = [(None, None, None, None, i, p.tobytes()) for i, p in enumerate(parts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*table), kinds)], names
            )

    return docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(identify, SHINGLES)


def _levels(counts: DataFrame) -> np.ndarray:
    """How frequent the elements of each cell are, in powers of two of the mean.

    The counts of all tasks are added part by part; what reaches the driver has a
    fixed size.
    """

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for data in batch.column("counts").to_pylist():
                total = total + np.frombuffer(data, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()])],
            ["part", "counts"],
        )

    summed = counts.groupBy("part").applyInArrow(add, "part int, counts binary")
    cells = np.zeros((COUNT_PARTS, (1 << COUNT_BITS) // COUNT_PARTS), np.int64)
    for part, data in summed.collect():
        cells[part] = np.frombuffer(data, np.int64)
    cells = cells.ravel()
    return np.ceil(np.log2(np.maximum(1, cells / max(1.0, cells.mean())))).astype(np.uint8)


class _Signer:
    """(signature, row, upper) of sets in all their bands."""

    def __init__(self, levels: np.ndarray, plans: list[tuple[int, int]], percent: int):
        self.levels, self.plans, self.percent = levels, plans, percent

    def __call__(self, sets: Sets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool))]
        for band, upper, most in roles(sets.sizes, self.percent):
            if most.any():
                found, row = signatures(sets, band, most, self.plans[band], self.levels)
                parts.append((found, row, np.full(len(found), upper)))
        return tuple(map(np.concatenate, zip(*parts)))


def _keys_of(batch: pa.RecordBatch, width: int, make: _Signer) -> tuple[np.ndarray, np.ndarray]:
    """The distinct signatures of a batch, and which of them two or more of its sets show.

    A set showing one twice makes a signature pass for shared, which costs a row.
    """
    own = [make(sets)[0] for _, sets in _distinct(batch, width)]
    found, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *own]), return_counts=True)
    return found, n > 1


def _shown(docs: DataFrame, width: int, signer, table) -> DataFrame:
    """(sig, sid, n, upper): shared signatures; and with bitmaps one row per set that has one."""

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, cells = signer.value, table.value
        for batch in batches:
            for sids, sets in _distinct(batch, width):
                found, row, upper = make(sets)
                good = sieve.passes(found, cells)
                found, row, upper = found[good], row[good], upper[good]
                once = np.unique(row)
                bits = list(bitmaps(sets)[once])
                ends = np.cumsum(sets.sizes)[once].tolist()
                spans = zip(ends, sets.sizes[once].tolist())
                wide = [wide_bitmap(sets.elements[end - n : end]) for end, n in spans]
                row = np.concatenate([row, once])
                none = [None] * len(once)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.view(np.int64).tolist() + none, pa.int64()),
                        pa.array(sids[row].view(np.int64)),
                        pa.array(sets.sizes[row].astype(np.int32)),
                        pa.array(upper.tolist() + none, pa.bool_()),
                        pa.array([None] * len(found) + bits, pa.list_(pa.int64())),
                        pa.array([None] * len(found) + wide, pa.binary()),
                    ],
                    ["sig", "sid", "n", "upper", "bits", "wide"],
                )

    return docs.mapInArrow(
        show, "sig long, sid long, n int, upper boolean, bits array<long>, wide binary"
    )


def _elements(docs: DataFrame, width: int, wanted: DataFrame) -> DataFrame:
    """(sid, n, elements) of the sets of the rows (doc_id, sid) that are ``wanted``.

    A few more may come along, as the rows are picked by a filter of fixed size.
    """
    columns = ["doc_id", "sid"]
    table = docs.sparkSession.sparkContext.broadcast(sieve.filter_of(wanted, columns))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sets in _some(batch, width):
                ids = np.array([NO_ID if i is None else i for i in ids], np.int64)
                sids = sets.ids().view(np.int64)
                rows = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sids)], columns)
                good = sieve.passes(sieve.row_keys(rows, columns), table.value)
                ends = 8 * np.cumsum(sets.sizes)
                begins = ends - 8 * sets.sizes
                data = sets.elements.tobytes()
                rows = np.flatnonzero(good & (sets.sizes > 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sids[rows]),
                        pa.array(sets.sizes[rows].astype(np.int32)),
                        pa.array([data[begins[i] : ends[i]] for i in rows.tolist()], pa.binary()),
                    ],
                    ["sid", "n", "elements"],
                )

    rows = docs.mapInArrow(gather, "sid long, n int, elements binary")
    return rows.dropDuplicates(["sid", "n"])


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _bits_fit(percent: int) -> Column:
    """False where the bitmaps alone show that two sets differ too much."""
    differ = reduce(
        lambda x, y: x + y,
        [F.bit_count(F.get("a_bits", F.lit(i)).bitwiseXOR(F.get("b_bits", F.lit(i)))) for i in range(BITMAP)],
    )
    return differ * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent)


def _likely(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """(a, a_n, b, b_n) of the pairs (a, b) that sizes and bitmaps do not rule out."""
    for s in "ab":
        one = bits.select(
            F.col("sid").alias(s), F.col("n").alias(f"{s}_n"), F.col("bits").alias(f"{s}_bits")
        )
        pairs = pairs.join(one, s)
    fit = _sizes_fit("a_n", "b_n", percent) & _bits_fit(percent)
    return pairs.where(fit).select("a", "a_n", "b", "b_n")


def _near(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, a_n, b, b_n) that their sets' wide bitmaps do not rule out.

    These leave few pairs too many, and take a sixteenth of the sets' room.
    """
    for s in "ab":
        one = bits.select(F.col("sid").alias(s), F.col("n").alias(f"{s}_n"), F.col("wide").alias(f"{s}_wide"))
        pairs = pairs.join(one, [s, f"{s}_n"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("a_n", "b_n", "a_wide", "b_wide")]
            good = [
                least_different(a, b) <= most_different(n, other, percent)
                for n, other, a, b in zip(*columns)
            ]
            yield batch.select(["a", "a_n", "b", "b_n"]).filter(pa.array(good, pa.bool_()))

    pairs = pairs.select("a", "a_n", "b", "b_n", "a_wide", "b_wide")
    return pairs.mapInArrow(keep, "a long, a_n int, b long, b_n int")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough, compared in full."""
    for s in "ba":
        full = sets.select(
            F.col("sid").alias(s), F.col("n").alias(f"{s}_n"), F.col("elements").alias(f"{s}_set")
        )
        pairs = pairs.hint("merge").join(full, [s, f"{s}_n"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column("a_set").to_pylist(), batch.column("b_set").to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.select("a", "b", "a_set", "b_set").mapInArrow(compare, "a long, b long")


def _in_blocks(members: DataFrame) -> DataFrame:
    """Every row with the signatures of its set, in the same role, that are in the row's block."""
    block = Window.partitionBy("sid", "upper", F.pmod(F.xxhash64("sig"), F.lit(BLOCKS)))
    return members.withColumn("sigs", F.collect_list("sig").over(block))


def _pairs_apart(members: DataFrame, percent: int) -> DataFrame:
    """(a, a_n, b, b_n) of sets of two components that share a signature and may be similar.

    Similar sets share many signatures; in each block of these the first one they share
    makes the pair. Two sets have the same roles in all they share: either both are of
    the band, or one is an upper set.
    """

    def side(s: str) -> DataFrame:
        names = {"sid": s} | {c: f"{s}_{c}" for c in ("n", "bits", "root", "main", "upper", "sigs")}
        return members.select("sig", *[F.col(c).alias(name) for c, name in names.items()])

    needed = (
        (F.col("a_root") != F.col("b_root"))
        & ~(F.col("a_upper") & F.col("b_upper"))
        & ((F.col("b_root") == F.col("b_main")) | (F.col("a") < F.col("b")))
        & _sizes_fit("a_n", "b_n", percent)
        & _bits_fit(percent)
        & (F.array_min(F.array_intersect("a_sigs", "b_sigs")) == F.col("sig"))
    )
    strays = side("a").where("a_root != a_main")
    pairs = strays.hint("merge").join(side("b"), "sig").where(needed)
    return pairs.select("a", "a_n", "b", "b_n")


def _groups(rows: DataFrame) -> list[DataFrame]:
    """(sig, sid, upper, m, lead, other, weight) of the signatures that two sets show, in two tables.

    m is the size of the group. Groups up to ``CROWD`` are led by their lowest and highest
    set id. Near copies of one text are often like that text and not like each other; a set
    in the middle shows what many show, others mostly what was changed in them. So a
    crowd's first leader is the set of most weight, the sizes of all the crowds it is in.
    """
    ends = [F.min("sid").alias("low"), F.max("sid").alias("high"), F.count("*").alias("m")]
    ends = rows.groupBy("sig").agg(*ends).where("low != high")
    grouped = written(rows.hint("merge").join(ends, "sig"), "jaccard-grouped")
    few, crowds = grouped.where(F.col("m") <= CROWD), grouped.where(F.col("m") > CROWD)
    few = few.withColumnsRenamed({"low": "lead", "high": "other"}).withColumn("weight", F.lit(0).cast("long"))
    few = written(few, "jaccard-groups")
    weights = crowds.groupBy("sid").agg(F.sum("m").alias("weight"))
    weighted = crowds.select("sig", "sid").hint("merge").join(weights, "sid")
    heads = weighted.groupBy("sig").agg(F.max(F.struct("weight", "sid")).alias("head"))
    other = F.when(F.col("low") == F.col("head.sid"), F.col("high")).otherwise(F.col("low"))
    crowds = crowds.hint("merge").join(heads, "sig").select(
        "sig", "sid", "upper", "m", F.col("head.sid").alias("lead"), other.alias("other"), "head.weight"
    )
    crowds = written(crowds, "jaccard-crowds")
    discard(grouped)
    return [few, crowds]


def _links(
    docs: DataFrame, ids: DataFrame, width: int, shown: DataFrame, percent: int
) -> DataFrame:
    """(node, root) over set ids, exact.

    Each signature's group has two leaders. First every set is compared with one of its
    leaders, the one of most weight that sizes and bitmaps allow: no more pairs than sets,
    and enough to join up large groups of near copies. What is one component then needs
    no more. Sets whose other leaders lie in another component are compared with these,
    which does for groups of up to three; and in a larger one that is not one component
    every set outside the first leader's component is compared with all sets of other
    components that sizes and bitmaps allow. Between sets of one component nothing can
    be gained.
    """
    rows = shown.where("sig IS NOT NULL").select("sig", "sid", "upper")
    marks = [F.first(c).alias(c) for c in ("bits", "wide")]
    bits = written(shown.where("sig IS NULL").groupBy("sid", "n").agg(*marks), "jaccard-bits")
    few, crowds = _groups(rows)
    grouped = few.unionByName(crowds)
    led = F.explode(F.array("lead", "other")).alias("a")
    star = grouped.select(led, F.col("sid").alias("b")).where("a != b").distinct()
    star = written(star, "jaccard-pairs")
    likely = written(_near(_likely(star, bits, percent), bits, percent), "jaccard-star")
    weights = crowds.select(F.col("lead").alias("a"), "weight").distinct()
    best = F.max(F.struct(F.coalesce("weight", F.lit(0)), "a", "a_n")).alias("to")
    nearest = likely.join(weights, "a", "left").groupBy("b", "b_n").agg(best)
    nearest = written(nearest.select("to.a", "to.a_n", "b", "b_n"), "jaccard-nearest")
    first = _compared(docs, ids, width, nearest, percent, "jaccard-first")
    roots = components(first, "jaccard-roots")

    def rooted(df: DataFrame, sid: str, name: str) -> DataFrame:
        known = roots.select(F.col("node").alias(sid), F.col("root").alias(name))
        return df.hint("merge").join(known, sid, "left").withColumn(name, F.coalesce(name, sid))

    def across(pairs: DataFrame) -> DataFrame:
        return rooted(rooted(pairs, "a", "a_root"), "b", "b_root").where("a_root != b_root")

    apart = across(star).select(F.col("a").alias("lead"), F.col("b").alias("sid"))
    apart = written(apart, "jaccard-apart")
    discard(star)
    larger = grouped.where("m > 3").select("sig", "sid", "upper", "lead")
    outside = sieve.semi_join(larger.select("sig", "sid", "lead"), apart, ["lead", "sid"])
    opened = written(outside.select("sig").distinct(), "jaccard-opened")
    members = sieve.semi_join(larger, opened, ["sig"])
    members = rooted(rooted(members.distinct(), "sid", "root"), "lead", "main")
    members = members.hint("merge").join(bits.select("sid", "n", "bits"), "sid")
    members = written(_in_blocks(members), "jaccard-members")
    discard(few, crowds, apart, opened)

    rest = written(_pairs_apart(members, percent).distinct(), "jaccard-strays")
    discard(members)
    rest = _near(rest, bits, percent).unionByName(across(likely).select("a", "a_n", "b", "b_n"))
    rest = rest.distinct().hint("merge").join(nearest, ["a", "a_n", "b", "b_n"], "left_anti")
    rest = written(rest, "jaccard-rest")
    discard(likely, nearest, bits)
    second = _compared(docs, ids, width, rest, percent, "jaccard-second")
    discard(rest)
    return components(first.unionByName(second), "jaccard-components")


def _compared(
    docs: DataFrame, ids: DataFrame, width: int, pairs: DataFrame, percent: int, label: str
) -> DataFrame:
    """The similar ones of ``pairs``; only the sets of these pairs are made again.

    Of the rows that share a set the one with the lowest id makes it.
    """
    sids = pairs.select(F.col("a").alias("sid")).unionByName(
        pairs.select(F.col("b").alias("sid"))
    )
    sids = written(sids.distinct(), f"{label}-sids")
    known = ids.where("sid IS NOT NULL").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "sid"
    )
    wanted = sieve.semi_join(known, sids, ["sid"]).groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
    wanted = written(wanted, f"{label}-rows")
    sets = written(_elements(docs, width, wanted), f"{label}-sets")
    similar = written(_verified(pairs, sets, percent), label)
    discard(sids, wanted, sets)
    return similar


def jaccard_join(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles, set_id, root, component_id.

    Rows link if their sets of distinct shingles have a Jaccard similarity of
    ``percent`` in a hundred or more, compared exactly over 64-bit shingle hashes.
    component_id is the lowest id reachable by links, the row's own included. Rows of
    equal sets are one node; ``root`` tells components apart whose lowest id is one. A null or wordless text has no shingles and links with
    nothing; a null id takes part but is never a component's id, so a component of
    null ids only has a null one. Equal rows give equal rows; an empty table gives an
    empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    seen = written(_identities(rows, width), "jaccard-identities")
    levels = _levels(seen.where("counts IS NOT NULL").select("part", "counts"))
    ids = seen.where("counts IS NULL").select("doc_id", "text_hash", "n_shingles", "sid")
    largest = ids.agg(F.max("n_shingles")).first()[0] or 0
    frequent = float((levels > 3).mean())
    plans = [allocation(b, frequent, percent) for b in range(band_of(max(1, largest)) + 1)]
    context = spark.sparkContext
    signer = context.broadcast(_Signer(levels, plans, percent))
    shared = sieve.shared_filter(rows, lambda batch: _keys_of(batch, width, signer.value))
    table = context.broadcast(shared)
    shown = written(_shown(rows, width, signer, table), "jaccard-shown")
    roots = _links(rows, ids, width, shown, percent)
    discard(shown)

    known = roots.select(F.col("node").alias("sid"), "root")
    rooted = ids.hint("merge").join(known, "sid", "left")
    rooted = written(rooted.withColumn("root", F.coalesce("root", "sid")), "jaccard-rooted")
    discard(seen, roots)
    lowest = rooted.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("lowest"))
    out = rooted.hint("merge").join(lowest, "root", "left")
    return out.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.col("sid").alias("set_id"),
        "root",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id"),
    )


def one_per_component(
    docs: DataFrame, joined: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Of each component the row with the lowest id, all columns as they are.

    Rows go by their own text, told by id and text hash: of rows with one id and
    different texts those go that lie in a component with another row to keep. Of several
    rows of a component with its lowest id the one of the lowest text hash stays, of equal
    ones the first in order of all columns. Rows without words or an id all stay.
    """
    judged = joined.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = F.min(F.struct("doc_id", "text_hash"))
    kept = judged.groupBy("root").agg(first.alias("first")).select(
        F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash")
    )
    rows = judged.groupBy("doc_id", "text_hash").agg(F.count("*").alias("times")).hint("merge")
    same = (F.col("doc_id") == F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    dropped = written(rows.join(kept, same, "left_anti").select("doc_id", "text_hash"), "jaccard-dropped")
    twice = rows.where("times > 1").join(kept, same, "left_semi").select("doc_id", "text_hash")

    def of(some: DataFrame):
        return (docs[id_col].cast("long") == some["doc_id"]) & (F.xxhash64(docs[text_col]) == some["text_hash"])

    left = docs.join(dropped, of(dropped), "left_anti")
    if twice.isEmpty():
        return left
    single = left.join(twice, of(twice), "left_anti")
    names = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    again = left.join(twice, of(twice), "left_semi").select(F.struct("*").alias("doc"))
    key = (F.col(f"doc.`{id_col}`"), F.xxhash64(F.col(f"doc.`{text_col}`")))
    once = again.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(key)]).agg(F.min("doc").alias("doc"))
    return single.unionByName(once.select(*names))
