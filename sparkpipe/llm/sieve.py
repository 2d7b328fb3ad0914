"""A filter of bounded size for the 64-bit keys that occur in two or more places.

It only saves work: a key that passes by mistake costs a row. It takes about 16 bits a
key up to 32 MB in all; the larger the data beyond that, the more pass, until the filter
does nothing. Keys are told apart by their first bits, which give the part, and their
last 32.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkpipe.llm.frames import mixed, tasks

MOST_BITS = 28  # of a whole filter
KEY_BITS = 16
HASHES = 4
ROWS = 2500  # whose keys are sent together
LAST = np.uint64((1 << 32) - 1)


@dataclass
class Sieve:
    """The bits of all parts, one after the other; a part has a power of two of them."""

    bits: np.ndarray  # packed
    starts: np.ndarray  # of the parts, in bits
    sizes: np.ndarray
    heavy: np.ndarray = None  # shared keys of too much weight, sorted: part, then last 32 bits

    def part_of(self, keys: np.ndarray) -> np.ndarray:
        return keys >> np.uint64(64 - (len(self.sizes) - 1).bit_length())


def part_bits(docs: DataFrame) -> int:
    """Keys are gathered in this many bits' worth of parts, at least four per task.

    What a part holds is in memory at once, so parts are smaller than a task's share.
    """
    return min(14, max(4, (tasks(docs.sparkSession) - 1).bit_length() + 2))


def _cell(keys: np.ndarray, k: int, size) -> np.ndarray:
    return mixed((keys & LAST) + np.uint64(k + 1)) & (size - np.uint64(1))


def shared_filter(
    docs: DataFrame,
    keys_of: Callable[[pa.RecordBatch], tuple[np.ndarray, ...]],
    most_weight: int | None = None,
) -> Sieve:
    """The filter of the keys that two batches have, or one batch has twice.

    ``keys_of`` gives the sorted distinct keys of a batch, and which of them occur twice
    in it. Each batch sends a key once, so even a key that a third of all rows have
    arrives no more often than there are batches of ``ROWS`` rows. What reaches the driver is bounded.

    With ``most_weight``, ``keys_of`` also gives each key's weight in the batch, and the
    shared keys that may weigh more in all are listed: weights are sent rounded up to
    powers of two, so no other key weighs more. There are at most twice as many of them as
    the whole weight holds ``most_weight``.
    """
    first = part_bits(docs)
    parts, most = 1 << first, 1 << (MOST_BITS - first)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            found, twice, *weight = keys_of(batch)
            power = np.zeros(len(found), np.uint8)
            if weight:
                power = np.ceil(np.log2(np.maximum(1, weight[0]))).astype(np.uint8)
            cuts = np.searchsorted(found >> np.uint64(64 - first), np.arange(parts + 1))
            rows = [
                (
                    p,
                    found[a:b].astype(np.uint32).tobytes(),
                    np.packbits(twice[a:b]).tobytes(),
                    power[a:b].tobytes() if weight else b"",
                )
                for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))
                if b > a
            ]
            if rows:
                kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    ["part", "found", "twice", "power"],
                )

    def gather(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        found, shared, power = [], [], []
        for batch in batches:
            power += (np.frombuffer(x, np.uint8) for x in batch.column("power").to_pylist())
            twice = batch.column("twice").to_pylist()
            for data, more in zip(batch.column("found").to_pylist(), twice):
                found.append(np.frombuffer(data, np.uint32))
                bits = np.unpackbits(np.frombuffer(more, np.uint8), count=len(found[-1]))
                shared.append(found[-1][bits.astype(bool)])
        every = np.concatenate(found)
        heavy = np.zeros(0, np.uint32)
        if most_weight is not None and len(every):
            order = np.argsort(every, kind="stable")
            every, power = every[order], np.concatenate(power)[order]
            first_of = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
            total = np.add.reduceat(np.left_shift(1, power.astype(np.int64)), first_of)
            heavy = every[first_of[total > most_weight]]
        else:
            every = np.sort(every)
        shared.append(every[1:][every[1:] == every[:-1]])
        shared = np.unique(np.concatenate(shared)).astype(np.uint64)
        heavy = heavy[np.isin(heavy, shared)]
        size = min(most, max(8, 1 << (KEY_BITS * len(shared)).bit_length()))
        row = np.zeros(size, bool)
        for k in range(HASHES):
            row[_cell(shared, k, np.uint64(size))] = True
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([key[0].as_py()], pa.int32()),
                pa.array([np.packbits(row).tobytes()]),
                pa.array([heavy.tobytes()], pa.binary()),
            ],
            ["part", "cells", "heavy"],
        )

    sent = docs.mapInArrow(send, "part int, found binary, twice binary, power binary")
    filled = sent.groupBy("part").applyInArrow(gather, "part int, cells binary, heavy binary")
    rows, heavy = {}, [np.zeros(0, np.uint64)]
    # At most 32 MB and the heavy keys; taken part by part, each would be a job of its own.
    for part, data, some in filled.collect():
        rows[part] = bytes(data)
        heavy.append(np.frombuffer(some, np.uint32) + (np.uint64(part) << np.uint64(32)))
    rows = [rows.get(part, b"\0") for part in range(parts)]
    sizes = np.array([8 * len(r) for r in rows], np.uint64)
    starts = np.cumsum(sizes) - sizes
    return Sieve(
        np.frombuffer(b"".join(rows), np.uint8), starts, sizes, np.sort(np.concatenate(heavy))
    )


def is_heavy(keys: np.ndarray, sieve: Sieve) -> np.ndarray:
    """Which keys are listed as too heavy, or told apart from no such key."""
    if not len(sieve.heavy):
        return np.zeros(len(keys), bool)
    told = sieve.part_of(keys) << np.uint64(32) | keys & LAST
    at = np.minimum(np.searchsorted(sieve.heavy, told), len(sieve.heavy) - 1)
    return sieve.heavy[at] == told


def passes(keys: np.ndarray, sieve: Sieve) -> np.ndarray:
    """Which keys may be shared."""
    part, good = sieve.part_of(keys), np.ones(len(keys), bool)
    starts, sizes = sieve.starts[part], sieve.sizes[part]
    for k in range(HASHES):
        cell = starts + _cell(keys, k, sizes)
        byte = sieve.bits[cell >> np.uint64(3)]
        good &= (byte >> (np.uint8(7) - (cell & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
    return good


def row_keys(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """One key per row from some long columns."""
    total = np.zeros(batch.num_rows, np.uint64)
    for name in columns:
        value = batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
        total = mixed(total * np.uint64(3) + value.view(np.uint64))
    return total


def filter_of(wanted: DataFrame, columns: list[str]) -> Sieve:
    """The filter of all rows of ``wanted``, by some long columns that are never null."""

    def keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        found = np.unique(row_keys(batch, columns))
        return found, np.ones(len(found), bool)

    return shared_filter(wanted.select(*columns), keys)


def semi_join(df: DataFrame, wanted: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``df`` that ``wanted`` has by some long columns, never null.

    Most others go where they are read; only what is left is shuffled.
    """
    table = df.sparkSession.sparkContext.broadcast(filter_of(wanted, columns))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(row_keys(batch, columns), table.value)))

    left = df.mapInArrow(keep, df.schema)
    return left.hint("merge").join(wanted.select(*columns), columns, "left_semi")
