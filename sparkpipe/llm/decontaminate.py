"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words; masked-out words are ignored, so a
passage with some words replaced still shares a seed's hash with the original wherever
the replaced words fall on ignored positions. Hashes of all benchmark positions are
joined with those of all document positions; each hit fixes an alignment, along which
the longest stretch with few enough substitutions is verified word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkpipe.llm.frames import id_and_text, mixed, word_hashes, written

# Seeds of which six words count. Every stretch with ten or more equal words
# and eight in ten equal has a hit: one of more than 25 words holds a shorter such stretch
# (a half of it), and for the others the tests go through all substitutions.
SEEDS = ("1101111", "111010011", "11100100011")
SEEDS_FIND = 10, 8  # equal words at least, and in ten
SHORTEST = 5  # benchmark items of fewer words are found where they are a whole text
FOUND = "doc_id long, text_hash long, item_id long, matched int, length int, doc_word int, item_word int"
SIEVE_BITS = 22


def words_of(text: str) -> np.ndarray:
    return word_hashes(text.encode().lower().split())


def masks_for(least: int, tenths: int) -> tuple[str, ...]:
    """Seeds that hit every overlap of ``least`` equal words, ``tenths`` in ten equal.

    Looser overlaps than ``SEEDS`` find are found by the run of equal words that the
    substitutions must leave: m equal words and at most m (10 - tenths) / tenths others
    have a run as long as the mean of all runs, which grows with m.
    """
    if least >= SEEDS_FIND[0] and tenths >= SEEDS_FIND[1]:
        return SEEDS
    run = -(-least * tenths // (least * (10 - tenths) + tenths)) if tenths else 1
    return ("1" * max(1, run),)


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """A hash for each position of ``mask`` along ``words``."""
    n = len(words) - len(mask) + 1
    total = np.full(max(0, n), hash_of(mask), np.uint64)
    for k, on in enumerate(mask if n > 0 else ""):
        if on == "1":
            total = mixed(total * np.uint64(3) + words[k : k + n])
    return total


def hash_of(mask: str) -> np.uint64:
    return np.uint64(int("1" + mask, 2))


@dataclass
class Block:
    """A bounded part of the benchmark: its items and where each seed hash occurs."""

    ids: list[int] = field(default_factory=list)
    items: list[np.ndarray] = field(default_factory=list)
    least: int = SEEDS_FIND[0]
    masks: tuple[str, ...] = SEEDS
    anywhere: int = SHORTEST  # words from which an item may be a part of a text
    whole: set[str] = field(default_factory=set)  # masks of items that are whole texts only
    hashes: np.ndarray = None  # sorted
    item: np.ndarray = None
    place: np.ndarray = None
    sieve: np.ndarray = None

    def close(self) -> Block:
        """Index all positions. An item of too few words for an overlap is its own seed."""
        seeds = self.masks
        short = {"1" * len(x) for x in self.items if len(x) < self.least}
        self.masks = (*seeds, *sorted(short.difference(seeds)))
        self.whole = {m for m in short.difference(seeds) if len(m) < self.anywhere}
        hashes, item, place = [], [], []
        for k, words in enumerate(self.items):
            own = seeds if len(words) >= self.least else ("1" * len(words),)
            for mask in own:
                found = seed_hashes(words, mask)
                hashes.append(found)
                item.append(np.full(len(found), k))
                place.append(np.arange(len(found)))
        hashes = np.concatenate(hashes)
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.item = np.concatenate(item)[order]
        self.place = np.concatenate(place)[order]
        self.sieve = np.zeros(1 << SIEVE_BITS, bool)
        self.sieve[self.hashes >> np.uint64(64 - SIEVE_BITS)] = True
        return self


def blocks(
    benchmark: DataFrame, id_col: str, text_col: str, words: int, least: int, tenths: int,
    anywhere: int = SHORTEST,
) -> Iterator[Block]:
    """The benchmark in blocks of about ``words`` words; a block holds at least one item."""
    rows = id_and_text(benchmark, id_col, text_col).dropna().distinct()

    def new() -> Block:
        return Block(least=least, masks=masks_for(least, tenths), anywhere=anywhere)

    block, size = new(), 0
    for row in written(rows, "benchmark").toLocalIterator():
        item = words_of(row["text"])
        if not len(item):
            continue
        block.ids.append(row["doc_id"])
        block.items.append(item)
        size += len(item)
        if size >= words:
            yield block.close()
            block, size = new(), 0
    if block.ids:
        yield block.close()


def alignments(words: np.ndarray, block: Block) -> Iterator[tuple[int, int]]:
    """Distinct (item, shift) of all seed hits; shift is document less item position.

    Hits are expanded a bounded number at a time, so a text that repeats one word
    over and over costs time, not memory.
    """
    seen: set[tuple[int, int]] = set()
    for mask in block.masks:
        if mask in block.whole and len(mask) != len(words):
            continue
        hashes = seed_hashes(words, mask)
        at = np.flatnonzero(block.sieve[hashes >> np.uint64(64 - SIEVE_BITS)])
        first = np.searchsorted(block.hashes, hashes[at], "left")
        last = np.searchsorted(block.hashes, hashes[at], "right")
        for start in range(0, len(at), 4096):
            part = slice(start, start + 4096)
            n = last[part] - first[part]
            for lower in range(0, int(n.max(initial=0)), 64):
                for offset in range(lower, min(lower + 64, int(n.max()))):
                    rows = np.flatnonzero(n > offset)
                    hit = first[part][rows] + offset
                    pairs = zip(
                        block.item[hit].tolist(), (at[part][rows] - block.place[hit]).tolist()
                    )
                    for pair in pairs:
                        if pair not in seen:
                            seen.add(pair)
                            yield pair


def longest_stretch(same: np.ndarray, tenths: int) -> tuple[int, int, int]:
    """(matches, start, end) of the longest stretch with enough matches.

    Enough is ``tenths`` in ten. Scoring a match 10 - tenths and a substitution
    -tenths, a stretch has enough if its sum is not negative, so the longest one ends
    at the last prefix sum that is no lower than some earlier one. Linear time.
    """
    if not same.any():
        return 0, 0, 0
    sums = np.concatenate([[0], np.cumsum(np.where(same, 10 - tenths, -tenths))])
    low = np.minimum.accumulate(sums)  # lowest sum up to each place
    high = np.maximum.accumulate(sums[::-1])[::-1]  # highest from each place on
    i = j = 0
    best = (0, 0, 0)
    while j < len(sums):
        if high[j] >= low[i]:
            if j - i > best[2] - best[1]:
                best = (0, i, j)
            j += 1
        else:
            i += 1
    _, start, end = best
    inside = np.flatnonzero(same[start:end])
    if not len(inside):
        return 0, 0, 0
    return len(inside), start + int(inside[0]), start + int(inside[-1]) + 1


def overlaps(
    words: np.ndarray, block: Block, least: int, tenths: int
) -> dict[int, tuple[int, int, int, int]]:
    """For each item that is found: (matched, length, document word, item word)."""
    found: dict[int, tuple[int, int, int, int]] = {}
    for k, shift in alignments(words, block):
        item = block.items[k]
        if len(item) < block.anywhere and len(item) != len(words):
            continue
        start, end = max(0, -shift), min(len(item), len(words) - shift)
        same = words[start + shift : end + shift] == item[start:end]
        matched, low, high = longest_stretch(same, tenths)
        if matched >= min(least, len(item)):
            new = (matched, high - low, start + shift + low, start + low)
            found[k] = max(found.get(k, new), new, key=lambda x: (x[0], -x[1], -x[2], -x[3]))
    return found


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = 10,
    tenths: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = 2_000_000,
    anywhere: int = SHORTEST,
) -> DataFrame:
    """One row per document row and benchmark item found in it, by its best overlap.

    An overlap is an aligned stretch of at least ``least`` equal words (all words of a
    shorter item) with at least ``tenths`` equal words in ten, words compared in ASCII
    lower case. An item of fewer than ``anywhere`` words is found where it is all words of
    a text; with 1, it is found anywhere. Null or empty texts overlap with nothing; items
    without words or an id are left out; equal items count once; a null document id stays
    null and equal documents give equal rows, which ``text_hash`` tells from others of the
    same id. Other columns are ignored.

    The benchmark is gone through in blocks of bounded size, each sent to all tasks and
    met with all documents, so it may be of any size. Documents are never shuffled.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    parts = []
    for block in blocks(benchmark, item_id_col, item_text_col, block_words, least, tenths, anywhere):
        sent = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for batch in batches:
                out = []
                for doc_id, text, mark in zip(*(c.to_pylist() for c in batch.columns)):
                    words = words_of(text or "")
                    for k, best in overlaps(words, block, least, tenths).items():
                        out.append((doc_id, mark, block.ids[k], *best))
                if out:
                    kinds = [pa.int64()] * 3 + [pa.int32()] * 4
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                        ["doc_id", "text_hash", "item_id", "matched", "length", "doc_word", "item_word"],
                    )

        parts.append(rows.mapInArrow(search, FOUND))
    if not parts:
        return spark.createDataFrame([], FOUND)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def clean_documents(
    docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without an overlap, judged row by row.

    Rows go by id and text hash: one that shares its id with a text that overlaps stays,
    and a row with a null id goes if its own text overlaps.
    """
    hit = found.select(F.col("doc_id").alias("_hit"), F.col("text_hash").alias("_hash")).distinct()
    same = docs[id_col].cast("long").eqNullSafe(hit["_hit"]) & (F.xxhash64(docs[text_col]) == hit["_hash"])
    return docs.join(hit, same, "left_anti")
