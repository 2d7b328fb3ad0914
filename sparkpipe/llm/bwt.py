"""Suffix-array deduplication by merging Burrows-Wheeler transforms.

The question: which bytes of a document lie in a string of ``LENGTH`` bytes that also
starts in a document with a smaller id?

Texts are cut so that equal strings meet. The windows of ``LENGTH`` bytes that share
their lowest hash of ``ANCHOR`` consecutive bytes with the windows next to them form a
piece, and pieces go by that hash: equal windows lie in pieces of the same group, so a
group decides about its windows alone. Pieces whose hash occurs in one document only
are dropped first. A hash whose pieces may exceed ``MERGE`` bytes, say because many
documents carry one passage with other text around it, is crowded: its windows go by
their own hash instead, and those that occur in one document only are dropped as well.

The pieces of some groups are divided into shards, and each shard's suffixes are sorted
and give its Burrows-Wheeler transform. The transforms are merged by refining an
interleave: it starts as shard after shard, and one pass, which reads the transforms in
the interleave's order and deals them out by symbol, turns an order by h symbols into one
by h + 1. Entries whose first h symbols differ are kept apart by boundaries, carried
along; the pass that sets a boundary is the longest common prefix of the two entries it
parts. After ``LENGTH`` passes the intervals without a boundary are the repeated strings,
and the smallest document in each decides for the others. No suffixes of different
shards are ever compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from sparkpipe.llm import sieve
from sparkpipe.llm.frames import few_at_a_time, id_and_text, mixed, written

LENGTH = 50
ANCHOR = 20
TOGETHER = 1 << 16  # bytes of text that are hashed at a time; their hashes stay in the cache
SHARD = 1 << 14  # bytes of a shard
AT_ONCE = 4 << 20  # bytes of pieces that are compared before they are sent
MERGE = 1 << 19  # bytes of a whole group; more are crowded
LOT = 1 << 16  # bytes from which on whole groups are merged
MARKED = 200_000  # marks that are held at a time
STEP = 5  # bytes between the strings by which pieces are told to have none in common
END = 0  # symbol of a string's end; bytes are symbols 1 to 256
BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
PIECES = np.dtype(
    [
        ("key", "<u8"),
        ("doc", "<i8"),
        ("row", "<i8"),
        ("start", "<u4"),
        ("to", "<u4"),  # where the last window ends; a run of one window has a longer stretch
        ("n", "<u4"),
    ]
)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(0xD6E8FEB86659FD93, n, 1 << 64))


def hashes_of(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` bytes."""
    hashes, held = [BYTE[data]], 1
    while held * 2 <= length:  # hashes of 1, 2, 4, 8, 16 bytes
        last = hashes[-1]
        hashes.append(last[:-held] * _power(held) + last[held:])
        held *= 2
    value, at = hashes[-1], held
    for k in reversed(range(len(hashes) - 1)):
        if (length - held) >> k & 1:
            size = len(hashes[k]) - at
            value = value[:size] * _power(1 << k) + hashes[k][at:]
            at += 1 << k
    return mixed(value)


def window_keys(data: np.ndarray) -> np.ndarray:
    """For each window of ``LENGTH`` bytes the lowest hash of its anchors."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    low, wide, window = hashes_of(data, ANCHOR), 1, LENGTH - ANCHOR + 1
    while wide * 2 <= window:
        low = np.minimum(low[:-wide], low[wide:])
        wide *= 2
    if wide < window:
        low = np.minimum(low[: n], low[window - wide : window - wide + n])
    return low[:n]


def cut(
    texts: list[bytes], table: sieve.Sieve | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pieces of some texts: key, text number, first window, number of windows, crowded.

    Windows whose key is heavy in ``table`` go by their own hash, and equal ones next to
    each other together.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    keys = window_keys(data)
    none = np.zeros(0, np.int64)
    if not len(keys):
        return keys, none, none, none, none.astype(bool)
    crowded = np.zeros(len(keys), bool)
    if table is not None and len(table.heavy):
        # Windows next to each other mostly have one key, so each run is looked up once.
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        many = sieve.is_heavy(mixed(keys[first]), table)
        crowded = np.repeat(many, np.diff(np.append(first, len(keys))))
        if many.any():
            # Only the stretches that crowded windows cover are hashed.
            change = np.zeros(len(data) + 1, np.int32)
            np.add.at(change, first[many], 1)
            np.add.at(change, np.append(first[1:], len(keys))[many] + LENGTH - 1, -1)
            inside = np.cumsum(change[:-1]) > 0
            place = np.cumsum(inside) - 1
            keys[crowded] = hashes_of(data[inside], LENGTH)[place[: len(keys)][crowded]]
    # A window must not cross into the next text.
    change = np.zeros(len(keys) + 1, np.int64)
    np.add.at(change, np.minimum(begins[:-1], len(keys)), 1)
    np.add.at(change, np.minimum(begins[:-1] + np.maximum(0, sizes - LENGTH + 1), len(keys)), -1)
    at = np.flatnonzero(np.cumsum(change[:-1]))
    if not len(at):
        return keys[:0], none, none, none, none.astype(bool)
    values = keys[at]
    text = np.searchsorted(begins, at, "right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    # Lowest hashes crowd among the low values; scrambled, their first bits are even.
    return mixed(values[first]), text[first], at[first] - begins[text[first]], n, crowded[at[first]]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Document ids, row keys and texts of a batch, about ``TOGETHER`` bytes at a time.

    Equal rows are left out after the first; so are rows without an id.
    """
    docs, rows, texts, size, seen = [], [], [], 0, set()
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        if doc_id is None or not text:
            continue
        data = text.encode()
        row = row_key(data)
        if (doc_id, row) in seen:
            continue
        seen.add((doc_id, row))
        docs.append(doc_id)
        rows.append(row)
        texts.append(data)
        size += len(data)
        if size >= TOGETHER:
            yield docs, rows, texts
            docs, rows, texts, size = [], [], [], 0
    if texts:
        yield docs, rows, texts


def row_key(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def keys_of(
    batch: pa.RecordBatch, table: sieve.Sieve | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct piece keys of a batch, which occur in two of its documents, their bytes.

    With ``table`` the crowded windows' keys instead.
    """
    keys, docs, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for ids, _, texts in _texts(batch):
        key, text, _, n, crowded = cut(texts, table)
        if table is not None:
            key, text, n = key[crowded], text[crowded], n[crowded]
        keys.append(key)
        docs.append(np.array(ids, np.int64)[text])
        sizes.append(n + LENGTH - 1)
    key, doc, size = np.concatenate(keys), np.concatenate(docs), np.concatenate(sizes)
    order = np.argsort(key)
    key, doc, size = key[order], doc[order], size[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
    if not len(first):
        return key, np.zeros(0, bool), size
    twice = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
    return key[first], twice, np.add.reduceat(size, first)


def crowded_keys_of(
    batch: pa.RecordBatch, table: sieve.Sieve
) -> tuple[np.ndarray, np.ndarray]:
    return keys_of(batch, table)[:2]


def sort_suffixes(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The order of all suffixes of strings that end in ``END``, by prefix doubling.

    ``left`` counts the symbols from each place to its string's end, that included.
    Suffixes that are equal to their ends keep the order of their strings.
    """
    n, h = len(symbols), 1
    rank = symbols.astype(np.int64)
    longest = int(left.max(initial=0))
    padded = np.zeros(n + 6, np.int64)
    padded[:n] = rank
    key = np.zeros(n, np.int64)
    for k in range(6):  # six symbols of nine bits, nothing after the end
        key = key << 9 | np.where(left > k, padded[k : k + n], 0)
    h = 6
    rank = np.unique(key, return_inverse=True)[1] + 1
    while h < longest and rank.max() < n:
        after = np.zeros(n, np.int64)
        after[: n - h] = rank[h:]
        after[left <= h] = 0
        rank = np.unique(rank * (n + 2) + after, return_inverse=True)[1] + 1
        h *= 2
    return np.argsort(rank, kind="stable")


def merge(
    transforms: list[np.ndarray], strings: list[int], depth: int
) -> tuple[np.ndarray, np.ndarray]:
    """Interleave the transforms of shards by the first ``depth`` symbols of each suffix.

    Returns the shard of each entry and the longest common prefix of each entry with
    the one before, ``depth`` standing for that or more. ``strings`` counts the strings
    of each shard: the entries for their ends stay in shard order, everything else
    follows from the transforms.
    """
    sizes = [len(t) for t in transforms]
    number = np.arange(len(sizes), dtype=np.uint8 if len(sizes) <= 256 else np.uint32)
    shard, ends = np.repeat(number, sizes), np.repeat(number, strings)
    symbols = np.concatenate(transforms)
    n = len(symbols)
    block = np.zeros(n, np.int32)  # entries agreeing in the symbols seen so far
    # Symbols that are dealt out lie in the same order after every pass.
    in_order = np.sort(symbols)
    parted = in_order[1:] != in_order[:-1]
    prefix = np.zeros(n, np.int16)
    read = np.empty(n, symbols.dtype)
    new = np.ones(n, bool)
    for _ in range(depth):
        read[np.argsort(shard, kind="stable")] = symbols
        dealt = np.argsort(read, kind="stable")
        before = block[dealt]
        shard = shard[dealt]
        shard[: len(ends)] = ends
        np.not_equal(before[1:], before[:-1], out=new[1:])
        new[1:] |= parted
        # Ends are alike at first and told apart by nothing but their strings.
        new[1 : len(ends)] = False
        prefix += ~new  # a boundary stays once it is set
        block = np.cumsum(new, dtype=np.int32)
    return shard, prefix


def smallest_docs(strings: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For each string and window, the smallest document of any string with that window."""
    order, texts, places = [], [], []
    transforms, counts = [], []
    begin = 0
    while begin < len(strings):
        end, size = begin, 0
        while end < len(strings) and (end == begin or size + len(strings[end]) < SHARD):
            size += len(strings[end]) + 1
            end += 1
        own = strings[begin:end]
        lengths = np.array([len(s) + 1 for s in own], np.int64)
        symbols = np.frombuffer(b"".join(s + b"\0" for s in own), np.uint8).astype(np.uint16) + 1
        last = np.cumsum(lengths) - 1
        symbols[last] = END
        text = np.repeat(np.arange(len(own)), lengths)
        place = np.arange(len(symbols)) - (last - lengths + 1)[text]
        suffixes = sort_suffixes(symbols, lengths[text] - place)
        previous = symbols[suffixes - 1]
        previous[place[suffixes] == 0] = END
        transforms.append(previous)
        counts.append(len(own))
        order.append(suffixes)
        texts.append(text + begin)
        places.append(place)
        begin = end
    shard, prefix = merge(transforms, counts, LENGTH)
    text, place = np.empty(len(shard), np.int64), np.empty(len(shard), np.int64)
    back = np.argsort(shard, kind="stable")
    text[back] = np.concatenate([t[o] for t, o in zip(texts, order)])
    place[back] = np.concatenate([p[o] for p, o in zip(places, order)])
    sizes = np.array([len(s) for s in strings], np.int64)
    whole = place + LENGTH <= sizes[text]
    interval = np.flatnonzero(prefix < LENGTH)
    doc = np.where(whole, docs[text], np.iinfo(np.int64).max)
    low = np.minimum.reduceat(doc, interval)
    low = np.repeat(low, np.diff(np.append(interval, len(doc))))
    text, place, low = text[whole], place[whole], low[whole]
    by_text = np.lexsort((place, text))
    return np.split(low[by_text], np.cumsum(np.maximum(0, sizes - LENGTH + 1))[:-1])


def _joined(
    owner: np.ndarray, start: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches by owner and start, those of one owner joined where they touch."""
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    # Counted on from owner to owner, no stretch touches one of another owner.
    shift = owner * (int(end.max(initial=0)) + 2)
    reach = np.maximum.accumulate(end + shift)
    new = np.flatnonzero(np.append(True, (start + shift)[1:] > reach[:-1]))
    last = np.append(new[1:], len(owner)) - 1
    return owner[new], start[new], (reach - shift)[last]


class _Marks:
    """Removed stretches by row."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, doc: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        if len(doc):
            self.held.append((doc, row, start, end))
            self.n += len(doc)

    def batch(self, parts: int = 1) -> pa.RecordBatch:
        """A row per document row, spread over ``parts``."""
        if not self.held:
            return _rows()
        doc, row, start, end = (np.concatenate(x) for x in zip(*self.held))
        names = np.empty(len(doc), [("doc", "<i8"), ("row", "<i8")])
        names["doc"], names["row"] = doc, row
        order = np.lexsort((row, doc))
        new = np.append(True, names[order][1:] != names[order][:-1])
        owner = np.empty(len(doc), np.int64)
        owner[order] = np.cumsum(new) - 1
        names = names[order[new]]
        owner, start, end = _joined(owner, start.astype(np.int64), end.astype(np.int64))
        data = np.stack([start, end], 1).astype("<u4").tobytes()
        cuts = (8 * np.searchsorted(owner, np.arange(len(names) + 1))).tolist()
        return _rows(
            docs=names["doc"],
            rows=names["row"],
            marks=[data[a:b] for a, b in zip(cuts[:-1], cuts[1:])],
            parts=(names["row"] % parts).astype(np.int32),
        )


def _rows(docs=(), rows=(), marks=(), parts=(), pieces=(), text=()) -> pa.RecordBatch:
    n = len(docs) or len(parts)
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary())
    columns = zip((docs, rows, marks, parts, pieces, text), kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) if len(c) else pa.nulls(n, k) for c, k in columns],
        ["doc_id", "row", "marks", "part", "pieces", "text"],
    )


SENT = "doc_id long, row long, marks binary, part int, pieces binary, text binary"


def _packed(index: np.ndarray, text: list[bytes]) -> tuple[bytes, bytes]:
    """Pieces as they are sent: the first bytes of all numbers, then the second, and so on."""
    planes = [np.ascontiguousarray(index[c]).view(np.uint8).reshape(len(index), -1).T.tobytes() for c in PIECES.names]
    squeeze = pa.Codec("zstd", 1).compress
    size = len(index).to_bytes(4, "little")
    return size + squeeze(b"".join(planes), asbytes=True), squeeze(b"".join(text), asbytes=True)


def _unpacked(pieces: bytes, text: bytes) -> tuple[np.ndarray, bytes]:
    n, at = int.from_bytes(pieces[:4], "little"), 0
    index, expand = np.empty(n, PIECES), pa.Codec("zstd").decompress
    data = np.frombuffer(expand(pieces[4:], n * PIECES.itemsize, asbytes=True), np.uint8)
    for name in PIECES.names:
        width = PIECES[name].itemsize
        plane = data[at : at + n * width].reshape(width, n)
        index[name] = np.ascontiguousarray(plane.T).view(PIECES[name])[:, 0]
        at += n * width
    return index, expand(text, int(index["n"].sum(dtype=np.int64)), asbytes=True)


def _lowest_only(
    index: np.ndarray, data: list[bytes], marks: _Marks
) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Of equal pieces those of the smallest document; the rest is marked.

    Whatever windows a piece has, they also start in the smallest document's. Returns the
    strings' numbers by piece, the strings, and which pieces are left.
    """
    known: dict[bytes, int] = {}
    number = np.fromiter((known.setdefault(d, len(known)) for d in data), np.int64, len(data))
    low = np.full(len(known), np.iinfo(np.int64).max)
    np.minimum.at(low, number, index["doc"])
    lowest = index["doc"] == low[number]
    lost = index[~lowest]
    marks.add(lost["doc"], lost["row"], lost["start"], lost["to"])
    return number, list(known), lowest


def send_pieces(
    batches: Iterator[pa.RecordBatch], table: sieve.Sieve, windows: sieve.Sieve | None = None
) -> Iterator[pa.RecordBatch]:
    """Shared pieces in parts by their keys; of equal ones sent together only the lowest.

    ``windows`` is the filter of the crowded windows.
    """
    parts = len(table.sizes)

    def sent(held: list[np.ndarray], data: list[bytes]) -> Iterator[pa.RecordBatch]:
        marks, index = _Marks(), np.concatenate([np.zeros(0, PIECES), *held])
        _, _, lowest = _lowest_only(index, data, marks)
        if marks.held:
            yield marks.batch(parts)
        order = np.flatnonzero(lowest)
        if not len(order):
            return
        order = order[np.argsort(index["key"][order])]
        index = index[order]
        cuts = np.searchsorted(table.part_of(index["key"]), np.arange(parts + 1))
        order = order.tolist()
        spans = [(p, a, b) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        packed = [_packed(index[a:b], [data[i] for i in order[a:b]]) for _, a, b in spans]
        pieces, text = zip(*packed)
        yield _rows(parts=[p for p, _, _ in spans], pieces=pieces, text=text)

    held, data, size = [], [], 0
    for batch in batches:
        for ids, rows, texts in _texts(batch):
            key, text, start, n, crowded = cut(texts, table)
            good = sieve.passes(key, table) & ~crowded
            if crowded.any():
                good[crowded] = sieve.passes(key[crowded], windows)
            text, start = text[good], start[good]
            index = np.empty(len(text), PIECES)
            index["key"], index["start"], index["to"] = key[good], start, start + n[good] + LENGTH - 1
            index["doc"], index["row"] = np.array(ids, np.int64)[text], np.array(rows, np.int64)[text]
            end = np.where(crowded[good], start + LENGTH, index["to"])
            index["n"] = end - start
            held.append(index)
            data += [texts[t][a:b] for t, a, b in zip(text.tolist(), start.tolist(), end.tolist())]
            size += int(index["n"].sum(dtype=np.int64))
            if size >= AT_ONCE:
                yield from sent(held, data)
                held, data, size = [], [], 0
    yield from sent(held, data)


def judge_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mark the windows of a part's pieces that a smaller document also has.

    Marks that come along are passed on.
    """
    indexes, texts = [np.zeros(0, PIECES)], []
    for batch in batches:
        yield batch.filter(pc.is_valid(batch.column("marks")))
        batch = batch.filter(pc.is_valid(batch.column("pieces")))
        for pieces, text in zip(batch.column("pieces"), batch.column("text")):
            index, text = _unpacked(pieces.as_py(), text.as_py())
            indexes.append(index)
            texts.append(text)
    # Only the pieces of some keys at a time become objects.
    index, text = np.concatenate(indexes), b"".join(texts)
    del indexes, texts
    ends = np.cumsum(index["n"], dtype=np.int64)
    order = np.argsort(index["key"])
    sizes = np.cumsum(index["n"][order], dtype=np.int64)
    keys = index["key"][order]
    cuts = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)) if len(keys) else []
    marks, begin, done = _Marks(), 0, 0
    for end in cuts:
        if sizes[end - 1] - done < AT_ONCE and end < len(keys):
            continue
        some = order[begin:end]
        stops = ends[some]
        spans = zip((stops - index["n"][some]).tolist(), stops.tolist())
        _judge(index[some], [text[a:b] for a, b in spans], marks)
        begin, done = end, sizes[end - 1]
        if marks.n >= MARKED:
            yield marks.batch()
            marks = _Marks()
    yield marks.batch()


def _judge(index: np.ndarray, data: list[bytes], marks: _Marks) -> None:
    """Judge all pieces of some keys, which are sorted."""
    number, strings, lowest = _lowest_only(index, data, marks)
    index, number = index[lowest], number[lowest]
    keys, docs = np.zeros(len(strings), np.uint64), np.zeros(len(strings), np.int64)
    keys[number], docs[number] = index["key"], index["doc"]
    good = _with_partners(strings, keys)
    found = []
    for lot in _lots(good, keys, strings):
        lows = smallest_docs([strings[i] for i in lot], docs[lot])
        sizes = np.array([len(x) for x in lows], np.int64)
        hit = np.concatenate(lows) < np.repeat(docs[lot], sizes)
        begins = np.cumsum(sizes) - sizes
        inside = np.append(hit[1:] & hit[:-1], False)
        inside[begins[1:] - 1] = False  # windows of two strings are not neighbours
        last = np.flatnonzero(hit & ~inside)
        first = np.flatnonzero(hit & ~np.append(False, inside[:-1]))
        at = np.searchsorted(begins, first, "right") - 1
        found.append((lot[at], first - begins[at], sizes[at] - 1 - (last - begins[at])))
    if not found:
        return
    string, first, left = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(string, kind="stable")
    string, first, left = string[order], first[order], left[order]
    # Each piece of a string gets its stretches.
    begins = np.searchsorted(string, number)
    n = np.searchsorted(string, number, "right") - begins
    piece = np.repeat(np.arange(len(number)), n)
    which = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n) + begins[piece]
    some = index[piece]
    start, to = some["start"].astype(np.int64), some["to"].astype(np.int64)
    marks.add(some["doc"], some["row"], start + first[which], to - left[which])


def _with_partners(strings: list[bytes], keys: np.ndarray) -> np.ndarray:
    """Which strings, each of a different content, may share a window with one of their key.

    A window that starts l bytes before its anchor holds, for the multiple m of ``STEP``
    at or below l, the ``LENGTH - STEP + 1`` bytes from m bytes before the anchor on. So
    pieces with a window in common have such a string in common, at the same m. Only equal
    hashes of these let a piece pass; a clash of two hashes costs no more than a merge.
    """
    _, group, n = np.unique(keys, return_inverse=True, return_counts=True)
    several = np.flatnonzero(n[group] > 1)
    if not len(several):
        return several
    keys, data = keys[several], b"".join([strings[i] for i in several.tolist()])
    sizes = np.fromiter((len(strings[i]) for i in several.tolist()), np.int64, len(several))
    begins, data = np.cumsum(sizes) - sizes, np.frombuffer(data, np.uint8)
    anchors, part = hashes_of(data, ANCHOR), LENGTH - STEP + 1
    piece = np.repeat(np.arange(len(several)), sizes)[: len(anchors)]
    at = np.flatnonzero(mixed(anchors) == keys[piece])
    piece, hashes = piece[at], hashes_of(data, part)
    place = at - begins[piece]
    found = []
    for before in range(0, LENGTH - ANCHOR + 1, STEP):
        inside = (place >= before) & (place - before + part <= sizes[piece])
        own = piece[inside]
        told = keys[own] + np.uint64(before)
        found.append((mixed(hashes[at[inside] - before] ^ mixed(told)), own))
    string, piece = (np.concatenate(x) for x in zip(*found))
    if not len(string):
        return several[:0]
    order = np.argsort(string)
    string, piece = string[order], piece[order]
    first = np.flatnonzero(np.append(True, string[1:] != string[:-1]))
    shared = np.minimum.reduceat(piece, first) != np.maximum.reduceat(piece, first)
    good = np.zeros(len(several), bool)
    good[piece[np.repeat(shared, np.diff(np.append(first, len(piece))))]] = True
    return several[good]


def _lots(good: np.ndarray, keys: np.ndarray, strings: list[bytes]) -> Iterator[np.ndarray]:
    """Strings by whole groups of equal keys, fewer than ``LOT`` and ``MERGE`` bytes at a time.

    A group of one string has nothing to be merged with.
    """
    good = good[np.argsort(keys[good], kind="stable")]
    keys = keys[good]
    cuts = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)).tolist()
    out, size, begin = [], 0, 0
    for end in cuts if len(keys) else []:
        group, begin = good[begin:end], end
        if len(group) == 1:
            continue
        out.append(group)
        size += sum(len(strings[i]) for i in group.tolist())
        if size >= LOT:
            yield np.concatenate(out)
            out, size = [], 0
    if out:
        yield np.concatenate(out)


def spans_of(marks: list[bytes]) -> np.ndarray:
    """The marked stretches of a text, joined where they touch: rows of start, end."""
    found = np.concatenate([np.frombuffer(m, "<u4").reshape(-1, 2) for m in marks]).astype(np.int64)
    found = found[np.argsort(found[:, 0], kind="stable")]
    reach = np.maximum.accumulate(found[:, 1])
    new = np.flatnonzero(np.concatenate([[True], found[1:, 0] > reach[:-1]]))
    return np.stack([found[new, 0], np.append(reach[new[1:] - 1], reach[-1])], 1)


DEDUPED = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans removed, kept (the rest).

    Spans are byte offsets, end exclusive, maximal, judged on the texts as given. A
    null text is empty. Rows with a null id are neither smaller nor larger than others
    and keep all; rows with equal ids do not affect each other; equal rows get equal
    answers. An empty table gives an empty result; other columns are ignored.

    Of equal pieces only one per ``AT_ONCE`` bytes is sent, so a passage that a third of
    all documents share costs few rows. Pieces and texts travel
    packed; texts are shuffled once, to meet their marks.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    shared = sieve.shared_filter(rows, keys_of, MERGE)
    table = spark.sparkContext.broadcast(shared)
    windows = None
    if len(shared.heavy):
        single = sieve.shared_filter(rows, lambda batch: crowded_keys_of(batch, table.value))
        windows = spark.sparkContext.broadcast(single)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from send_pieces(batches, table.value, windows and windows.value)

    def judge(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        yield from judge_pieces(batches)

    judged = rows.mapInArrow(send, SENT).groupBy("part").applyInArrow(judge, SENT)
    marks = written(judged.select("doc_id", "row", "marks"), "bwt-marks")
    marks = marks.groupBy("doc_id", "row").agg(F.collect_list("marks").alias("marks"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = pa.Codec("zstd", 1).compress
        for batch in batches:
            keys, packed = [], []
            for text in few_at_a_time(batch.column(1)):
                data = text.encode() if text else b""
                keys.append(row_key(data) if data else None)
                packed.append(len(data).to_bytes(8, "little") + squeeze(data, asbytes=True) if data else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary()), pa.array(keys, pa.int64())],
                ["doc_id", "packed", "row"],
            )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = pa.Codec("zstd").decompress
        for batch in batches:
            out = []
            for packed, marks in zip(few_at_a_time(batch.column(1)), few_at_a_time(batch.column(2))):
                data, spans = b"", []
                if packed:
                    data = expand(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)
                kept, at = [], 0
                if marks:
                    spans = spans_of(marks).tolist()
                for start, end in spans:
                    kept.append(data[at:start])
                    at = end
                kept.append(data[at:])
                out.append(
                    (len(data), [{"start": a, "end": b} for a, b in spans], b"".join(kept))
                )
            kinds = (
                pa.int64(),
                pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                pa.binary(),
            )
            columns = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    numbered = rows.mapInArrow(number, "doc_id long, packed binary, row long")
    met = numbered.hint("merge").join(marks, ["doc_id", "row"], "left")
    return met.select("doc_id", "packed", "marks").mapInArrow(apply, DEDUPED)


def repeats_digest(deduped: DataFrame) -> DataFrame:
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"]
    )
    return deduped.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
