"""Periodic runs of words: stretches that repeat themselves several times in a row.

A run has a smallest period q, at least ``repeats`` times q words, and no neighbouring
word that would go on with the period. They are found with a suffix automaton. A suffix
of the text so far is a path from its state to the root of the link tree, and each state
remembers where its strings ended last. An appended word accesses the path of the new
prefix, as in a link-cut tree: the path falls into segments of equal last ends, and all
of it takes the new end as its colour. A segment with last end e whose longest string has
l words says that the text up to the new end r has the period r - e for l + (r - e)
words. Where l is at least (repeats - 1) times the distance, that is a run as far as it
has come; it keeps its start and period as further words extend it.

The links are final once the automaton stands, so preferred paths are kept as stacks of
prefixes on heavy paths instead of in splay trees. An access changes segments in amortised
logarithmic number all the same.

Most texts hold no run. Before the automaton, windows of three words with no equal window
near enough are sorted out: inside a run every window recurs at a distance of its period,
which the length of the stretch bounds. What is compared there are hashes, and a clash of
two only lets more through; the automaton works on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from sparkpipe.llm.frames import id_and_text, mixed, window_hashes

LEAST = 6
REPEATS = 4
TOGETHER = 1 << 20  # bytes of text looked at together
ROUNDS = 4  # of narrowing stretches; each is exact

Run = tuple[int, int, int]  # start, length, period


def _automaton(words: list[bytes]) -> tuple[list[int], list[int], list[int]]:
    """Suffix automaton: link and longest string of each state, state of each prefix."""
    step: list[dict[bytes, int]] = [{}]
    link, longest, prefix = [-1], [0], []
    last = 0
    for word in words:
        new = len(link)
        longest.append(longest[last] + 1)
        step.append({})
        link.append(0)
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            there = step[at][word]
            if longest[there] == longest[at] + 1:
                link[new] = there
            else:
                copy = len(link)
                longest.append(longest[at] + 1)
                step.append(step[there].copy())
                link.append(link[there])
                while at >= 0 and step[at].get(word) == there:
                    step[at][word] = copy
                    at = link[at]
                link[there] = link[new] = copy
        prefix.append(new)
        last = new
    return link, longest, prefix


def _heavy_paths(link: list[int], longest: list[int]) -> list[int]:
    """The top state of each state's heavy path in the link tree."""
    order = np.argsort(longest, kind="stable").tolist()
    weight, heavy = [1] * len(link), [-1] * len(link)
    for state in reversed(order[1:]):  # children before parents
        above = link[state]
        weight[above] += weight[state]
        if heavy[above] < 0 or weight[heavy[above]] < weight[state]:
            heavy[above] = state
    top = list(range(len(link)))
    for state in order[1:]:
        if heavy[link[state]] == state:
            top[state] = top[link[state]]
    return top


def runs_of(words: list[bytes], repeats: int = REPEATS, least: int = LEAST) -> list[Run]:
    """All runs of at least ``repeats`` periods and ``least`` words, by start and period."""
    link, longest, prefix = _automaton(words)
    top = _heavy_paths(link, longest)
    # Colours of a heavy path from its lower end to its top: (longest string, last end).
    colours: dict[int, list[tuple[int, int]]] = {}
    found: dict[tuple[int, int], int] = {}
    for end, state in enumerate(prefix):
        periods = {}
        while state > 0:  # access
            head, size = top[state], longest[state]
            path = colours.get(head)
            if path is None:
                colours[head] = [(size, end)]
            else:
                while path:
                    length, before = path[-1]
                    reach = min(length, size)
                    if (repeats - 1) * (end - before) <= reach:
                        # The same end further up is the same string, cut short.
                        periods.setdefault(end - before, reach)
                    if length <= size:
                        path.pop()
                    if length >= size:
                        break
                path.append((size, end))
            state = link[head]
        for period, reach in periods.items():
            found[end - reach - period + 1, period] = end
    runs = [(start, end - start + 1, period) for (start, period), end in found.items()]
    return sorted((r for r in runs if r[1] >= least), key=lambda r: (r[0], r[2]))


def _near(windows: np.ndarray) -> np.ndarray:
    """For each window the distance to the nearest one of the same hash."""
    n = len(windows)
    bits = np.uint64(max(1, n.bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    order = np.sort((windows & ~mask) | np.arange(n, dtype=np.uint64))
    place = (order & mask).astype(np.int64)
    gap = np.where((order[1:] ^ order[:-1]) <= mask, np.diff(place), n + 1)
    near = np.full(n, n + 1)
    near[place[:-1]] = gap
    near[place[1:]] = np.minimum(near[place[1:]], gap)
    return near


def stretches(
    texts: list[list[bytes]], repeats: int = REPEATS, least: int = LEAST
) -> Iterator[tuple[int, int, int]]:
    """Where runs may be: text number, first word, number of words.

    A run lies in one stretch whole, and no word beside the stretch would extend it.
    """
    gram = 3 if repeats >= 3 and least >= 4 else 1
    sizes = np.array([len(t) for t in texts], np.int64)
    total = int(sizes.sum())
    if total < gram:
        return
    hashes = np.fromiter((h for t in texts for h in map(hash, t)), np.int64, total)
    text = np.repeat(np.arange(len(texts)), sizes)
    windows = window_hashes(hashes.view(np.uint64), gram)
    n = len(windows)
    inside = text[:n] == text[gram - 1 :]
    text = text[:n]
    near = _near(mixed(windows + text.astype(np.uint64)))
    good = inside & (near <= sizes[text] // repeats)
    for _ in range(ROUNDS):
        edges = np.diff(np.concatenate([[0], good.view(np.int8), [0]]))
        # Windows of two texts never touch: those across the border are not inside.
        first, after = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        words = after - first + gram - 1
        if gram == 1 and len(first):
            first, after, words = _cut_at_texts(good, text)
        long = words >= least
        first, after, words = first[long], after[long], words[long]
        kept = np.zeros(n, bool)
        at = np.repeat(first - np.cumsum(after - first) + (after - first), after - first)
        at += np.arange(len(at))
        kept[at] = near[at] <= np.repeat(words // repeats, after - first)
        if kept.sum() == good.sum():
            break
        good = kept
    begins = np.cumsum(sizes) - sizes
    for a, b in zip(first.tolist(), words.tolist()):
        t = int(text[a])
        yield t, a - int(begins[t]), b


def _cut_at_texts(good: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of good single words, cut where a text ends."""
    at = np.flatnonzero(good)
    new = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(text[at]) > 0)])
    first = at[new]
    n = np.diff(np.append(np.flatnonzero(new), len(at)))
    return first, first + n, n


def _collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words no run repeats: of each run only the first period counts as its own."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


RUNS = pa.list_(
    pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
)
FOUND = (
    "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
    "collapsed string"
)


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repeats: int = REPEATS,
    least: int = LEAST,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs, collapsed.

    Runs are in words, numbered from 0, by start and period. ``collapsed`` is the text
    without the words that a run holds after its first period, joined by single spaces.

    A null text has no words, as an empty one or one of separators alone. Rows are
    judged one by one, so repeated rows get equal answers and null ids are carried
    along. An empty table gives an empty result; other columns are ignored. Nothing is
    shuffled; a task holds a batch of rows and the automaton of one stretch.
    """
    if repeats < 2:
        raise ValueError("a run has two periods at least")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            yield from _found(batch.column(0), texts, repeats, least)

    return id_and_text(docs, id_col, text_col).mapInArrow(find, FOUND)


def _found(
    ids: pa.Array, texts: pa.Array, repeats: int, least: int
) -> Iterator[pa.RecordBatch]:
    """Rows of the result, about ``TOGETHER`` bytes of text at a time."""
    begin, size = 0, 0
    for end, length in enumerate(pc.binary_length(texts).to_pylist(), 1):
        size += length or 0
        if size < TOGETHER and end < len(texts):
            continue
        words = [(x or b"").split() for x in texts.slice(begin, end - begin).to_pylist()]
        runs: list[list[Run]] = [[] for _ in words]
        for t, first, n in stretches(words, repeats, least):
            some = runs_of(words[t][first : first + n], repeats, least)
            runs[t] += [(first + start, n, q) for start, n, q in some]
        rows = [
            [{"start": s, "length": n, "period": q} for s, n, q in found] for found in runs
        ]
        collapsed = pa.array([_collapsed(w, r) for w, r in zip(words, runs)], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [
                ids.slice(begin, end - begin),
                pa.array([len(w) for w in words], pa.int64()),
                pa.array(rows, RUNS),
                collapsed.cast(pa.string()),
            ],
            ["doc_id", "n_words", "runs", "collapsed"],
        )
        begin, size = end, 0


def runs_digest(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one, and hashes of runs and rest."""
    # Greatest length, then smallest start, then smallest period.
    ranked = F.transform(
        "runs",
        lambda r: F.struct(
            r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
        ),
    )
    best = F.col("best")

    def line(r: Column) -> Column:
        return F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))

    return found.withColumn("best", F.array_max(ranked)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-best["start"]).alias("start"),
        best["length"].alias("length"),
        (-best["period"]).alias("period"),
        F.floor(best["length"] * 1000 / -best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
