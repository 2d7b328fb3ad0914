import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from odd import ROWS, documents, empty, tuples

from sparkpipe.llm import bwt, sieve
from sparkpipe.llm.frames import id_and_text
from sparkpipe.llm.queries import op9_bwt_dedup

SF = "/root/testdata/sf0.001"


def brute(rows):
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - 49 if doc_id is not None else 0):
            window = data[p : p + 50]
            first[window] = min(doc_id, first.get(window, doc_id))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 49 if doc_id is not None else 0):
            if first[data[p : p + 50]] < doc_id:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, x in zip(data, gone) if not x)
        spans = sum(x and not (i and gone[i - 1]) for i, x in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_query_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in op9_bwt_dedup(spark, SF).collect())
    assert got == sorted(brute([tuple(r) for r in docs]))


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh é\0"])
def test_random_documents(spark, letters):
    chance = random.Random(len(letters))
    texts = ["".join(chance.choices(letters, k=chance.randint(0, 300))) for _ in range(40)]
    for _ in range(60):
        a, b = chance.choice(texts), chance.choice(texts)
        i, j = chance.randrange(len(a) + 1), chance.randrange(len(b) + 1)
        texts.append(a[i : i + 120] + b[j : j + 120])
    rows = [(k * 7 % 101, t, "en", "a", 1) for k, t in enumerate(texts)]
    got = bwt.repeats_digest(bwt.remove_repeats(documents(spark, rows)))
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute([r[:2] for r in rows]))


def test_passage_shared_with_different_flanks(spark, monkeypatch):
    """Many documents share a passage, so nearly all send other pieces under one key."""
    chance = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz "
    passage = "".join(chance.choices(letters, k=389))
    rows = []
    for k in range(600):
        a, b = ("".join(chance.choices(letters, k=chance.randint(40, 90))) for _ in range(2))
        text = a + passage + b + "-" * chance.randint(0, 120) + "ab" * chance.randint(0, 60)
        rows.append((k * 7 % 601, text, "en", "a", 1))
    pairs = [r[:2] for r in rows]
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in pairs])
    monkeypatch.setattr(bwt, "MERGE", 1 << 13)
    sizes, merged = [], bwt.smallest_docs

    def watched(strings, docs):
        sizes.append(sum(map(len, strings)))
        return merged(strings, docs)

    monkeypatch.setattr(bwt, "smallest_docs", watched)
    docs = id_and_text(documents(spark, rows), "doc_id", "text")
    table = sieve.shared_filter(docs, bwt.keys_of, bwt.MERGE)
    assert len(table.heavy)
    windows = sieve.shared_filter(docs, lambda b: bwt.crowded_keys_of(b, table))
    sent = list(bwt.send_pieces(iter([batch]), table, windows))
    list(bwt.judge_pieces(iter(sent)))
    assert max(sizes, default=0) < 2 * bwt.MERGE
    got = bwt.repeats_digest(bwt.remove_repeats(documents(spark, rows)))
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(pairs))


@pytest.mark.parametrize("shard", [60, 300, 1 << 16])
def test_merge_of_shards(monkeypatch, shard):
    monkeypatch.setattr(bwt, "SHARD", shard)
    chance = random.Random(shard)
    for _ in range(30):
        strings = {
            bytes(chance.choices(b"ab\0\xc3", k=chance.randint(50, 150)))
            for _ in range(chance.randint(1, 10))
        }
        some = chance.choice(sorted(strings))
        strings = sorted({*strings, some[1:] + b"ab" * 25, b"a" * 50 + some})
        docs = np.array([chance.randrange(9) for _ in strings])
        low = {}
        for s, doc in zip(strings, docs):
            for p in range(len(s) - 49):
                low[s[p : p + 50]] = min(doc, low.get(s[p : p + 50], 99))
        for s, got in zip(strings, bwt.smallest_docs(strings, docs)):
            assert got.tolist() == [low[s[p : p + 50]] for p in range(len(s) - 49)]


def test_longest_common_prefixes():
    """The pass that sets a boundary is the common prefix of the entries it parts."""
    strings = [b"banana" * 12, b"ananas" * 11, b"bandana" * 9]
    suffixes = sorted(s[i:] for s in strings for i in range(len(s) + 1))
    transforms, counts = [], []
    for s in strings:
        symbols = np.append(np.frombuffer(s, np.uint8).astype(np.uint16) + 1, bwt.END).astype(np.uint16)
        order = bwt.sort_suffixes(symbols, np.arange(len(symbols), 0, -1))
        previous = symbols[order - 1]
        transforms.append(previous)
        counts.append(1)
    _, prefix = bwt.merge(transforms, counts, 50)
    for k in range(3, len(suffixes)):
        a, b = suffixes[k - 1], suffixes[k]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        if len(a) > n and len(b) > n:
            assert prefix[k] == min(50, n)


def test_odd_rows(spark):
    got = bwt.repeats_digest(bwt.remove_repeats(documents(spark)))
    want = spark.createDataFrame(
        brute([r[:2] for r in ROWS]), "doc_id long, n long, m long, s long, h string"
    )
    assert tuples(got) == tuples(want)
    assert bwt.remove_repeats(empty(spark)).count() == 0


def test_parts_are_even(spark):
    """Keys are lowest hashes; their first bits must not crowd in the first parts."""
    draw = np.random.default_rng(3)
    texts = [draw.integers(97, 123, 4000, np.uint8).tobytes() for _ in range(40)]
    keys, _, _, n, _ = bwt.cut(texts)
    parts = np.bincount((keys >> np.uint64(58)).astype(int), n, 64)
    assert parts.max() < 3 * parts.sum() / 64


def test_jobs_do_not_grow_with_partitions(spark):
    docs = spark.createDataFrame([(i, f"text number {i} " * 20) for i in range(50)], "doc_id long, text string")
    tracker = spark.sparkContext.statusTracker()

    def jobs(partitions):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.sparkContext.setJobGroup(f"filter-{partitions}", "")
        sieve.shared_filter(docs, bwt.keys_of)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", before)
        return len(tracker.getJobIdsForGroup(f"filter-{partitions}"))

    assert jobs("32") <= jobs("4")


def test_pieces_travel_packed():
    """What is sent takes less room than the numbers and strings it stands for."""
    chance = random.Random(4)
    words = ["".join(chance.choices("abcdefgh", k=chance.randint(2, 9))) for _ in range(300)]
    texts = [" ".join(chance.choices(words, k=400)) for _ in range(30)]
    texts = [t + texts[0][:900] for t in texts]
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in enumerate(texts)])
    keys = np.sort(bwt.keys_of(batch)[0])
    bits = np.full(1 << 10, 255, np.uint8)  # all pass
    table = sieve.Sieve(bits, np.zeros(2, np.uint64), np.full(2, 1 << 13, np.uint64), keys[:0])
    sent = [b for b in bwt.send_pieces(iter([batch]), table) if b.column("pieces").null_count == 0]
    room = sum(b.column(c).nbytes for b in sent for c in ("pieces", "text"))
    _, _, _, n, _ = bwt.cut([t.encode() for t in texts])
    plain = int((n + 49 + bwt.PIECES.itemsize).sum())
    assert room < plain // 2


def test_marks_of_rows_are_joined():
    marks = bwt._Marks()
    for spans in ([(1, 5, 0, 60), (1, 5, 60, 90), (2, 5, 10, 70)], [(1, 5, 200, 260), (1, 4, 50, 100), (2, 5, 0, 20)]):
        marks.add(*np.array(spans, np.int64).T)
    got = {}
    for row in marks.batch(3).to_pylist():
        got[row["doc_id"], row["row"]] = bwt.spans_of([row["marks"]]).tolist()
        assert row["part"] == row["row"] % 3
    assert got == {(1, 5): [[0, 90], [200, 260]], (1, 4): [[50, 100]], (2, 5): [[0, 70]]}
