"""Token-ID output: length-delimited binary records with a separate offset index.

A shard is two files. The data file holds one frame per document:

    length   8 bytes, little-endian, of the payload
    check    4 bytes, masked CRC-32 of the length field
    payload  the token ids, little-endian, 2 bytes each if the vocabulary allows, else 4
    check    4 bytes, masked CRC-32 of the payload

The mask (rotate right by 15 bits, add a constant) keeps a checksum of data that
itself holds checksums from being trivially right. The index file holds one
fixed-size entry per frame (``INDEX``) and ends with its own masked checksum, so a
shuffled read can go straight to any frame. Both files carry a name that no other
attempt of the task uses; the manifest, which Spark commits, says which files count,
so a task that dies or runs twice leaves only files that nobody reads.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sparkpipe.llm.frames import id_and_text, tasks
from sparkpipe.session import work_dir

INDEX = np.dtype(
    [
        ("doc_id", "<i8"),
        ("offset", "<u8"),
        ("before", "<u8"),  # ids of the shard's earlier documents
        ("n_tokens", "<u8"),
        ("no_id", "<u4"),  # 1: the document's id is null
        ("pad", "<u4"),
    ]
)
MANIFEST = "part int, shard int, data string, index string, width int, documents long, tokens long"
RECORDS = "doc_id long, start long, n_tokens long, ids binary"
MASK = 0xA282EAD8
TOGETHER = 256  # texts that are encoded at a time
HEAD, CHECK = "<QI", "<I"  # before and after the payload
AROUND = struct.calcsize(HEAD) + struct.calcsize(CHECK)

# A space between two characters that are not white space.
SPLIT = re.compile(r"(?<=\S) (?=\S)")
# Letters that are letters to every version of the pattern; marks without apostrophes.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?*%$#&|()"
WORD = re.compile(f"[{LETTERS}]+")
PLAIN = re.compile(
    rf"([{LETTERS}]+)([{MARKS}]*)(?:\n([{LETTERS}]+)([{MARKS}]*))?"
)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, struct.pack(CHECK, masked(length)), payload, struct.pack(CHECK, masked(payload)))
    )


def unframe(data: bytes, offset: int) -> bytes:
    """The payload of the frame at ``offset``; a damaged frame is an error."""
    length, check = struct.unpack_from(HEAD, data, offset)
    if masked(data[offset : offset + 8]) != check:
        raise ValueError(f"damaged length at {offset}")
    start = offset + struct.calcsize(HEAD)
    payload = data[start : start + length]
    if len(payload) < length or struct.pack(CHECK, masked(payload)) != data[
        start + length : start + length + struct.calcsize(CHECK)
    ]:
        raise ValueError(f"damaged record at {offset}")
    return payload


class _Loose(Exception):
    """A text holds a space next to white space."""


class _Pieces(dict):
    """Ids by piece; a piece not met before is made, and kept unless it is long."""

    LONGEST = 48

    def __init__(self, make):
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        ids = self.make(piece)
        if len(piece) <= self.LONGEST:
            self[piece] = ids
        return ids


class Encoder:
    """The ids of whole texts, encoding each distinct word only once.

    With byte-level tokenizers that split by the usual pattern, a single space between
    two characters that are not white space always starts a new unit, so a text may be
    cut there and its pieces encoded on their own. A piece of letters and marks with at
    most one line feed inside may be cut between these as well. What was met before
    comes from tables that are emptied when full; long pieces are never kept. Any other
    tokenizer gets the texts whole, and so does a text that holds one of the tokenizer's
    added tokens. ``literal`` reads special tokens in a text as plain text.
    """

    KEPT = 1_000_000

    def __init__(self, path: str, literal: bool = True, kept: int = KEPT):
        from tokenizers import Tokenizer, pre_tokenizers

        self.KEPT = kept
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [a.content for a in added if not (literal and a.special)]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        made = json.loads(self.tokenizer.to_str())
        splitter = made["pre_tokenizer"] or {}
        self.cuts = (
            made["normalizer"] is None
            and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space", True)
            and made["model"]["type"] == "BPE"
        )
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        plain = [c for c in map(chr, range(256)) if c == " " or WORD.fullmatch(c)]
        self.letters = {ord(c): spell.pre_tokenize_str(c)[0][0] for c in plain}
        self.merged = self.tokenizer.model.tokenize
        self.pieces = _Pieces(self._piece)  # by piece, without the space before it
        self.units = _Pieces(lambda unit: self._ids([unit])[0])  # by text, as it stands

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.kind}", *ids)

    def _ids(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [self._packed(e.ids) for e in encoded]

    def _word(self, word: str) -> bytes:
        """The ids of a word of plain letters after a space.

        Such a word is one unit, so the tokenizer's own model can take it as it is,
        once its bytes are written in the model's alphabet.
        """
        spelt = word if word.isascii() else word.translate(self.letters)
        return self._packed([t.id for t in self.merged(self.letters[32] + spelt)])

    def _piece(self, piece: str) -> bytes:
        """The ids of a piece after a space; white space at its ends is not for a table."""
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Loose
        if WORD.fullmatch(piece):
            return self._word(piece)
        if cut := PLAIN.fullmatch(piece):
            first, marks, after, more = cut.groups("")
            ids = self.pieces[first] + (self.units[marks] if marks else b"")
            if not after:
                return ids
            return ids + self.units["\n"] + self.units[after] + (self.units[more] if more else b"")
        return self._ids([" " + piece])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.cuts:
            return self._ids(texts)
        whole = [any(a in t for a in self.added) for t in texts]
        if any(whole):
            uncut = iter(self._ids([t for t, w in zip(texts, whole) if w]))
            rest = iter(self._cut([t for t, w in zip(texts, whole) if not w]))
            return [next(uncut if w else rest) for w in whole]
        return self._cut(texts)

    def _cut(self, texts: list[str]) -> list[bytes]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> bytes:
        first, *pieces = text.split(" ")
        try:
            if pieces and (not first or first[-1].isspace()):
                raise _Loose
            out = [*map(self.pieces.__getitem__, pieces)]
        except _Loose:
            first, *pieces = SPLIT.split(text)
            # Only the last piece can end in white space, and none begins with it.
            loose = [pieces.pop()] if pieces and pieces[-1][-1].isspace() else []
            out = [*map(self.pieces.__getitem__, pieces), *self._ids([" " + p for p in loose])]
        for table in (self.pieces, self.units):
            if len(table) > self.KEPT:
                table.clear()
        return b"".join([self._ids([first])[0], *out])


_encoders: dict[tuple[str, bool, int], Encoder] = {}


def encoder(path: str, literal: bool, kept: int = Encoder.KEPT) -> Encoder:
    """One encoder per worker process, tokenizer file, reading of special tokens and table size."""
    if (path, literal, kept) not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path, literal, kept] = Encoder(path, literal, kept)
    return _encoders[path, literal, kept]


class _Shard:
    """A data file being written, and its index."""

    def __init__(self, folder: str, part: int, number: int):
        self.files, root = fs.FileSystem.from_uri(folder)
        self.part, self.number = part, number
        self.name = f"{part:06d}-{number:04d}-{uuid.uuid4().hex}"
        self.root = root
        self.out = self.files.open_output_stream(f"{root}/{self.name}.data")
        self.entries: list[tuple] = []
        self.offset = self.tokens = 0

    def add(self, doc_id: int | None, payload: bytes, n_tokens: int) -> None:
        data = frame(payload)
        self.entries.append(
            (doc_id or 0, self.offset, self.tokens, n_tokens, int(doc_id is None), 0)
        )
        self.out.write(data)
        self.offset += len(data)
        self.tokens += n_tokens

    def close(self, width: int) -> tuple:
        self.out.close()
        index = np.array(self.entries, INDEX).tobytes()
        with self.files.open_output_stream(f"{self.root}/{self.name}.index") as out:
            out.write(index + struct.pack(CHECK, masked(index)))
        names = (f"{self.name}.data", f"{self.name}.index")
        return (self.part, self.number, *names, width, len(self.entries), self.tokens)


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = 256 << 20,
    literal: bool = False,
    kept: int = Encoder.KEPT,
) -> DataFrame:
    """Encode every text, append ``end_id``, write shards in id order; the manifest.

    Documents are dealt by ranges of (id, text hash) and sorted within them, so shard
    order is id order and rows that share one id can still spread over tasks. A null
    text is encoded as an empty one; a null id sorts first and stays null; rows with
    equal ids follow the hash of their text; an empty table gives an empty manifest.
    Columns other than the two named are ignored. Special tokens in a text are encoded as
    the tokenizer does by default, or with ``literal`` as plain text. A shard is closed once it holds
    ``shard_bytes``, so no file grows with the input. ``kept`` bounds the pieces whose ids a
    worker remembers, at some 160 bytes each; fewer save memory and cost time.
    """
    spark = docs.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        codec, part = encoder(tokenizer, literal, kept), TaskContext.get().partitionId()
        end = np.array([end_id], f"<u{codec.width}").tobytes()
        shard, done = None, []
        for batch in batches:
            # Only the texts of some rows at a time become objects.
            for some in (batch.slice(at, TOGETHER) for at in range(0, batch.num_rows, TOGETHER)):
                encoded = codec.encode([t or "" for t in some.column(1).to_pylist()])
                for doc_id, ids in zip(some.column(0).to_pylist(), encoded):
                    shard = shard or _Shard(data, part, len(done))
                    payload = ids + end
                    shard.add(doc_id, payload, len(payload) // codec.width)
                    if shard.offset >= shard_bytes:
                        done.append(shard.close(codec.width))
                        shard = None
        if shard:
            done.append(shard.close(codec.width))
        if done:
            names = [x.split()[0] for x in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in done], SCHEMA)

    # Spark makes the folder, whatever store it is in; the executors add files to it.
    data = f"{folder}/shards"
    spark.createDataFrame([], "made int").write.parquet(data)
    rows = id_and_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange(tasks(spark), "doc_id", "tie")
    dealt = dealt.sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    dealt.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("shard", pa.int32()),
        ("data", pa.string()),
        ("index", pa.string()),
        ("width", pa.int32()),
        ("documents", pa.int64()),
        ("tokens", pa.int64()),
    ]
)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard that counts, with the ids of all shards before it.

    The running sum goes through one task, over one short row per shard file.
    """
    shards = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _read_index(files: fs.FileSystem, path: str) -> np.ndarray:
    with files.open_input_stream(path) as source:
        data = source.read()
    if struct.pack(CHECK, masked(data[:-4])) != data[-4:]:
        raise ValueError(f"damaged index {path}")
    return np.frombuffer(data[:-4], INDEX)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])


def _widened(payload: bytes, width: int) -> bytes:
    return np.frombuffer(payload, f"<u{width}").astype("<u4").tobytes()


def read_records(spark: SparkSession, folder: str, batch_bytes: int = 8 << 20) -> DataFrame:
    """Every document's record, read back front to back, checksums verified.

    ``ids`` holds little-endian unsigned 32-bit integers; ``start`` counts the ids of
    all documents before. A task holds one index and about ``batch_bytes`` of records.
    """
    data = f"{folder}/shards"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(data)
        for shard in (x for b in batches for x in b.to_pylist()):
            index, rows, held = _read_index(files, f"{root}/{shard['index']}"), [], 0
            with files.open_input_stream(f"{root}/{shard['data']}") as source:
                for e in index:
                    size = int(e["n_tokens"]) * shard["width"] + AROUND
                    payload = unframe(source.read(size), 0)
                    doc_id = None if e["no_id"] else int(e["doc_id"])
                    start = shard["start"] + int(e["before"])
                    ids = _widened(payload, shard["width"])
                    rows.append((doc_id, start, len(ids) // 4, ids))
                    held += len(ids)
                    if held >= batch_bytes:
                        yield _batch(rows)
                        rows, held = [], 0
            if rows:
                yield _batch(rows)

    shards = manifest(spark, folder)
    return shards.repartition(max(1, shards.count())).mapInArrow(read, RECORDS)


def read_shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """All records in a seeded random order, each fetched through its index entry.

    Only index entries are shuffled; a record's bytes are read once, in the task
    that the order gives it to.
    """
    data = f"{folder}/shards"
    entry = "data string, width int, offset long, size long, doc_id long, start long"

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(data)
        for shard in (x for b in batches for x in b.to_pylist()):
            index = _read_index(files, f"{root}/{shard['index']}")
            yield pa.RecordBatch.from_pydict(
                {
                    "data": pa.array([shard["data"]] * len(index)),
                    "width": pa.array([shard["width"]] * len(index), pa.int32()),
                    "offset": pa.array(index["offset"].astype("i8")),
                    "size": pa.array(
                        index["n_tokens"].astype("i8") * shard["width"] + AROUND
                    ),
                    "doc_id": pa.array(index["doc_id"], mask=index["no_id"] == 1),
                    "start": pa.array(index["before"].astype("i8") + shard["start"]),
                }
            )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(data)
        for batch in batches:
            for x in batch.to_pylist():
                with files.open_input_file(f"{root}/{x['data']}") as source:
                    payload = unframe(source.read_at(x["size"], x["offset"]), 0)
                ids = _widened(payload, x["width"])
                yield _batch([(x["doc_id"], x["start"], len(ids) // 4, ids)])

    shards = manifest(spark, folder)
    rows = shards.repartition(max(1, shards.count())).mapInArrow(entries, entry)
    order = F.xxhash64(F.lit(seed), "data", "offset")
    return rows.orderBy(order, "data", "offset").mapInArrow(fetch, RECORDS)


def records_digest(records: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids, from records read back."""
    return records.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def round_trip(
    docs: DataFrame, tokenizer: str, end_id: int, kept: int = Encoder.KEPT
) -> DataFrame:
    """Write ``docs`` below the shared work folder and read the records back."""
    spark = docs.sparkSession
    folder = work_dir(spark, "records")
    write_records(docs, folder, tokenizer, end_id, kept=kept)
    return read_records(spark, folder)
