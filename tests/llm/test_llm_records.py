import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from odd import ROWS, documents, empty
from tokenizers import Tokenizer

from sparkpipe.llm import records
from sparkpipe.llm.queries import END_ID, TOKENIZER, op1_token_records

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def digest(rows, encode):
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*encode(text), END_ID]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        out.append((doc_id, start, len(ids), crc))
        start += len(ids)
    return out


def test_query_equals_encoding_each_text_alone(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in op1_token_records(spark, SF).collect())
    assert got == digest(sorted(map(tuple, docs)), plain)


def test_pieces_are_encoded_like_whole_texts(plain):
    chance = random.Random(7)
    parts = ["a", "é", " ", "  ", "\n", "\n\n", ".", ",", "'s", "'", "!!", "\t", "1", "Ω", "中", "\x1c",
             "\x85", "\u0301", "foo", "Bar", "|", "(", "don't", "\r\n", "\u200b", "😀", "<|endoftext|>", "ß"]
    texts = ["".join(chance.choices(parts + [" "] * 6, k=chance.randint(0, 30))) for _ in range(3000)]
    codec = records.Encoder(TOKENIZER)
    codec.KEPT = 500  # also empties the tables
    assert codec.cuts
    for text, data in zip(texts, codec.encode(texts)):
        assert np.frombuffer(data, "<u2").tolist() == plain(text), repr(text)


def test_added_tokens_are_encoded_as_by_default(spark, folder):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = ["a <|endoftext|> b", "a<|endoftext|>", " plain text. ", "<|endoftext|><|endoftext|>\n x"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 220, 50256, 275]
    got = records.Encoder(TOKENIZER, literal=False).encode(texts)
    assert [np.frombuffer(data, "<u2").tolist() for data in got] == want
    rows = [(k, t, "en", "a", 1) for k, t in enumerate(texts)]
    records.write_records(documents(spark, rows), folder, TOKENIZER, END_ID)
    read = records.read_records(spark, folder).orderBy("start").collect()
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in read] == [[*w, END_ID] for w in want]


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    codec = records.Encoder(path)
    assert not codec.cuts
    want = Tokenizer.from_file(path).encode("Some words, here.", add_special_tokens=False).ids
    assert np.frombuffer(codec.encode(["Some words, here."])[0], "<u2").tolist() == want


def test_odd_rows(spark, folder, plain):
    records.write_records(documents(spark), folder, TOKENIZER, END_ID, shard_bytes=1000)
    got = records.read_records(spark, folder, batch_bytes=100).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in ROWS), key=lambda x: (x is not None, x))
    assert sorted(bytes(r.ids) for r in got) == sorted(
        np.array([*plain(t), END_ID], "<u4").tobytes() for _, t, *_ in ROWS
    )
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens
    assert records.manifest(spark, folder).count() > 1


def test_shuffled_read_is_seeded_and_whole(spark, folder):
    records.write_records(documents(spark), folder, TOKENIZER, END_ID)
    plain_order = [tuple(r) for r in records.read_records(spark, folder).collect()]
    once = [tuple(r) for r in records.read_shuffled(spark, folder, 1).collect()]
    again = [tuple(r) for r in records.read_shuffled(spark, folder, 1).collect()]
    other = [tuple(r) for r in records.read_shuffled(spark, folder, 2).collect()]
    assert once == again != other
    assert sorted(map(str, once)) == sorted(map(str, plain_order)) == sorted(map(str, other))


def test_empty_table(spark, folder):
    records.write_records(empty(spark), folder, TOKENIZER, END_ID)
    assert records.read_records(spark, folder).count() == 0


def test_damage_is_found():
    data = bytearray(records.frame(b"some payload"))
    assert records.unframe(bytes(data), 0) == b"some payload"
    for place in (0, 9, 15, len(data) - 1):
        broken = bytearray(data)
        broken[place] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bytes(broken), 0)
    with pytest.raises(ValueError):
        records.unframe(bytes(data[:-6]), 0)


def test_tables_of_pieces_are_bounded(plain):
    texts = [" ".join(f"w{i}x{k}" for k in range(50)) for i in range(40)]
    codec = records.Encoder(TOKENIZER, kept=200)
    for text, data in zip(texts, codec.encode(texts)):
        assert np.frombuffer(data, "<u2").tolist() == plain(text)
        assert len(codec.pieces) <= 200
