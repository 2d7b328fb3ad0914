import random
import re
import zlib

import pytest
from odd import ROWS, documents, empty, tuples

from sparkpipe.llm import secrets
from sparkpipe.llm.queries import op5_secret_scan

SF = "/root/testdata/sf0.01"
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def plain(text):
    """The base kinds by scanning the whole text with each pattern."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(secrets.KINDS[k], s, e) for s, k, e in sorted(out)]


def base(spans):
    return [s for s in spans if s[0] in secrets.BASE]


def test_base_spans_equal_whole_scans():
    chance = random.Random(4)
    parts = ["password", "PassWD", "secret", "token", "api_key", "apikey", "APIkey", '"', "'", " ", "=", ":", "abc123", "é", "\n",
             "AKIA", "ABCDEFGHIJ0123456789", "deadbeef", "0123456789ab", "A", "ſecret", "to\u212aen", "Z", "ghp_", "card ", "x"]
    for _ in range(4000):
        text = "".join(chance.choices(parts, k=chance.randint(1, 25)))
        assert base(secrets.scan(text)) == plain(text), repr(text)


def test_query_on_the_documents(spark):
    import hashlib

    got = {r.doc_id: r for r in op5_secret_scan(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        spans = plain(r.text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[r.doc_id][f"n_{k}"] for k in secrets.BASE] == [
            sum(s[0] == k for s in spans) for k in secrets.BASE
        ]


def signed(prefix, body="0123456789abcdefghijABCDEFGHIJ"):
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = secrets.BASE62[digit] + digits
    return prefix + body + digits


@pytest.mark.parametrize(
    "text, kind",
    [
        (signed("ghp_"), "github"),
        (signed("npm_"), "npm"),
        ("Card no. 4111 1111 1111 1111.", "card"),
        ("IBAN: GB82 WEST 1234 5698 7654 32", "iban"),
    ],
)
def test_checksums_decide(text, kind):
    assert [k for k, _, _ in secrets.scan("é " + text) if k == kind] == [kind]
    at = max(i for i, c in enumerate(text) if c.isdigit())
    wrong = text[:at] + str((int(text[at]) + 1) % 10) + text[at + 1 :]
    assert kind not in [k for k, _, _ in secrets.scan(wrong)]


def test_odd_rows(spark):
    rows = [*ROWS, (20, "secret=" + "a" * 200_000 + " " + "f" * 100_000, "en", "a", 1)]
    got = secrets.secrets_digest(secrets.find_secrets(documents(spark, rows)))
    assert got.count() == len(rows)
    assert tuples(got.where("doc_id = 20"), "n_assign", "n_hex") == [(1, 2)]
    assert secrets.find_secrets(empty(spark)).count() == 0
