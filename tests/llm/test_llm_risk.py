import math
import re
from collections import Counter

import pytest
from odd import ROWS, documents, empty

from sparkpipe.llm import risk
from sparkpipe.llm.queries import op2_risk_rules

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = set()
    for i, window in enumerate(zip(words, words[1:], words[2:])):
        if windows[window] > 1:
            repeated |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def test_counts_on_the_documents(spark):
    got = {r.doc_id: r for r in op2_risk_rules(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        want, row = plain_counts(r.text), got[r.doc_id]
        assert tuple(row[c] for c in risk.COUNTS[:5]) == want
        assert row.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (row.base_failed and row.kept)


@pytest.mark.parametrize("n, p", [(1, 0.5), (10, 0.1), (40, 0.01), (200, 0.3), (1000, 0.002)])
def test_binomial_is_exact(n, p):
    total = 0.0
    for k in range(n + 1):
        total += math.comb(n, k) * p**k * (1 - p) ** (n - k)
        assert risk.at_most(k, n, p) == pytest.approx(min(1, total), rel=1e-9)


def test_upper_bound():
    assert risk.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100))
    assert risk.upper_bound(100, 100, 0.05) == 1.0
    assert risk.upper_bound(0, 0, 0.05) == 1.0
    assert risk.at_most(7, 300, risk.upper_bound(7, 300, 0.01)) == pytest.approx(0.01)


def labelled(spark, n, noise):
    """n good documents per language, of which some have many symbols, and as much junk."""
    prose = " ".join(f"word{i}" for i in range(80))
    rows, marks = [], []
    for i in range(2 * n):
        junk = i >= n
        marked = junk or i < noise
        text = f"{prose} n{i} " + ("$$$ " * 60 if marked else "")
        rows.append((i, text, "en", "a", 1))
        marks.append((i, 0 if junk else 1, 0))
    return documents(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_certified_cutoffs_reject_junk_only(spark):
    docs, labels = labelled(spark, 1200, 0)
    kept = {r.doc_id: r.kept for r in risk.judge(docs, labels).collect()}
    assert all(kept[i] for i in range(1200)) and not any(kept[i] for i in range(1200, 2400))


def test_no_cutoff_without_enough_evidence(spark):
    for n, noise in ((60, 0), (1200, 40)):
        docs, labels = labelled(spark, n, noise)
        judged = risk.judge(docs, labels).where("NOT array_contains(rejected_by, 'repeats')")
        assert judged.where("array_contains(rejected_by, 'symbols')").count() == 0


def test_copies_are_one_piece_of_evidence(spark):
    docs, labels = labelled(spark, 1200, 0)
    one = docs.withColumn("text", docs["text"].substr(1, 400))
    judged = risk.judge(one, labels)
    assert judged.where("size(rejected_by) > 0").count() == 0


def test_odd_rows(spark):
    labels = [(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (99, 1, 1), (4, 1, 0), (4, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    judged = risk.judge(documents(spark), labels)
    assert sorted(map(str, (r.doc_id for r in judged.collect()))) == sorted(str(r[0]) for r in ROWS)
    assert risk.judge(empty(spark), labels).count() == 0
    assert risk.judge(documents(spark), labels.limit(0)).count() == len(ROWS)
