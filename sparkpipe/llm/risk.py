"""Quality rules with risk-controlled thresholds.

A rule rejects a document whose score is at or above a cutoff. Every rule has a fixed
list of cutoffs from lax to strict. On labelled documents of good quality, the share a
cutoff would falsely reject has an exact (Clopper-Pearson) upper bound; going from lax
to strict, the last cutoff before the first whose bound exceeds the rule's share of the
allowed risk is taken, and none if the first already does. As each stratum and rule is
tested in a fixed order, only their number needs a correction (Bonferroni): with
probability 1 - ``delta`` every stratum falsely rejects at most ``risk`` of its good
documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkpipe.llm.frames import written

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_marks",
)

#: Rules: score as 100 * numerator / denominator, and cutoffs from lax to strict.
RULES = {
    "symbols": ("n_symbols", "n_words", (200, 150, 100, 80, 60, 40, 30, 20)),
    "dup_lines": ("n_dup_lines", "n_lines", (90, 75, 60, 50, 40, 30, 20)),
    "repeats": ("n_repeat_words", "n_words", (50, 45, 40, 35, 30, 25, 20)),
    "upper": ("n_upper", "word_chars", (90, 75, 60, 50, 40, 30, 20)),
    "marks": ("n_marks", "n_words", (250, 200, 150, 100, 80, 60, 40)),
    "long_words": ("word_chars", "n_words", (3000, 2000, 1500, 1200, 1000, 900, 800)),
}


def counts_of(text: str) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for one text."""
    data = text.encode()
    words = data.split()
    n_space = len(data) - len(data.translate(None, b" \t\n\v\f\r"))
    n_symbols = len(data) - len(data.translate(None, b"#*$%&|<>"))
    n_upper = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        len(words),
        len(text) - n_space,
        n_symbols,
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        n_upper,
        data.count(b"!") + data.count(b"?"),
    )


def repeated_words(words: list[bytes], length: int = 3) -> int:
    """Words that lie in a window of ``length`` words found twice or more."""
    if len(words) < length + 1:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    n = len(words) - length + 1
    key = ids[:n]
    for k in range(1, length):
        # Renumbering after each step keeps the product within 64 bits.
        key = np.unique(key * len(number) + ids[k : k + n], return_inverse=True)[1]
    again = np.bincount(key)[key] > 1
    covered = np.zeros(len(words), bool)
    for k in range(length):
        covered[k : k + n] |= again
    return int(covered.sum())


def text_counts(docs: DataFrame, columns: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The counts of each row's text beside ``columns``, which are given by new name."""
    names = list(columns)
    rows = docs.select(
        *[c.alias(n) for n, c in columns.items()], F.col(text_col).cast("string").alias("_text")
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:-1])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(names)).to_pylist()
            table = np.array([counts_of(t or "") for t in texts], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *map(pa.array, table.T)], [*names, *COUNTS]
            )

    return rows.mapInArrow(count, f"{kinds}, " + ", ".join(f"{c} long" for c in COUNTS))


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial(n, p), summed from the largest of the lower terms."""
    if k >= n or p <= 0:
        return 1.0
    if p >= 1:
        return 0.0
    if k > n * p:  # the upper tail is the short one
        return 1.0 - at_most(n - k - 1, n, 1 - p)
    log = (
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
        + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    term = total = math.exp(log)
    for i in range(k, 0, -1):
        term *= i * (1 - p) / ((n - i + 1) * p)
        total += term
        if term < total * 1e-17:
            break
    return min(1.0, total)


def upper_bound(k: int, n: int, error: float) -> float:
    """The exact upper confidence bound of a share of which k of n were seen."""
    low, high = (k / n, 1.0) if n else (1.0, 1.0)
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if at_most(k, n, middle) > error else (low, middle)
    return high


def _hits(rule: str, cutoff: int) -> Column:
    top, bottom, _ = RULES[rule]
    return (F.col(bottom) > 0) & (100 * F.col(top) >= cutoff * F.col(bottom))


def thresholds(labelled: DataFrame, risk: float, delta: float) -> DataFrame:
    """(stratum, rule, cutoff, n_good, n_hit, bound): the chosen cutoffs.

    ``labelled`` has stratum, good (boolean), text_key and the counts. Copies of a text
    count once per stratum, and as good only if every label of them is good, so that
    the sample is one of independent texts. Sums are taken per stratum by Spark; each
    stratum's few sums are then judged on their own.
    """
    once = labelled.where("good IS NOT NULL").groupBy("stratum", "text_key")
    once = once.agg(F.min("good").alias("good"), *[F.min(c).alias(c) for c in COUNTS])
    sums = [
        F.count_if(_hits(rule, cutoff)).alias(f"{rule}_{i}")
        for rule, (_, _, cutoffs) in RULES.items()
        for i, cutoff in enumerate(cutoffs)
    ]
    held = once.where("good").groupBy("stratum").agg(F.count("*").alias("n"), *sums)
    held = written(held, "risk-sums")
    n_tests = max(1, held.count()) * len(RULES)
    share, error = risk / len(RULES), delta / n_tests
    rules = {r: c for r, (_, _, c) in RULES.items()}

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                for rule, cutoffs in rules.items():
                    best = None
                    for i, cutoff in enumerate(cutoffs):
                        bound = upper_bound(row[f"{rule}_{i}"], row["n"], error)
                        if bound > share:
                            break
                        best = (row["stratum"], rule, cutoff, row["n"], row[f"{rule}_{i}"], bound)
                    if best:
                        out.append(best)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], fields
                )

    fields = ["stratum", "rule", "cutoff", "n_good", "n_hit", "bound"]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64()]
    return held.mapInArrow(
        choose, "stratum string, rule string, cutoff int, n_good long, n_hit long, bound double"
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    risk: float = 0.06,
    delta: float = 0.05,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    good_col: str = "quality",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts, base_failed, rejected_by, kept.

    ``labels`` has the id and ``good_col`` (1: good). A null text has no words; a null
    stratum is a stratum; null labels and labels of unknown documents are ignored; a
    null id has no label. A document with several labels is good if all are. A
    stratum with too few good labels to certify anything rejects by the base rule
    only, and so does an empty label table. Other columns are ignored.

    Texts are read once; what is shuffled are counts. The chosen cutoffs are one row
    per stratum.
    """
    rows = text_counts(
        docs,
        {
            "doc_id": F.col(id_col).cast("long"),
            "stratum": F.col(stratum_col).cast("string"),
            "text_key": F.xxhash64(F.col(text_col).cast("string")),
        },
        text_col,
    )
    rows = written(rows, "risk-counts")
    marks = labels.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.col(good_col) == 1).alias("good")
    )
    marks = marks.where("doc_id IS NOT NULL AND good IS NOT NULL")
    marks = marks.groupBy("doc_id").agg(F.min("good").alias("good"))
    chosen = thresholds(rows.join(marks, "doc_id"), risk, delta)
    cutoffs = chosen.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff"))
    cutoffs = cutoffs.select("stratum", *[F.col(r).alias(f"cut_{r}") for r in RULES])
    cutoffs = written(cutoffs, "risk-cutoffs")
    joined = rows.alias("r").join(cutoffs.alias("c"), F.expr("r.stratum <=> c.stratum"), "left")
    rejects = [
        F.when(
            (F.col(bottom) > 0) & (100 * F.col(top) >= F.col(f"cut_{rule}") * F.col(bottom)), rule
        )
        for rule, (top, bottom, _) in RULES.items()
    ]
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = joined.select(
        "doc_id",
        F.col("r.stratum").alias("stratum"),
        *COUNTS,
        base.alias("base_failed"),
        F.array_compact(F.array(*rejects)).alias("rejected_by"),
    )
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def quality_digest(judged: DataFrame) -> DataFrame:
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )
