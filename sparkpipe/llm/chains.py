"""Toxicity by a classifier chain.

Categories are predicted one after another, each by a logistic regression over word
features and the log odds of all earlier categories. While training, those log odds
are out-of-fold predictions: a document's come from a model that has not seen it, so a
later model learns how far an earlier one can be trusted. The final models, fitted on
all folds, then score every document in one pass.

The features of a document are the distinct lower-case words and word beginnings that
it holds, among those whose share differs most between the classes of a category.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from sparkpipe.llm.frames import few_at_a_time, written

TRIM = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~"
BEGINNINGS = (3, 5)


def features(text: str) -> set[str]:
    """Distinct words, and beginnings of longer words marked by a final "*"."""
    words = {w.strip(TRIM) for w in set(text.lower().split())}
    words.discard("")
    marked = {w[:n] + "*" for n in BEGINNINGS for w in words if len(w) > n}
    return words | marked


@dataclass
class Chain:
    """Weights of a fitted chain: a few thousand numbers at most."""

    categories: list[str]
    vocabulary: list[str]
    weights: list[np.ndarray] = field(default_factory=list)  # words, then earlier log odds
    biases: list[float] = field(default_factory=list)

    def score(self, places: list[int]) -> list[float]:
        """The probability of each category, given the places of the words present."""
        n, odds = len(self.vocabulary), []
        for weight, bias in zip(self.weights, self.biases):
            total = bias + float(weight[places].sum()) + float(np.dot(weight[n:], odds))
            odds.append(min(30.0, max(-30.0, total)))
        return [1 / (1 + math.exp(-x)) for x in odds]


def sample(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str], rows: int, seed: int,
    id_col: str, text_col: str, folds: int,
) -> DataFrame:
    """About ``rows`` labelled documents at most: doc_id, text, fold, a 0/1 per category.

    A document counts once: several labels of one document are joined by their
    maximum, several rows of one id by their first text in order.
    """
    marks = labels.select(
        F.col(id_col).cast("long").alias("doc_id"), *[F.col(c).cast("int").alias(c) for c in categories]
    ).dropna()
    marks = marks.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in categories])
    share = min(1.0, rows / max(1, marks.count()))
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000))
    marks = marks.where(place < int(share * 1_000_000))
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    found = texts.dropna().join(marks, "doc_id").groupBy("doc_id", *categories)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(folds)).cast("int")
    return found.agg(F.min("text").alias("text")).withColumn("fold", fold)


def _present(rows: DataFrame, keep: Sequence[str], words: frozenset[str]) -> DataFrame:
    """Which of ``words`` each text holds, beside the columns to keep."""
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sorted(features(t) & words) for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(held, pa.list_(pa.string()))],
                [*keep, "words"],
            )

    return rows.select(*keep, "text").mapInArrow(extract, f"{kinds}, words array<string>")


def telling_words(
    rows: DataFrame, categories: Sequence[str], size: int, least: int
) -> list[str]:
    """For each category the ``size`` words whose shares differ most, by z score.

    Words of fewer than ``least`` documents are left out. Each batch of documents is
    counted where it is, so what is shuffled is one row per word and batch.
    """
    names = list(categories)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            marks = list(zip(*(batch.column(k).to_pylist() for k in range(len(names)))))
            for mark, text in zip(marks, batch.column(len(names)).to_pylist()):
                for word in features(text):
                    seen = counts.setdefault(word, [0] * (len(names) + 1))
                    seen[-1] += 1
                    for k, one in enumerate(mark):
                        seen[k] += one
            if counts:
                columns = list(zip(*counts.values()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(counts), *(pa.array(c, pa.int64()) for c in columns)],
                    ["word", *names, "n"],
                )

    kinds = "word string, " + ", ".join(f"{c} long" for c in [*names, "n"])
    counted = rows.select(*names, "text").mapInArrow(count, kinds)
    counted = counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in [*names, "n"]])
    counted = written(counted.where(F.col("n") >= least), "chain-words")
    totals = rows.agg(F.count("*"), *[F.sum(c) for c in names]).first()
    total = totals[0]
    chosen: set[str] = set()
    for name, positive in zip(names, totals[1:]):
        if not positive or positive == total:
            continue
        rest = total - positive
        share = F.col("n") / total
        gap = F.col(name) / positive - (F.col("n") - F.col(name)) / rest
        z = F.abs(gap) / F.sqrt(share * (1 - share) * (1 / positive + 1 / rest) + 1e-12)
        best = counted.select("word", z.alias("z")).where("z >= 4").orderBy(F.desc("z"), "word")
        chosen |= {r[0] for r in best.limit(size).collect()}
    return sorted(chosen)


def _fitted(rows: DataFrame, category: str):
    model = LogisticRegression(
        featuresCol="features", labelCol=category, regParam=2e-3, maxIter=30, aggregationDepth=2
    )
    fitted = model.fit(rows)
    # The summary holds the session, which cannot go to tasks once it has observed a frame.
    fitted._java_obj.setSummary(rows.sparkSession._jvm.scala.Option.empty())
    return fitted


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    rows: int = 12_000,
    folds: int = 3,
    words: int = 400,
    seed: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Chain:
    """Fit the chain on about ``rows`` labelled documents at most.

    A category all of whose labels agree gets a constant model, and with no labelled
    documents all categories are improbable.
    """
    chosen = sample(docs, labels, categories, rows, seed, id_col, text_col, folds)
    chosen = written(chosen, "chain-sample")
    vocabulary = telling_words(chosen, categories, words, least=3)
    present = _present(chosen, ["doc_id", "fold", *categories], frozenset(vocabulary))
    chain = Chain(list(categories), vocabulary)
    if not vocabulary:
        n = chosen.agg(F.count("*"), *[F.sum(c) for c in categories]).first()
        for k, positive in enumerate(n[1:]):
            share = ((positive or 0) + 0.5) / (n[0] + 2)
            chain.weights.append(np.zeros(k))
            chain.biases.append(math.log(share / (1 - share)))
        return chain
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, "words", "present", 1.0)
    data = written(vectors.setBinary(True).transform(present).drop("words"), "chain-vectors")

    odds: list[str] = []
    for k, category in enumerate(categories):
        inputs = VectorAssembler(inputCols=["present", *odds], outputCol="features")
        ready = inputs.transform(data).persist()
        final = _fitted(ready, category)
        chain.weights.append(np.array(final.coefficients.toArray()))
        chain.biases.append(float(final.intercept))
        if k + 1 < len(categories):
            parts = []
            for fold in range(folds):
                model = _fitted(ready.where(F.col("fold") != fold), category)
                scored = model.transform(ready.where(F.col("fold") == fold))
                raw = F.get(vector_to_array("rawPrediction"), F.lit(1))
                log_odds = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), raw))
                parts.append(scored.select(*data.columns, log_odds.alias(f"odds_{k}")))
            after = written(reduce(DataFrame.unionByName, parts), f"chain-odds-{k}")
            ready.unpersist()
            data = after
            odds.append(f"odds_{k}")
        else:
            ready.unpersist()
    return chain


def predict(docs: DataFrame, chain: Chain, id_col: str, text_col: str = "text") -> DataFrame:
    """doc_id and a probability per category for every whole text, one row per row.

    A null text is an empty one. The chain's weights travel with the function; they
    are bounded by the number of words and categories.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    place = {w: i for i, w in enumerate(chain.vocabulary)}
    known = frozenset(place)
    names = [f"p_{c}" for c in chain.categories]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = [
                chain.score([place[w] for w in features(t or "") & known])
                for t in few_at_a_time(batch.column(1))
            ]
            columns = list(zip(*table)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.float64()) for c in columns)],
                ["doc_id", *names],
            )

    key = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {key}, " + ", ".join(f"{n} double" for n in names))


def keep_below(
    docs: DataFrame, chain: Chain, category: str, limit: float, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose probability is below ``limit``."""
    rows = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("text"))
    place = {w: i for i, w in enumerate(chain.vocabulary)}
    known, which = frozenset(place), chain.categories.index(category)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                chain.score([place[w] for w in features(t or "") & known])[which] < limit
                for t in few_at_a_time(batch.column(1))
            ]
            yield batch.select(["doc"]).filter(pa.array(good, pa.bool_()))

    kind = rows.schema["doc"].dataType.simpleString()
    kept = rows.mapInArrow(keep, f"doc {kind}")
    return kept.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
