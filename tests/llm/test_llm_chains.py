import random

import pytest
from odd import ROWS, documents, empty

from sparkpipe.llm import chains

LABELS = "doc_id long, toxic int, junk int"
NICE = [f"nice{i}" for i in range(60)]


def corpus(spark, n=400):
    chance = random.Random(3)
    rows, marks = [], []
    for i in range(n):
        toxic, junk = i % 4 == 0, i % 5 == 0
        text = chance.choices(NICE, k=30) + ["scum,", "Idiot"] * toxic + ["$$$buy"] * junk
        chance.shuffle(text)
        rows.append((i, " ".join(text), "en", "a", 1))
        if i % 2 == 0:
            marks.append((i, int(toxic), int(junk)))
    return documents(spark, rows), spark.createDataFrame(marks, LABELS)


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus(spark)
    return docs, chains.fit_chain(docs, labels, ["junk", "toxic"], folds=2)


def test_held_out_accuracy(fitted):
    docs, chain = fitted
    rows = chains.predict(docs, chain, "doc_id").collect()
    held_out = [r for r in rows if r.doc_id % 2]
    right = sum((r.p_toxic >= 0.5) == (r.doc_id % 4 == 0) for r in held_out)
    assert right >= 0.97 * len(held_out)
    assert all((r.p_toxic >= 0.5) == (r.doc_id % 4 == 0) for r in rows if r.doc_id % 4 == 0)


def test_later_models_take_earlier_odds(fitted):
    _, chain = fitted
    n = len(chain.vocabulary)
    assert [len(w) - n for w in chain.weights] == [0, 1]


def test_filter_keeps_columns(fitted):
    docs, chain = fitted
    kept = chains.keep_below(docs, chain, "toxic", 0.5)
    assert kept.dtypes == docs.dtypes
    assert not [r for r in kept.collect() if r.doc_id % 4 == 0]
    assert kept.count() >= 0.97 * 300


def test_odd_rows(spark, fitted):
    _, chain = fitted
    assert chains.predict(documents(spark), chain, "doc_id").count() == len(ROWS)
    assert chains.keep_below(documents(spark), chain, "toxic", 0.5).count() == len(ROWS)
    assert chains.predict(empty(spark), chain, "doc_id").count() == 0


def test_useless_labels(spark):
    docs = documents(spark)
    rows = [(None, 1, 0), (1, None, 0), (2, 0, 0), (2, 1, 0), (77, 1, 1)]
    for labels in (rows, []):
        chain = chains.fit_chain(docs, spark.createDataFrame(labels, LABELS), ["junk", "toxic"])
        assert chains.predict(docs, chain, "doc_id").count() == len(ROWS)
    chain = chains.fit_chain(empty(spark), spark.createDataFrame(rows, LABELS), ["junk", "toxic"])
    assert chains.predict(docs, chain, "doc_id").count() == len(ROWS)
