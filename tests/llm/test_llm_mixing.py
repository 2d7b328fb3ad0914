import pytest
from odd import ROWS, documents, empty, tuples
from pyspark.sql import functions as F

from sparkpipe.llm import mixing


def fill(sizes, weights, epochs):
    """Capped shares, clamping one source at a time."""
    total, target, free = sum(sizes), {}, dict(enumerate(weights))
    free = {i: w for i, w in free.items() if sizes[i] > 0}
    left = total
    while free:
        level = left / sum(free.values())
        over = [i for i, w in free.items() if w * level > epochs * sizes[i]]
        if not over:
            target |= {i: w * level for i, w in free.items()}
            break
        target[over[0]] = epochs * sizes[over[0]]
        left -= target[over[0]]
        del free[over[0]]
    return [target.get(i, 0.0) for i in range(len(sizes))]


@pytest.mark.parametrize(
    "sizes", [[10, 10, 10], [1000, 1, 1], [5, 0, 900, 3], [1], [0, 0], [7, 7000, 7, 7, 7, 7]]
)
def test_water_filling(spark, sizes):
    weights = [float(1 + i % 3) for i in range(len(sizes))]
    rows = [(str(i), s, w) for i, (s, w) in enumerate(zip(sizes, weights))]
    sources = spark.createDataFrame(rows, "source string, source_size long, weight double")
    got = [r.target for r in mixing.water_fill(sources, 3.0).orderBy("source").collect()]
    assert got == pytest.approx(fill(sizes, weights, 3.0))


def test_weights_go_by_code_point_and_null_last(spark):
    names = ["b", None, "a", "é", "Z", "😀", "\uffff"]
    sources = spark.createDataFrame([(n, 1) for n in names], "source string, source_size long")
    got = {r.source: r.weight for r in mixing.cyclic_weights(sources, (1, 2, 3)).collect()}
    assert got == {"Z": 1, "a": 2, "b": 3, "é": 1, "\uffff": 2, "😀": 3, None: 1}


def test_odd_rows(spark):
    mixed = mixing.mix(documents(spark)).cache()
    assert mixed.count() == len(ROWS)
    digest = mixing.mixed_digest(mixed)
    taken, target = {}, {}
    for r, source in zip(digest.collect(), [x.doc.source for x in mixed.collect()]):
        assert 0 <= r.taken <= 3 * r.size
        taken[source] = taken.get(source, 0) + r.taken
        target[source] = r.target
    assert {s: pytest.approx(t, abs=0.51) for s, t in target.items()} == taken
    assert tuples(digest) == tuples(mixing.mixed_digest(mixing.mix(documents(spark))))


def test_documents_of_the_mix(spark):
    docs = documents(spark)
    mixed = mixing.mix(docs).cache()
    out = mixing.mixed_documents(mixed)
    assert out.dtypes == docs.dtypes
    assert {r.text for r in out.collect()} <= {r[1] for r in ROWS}
    # Half of the document at the border is the most a source is off its target.
    digest = mixing.mixed_digest(mixed).collect()
    taken, largest = {}, {}
    for r, source in zip(digest, [x.doc.source for x in mixed.collect()]):
        taken[source] = taken.get(source, 0) + r.taken
        largest[source] = max(largest.get(source, 0), r.size)
    words = out.groupBy("source").agg(F.sum(mixing.n_words(out["text"])).alias("n"))
    for source, n in words.collect():
        assert abs(n - taken[source]) <= largest[source] / 2
    empty_texts = [r for r in ROWS if not (r[1] or "").split()]
    assert out.where("text IS NULL OR trim(text) = '' OR doc_id = 6").count() == len(empty_texts)


def test_empty_table(spark):
    assert mixing.mix(empty(spark)).count() == 0
