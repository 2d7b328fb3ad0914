import hashlib
import math
import random

import numpy as np
import pytest

from sparkpipe.llm import codes, nearest

SCHEMA = "vec_id long, embedding array<double>, label string, part int, entry int, rank int, score int, n int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], SCHEMA)


def drawn(n, width, seed, spread=1.0):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0, spread) for _ in range(width)], draw.choice(["a", "b", None])) for i in range(n)]


ODD = [
    (1, [1.0, 2.0, 3.0, 4.0], "a"),
    (1, [1.0, 2.0, 3.0, 4.0], "a"),
    (2, None, "a"),
    (3, [], None),
    (4, [1.0, None, 3.0, 4.0], "a"),
    (5, [1.0, float("nan"), 3.0, 4.0], "b"),
    (6, [1.0, float("-inf"), 3.0, 4.0], "b"),
    (7, [0.0, 0.0, 0.0, 0.0], None),
    (8, [-1.5], "c"),
    (None, [1.0, 2.0, 3.0, 5.0], "a"),
    (1, [2.0, 2.0, 3.0, 4.0], None),
    (20, [1.0, 2.0, 3.0, 4.0], "a"),
]


def kept(rows):
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    return sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def brute_codes(rows, parts, entries, rounds, scale):
    rows = kept(rows)
    width = -(-max((len(r[1]) for r in rows), default=0) // parts) * parts
    at = width // parts
    whole = []
    for _, v, _ in rows:
        v = [*v, *[0.0] * (width - len(v))]
        whole.append([x.as_integer_ratio()[0] * scale // x.as_integer_ratio()[1] for x in v])
    cut = [[v[p * at : (p + 1) * at] for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def near(v, book):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for v in cut:
                own[near(v[p], books[p])[1]].append(v[p])
            books[p] = [[sum(x) // len(x) for x in zip(*vs)] if vs else c for vs, c in zip(own, books[p])]
    coded = [[near(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [min(sum(d for d, _ in c), codes.LARGEST) for c in coded]
    by_label = {}
    for r, e in zip(rows, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(
        (
            (r[0], "".join(f"{e:02x}" for _, e in c), error, min(by_label[r[2]], codes.LARGEST), digest)
            for r, c, error in zip(rows, coded, errors)
        ),
        key=str,
    )


def coded(spark, rows, parts=16, entries=64, rounds=2, scale=256):
    df = vectors(spark, rows)
    books = codes.fit_codebooks(df, parts=parts, entries=entries, rounds=rounds, scale=scale)
    out = codes.codes_digest(codes.with_label_error(codes.encode(df, books)), books)
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("spread", [1.0, 0.01, 1e7, 1e12, 1e30])
def test_codes_are_those_of_whole_numbers(spark, spread):
    """Also where products need several limbs, and where no machine integer holds them."""
    rows = drawn(60, 12, 3, spread) + drawn(3, 12, 4)
    assert coded(spark, rows, 4, 8, 2) == brute_codes(rows, 4, 8, 2, 256)


def test_ties_and_unused_entries(spark):
    rows = [(i, [float(i // 6 % 2)] * 8, "x") for i in range(40)]
    assert coded(spark, rows, 4, 8, 2) == brute_codes(rows, 4, 8, 2, 256)


def test_odd_vectors_are_coded(spark):
    assert coded(spark, ODD, 2, 4, 2) == brute_codes(ODD, 2, 4, 2, 256)
    only_empty = [(1, [], "a"), (2, [], None)]
    assert coded(spark, only_empty) == brute_codes(only_empty, 16, 64, 2, 256)


def test_no_vectors_give_no_codes(spark):
    assert coded(spark, [(1, None, "a")]) == []
    assert coded(spark, []) == []


@pytest.mark.parametrize("bits", [3, 24, 26, 31, 40, 61])
def test_dot_products_are_exact(bits):
    draw = random.Random(bits)
    a = [[draw.randrange(-(2**bits), 2**bits) for _ in range(7)] for _ in range(20)]
    b = [[draw.randrange(-(2**bits), 2**bits) for _ in range(7)] for _ in range(9)]
    found = codes.exact_dots(np.array(a), np.array(b)).tolist()
    assert found == [[sum(x * y for x, y in zip(r, s)) for s in b] for r in a]


def brute_nearest(rows, asked, k):
    rows = {(r[0], tuple(r[1])) for r in kept(rows) if r[0] is not None and any(r[1])}
    out = []
    for q in sorted(x for x in rows if asked(x[0])):
        scores = [(-sum(a * b for a, b in zip(q[1], v)), i) for i, v in rows if i != q[0]]
        out += [(q[0], n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def found(spark, rows, k, where="vec_id % 20 = 0"):
    df = vectors(spark, rows)
    return [tuple(r) for r in nearest.nearest(df, df.where(where), k).orderBy("query_id", "rank").collect()]


def test_fewer_vectors_than_asked_for(spark):
    expected = brute_nearest(ODD, lambda i: i % 20 == 0, 20)
    result = found(spark, ODD, 20)
    assert [r[:3] for r in result] == [r[:3] for r in expected]
    assert [r[3] for r in result] == pytest.approx([r[3] for r in expected])
    assert [x[2] for x in expected] == [1, 1, 8]


def test_two_vectors_of_one_id_are_two_queries(spark):
    result = found(spark, ODD, 20, "vec_id = 1")
    assert [r[:3] for r in result].count((1, 1, 20)) == 2


def test_equal_vectors_tie_by_id(spark):
    rows = [(i, [1.0, 0.5, 0.25], "a") for i in range(100)] + drawn(20, 3, 8, 0.1)[1:]
    rows = [(n, v, label) for n, (_, v, label) in enumerate(rows)]
    for query in range(0, 100, 20):
        nearest_ids = [r[2] for r in found(spark, rows, 20) if r[0] == query]
        assert nearest_ids == [i for i in range(30) if i != query][:20]


def test_no_vectors_find_nothing(spark):
    assert found(spark, [], 5) == []
    assert found(spark, [(20, [0.0], "a"), (40, None, "a")], 5) == []


@pytest.mark.parametrize("kind", ["sphere", "norms", "clusters"])
def test_recall_of_many_shards(spark, kind, monkeypatch):
    monkeypatch.setattr(nearest, "SHARD", (256, 131_072))
    monkeypatch.setattr(nearest, "QUERIES", 16)
    draw = np.random.default_rng(1)
    x = draw.standard_normal((1500, 24))
    if kind == "sphere":
        x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "norms":
        x *= np.exp(draw.standard_normal(1500))[:, None]
    if kind == "clusters":
        x = x / 5 + draw.standard_normal((12, 24))[draw.integers(0, 12, 1500)]
    rows = [(i, v.tolist(), "a") for i, v in enumerate(x)]
    expected = brute_nearest(rows, lambda i: i % 20 == 0, 20)
    result = found(spark, rows, 20)
    assert len(result) == len(expected)
    both = {(r[0], r[2]) for r in result} & {(r[0], r[2]) for r in expected}
    assert len(both) >= 0.95 * len(expected)
    score = {(r[0], r[2]): r[3] for r in expected}
    assert all(r[3] == pytest.approx(score[r[0], r[2]]) for r in result if (r[0], r[2]) in score)


def test_threshold_keeps_its_promise():
    p = math.erf(1 / math.sqrt(2))
    least = nearest.threshold(32, 1.0, 0.03)
    below = sum(math.comb(32, c) * p**c * (1 - p) ** (32 - c) for c in range(least))
    assert below <= 0.03 < below + math.comb(32, least) * p**least * (1 - p) ** (32 - least)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_table(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    x, ids = np.array([r.embedding for r in rows]), np.array([r.vec_id for r in rows])
    result = {(r.query_id, r.vec_id) for r in nearest.nearest(df, df.where("vec_id % 20 = 0")).collect()}
    hit = asked = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[q]
        scores[q] = -np.inf
        top = ids[np.argsort(-scores)[:20]]
        hit += sum((ids[q], i) in result for i in top)
        asked += 20
    assert hit >= 0.95 * asked
