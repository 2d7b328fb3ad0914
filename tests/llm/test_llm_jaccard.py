import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from odd import ROWS, documents, empty, tuples

from sparkpipe.llm import components, jaccard
from sparkpipe.llm.queries import op6_jaccard_join

SF = "/root/testdata/sf0.01"


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(5))))


def brute(rows):
    """(id, size, component) by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    seen = defaultdict(list)
    for i, own in enumerate(sets):
        common = Counter(j for s in own for j in seen[s])
        for s in own:
            seen[s].append(i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            lowest[root(i)] = min(doc_id, lowest.get(root(i), doc_id))
    return [
        (doc_id, len(sets[i]), lowest.get(root(i)) if sets[i] else doc_id)
        for i, (doc_id, _) in enumerate(rows)
    ]


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = tuples(jaccard.jaccard_join(df), "doc_id", "n_shingles", "component_id")
    want = spark.createDataFrame(brute(rows), "a long, b long, c long")
    assert got == tuples(want)


def test_query_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in op6_jaccard_join(spark, SF).collect())
    assert got == sorted(brute([tuple(r) for r in docs]))


def edited(chance, words, edits):
    words = list(words)
    for _ in range(edits):
        words[chance.randrange(len(words))] = f"new{chance.randrange(10**6)}"
    return words


@pytest.mark.parametrize("seed", range(2))
def test_near_copies_at_the_limit(spark, seed):
    """Groups of near copies of all sizes, passages shared by many, chains of links."""
    chance = random.Random(seed)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for group in range(40):
        base = [f"w{group}x{k}" for k in range(chance.choice([3, 5, 8, 9, 12, 30, 70, 150, 600]))]
        for _ in range(chance.randint(2, 9)):
            words = edited(chance, base, chance.randint(0, max(1, len(base) // 22)))
            words += [f"t{chance.randrange(10**6)}" for _ in range(chance.choice([0, 0, 1, 4]))]
            rows.append(" ".join(words))
    for _ in range(60):
        own = [f"o{chance.randrange(10**6)}" for _ in range(chance.choice([0, 2, 8, 9, 10, 30]))]
        rows.append(" ".join(passage + own))
    base = [f"c{k}" for k in range(100)]
    for k in range(30):  # a chain: only neighbours link
        rows.append(" ".join(base[k * 2 :] + [f"d{j}" for j in range(k * 2)]))
    chance.shuffle(rows)
    check(spark, list(enumerate(rows)))


def test_odd_rows(spark):
    check(spark, [r[:2] for r in ROWS])
    assert jaccard.jaccard_join(documents(spark)).count() == len(ROWS)
    assert jaccard.jaccard_join(empty(spark)).count() == 0


def test_one_of_each_group(spark):
    docs = documents(spark)
    kept = jaccard.one_per_component(docs, jaccard.jaccard_join(docs))
    assert kept.dtypes == docs.dtypes
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is not None, x))
    assert ids == [None, None, 1, 4, 5, 6, 7, 8, 9, 10]


def test_rows_of_one_id_are_kept_by_their_own_text(spark):
    base = " ".join(f"w{k}" for k in range(100))
    rows = [
        (3, base),
        (9, base + " tail"),
        (9, "something else entirely that is like no other text here"),
        (9, "and a third text of the same id that is also like none"),
        (12, "something else entirely that is like no other text here"),
        (20, base + " more"),
        (20, base + " more"),
        (30, "a repeated row that nothing else is like at all"),
        (30, "a repeated row that nothing else is like at all"),
    ]
    docs = documents(spark, [(i, t, "en", "a", n) for n, (i, t) in enumerate(rows)])
    kept = jaccard.one_per_component(docs, jaccard.jaccard_join(docs))
    assert sorted(r.n_chars for r in kept.collect()) == [0, 2, 3, 7]


@pytest.mark.parametrize("deleted", [0, 1, 2])
@pytest.mark.parametrize("n", [4, 9, 40, 300])
def test_similar_sets_always_show_a_common_signature(n, deleted):
    """The pigeonhole promise, with and without one-deletion neighbourhoods."""
    chance = np.random.default_rng(n)
    levels = chance.integers(0, 5, 1 << jaccard.COUNT_BITS).astype(np.uint8)
    for _ in range(60):
        most = int(jaccard.most_different(n, n, 80))
        segments = max(most + 1, 3 * n // 4)
        base = chance.integers(0, 1 << 63, n, dtype=np.uint64)
        lost = int(chance.integers(0, most // 2 + 1))
        other = np.concatenate([base[lost:], chance.integers(0, 1 << 63, lost, dtype=np.uint64)])
        elements = np.concatenate([np.sort(base), np.sort(other)])
        sets = jaccard.Sets(elements, np.repeat([0, 1], n), np.array([n, n]))
        found, row = jaccard.signatures(sets, 1, np.array([most, most]), (segments, deleted), levels)
        if most:
            assert set(found[row == 0].tolist()) & set(found[row == 1].tolist())


def test_components(spark):
    chance = random.Random(8)
    links = [(chance.randrange(300), chance.randrange(300)) for _ in range(220)] + [(5, 5)]
    links += [(k, k + 1) for k in range(1000, 1060)] + [(2000, 2000 + k) for k in range(1, 80)]
    parent = {n: n for pair in links for n in pair}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components.components(df, "test").collect()}
    want = {n: root(n) for n in parent if root(n) != n}
    assert got == want
    assert components.components(df.limit(0), "test").count() == 0


def test_filter_of_shared_keys(spark):
    """It passes every key that is wanted and few others, at any size."""
    from sparkpipe.llm import sieve

    wanted = spark.range(0, 3000, 3).select((F.col("id") * 7919).alias("k"))
    every = spark.range(3000).select((F.col("id") * 7919).alias("k"), F.lit("x").alias("v"))
    for rows in (wanted, wanted.limit(1), wanted.limit(0)):
        table = sieve.filter_of(rows, ["k"])
        assert len(table.bits) < 1 << 20
        left = sieve.semi_join(every, rows, ["k"])
        assert tuples(left, "k") == tuples(rows, "k")


def test_a_pair_is_made_once_a_block(spark):
    """However many signatures two sets share, and whichever of them is an upper set."""
    bits, rows = [0] * jaccard.BITMAP, []
    for sig in range(60):
        # 1, 2 and 3 are of one band, 9 is an upper set there; 2 lies in the leader's component.
        rows += [(sig, s, upper, 1, s, 2, n, bits) for s, upper, n in ((1, False, 50), (2, False, 51), (3, False, 52))]
        rows += [(sig, 9, True, 1, 9, 2, 60, bits), (sig, 10, True, 1, 10, 2, 60, bits)]
    schema = "sig long, sid long, upper boolean, low long, root long, main long, n int, bits array<long>"
    members = spark.createDataFrame(rows, schema)
    made = jaccard._pairs_apart(jaccard._in_blocks(members), 80)
    found = sorted((r.a, r.b) for r in made.collect())
    # Upper sets meet each other in their own band; all other pairs are made.
    assert set(found) == {(1, 2), (3, 2), (9, 2), (10, 2), (1, 3), (1, 9), (3, 9), (1, 10), (3, 10)}
    assert len(found) <= jaccard.BLOCKS * len(set(found))


def test_a_crowd_is_led_from_its_middle(spark):
    """Copies share three signatures of a text with it, and each few with other copies."""
    rows = [(sig, 500, False) for sig in range(30)]
    rows += [((k + j) % 30, k, False) for k in range(200) for j in (0, 7, 18)]
    rows += [(1000, 5, False), (1000, 9, False), (2000, 5, False)]
    few, crowds = jaccard._groups(spark.createDataFrame(rows, "sig long, sid long, upper boolean"))
    assert {(r.sig, r.lead, r.other) for r in few.collect()} == {(1000, 5, 9)}
    assert {(r.sig, r.lead) for r in crowds.collect()} == {(sig, 500) for sig in range(30)}
    assert all(r.other != 500 for r in crowds.select("other").collect())
    shown = few.unionByName(crowds).select("sig", "sid", "upper")
    assert tuples(shown) == sorted(r for r in rows if r[0] != 2000)
