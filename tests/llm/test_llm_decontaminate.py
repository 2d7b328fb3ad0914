import itertools
import random

import numpy as np
from odd import ROWS, documents, empty, tuples

from sparkpipe.llm import decontaminate as d

ITEM = "item_id long, text string, doc_id long"


def words(chance, n):
    return ["".join(chance.choices("abcdefgh", k=4)) for _ in range(n)]


def brute(docs, items, least=10, tenths=8):
    """Every alignment of every pair, every stretch of it."""
    out = {}
    for doc_id, text in docs:
        have = (text or "").lower().split()
        for item_id, item in items:
            want = (item or "").lower().split()
            best = None
            for shift in range(-len(want), len(have) + 1):
                for i in range(len(want)):
                    same = 0
                    for j in range(i, len(want)):
                        if not 0 <= j + shift < len(have) or i + shift < 0:
                            break
                        same += have[j + shift] == want[j]
                        if 10 * same >= tenths * (j - i + 1) and same >= min(least, len(want)):
                            best = max(best or 0, same)
            if best:
                out[doc_id, item_id] = best
    return out


def test_against_brute_force(spark):
    chance = random.Random(5)
    items = [(i, " ".join(words(chance, n))) for i, n in enumerate([15, 20, 30, 7, 12])]
    docs = []
    for k in range(60):
        text = words(chance, 20)
        item = items[k % 5][1].split()
        for place in chance.sample(range(len(item)), k % 3):
            item[place] = "other"
        text[5:5] = [w.upper() if k % 2 else w for w in item]
        docs.append((k, " ".join(text), "en", "a", 1))
    docs += [(100 + k, " ".join(words(chance, 60)), "en", "a", 1) for k in range(20)]
    got = d.find_overlaps(
        documents(spark, docs),
        spark.createDataFrame([(i, t, 1) for i, t in items], ITEM),
        block_words=25,
    )
    want = brute([r[:2] for r in docs], items)
    found = {(r.doc_id, r.item_id): r.matched for r in got.collect()}
    assert found.items() <= want.items()
    # Two substitutions may fall on every seed of a short item; one in a long one never does.
    assert {k for k in want if k[0] < 100 and k[0] % 3 < 2 and k[1] != 3} <= set(found)
    assert all(k[0] < 100 for k in found)


def test_seeds_hit_every_allowed_substitution():
    """Stretches of up to 25 words; of a longer one, a half is a stretch as well."""
    for n in range(10, 26):
        hit = [int(m, 2) << k for m in d.SEEDS for k in range(n - len(m) + 1)]
        for others in range(n - max(10, -(-8 * n // 10)) + 1):
            for places in itertools.combinations(range(n), others):
                gone = sum(1 << k for k in places)
                assert any(not gone & h for h in hit), (n, places)


def test_finds_all_that_brute_force_finds(spark):
    chance = random.Random(3)
    sizes = [10, 11, 12, 13, 15, 16, 18, 20, 25, 7]
    items = [(i, " ".join(words(chance, n))) for i, n in enumerate(sizes)]
    docs = []
    for k in range(300):
        item = items[k % 10][1].split()
        for place in chance.sample(range(len(item)), len(item) // 5):
            item[place] = "other"
        text = words(chance, 8) + item + words(chance, 8)
        docs.append((k, " ".join(text), "en", "a", 1))
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], ITEM)
    for least, tenths in ((10, 8), (12, 9), (6, 7)):
        got = d.find_overlaps(documents(spark, docs), benchmark, least, tenths, block_words=60)
        want = brute([r[:2] for r in docs], items, least, tenths)
        found = {(r.doc_id, r.item_id): r.matched for r in got.collect()}
        assert found.keys() == want.keys() and len(want) > 20
        assert all(matched <= want[pair] for pair, matched in found.items())


def test_longest_stretch():
    chance = random.Random(1)
    for _ in range(300):
        same = np.array([chance.random() < 0.7 for _ in range(chance.randint(0, 40))], bool)
        best = 0
        for i in range(len(same)):
            for j in range(i + 1, len(same) + 1):
                if 10 * same[i:j].sum() >= 8 * (j - i):
                    best = max(best, j - i)
        matched, start, end = d.longest_stretch(same, 8)
        assert matched == same[start:end].sum() and 10 * matched >= 8 * (end - start)
        # The end trimmed off was of substitutions only.
        assert end - start <= best and matched >= 0.8 * best - 1e-9 or best == 0


def test_odd_rows(spark):
    benchmark = [
        (1, "one two three four five six seven eight nine ten eleven", 1),
        (1, "one two three four five six seven eight nine ten eleven", 1),
        (2, None, 1),
        (3, "", 1),
        (None, "lorem ipsum dolor sit amet lorem ipsum", 1),
        (4, "lorem ipsum dolor sit amet " * 10, 1),
        (5, "one two three four", 1),
    ]
    benchmark = spark.createDataFrame(benchmark, ITEM)
    found = d.find_overlaps(documents(spark), benchmark)
    assert tuples(found, "doc_id", "item_id") == [(7, 4), (10, 5), (11, 5)]
    kept = d.clean_documents(documents(spark), found)
    assert kept.count() == len(ROWS) - 3 and kept.columns == documents(spark).columns
    assert d.find_overlaps(empty(spark), benchmark).count() == 0
    assert d.find_overlaps(documents(spark), benchmark.limit(0)).count() == 0


def test_short_items_are_found_as_whole_texts_or_anywhere(spark):
    benchmark = spark.createDataFrame([(1, "to be or", 1), (2, "yes", 1)], ITEM)
    texts = ["To be  or", "to be or not", "not to be or", "yes", "yes yes", "or be to"]
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    assert tuples(d.find_overlaps(docs, benchmark), "doc_id", "item_id") == [(0, 1), (3, 2)]
    assert tuples(d.find_overlaps(docs, benchmark, anywhere=1), "doc_id", "item_id") == [
        (0, 1), (1, 1), (2, 1), (3, 2), (4, 2),
    ]


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    item = "a passage of the benchmark that somebody has copied from it word for word"
    rows = [(9, f"before {item} after", 0), (9, "clean text", 1), (None, item, 2), (None, "clean", 3), (9, None, 4)]
    docs = documents(spark, [(i, t, "en", "a", n) for i, t, n in rows])
    found = d.find_overlaps(docs, spark.createDataFrame([(1, item, 1)], ITEM))
    assert sorted(r.n_chars for r in d.clean_documents(docs, found).collect()) == [1, 3, 4]
