import random
import zlib

import odd
import pytest

from sparkpipe.llm import inputs, runs

REPEATS = [(4, 6), (3, 6), (2, 2), (2, 6)]


def brute(words, repeats=4, least=6):
    """Every maximal stretch of every period; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, repeats * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def texts(n, seed):
    draw = random.Random(seed)
    for _ in range(n):
        letters = draw.choice([1, 2, 2, 3, 6])
        words = [b"abcdef"[k : k + 1] for k in (draw.randrange(letters) for _ in range(draw.randrange(60)))]
        if words and draw.random() < 0.7:
            p = draw.randint(1, 8)
            words = words[:5] + [words[i % p] for i in range(len(words))] + words[-5:]
            if draw.random() < 0.5:
                words[draw.randrange(len(words))] = b"z"
        yield words


@pytest.mark.parametrize("repeats, least", REPEATS)
def test_automaton_finds_all_runs(repeats, least):
    for words in texts(600, seed=repeats):
        assert runs.runs_of(words, repeats, least) == brute(words, repeats, least)


@pytest.mark.parametrize("repeats, least", REPEATS)
def test_stretches_lose_no_run(repeats, least):
    for words in texts(300, seed=least):
        batch, found = [words[::-1], [], words, words[:3], words], []
        for t, first, n in runs.stretches(batch, repeats, least):
            if t == 2:
                found += [(first + s, l, q) for s, l, q in runs.runs_of(words[first : first + n], repeats, least)]
        assert sorted(found, key=lambda r: (r[0], r[2])) == brute(words, repeats, least)


def test_prose_is_sorted_out_before_the_automaton():
    draw = random.Random(5)
    words = [b"w%d" % min(draw.randrange(1, 400), draw.randrange(1, 400)) for _ in range(5000)]
    assert sum(n for _, _, n in runs.stretches([words])) < 500


def test_a_long_text_of_one_period_takes_linear_time():
    words = [b"%d" % (i % 7000) for i in range(150_000)]
    assert runs.runs_of(words) == [(0, 150_000, 7000)]
    assert runs.runs_of([b"a"] * 150_000) == [(0, 150_000, 1)]


def test_odd_rows(spark):
    docs = odd.documents(spark)
    found = odd.tuples(runs.find_runs(docs), "doc_id", "n_words", "collapsed")
    expected = []
    for doc_id, text in docs.select("doc_id", "text").collect():
        words = (text or "").encode().split()
        keep = [True] * len(words)
        for start, n, q in brute(words) if len(words) < 5000 else [(0, len(words), 5)]:
            keep[start + q : start + n] = [False] * (n - q)
        expected.append((doc_id, len(words), b" ".join(w for w, k in zip(words, keep) if k).decode()))
    key = lambda r: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in r)
    assert found == sorted(expected, key=key)
    digest = {r.doc_id: r for r in runs.runs_digest(runs.find_runs(docs)).collect()}
    assert digest[4].n_runs == 0 and digest[4].start is None and digest[4].exponent_milli is None
    assert digest[4].runs_sha256 == digest[4].collapsed_sha256 == digest[5].collapsed_sha256
    assert (digest[7].start, digest[7].length, digest[7].period) == (0, 20_000, 5)


def test_empty_table(spark):
    assert runs.runs_digest(runs.find_runs(inputs.with_periods(odd.empty(spark)))).isEmpty()


def test_made_periods(spark):
    docs = odd.documents(spark, [(i, " ".join(f"w{k}" for k in range(i % 50)), "en", "a", 1) for i in range(200)] + [(None, "a b", "en", "a", 1)])
    for doc_id, text in inputs.with_periods(docs).collect():
        if doc_id is None:
            assert text == "a b"
            continue
        words, h = [f"w{k}" for k in range(doc_id % 50)], zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        assert text == " ".join(words)
