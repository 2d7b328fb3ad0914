import datetime
import random

import pytest
from pyspark.sql import functions as F

from sparkpipe.operators import history, merge

DAY0 = datetime.datetime(2024, 1, 1)
HISTORY = "id long, name string, price double, valid_from timestamp, valid_to timestamp"
CHANGES = "id long, name string, price double, at timestamp, gone boolean"


def day(n):
    return None if n is None else DAY0 + datetime.timedelta(days=n)


def held(rows):
    return sorted(rows, key=str)


def replay(rows, changes):
    """Set every day by every row and change in turn, then read the days off again."""
    last, keys = 200, {r[0] for r in rows} | {c[0] for c in changes}
    out = []
    for key in keys:
        starts = {r[3]: (r[1], r[2]) for r in rows if r[0] == key}
        for _, _, _, _, end in (r for r in rows if r[0] == key):
            if end is not None:
                starts.setdefault(end, None)
        for _, name, price, at, gone in sorted((c for c in changes if c[0] == key), key=lambda c: c[2]):
            starts[at] = None if gone else (name, price)
        days = [None] * last
        for at in sorted(starts):
            days[at:] = [starts[at]] * (last - at)
        begin = 0
        for d in range(1, last + 1):
            if d == last or days[d] != days[begin]:
                if days[begin] is not None:
                    out.append((key, *days[begin], begin, d if d < last else None))
                begin = d
    return held(out)


def run(spark, rows, changes, **options):
    table = spark.createDataFrame([(*r[:3], day(r[3]), day(r[4])) for r in rows], HISTORY)
    came = spark.createDataFrame([(*c[:3], day(c[3]), c[4]) for c in changes], CHANGES)
    after = history.merge_history(table, came, ["id"], "at", ["price"], F.col("gone"), **options)
    return held(
        tuple((x - DAY0).days if isinstance(x, datetime.datetime) else x for x in r) for r in after.collect()
    )


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("seed", range(2))
def test_history_is_that_of_a_replay(spark, seed, small):
    draw = random.Random(seed)
    rows, changes = [], []
    for key in range(30):
        at = draw.randrange(20)
        for n in range(draw.randrange(4)):
            end = at + draw.randrange(1, 20)
            rows.append((key, "ab"[draw.randrange(2)], float(n), at, end))
            at = end + draw.choice([0, 0, 7])
        if rows and rows[-1][0] == key and draw.random() < 0.5:
            rows[-1] = (*rows[-1][:4], None)
        # Prices of one key differ, so that no two changes at one time tie.
        for n in range(draw.randrange(5)):
            changes.append((key, draw.choice(["a", "b", None]), 10.0 + n // 2, draw.randrange(90), draw.random() < 0.2))
        seen = {}
        for c in [c for c in changes if c[0] == key]:
            seen[c[2], c[3]] = c
        changes = [c for c in changes if c[0] != key] + list(seen.values())
    assert run(spark, rows, changes, small=small) == replay(rows, changes)


def test_a_late_change_splits_the_row_that_held(spark):
    rows = [(1, "a", 1.0, 0, 50), (1, "a", 2.0, 50, None)]
    assert run(spark, rows, [(1, "a", 9.0, 20, False)]) == held(
        [(1, "a", 1.0, 0, 20), (1, "a", 9.0, 20, 50), (1, "a", 2.0, 50, None)]
    )


def test_a_change_to_what_holds_changes_nothing(spark):
    rows = [(1, "a", 1.0, 0, None)]
    assert run(spark, rows, [(1, "a", 1.0, 20, False)]) == rows
    assert run(spark, rows, []) == rows
    assert run(spark, [], [(1, "a", 1.0, 3, True)]) == []


def test_a_change_without_key_or_time_is_refused(spark):
    for change in ((None, "a", 1.0, 3, False), (1, "a", 1.0, None, False)):
        with pytest.raises(Exception, match="NULL key or time"):
            run(spark, [(1, "a", 1.0, 0, None)], [change], small=False)


def test_many_changes_meet_history_in_one_shuffle(spark):
    table = spark.createDataFrame([(1, "a", 1.0, day(0), None)], HISTORY)
    came = spark.createDataFrame([(1, "a", 2.0, day(1), False)], CHANGES)
    after = history.merge_history(table, came, ["id"], "at", ["price"], small=False)
    plan = after._jdf.queryExecution().executedPlan().toString()
    # One for the changes of one key at one time, one for all rows by key.
    assert plan.count("Exchange hashpartitioning(id") == 2 and "Join" not in plan


def test_history_of_a_change_feed(spark):
    first = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id long, name string, price double")
    second = spark.createDataFrame([(1, "a", 5.0), (3, "c", 3.0)], first.schema)
    feed = merge.feed_of_states([first, second], ["id"])
    time = F.lit(DAY0) + F.make_dt_interval(F.col("_commit_version").cast("int"))
    changes, gone = history.history_of_feed(feed, time)
    empty = spark.createDataFrame([], HISTORY)
    after = history.merge_history(empty, changes, ["id"], "_time", ["_commit_version"], gone)
    assert held(map(tuple, after.collect())) == held(
        [(1, "a", 1.0, day(0), day(1)), (1, "a", 5.0, day(1), None), (2, "b", 2.0, day(0), day(1)), (3, "c", 3.0, day(1), None)]
    )


@pytest.mark.parametrize("hot_share, slices", [(0.001, 5), (1.0, None)])
def test_as_of_join_finds_the_last_row_before(spark, hot_share, slices):
    draw = random.Random(4)
    side = [(draw.choice([1, 2, 3, None]), draw.choice([*range(40), None]), n, draw.choice([None, 25])) for n in range(40)]
    facts = [(n, draw.choice([1, 1, 1, 1, 2, 3, 4, None]), draw.choice([*range(50), None])) for n in range(300)]
    left = spark.createDataFrame([(n, k, day(t)) for n, k, t in facts], "n long, k long, t timestamp")
    right = spark.createDataFrame([(k, day(t), n, day(u)) for k, t, n, u in side], "k long, since timestamp, v long, until timestamp")
    joined = history.as_of_join(left, right, ["k"], "t", "since", ["v"], "until", hot_share, slices)
    expected = {}
    for n, k, t in facts:
        rows = [s for s in side if k is not None and t is not None and s[0] == k and s[1] is not None and s[1] <= t]
        best = max(rows, key=lambda s: (s[1], s[2]), default=None)
        expected[n] = best[2] if best and (best[3] is None or best[3] > t) else None
    found = joined.collect()
    assert len(found) == len(facts) and {r.n: r.v for r in found} == expected


def test_a_crowded_key_is_cut_by_time(spark):
    facts = spark.range(4000).select(F.lit(1).cast("long").alias("k"), F.timestamp_seconds("id").alias("t"), "id")
    side = spark.range(0, 4000, 500).select(F.lit(1).cast("long").alias("k"), F.timestamp_seconds("id").alias("at"), F.col("id").alias("v"))
    joined = history.as_of_join(facts, side, ["k"], "t", "at", ["v"], slices=16)
    assert joined.filter("v != id - id % 500").isEmpty() and joined.count() == 4000
    spread = joined.select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 1
