import datetime
import random

from odd import tuples

from sparkpipe.llm import url_lists

DAY = datetime.datetime(2024, 1, 1)
CAPTURES = "capture_id long, url string, fetched timestamp, entry string, list string"
ENTRIES = "list string, entry string, action string, at timestamp, url string"


def at(day):
    return DAY + datetime.timedelta(days=day)


def brute(captures, history):
    states = {}
    for name, entry, action, when, _ in history:
        if None in (name, entry, when) or action not in ("add", "remove"):
            continue
        days = states.setdefault((name, entry), {})
        days[when] = max(days.get(when, False), action == "add")
    out = []
    for cid, keys, fetched in captures:
        hits = []
        for (name, entry), days in states.items():
            past = [d for d in days if fetched is not None and d <= fetched]
            if past and days[max(past)] and entry in keys:
                hits.append((keys.index(entry), name, entry))
        best = min(hits, default=(None, None, None))
        out.append((cid, len(hits), best[1], best[2], best[1] == "block"))
    return out


def test_against_brute_force(spark):
    chance = random.Random(2)
    hosts = ["a.example.com", "b.example.com", "example.com", "other.org"]
    captures, known = [], []
    for cid in range(300):
        host, steps = chance.choice(hosts), chance.sample(["x", "y", "z"], chance.randint(0, 2))
        labels = host.split(".")
        keys = ["/".join([host, *steps[:n]]) for n in range(len(steps), -1, -1)]
        keys += [".".join(labels[n:]) for n in range(1, len(labels))]
        fetched = at(chance.randint(0, 400))
        captures.append((cid, f"http://www.{host}/{'/'.join(steps)}?q#f", fetched, "e", "l"))
        known.append((cid, keys, fetched))
    names = ["a.example.com", "a.example.com/x", "example.com", "com", "other.org/y/z", "b.example.com/z"]
    history = [
        (chance.choice(["block", "allow"]), chance.choice(names), chance.choice(["add", "remove", "odd"]),
         at(chance.randint(0, 400)), "u")
        for _ in range(60)
    ]
    history += history[:5]
    got = url_lists.judge(
        spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(history, ENTRIES)
    )
    assert tuples(got, "capture_id", "n_active", "rule", "entry", "blocked") == brute(known, history)


def test_odd_rows(spark):
    rows = [
        (1, None, at(1), "e", "l"),
        (2, "not a url", at(1), "e", "l"),
        (3, "http://x.org/", None, "e", "l"),
        (3, "http://x.org/", at(1), "e", "l"),
        (3, "http://x.org/", at(1), "e", "l"),
        (None, "HTTP://user:pw@WWW.X.org.:80/a//b/?q", at(1), "e", "l"),
        (4, "http://x.org/" + "s/" * 5000, at(1), "e", "l"),
    ]
    captures = spark.createDataFrame(rows, CAPTURES)
    history = [
        ("block", "x.org", "add", at(1), "u"),
        (None, "x.org", "add", at(0), "u"),
        ("allow", None, "add", at(0), "u"),
        ("allow", "x.org", None, at(0), "u"),
        ("allow", "x.org", "add", None, "u"),
    ]
    entries = spark.createDataFrame(history, ENTRIES)
    got = tuples(url_lists.judge(captures, entries), "capture_id", "blocked")
    assert got == [(None, True), (1, False), (2, False), (3, False), (3, True), (3, True), (4, True)]
    assert url_lists.judge(captures.limit(0), entries).count() == 0
    assert url_lists.judge(captures, entries.limit(0)).where("blocked").count() == 0


def test_intervals(spark):
    history = [
        ("block", "e", action, at(day), "u")
        for action, day in [("remove", 0), ("add", 1), ("add", 2), ("remove", 3), ("remove", 4), ("add", 5), ("remove", 5)]
    ]
    got = url_lists.intervals(spark.createDataFrame(history, ENTRIES))
    # On the last day an entry is added and removed at one time, and the add wins.
    assert tuples(got, "since", "until") == [(at(1), at(3)), (at(5), None)]


def test_an_entry_of_many_steps_holds(spark):
    deep = "h.org/" + "/".join(str(k) for k in range(1, 13))
    captures = spark.createDataFrame(
        [(1, f"http://{deep}/more", at(2), "e", "l"), (2, "http://h.org/1/2/3", at(2), "e", "l")], CAPTURES
    )
    entries = spark.createDataFrame([("block", deep, "add", at(1), "u")], ENTRIES)
    assert tuples(url_lists.judge(captures, entries), "capture_id", "blocked") == [(1, True), (2, False)]
