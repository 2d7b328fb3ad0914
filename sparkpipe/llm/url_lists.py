"""URL filters: captures against dated list entries, as of the time they were fetched.

A list is a history of entries: on a date an entry is added to, or removed from, the
block or the allow list. An entry names a host (and with it every host below) or a host
with a path (and every path below). Histories become validity intervals; a capture is
looked up under every host and path it lies in, against the intervals that hold its
fetch time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Days of the time buckets that are part of the join key.
BUCKET_DAYS = 32


def host_of(url: Column) -> Column:
    """Lower-case host, without user, port, "www." and a final dot; null if none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    host = F.regexp_replace(host, r"^www\.|\.$", "")
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """Path without query, fragment and final slash."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.regexp_replace(path, "/+$", "")


def url_keys(url: Column, depth: int) -> Column:
    """The keys a URL lies under, most specific first.

    All paths of up to ``depth`` steps on its own host, the host, and every parent
    domain.
    """
    host, steps = host_of(url), F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    shown = F.least(F.size(steps), F.lit(depth))
    paths = F.transform(
        F.sequence(shown, F.lit(0), F.lit(-1)),
        lambda n: F.concat_ws("/", host, F.array_join(F.slice(steps, 1, n), "/")),
    )
    own = F.transform(paths, lambda p: F.regexp_replace(p, "/$", ""))
    labels = F.split(host, r"\.")
    rest = F.when(
        F.size(labels) > 1,
        F.transform(
            F.sequence(F.lit(2), F.size(labels)),
            lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host.isNotNull(), F.concat(own, rest))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, entry, since, until) from a history of (list, entry, action, at).

    ``action`` is "add" or "remove"; other actions and null columns are errors of the
    list and ignored. Of several actions on an entry at one time an "add" wins.
    Repeats change nothing: only changes of state open or close an interval. An open
    interval has a null ``until``. An entry's whole history is in one task, since its
    states follow from one another; it is first cut to one row per entry and time.
    """
    known = entries.where("action IN ('add', 'remove') AND list IS NOT NULL AND at IS NOT NULL")
    known = known.where("entry IS NOT NULL")
    states = known.groupBy("list", "entry", "at").agg(F.max(F.col("action") == "add").alias("on"))
    history = Window.partitionBy("list", "entry").orderBy("at")
    states = states.withColumn("was", F.lag("on", 1, False).over(history))
    changes = states.where("on != was").withColumn("until", F.lead("at").over(history))
    return changes.where("on").select("list", "entry", F.col("at").alias("since"), "until")


def _bucket(time: Column) -> Column:
    return F.floor(F.unix_seconds(time) / (86400 * BUCKET_DAYS)).cast("int")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Judge every capture (capture_id, url, fetched) by the list of its fetch time.

    Returns one row per row of ``captures``: capture_id, fetched, host, n_active
    (entries it fell under), rule ("block" or "allow"), entry (the most specific one
    that holds; on the same entry "allow" wins) and blocked. A null or hostless URL or
    a null time falls under no entry and is not blocked. Equal rows get equal answers.
    Empty captures give an empty result, an empty list blocks nothing.

    Captures meet intervals by key and time bucket, through a sort-merge join, whose
    crowded keys (a third of all captures may be of one host) Spark splits at run
    time. Equal captures are judged once: what is joined is the distinct (url key,
    time), so a hot host costs by its different fetch times, and results go back by
    (url, time).
    """
    latest = F.lit(captures.agg(F.max("fetched")).first()[0]).cast("timestamp")
    held = intervals(entries).where(F.col("since") <= latest)
    # A URL is looked up under as many steps as the deepest entry has.
    depth = entries.agg(F.max(F.size(F.split("entry", "/")))).first()[0] or 1
    depth -= 1
    end = F.least(F.coalesce(F.col("until"), latest), latest)
    held = held.select(
        "list",
        F.col("entry").alias("key"),
        "since",
        "until",
        F.explode(F.sequence(_bucket(F.col("since")), _bucket(end))).alias("bucket"),
    )
    rows = captures.select("capture_id", "url", "fetched")
    asked = rows.where("url IS NOT NULL AND fetched IS NOT NULL").select("url", "fetched")
    asked = asked.distinct()
    keys = asked.select(
        "url", "fetched", _bucket(F.col("fetched")).alias("bucket"),
        F.posexplode(url_keys(F.col("url"), depth)).alias("rank", "key"),
    )
    met = keys.hint("merge").join(held, ["key", "bucket"])
    met = met.where("fetched >= since AND (until IS NULL OR fetched < until)")
    best = F.min(F.struct("rank", "list", "key"))  # "allow" sorts before "block"
    found = met.groupBy("url", "fetched").agg(F.count("*").alias("n"), best.alias("best"))
    judged = rows.hint("merge").join(found, ["url", "fetched"], "left")
    return judged.select(
        "capture_id",
        "fetched",
        host_of(F.col("url")).alias("host"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_active"),
        F.col("best.list").alias("rule"),
        F.col("best.key").alias("entry"),
        F.coalesce(F.col("best.list") == "block", F.lit(False)).alias("blocked"),
    )
