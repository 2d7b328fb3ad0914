"""Inputs that the queries derive from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkpipe.functions.once import evaluated
from sparkpipe.llm.frames import SPACE
from sparkpipe.llm.url_lists import host_of

#: The conversation that holds the template's own control strings.
CLASH_ID, CLASH_TEXT = -7, "\\### Assistant: </turn> ok"


def with_clash(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    rows = [(CLASH_ID, 0, "user", CLASH_TEXT), (CLASH_ID, 1, "assistant", CLASH_TEXT)]
    clash = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(clash)


def _day(number) -> F.Column:
    return F.timestamp_seconds((number + 18262) * 86400)  # from 2020-01-01


def captures(pages: DataFrame) -> DataFrame:
    """Pages as captures, fetched on a day of four years that the page's id decides."""
    return pages.select(
        F.col("page_id").alias("capture_id"), "url", _day(F.col("page_id") * 7919 % 1461).alias("fetched")
    )


def list_history(pages: DataFrame) -> DataFrame:
    """A dated block and allow list over the hosts of ``pages`` and their sections.

    Digits of a key's md5 decide whether it is listed, and when entries come and go.
    """
    host = host_of(F.col("url"))
    section = F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z]+)/", 1)
    keys = pages.select(host.alias("host"), section.alias("section")).distinct()
    keys = keys.where("host IS NOT NULL")
    hosts = keys.select(F.col("host").alias("entry")).distinct()
    sections = keys.where("section != ''").select(F.concat_ws("/", "host", "section").alias("entry"))
    digest = F.md5(F.col("entry").cast("binary"))

    def digits(at: int, n: int) -> F.Column:
        return F.conv(F.substring(digest, at, n), 16, 10).cast("long")

    listed = hosts.unionByName(sections).select(
        F.when(digits(1, 2) < 48, "allow").otherwise("block").alias("list"),
        "entry",
        digits(3, 2).alias("chance"),
        (digits(5, 3) % 1461).alias("first"),
        (digits(8, 3) % 700 + 1).alias("gone"),
        (digits(11, 3) % 700 + 1).alias("again"),
    )
    listed = listed.where("chance < 160")
    first, gone, again = F.col("first"), F.col("gone"), F.col("again")
    events = F.array(
        F.struct(F.lit("add").alias("action"), _day(first).alias("at")),
        F.struct(F.lit("remove").alias("action"), _day(first + gone).alias("at")),
        F.struct(F.lit("add").alias("action"), _day(first + gone + again).alias("at")),
    )
    return listed.select("list", "entry", F.inline(F.slice(events, 1, (F.col("chance") % 3 + 1).cast("int"))))


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents, those with a crc32 of their id that ends in 0 made periodic.

    From word a on they repeat p words, both of which the crc32 decides.
    """
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", f"{SPACE}+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", F.floor(mark / 10).alias("g"), F.when(mark % 10 == 0, words).alias("w"))
    n, g = F.size("words"), F.col("g")
    rows = evaluated(chosen, "words", F.col("w")).withColumn("a", g % n)
    rows = rows.withColumn("p", F.floor((n - F.col("a")) / (3 + g % 8)) + 1)
    a, p = F.col("a").cast("int"), F.col("p").cast("int")
    periodic = F.transform("words", lambda w, i: F.when(i < a, w).otherwise(F.get("words", a + (i - a) % p)))
    text = F.when(n > 0, F.array_join(periodic, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))
