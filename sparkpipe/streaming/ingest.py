"""Streaming ingest: append, route, upsert, and how a query is run."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from sparkpipe.operators.contracts import check
from sparkpipe.operators.decode import decode
from sparkpipe.operators.merge import PREIMAGE, unique_by_key, upsert
from sparkpipe.operators.metrics import counters
from sparkpipe.operators.quality import QualityError, gate_observed, observed
from sparkpipe.streaming.keyed import latest_images, latest_rows, rocks_store

# Fixed value: micro-batch interval of the ingest stream.
INTERVAL = "10 seconds"

Batch = tuple[int, int]  # number of the run, number of the batch in it


def _triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """A micro-batch interval, or with None all that is there now, then stop."""
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def _outside(path: str, checkpoint: str) -> str:
    if f"{checkpoint.rstrip('/')}/".startswith(f"{path.rstrip('/')}/"):
        raise ValueError("the checkpoint must lie outside the table folder")
    return checkpoint


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append to a file table; each input row arrives there exactly once."""
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", _outside(path, checkpoint))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _triggered(writer, interval).start(path)


def ingest_raw(
    stream: DataFrame, domain: str, path: str, checkpoint: str, interval: str | None = INTERVAL
) -> StreamingQuery:
    """Topic messages to the raw table, every message a row."""
    rows = decode(stream, domain).withColumn("processing_timestamp", F.current_timestamp())
    return append_stream(rows, path, checkpoint, interval)


def ingest_routed(
    stream: DataFrame, domain: str, path: str, checkpoint: str, interval: str | None = INTERVAL
) -> StreamingQuery:
    """Each message with its reasons under ``route=malformed|dlq|curated``.

    A single pass decodes, judges and writes all routes; readers of one route
    skip the files of the others.
    """
    rows = check(stream, domain).drop("record")
    return append_stream(rows, path, checkpoint, interval, ["route"])


def publish_stream(
    messages: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    interval: str | None = INTERVAL,
    **options: str,
) -> StreamingQuery:
    """Messages to a topic, or with a ``topic`` column each to its own."""
    writer = (
        messages.writeStream.format(fmt)
        .outputMode("append")
        .options(**options)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, interval).start()


def upsert_stream(
    df: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    interval: str | None = INTERVAL,
) -> StreamingQuery:
    """The upserts of every micro-batch, one row per key, in a folder of the batch.

    With ``order_by`` the greatest row of a key wins over all batches: the stream keeps it
    as keyed state, so no earlier batch is read again and a row that comes late changes
    nothing. Without, a later batch wins and two rows of a key in one batch are an error.

    A batch that runs again replaces its own folder. :func:`upserted` applies the rows to
    a table; the query must be the only one that writes below ``root``.
    """
    if order_by:
        latest = latest_rows(df, keys, order_by)
        return _each_batch(latest, root, checkpoint, interval, "update")

    def write(batch: DataFrame, folder: str) -> None:
        _overwrite(unique_by_key(batch, keys), folder)

    return _each_batch(df, root, checkpoint, interval, "append", write)


def change_stream(
    df: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    interval: str | None = INTERVAL,
    keep: datetime.timedelta | None = None,
) -> StreamingQuery:
    """The changes that every micro-batch makes, with ``_change_type``, in its folder.

    What :func:`sparkpipe.streaming.keyed.latest_images` gives, laid out as the upserts
    of :func:`upsert_stream`: derived tables can be kept up from it batch by batch.
    State that ages needs an ``interval``: a run over what is there now would go on for
    ever, looking for state to drop.
    """
    if keep and interval is None:
        raise ValueError("state that ages needs an interval")
    images = latest_images(df, keys, order_by, keep)
    return _each_batch(images, root, checkpoint, interval, "update")


def gated_stream(
    df: DataFrame,
    root: str,
    checkpoint: str,
    rules: Mapping[str, Column],
    interval: str | None = INTERVAL,
) -> StreamingQuery:
    """Append batches in folders of their own; one that breaks a rule fails the query.

    The rules are counted by the write itself. The rows of a failed batch are taken away
    again, and as its offsets are not committed, a restart gives it another try.
    """

    def write(batch: DataFrame, folder: str) -> None:
        rows, seen = observed(batch, rules)
        rows.write.mode("overwrite").parquet(folder)
        try:
            gate_observed(seen, rules)
        except QualityError:
            _remove(batch.sparkSession, folder)
            raise

    return _each_batch(df, root, checkpoint, interval, "append", write)


def batches_after(spark: SparkSession, root: str, since: Batch | None = None) -> DataFrame:
    """What a stream wrote below ``root`` in batches after ``since``; others are not read."""
    written = spark.read.parquet(root)
    if since is None:
        return written
    run, batch = since
    return written.filter((F.col("run") > run) | ((F.col("run") == run) & (F.col("batch") > batch)))


def newest_batch(spark: SparkSession, root: str) -> Batch | None:
    """The newest batch below ``root``, read from folder names."""
    runs = _numbers(spark, root, "run")
    for run in sorted(runs, reverse=True):
        batches = [n for path in _folders(spark, runs[run]) for n in _numbers(spark, path, "batch")]
        if batches:
            return run, max(batches)
    return None


def upserted(base: DataFrame, root: str, keys: Sequence[str], since: Batch | None = None) -> DataFrame:
    """``base`` after the batches of an upsert stream; the latest batch wins per key.

    A base that holds all batches up to ``since`` needs only those after it.
    """
    rows = batches_after(base.sparkSession, root, since)
    if "_change_type" in rows.columns:
        rows = rows.filter(F.col("_change_type") != PREIMAGE)
    latest = unique_by_key(rows, keys, ["run", "batch"])
    return upsert(base, latest.select(*base.columns), keys)


def counter_stream(
    df: DataFrame,
    attributes: Sequence[str],
    root: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
) -> StreamingQuery:
    """Running counts per attribute set; a batch writes the totals it changes, no others."""
    return _each_batch(counters(df, attributes), root, checkpoint, interval, "update")


def latest_totals(
    spark: SparkSession, root: str, base: DataFrame | None = None, since: Batch | None = None
) -> DataFrame:
    """The totals of the newest run below ``root``: per attribute set those of its last batch.

    Totals read up to the batch ``since`` may be given as ``base``; then only later batches
    are read. A run that is newer than ``since`` counts from nothing and replaces them.
    """
    newest = max(_numbers(spark, root, "run"))
    rows = batches_after(spark, root, since).filter(F.col("run") == newest)
    rows = rows.drop("run", "query")
    if base is not None and since is not None and since[0] == newest:
        rows = rows.unionByName(base.withColumn("batch", F.lit(-1)))
    attributes = [c for c in rows.columns if c not in ("batch", "ingested_total")]
    last = F.max_by("ingested_total", "batch").alias("ingested_total")
    return rows.groupBy(*attributes).agg(last)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The folders in a folder, by the file system that Spark uses for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return []
    return [s.getPath().toString() for s in files.listStatus(at) if s.isDirectory()]


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _overwrite(batch: DataFrame, folder: str) -> None:
    batch.write.mode("overwrite").parquet(folder)


def _numbers(spark: SparkSession, path: str, name: str) -> dict[int, str]:
    """The folders ``name=<number>`` in a folder, by number."""
    found = {}
    for folder in _folders(spark, path):
        last = folder.rsplit("/", 1)[1]
        if last.startswith(f"{name}="):
            found[int(last.removeprefix(f"{name}="))] = folder
    return found


def _run_of(spark: SparkSession, root: str, query: str) -> int:
    """The number of a query's run: its own from before, or one after all others."""
    runs = _numbers(spark, root, "run")
    for run, folder in runs.items():
        if any(f.endswith(f"/query={query}") for f in _folders(spark, folder)):
            return run
    return max(runs, default=-1) + 1


def _each_batch(df, root, checkpoint, interval, mode, put=_overwrite) -> StreamingQuery:
    """Put each batch into ``root/run=<number>/query=<id>/batch=<number>``.

    The id is the query's own, kept in its checkpoint: a new checkpoint, even one in the
    place of an old one, is another query and counts its batches from 0. Runs are
    numbered in the order in which their queries first wrote, whatever any clock says.
    """
    place = []

    def put_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if not place:
            query = spark.read.json(f"{checkpoint}/metadata").first()["id"]
            place.append(f"{root}/run={_run_of(spark, root, query)}/query={query}")
        put(batch, f"{place[0]}/batch={number}")

    writer = (
        df.writeStream.outputMode(mode)
        .foreachBatch(put_batch)
        .option("checkpointLocation", _outside(root, checkpoint))
    )
    with rocks_store(df.sparkSession):
        return _triggered(writer, interval).start()


def run_available(query: StreamingQuery) -> None:
    """Wait until a query over what is there now has finished; raise if it failed."""
    query.awaitTermination()


def run_bounded(query: StreamingQuery, seconds: float) -> None:
    """Let a query run for a while, then stop it."""
    try:
        query.awaitTermination(seconds)
    finally:
        query.stop()


def run_forever(query: StreamingQuery, spark: SparkSession) -> None:
    """Wait until interrupted, then stop the query and the session."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()
        spark.stop()
