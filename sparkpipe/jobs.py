"""One command per pipeline step, for spark-submit.

    spark-submit jobs.py curate /lake/raw /lake/curated --lookup /lake/merchants

Connector packages and credentials come from spark-submit's own options.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkpipe.operators import curate, flatten, merge, quality, score
from sparkpipe.plans import flow
from sparkpipe.schemas import domain_of
from sparkpipe.session import build_session
from sparkpipe.sources import documents, jdbc, streams, tables
from sparkpipe.streaming import ingest


def _pairs(items: Sequence[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Topic to raw table, or to one partition per route."""
    domain = domain_of(args.topic)
    if args.format == "kafka":
        stream = streams.topic_stream(
            spark, args.source, args.topic, options=_pairs(args.read_option)
        )
    else:
        stream = streams.file_stream(spark, args.source, "value string", args.format)
    start = ingest.ingest_routed if args.routed else ingest.ingest_raw
    checkpoint = args.checkpoint or f"{args.table.rstrip('/')}-checkpoint"
    interval = None if args.available_now else args.interval
    query = start(stream, domain, args.table, checkpoint, interval)
    if args.available_now:
        ingest.run_available(query)
    elif args.seconds:
        ingest.run_bounded(query, args.seconds)
    else:
        ingest.run_forever(query, spark)


def _lookup(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    if args.lookup_url:
        return jdbc.read_jdbc(
            spark,
            args.lookup_url,
            args.lookup_table,
            _pairs(args.option),
            args.lookup_column,
            *(args.lookup_range or (None, None, None)),
        )
    return tables.read_table(spark, args.lookup) if args.lookup else None


def _read(spark: SparkSession, args: argparse.Namespace, path: str) -> DataFrame:
    return tables.read_table(spark, path, args.table_format, _pairs(args.read_option))


def _write(df: DataFrame, args: argparse.Namespace, path: str) -> None:
    tables.write_table(df, path, args.table_format, _pairs(args.write_option))


def run_curate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Raw table to the curated table, which is replaced."""
    raw = _read(spark, args, args.raw)
    if args.preview:
        tables.preview(raw)
    _write(curate.stamped(curate.curate(raw, _lookup(spark, args))), args, args.curated)


def run_pipeline(spark: SparkSession, args: argparse.Namespace) -> None:
    """Messages to contract, curated table, rule gate and scored table, as one job.

    Messages that break their contract do not get into the curated table.
    """
    messages = tables.read_table(spark, args.source, args.format)
    scored = flow.messages_to_scored(
        spark, messages, _lookup(spark, args), args.curated, threshold=args.threshold,
        training_rows=args.training_rows or None, fmt=args.table_format,
    )
    _write(curate.stamped(scored, "inference_timestamp"), args, args.output)


def run_documents(spark: SparkSession, args: argparse.Namespace) -> None:
    """Document collection to a flat table, which is replaced."""
    docs = documents.read_documents(
        spark, args.source, args.format, _pairs(args.option), sampling_ratio=args.sampling_ratio
    )
    if tables.is_empty(docs):
        print(f"no documents in {args.source}")
        return
    if args.preview:
        tables.preview(docs)
    flat = flatten.transform_documents(docs, args.collection)
    _write(curate.stamped(flat, "processing_timestamp"), args, args.output)


def run_merge(spark: SparkSession, args: argparse.Namespace) -> None:
    """Keyed merge of a source into a table, created from a seed if absent.

    A matched row takes the source's value of the columns in ``--update`` and
    its time of change; all others keep theirs. Without ``--update`` every
    column is taken over. The result goes to a folder of its own, or with
    ``--in-place`` the table, then a name in the catalog, merges it itself.
    """
    now = F.current_timestamp()
    if args.seed:
        seed = _read(spark, args, args.seed).withColumns({"created_at": now, "updated_at": now})
        tables.create_if_absent(seed, args.table, args.table_format, _pairs(args.write_option))
    source = _read(spark, args, args.source).withColumn("updated_at_incoming", now)
    target = spark.table(args.table) if args.in_place else _read(spark, args, args.table)
    columns = target.columns
    times = {c: "updated_at_incoming" for c in ("created_at", "updated_at") if c in columns}
    insert = {c: times.get(c, c) for c in columns}
    chosen = args.update or [c for c in columns if c not in args.key and c not in times]
    update = {c: c for c in chosen}
    if "updated_at" in times:
        update["updated_at"] = times["updated_at"]
    if args.in_place:
        merge.merge_table(source, args.table, args.key, update, insert, args.order_by)
    elif not args.output:
        raise ValueError("name an --output folder, or merge --in-place")
    else:
        merged = merge.merge(target, source, args.key, update, insert, args.order_by)
        _write(merged, args, args.output)


def run_feed(spark: SparkSession, args: argparse.Namespace) -> None:
    """Row changes between two states of a table."""
    before, after = _read(spark, args, args.before), _read(spark, args, args.after)
    _write(merge.change_feed(before, after, args.key, args.ignore), args, args.output)


def run_gate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Fail if a curated row breaks one of the named rules."""
    rules = quality.curated_rules()
    chosen = {name: rules[name] for name in args.rule} if args.rule else rules
    rows = _read(spark, args, args.curated)
    quality.gate(quality.rule_suite(rows, chosen))


def run_score(spark: SparkSession, args: argparse.Namespace) -> None:
    """Curated table to the scored table, which is replaced."""
    rows = _read(spark, args, args.curated)
    if tables.is_empty(rows):
        print(f"no rows in {args.curated}")
        return
    featured = score.features(rows, args.threshold)
    scored = score.score(featured, score.fit(featured, args.training_rows or None))
    _write(curate.stamped(scored, "inference_timestamp"), args, args.output)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(
        prog="sparkpipe",
        description=__doc__,
        formatter_class=argparse.RawDescriptionHelpFormatter,
    )
    steps = root.add_subparsers(dest="step", required=True)

    def step(name: str, run, *positional: str) -> argparse.ArgumentParser:
        sub = steps.add_parser(name, help=run.__doc__.splitlines()[0])
        for argument in positional:
            sub.add_argument(argument)
        sub.add_argument("--table-format", default="parquet")
        sub.add_argument("--read-option", action="append", default=[])
        sub.add_argument("--write-option", action="append", default=[])
        sub.set_defaults(run=run)
        return sub

    def lookup(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--lookup")
        sub.add_argument("--lookup-url")
        sub.add_argument("--lookup-table", default="merchant_lookup")
        sub.add_argument("--lookup-column", help="numeric column to split the read by")
        sub.add_argument("--lookup-range", nargs=3, type=int, metavar=("LOWER", "UPPER", "PARTS"))
        sub.add_argument("--option", action="append", default=[])

    sub = step("ingest", run_ingest, "topic", "source", "table")
    sub.add_argument("--format", default="kafka")
    sub.add_argument("--routed", action="store_true")
    sub.add_argument("--checkpoint")
    sub.add_argument("--interval", default=ingest.INTERVAL)
    sub.add_argument("--seconds", type=float)
    sub.add_argument("--available-now", action="store_true")

    sub = step("curate", run_curate, "raw", "curated")
    lookup(sub)
    sub.add_argument("--preview", action="store_true")

    sub = step("pipeline", run_pipeline, "source", "curated", "output")
    lookup(sub)
    sub.add_argument("--format", default="parquet", help="of the messages")
    sub.add_argument("--threshold", type=float, default=score.THRESHOLD)
    sub.add_argument("--training-rows", type=int, default=score.TRAINING_ROWS)

    sub = step("documents", run_documents, "source", "collection", "output")
    sub.add_argument("--format", default="json")
    sub.add_argument("--option", action="append", default=[])
    sub.add_argument("--sampling-ratio", type=float)
    sub.add_argument("--preview", action="store_true")

    sub = step("merge", run_merge, "table", "source")
    sub.add_argument("--key", action="append", required=True)
    sub.add_argument("--update", action="append")
    sub.add_argument("--order-by", action="append")
    sub.add_argument("--seed")
    sub.add_argument("--output")
    sub.add_argument("--in-place", action="store_true")

    sub = step("feed", run_feed, "before", "after", "output")
    sub.add_argument("--key", action="append", required=True)
    sub.add_argument("--ignore", action="append", default=[])

    sub = step("gate", run_gate, "curated")
    sub.add_argument("--rule", action="append")

    sub = step("score", run_score, "curated", "output")
    sub.add_argument("--threshold", type=float, default=score.THRESHOLD)
    sub.add_argument("--training-rows", type=int, default=score.TRAINING_ROWS)
    return root


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(f"sparkpipe-{args.step}"), args)


if __name__ == "__main__":
    main(sys.argv[1:])
