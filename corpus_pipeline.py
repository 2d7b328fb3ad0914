"""The training-data pipeline: stages that take documents and return documents."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from sparkpipe.llm import chains, decontaminate, jaccard, mixing, queries, records
from sparkpipe.llm.frames import WORKER_MEMORY, visible_to_workers, written
from sparkpipe.plans.inputs import table


#: Workers also hold what earlier stages left behind, so the last remembers fewer pieces.
PIECES_KEPT = 1 << 17

#: And they give back smaller stretches of memory than those of a single operator do.
STAGE_MEMORY = {
    **WORKER_MEMORY,
    "MALLOC_MMAP_THRESHOLD_": str(256 << 10),
    "MALLOC_TRIM_THRESHOLD_": str(1 << 20),
}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents the classifier chain finds toxic; all others stay.

    The chain is trained on the labelled documents among ``docs``. Rows with a null id
    are scored like any other; a null text is scored as an empty one.
    """
    chain = queries.toxicity_chain(docs, table(spark, sf_dir, "labels"))
    return chains.keep_below(docs, chain, "toxic", 0.5)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near duplicates the document with the lowest id.

    Of several rows with that id the first text in order stays. Documents without
    words, or without an id, are near duplicates of nothing and all stay.
    """
    return jaccard.one_per_component(docs, jaccard.jaccard_join(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that overlap with a benchmark item; all others stay."""
    found = decontaminate.find_overlaps(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.clean_documents(docs, found)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or thin out documents until sources meet their weights."""
    return mixing.mixed_documents(mixing.mix(docs))


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token records and return the digest of what is read back."""
    made = records.round_trip(docs, queries.TOKENIZER, queries.END_ID, kept=PIECES_KEPT)
    return records.records_digest(made)


def _visible(stage):
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        visible_to_workers(spark, STAGE_MEMORY)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("toxicity", _visible(drop_toxic)),
    ("near_duplicates", _visible(one_of_each_group)),
    ("decontamination", _visible(drop_contaminated)),
    ("mixing", _visible(mix_sources)),
    ("token_records", _visible(token_records)),
]

#: SQL cannot express the first stage, which trains a model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
