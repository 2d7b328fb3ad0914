"""The registered queries of this subpackage."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import functions as F

from sparkpipe.llm import (
    bwt, chains, chat, codes, decontaminate, inputs, jaccard, mixing, nearest, records, risk, runs, secrets,
    url_lists,
)
from sparkpipe.llm.frames import visible_to_workers
from sparkpipe.plans.inputs import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2

LLM_QUERIES = {}


def query(run):
    @functools.wraps(run)
    def visible(spark, sf):
        visible_to_workers(spark)
        return run(spark, sf)

    LLM_QUERIES[run.__name__] = visible
    return visible


def _documents(spark, sf):
    return table(spark, sf, "documents")


@query
def op1_token_records(spark, sf):
    return records.records_digest(records.round_trip(_documents(spark, sf), TOKENIZER, END_ID))


@query
def op2_risk_rules(spark, sf):
    return risk.quality_digest(risk.judge(_documents(spark, sf), table(spark, sf, "labels")))


@query
def op3_spaced_seeds(spark, sf):
    return decontaminate.find_overlaps(_documents(spark, sf), table(spark, sf, "benchmark"))


CATEGORIES = ("junk", "abusive_prose", "toxic")


def toxicity_chain(docs, labels):
    """Junk first, then abuse in otherwise good text, then toxicity as such."""
    marks = labels.select(
        "doc_id",
        (F.col("quality") == 0).cast("int").alias("junk"),
        ((F.col("toxic") == 1) & (F.col("quality") == 1)).cast("int").alias("abusive_prose"),
        F.col("toxic").cast("int").alias("toxic"),
    )
    return chains.fit_chain(docs, marks, CATEGORIES)


@query
def op4_toxicity_chain(spark, sf):
    docs = _documents(spark, sf)
    scored = chains.predict(docs, toxicity_chain(docs, table(spark, sf, "labels")), "doc_id")
    return scored.withColumn("toxic", F.col("p_toxic") >= 0.5)


@query
def op5_secret_scan(spark, sf):
    return secrets.secrets_digest(secrets.find_secrets(_documents(spark, sf)))


@query
def op6_jaccard_join(spark, sf):
    joined = jaccard.jaccard_join(_documents(spark, sf))
    return joined.select("doc_id", "n_shingles", "component_id")


@query
def op7_mix_sources(spark, sf):
    return mixing.mixed_digest(mixing.mix(_documents(spark, sf)))


@query
def op8_url_lists(spark, sf):
    pages = table(spark, sf, "pages")
    return url_lists.judge(inputs.captures(pages), inputs.list_history(pages))


@query
def op9_bwt_dedup(spark, sf):
    return bwt.repeats_digest(bwt.remove_repeats(_documents(spark, sf)))


@query
def op10_format_chats(spark, sf):
    rows = inputs.with_clash(table(spark, sf, "conversations"))
    return chat.chat_digest(chat.format_chats(rows))


@query
def op11_word_runs(spark, sf):
    return runs.runs_digest(runs.find_runs(inputs.with_periods(_documents(spark, sf))))


@query
def op12_vector_codes(spark, sf):
    vectors = table(spark, sf, "embeddings")
    books = codes.fit_codebooks(vectors)
    return codes.codes_digest(codes.with_label_error(codes.encode(vectors, books)), books)


@query
def op13_collision_search(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return nearest.nearest(vectors, vectors.where("vec_id % 20 = 0"))
