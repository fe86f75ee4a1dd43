"""A corpus from raw documents to training sequences, in five stages.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a DataFrame; all
but the last return the columns of documents. Stages are written as Parquet in between, so each is planned on its
own input and survives the loss of executors.

run() removes what a stage leaves in the shared folder once the next stage is written.

Stages that run Python bound the bytes of Arrow batches (`bound_batches`) for the session that they are given: their results are
lazy, so the setting has to hold until they are written. run() puts the earlier setting back.

Defined cases, for every stage: an empty table gives an empty one; null and empty texts stay documents (they are not toxic
by themselves, linked with nothing, hold no secret and have size 0, which makes their copies a matter of their source's
rate); very long texts are worked on whole; a null doc_id or source is a value of its own; of repeated rows near_dedup keeps
one; ties go to the least doc_id; columns other than those of documents, whatever their names, are not carried along.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelforge.llm import minhash, mixing, packing, secrets, toxicity
from reelforge.llm.common import BATCH_SETTING, bound_batches, crc_of_id, intermediates, remove, shared_dir, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, with texts handed to Python in batches of bounded bytes."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier scores 0.5 or more; the classifier learns from labels not held out.

    Where the labels tell no text from another (too few, or of one class) no document is rejected; rows of one doc_id are judged
    one by one.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_of_id(F.col("doc_id")) % 5 != 0)
    return toxicity.keep_clean(docs, model)


@in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least doc_id of each group of near copies.

    Rows with a null or repeated doc_id are told apart by their texts, so one of equal rows stays; null and empty texts with a doc_id of
    their own all stay.
    """
    return minhash.keep_first(docs)


@in_small_batches
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in texts by a mark; all documents stay, null texts as they are, and n_chars is counted anew."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as its source's rate says, some not at all; rows with equal doc_id draw alike."""
    mixed = mixing.mix(docs.select(*COLUMNS)).where("copies > 0")
    return mixed.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_")).drop("_")


@in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs token pieces of all documents into sequences; a copy is packed as a document of its own, an empty text as its end id."""

    def encoder():
        import public_tokenizers

        return packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))

    return packing.pack(docs, encoder)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Classifiers, near copies and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to documents."""
    docs, base, before = table(spark, sf_dir, "documents").select(*COLUMNS), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    earlier = spark.conf.get(BATCH_SETTING)
    try:
        for name, stage in STAGES:
            path = f"{base}/{name}"
            with intermediates(spark):
                stage(spark, docs, sf_dir).write.parquet(path)
            if before:
                remove(spark, before)
            docs, before = spark.read.parquet(path), path
    finally:
        spark.conf.set(BATCH_SETTING, earlier)
    return docs
