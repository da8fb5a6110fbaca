"""The corpus pipeline: language ID, near duplicates, personal data, mixing and packing, each stage from Parquet to Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborline.llm import jaccard, langid, mixing, packing, pii
from arborline.llm.common import ensure_checkpoint_dir, table
from arborline.llm.queries import CAPACITY, END_ID, MIX_ALPHA, MIX_SEED, THRESHOLD, WIDTH, tokenizer_file

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language; those without a letter, and null texts, go. lang is the predicted language.

    Cases: a null key or source is kept as it is, a null language isn't learnt from; if no row has a language none can be told and all
    documents go; repeated rows are each judged alike; of equal scores the first language by name stands; texts of any length
    are read whole; an empty table stays empty; further columns, of whatever name, are left out.
    """
    found = langid.identify(docs.select(*COLUMNS), "doc_id", "text", "lang").where(F.col("lang_pred") != langid.UNKNOWN)
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of linked texts: the one with the least doc_id.

    Cases: a null key is less than all others; every null text is a group of its own and stays; empty texts are equal, so one of them stays;
    of repeated rows one stays; different texts under the least key tie, the one with the least md5 stays; an empty
    table stays empty; further columns are left out.
    """
    return jaccard.representatives(docs.select(*COLUMNS), "doc_id", "text", WIDTH, THRESHOLD).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in brackets; n_chars follows the text. No document goes.

    Cases: a null text stays null, with a null n_chars; an empty one stays empty; of overlapping spans the first one's kind stands; repeated
    rows get equal results; texts of any length are read whole; an empty table stays empty; further columns are left out.
    """
    clean = pii.scan(docs.select(*COLUMNS), "text").withColumn("text", F.col("redacted"))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that sources' sizes go as their square roots, in one global shuffle.

    Cases: a null source is a source, a null key a key, a null text has size 1 as an empty one; rows that share a key are repeated equally
    often; copies of one key tie in the shuffle's order and lie in any; an empty table stays empty; further columns are left out.
    """
    size = F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(1)
    return mixing.mix(docs.select(*COLUMNS), "doc_id", "source", size, alpha=MIX_ALPHA, seed=MIX_SEED).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences, ids included. In order of sequence_id the sequences are shuffled, so the mix holds.

    Cases: a null text is packed as an empty one, as its end mark alone; repeated rows and null keys are packed like any other; rows that tie are
    placed in any order; a text of any length is cut into full pieces; an empty table stays empty; further columns are left out.
    """
    return packing.pack_documents(docs, "doc_id", "text", tokenizer_file("byte_bpe_50k.json"), CAPACITY, END_ID)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix", mix), ("pack", pack)]

#: SQL cannot express the trained stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
