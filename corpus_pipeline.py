"""Corpus pipeline: the stages in order, each over all its predecessor kept.

Rows and columns are those of ``documents`` until the last stage, which returns
doc_id, n_tokens, ids and the decoded text. Each stage is written as Parquet in the
shared folder and read again by the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlift.llm.bpe import bpe
from ledgerlift.llm.common import crc_mod, table
from ledgerlift.llm.decontamination import without_leaks
from ledgerlift.llm.line_dedup import line_dedup
from ledgerlift.llm.near_dedup import without_near_duplicates
from ledgerlift.llm.queries import vocabulary
from ledgerlift.llm.toxicity import without_toxic

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more go."""
    return without_toxic(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), crc_mod(3) != 1)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; a null text stays null, and n_chars follows the text."""
    kept = line_dedup(docs.withColumn("no_text", F.col("text").isNull()), min_docs=10, min_chars=1, carry=["lang", "source", "no_text"])
    text = F.when(~F.col("no_text"), F.col("kept_text"))
    return kept.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("bigint").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class stays."""
    return without_near_duplicates(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text as ids, with the text that they decode to."""
    return bpe(docs, *vocabulary(), form="full").select("doc_id", "n_tokens", "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", encoding),
]

#: Toxicity and decontamination have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_pipeline"
    folder = f"{base.rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
