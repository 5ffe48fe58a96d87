"""Corpus pipeline: quality rules, near-duplicate removal, pseudonyms for
personal data, mixing to target weights, SentencePiece encoding.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its rows are
written as Parquet and read back as the next stage's ``docs``. All but the
last return the columns of ``documents``; the last returns one row per
document of the stream with its token ids and their decoding.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.llm import curriculum, minhash_dedup, piece_encoder, pseudonyms, quality_rules
from footlink.llm.frames import DOCUMENT_COLUMNS, prepare, table
from footlink.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality_rules.accepted(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles,
    similarity 0.8)."""
    prepare(spark)
    return minhash_dedup.keep_one(docs.select(*DOCUMENT_COLUMNS), k=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by pseudonyms of its format."""
    prepare(spark)
    return pseudonyms.rewrite(docs.select(*DOCUMENT_COLUMNS))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training stream, in order of position; documents that the mix
    repeats occur repeatedly, documents beyond a source's target go."""
    prepare(spark)
    return curriculum.mix(docs.select(*DOCUMENT_COLUMNS))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, ids, n_tokens, decoded)."""
    prepare(spark)
    return (piece_encoder.encode(docs.select("doc_id", "source", "lang", "text"))
            .withColumn("n_tokens", F.size("ids").cast("long")))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("encoding", encoding),
]

#: SQL expresses neither the fitted ratio nor the encoder; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
