"""The training-corpus pipeline: quality, frequent lines, near copies, benchmark leaks, tokens.

``STAGES`` are run in order over ``documents``; each one's result is written and read again as the
next one's documents. A stage works on all that the one before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import byte_bpe, decontamination, line_dedup, quality_classifier, simhash
from cohortlens.llm.common import read, staged

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier does not reject."""
    return quality_classifier.score(docs, read(spark, sf_dir, "labels")).where("predicted = 1").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without the lines that five or more documents share."""
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id."""
    return simhash.keep_one(docs, shingle=3, max_bits=3).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontamination.without_leaks(docs, read(spark, sf_dir, "benchmark")).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids (little-endian unsigned 32-bit), their digest and that of the text
    that they decode to."""
    path = public_tokenizers.path(VOCABULARY)
    decoded = byte_bpe.decode(byte_bpe.encode(docs, path, public_tokenizers.PATTERN), path)
    return decoded.select("doc_id", (F.length("tokens") / 4).cast("long").alias("n_tokens"), F.sha2("tokens", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"), "tokens")


STAGES = [("quality classifier", keep_quality), ("line dedup", dedup_lines), ("simhash near-dedup", drop_near_copies),
          ("benchmark decontamination", drop_leaks), ("byte-level bpe", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier's scores cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None
