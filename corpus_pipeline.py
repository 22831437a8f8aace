"""Corpus pipeline: documents through five of the training-data operators.

Each stage takes the rows its predecessor wrote and returns a DataFrame; its
decisions take effect there. ``run`` writes every stage's rows as Parquet in the
shared folder and reads them again, so a lost executor repeats at most one
stage and no plan grows over the stages.

Cases, for every stage: null and empty texts have no words, so quality rules
reject them, and later stages meet one only if they are given it (it joins no
group, isn't contaminated, has no secret, and encodes to no ids); texts of any
length are worked on whole; rows of one doc_id are separate rows; an empty table
gives an empty table; extra columns, also with names that a stage uses inside,
are handed on by all stages but the last, which returns its own columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabula.llm import bpe, decontaminate, ngram_join, quality, secrets
from tabula.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, with fewer than 20 words among them;
    of repeated rows all stay or all go."""
    return quality.keep_good(docs, public_tokenizers.path("piece_bpe_32k.model"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays: the least doc_id, named ones
    before null; of equal rows the first in the table."""
    return ngram_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; a benchmark without a word in it takes none."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced; all documents stay."""
    return secrets.redact(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, decoded again, as counts and digests; one row per row."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("byte_level_bpe", byte_level_bpe),
]

#: SentencePiece and byte-level BPE can't be written in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
