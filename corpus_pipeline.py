"""Corpus pipeline: the stages that turn ``documents`` into training data, each written and reread.

Rows that a stage keeps have the columns of ``documents``; the last stage returns the token ids.  Line
de-duplication sets ``n_chars`` anew, as it changes texts.  Every stage works on all rows its predecessor
kept and says in its operator what it makes of nulls, ties, repeated rows and empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.llm import decontaminate, line_dedup, piece_codec, quality_rules, simhash_index
from turnout.llm.common import table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules hold good (operator 3)."""
    return quality_rules.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of passages of 50 words or more (operator 8)."""
    kept, made = line_dedup.dedup_lines(docs, min_words=50)
    columns = [F.length("text").cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (operator 9)."""
    return simhash_index.one_per_group(docs, shingle=4, max_bits=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item (operator 10)."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=10)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256 of every document left (operator 4)."""
    coded = piece_codec.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("sentencepiece_encoding", encoding_stage),
]

# merging in vocabulary order is not for SQL; tests/llm holds the rows against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents`` one after the other."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
