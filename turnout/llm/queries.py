"""The thin registered queries: each applies its operator to the whole given table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from turnout.llm import (decontaminate, embedding_dedup, html_extract, importance, line_dedup, line_quality, pii, piece_codec, quality_rules,
                         simhash_index, token_io, toxicity, whitening)
from turnout.llm.common import table


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = token_io.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_io.token_checksums(tokens)


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(piece_codec.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")))


def op5_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_quality.score(docs, line_quality.train(docs, table(spark, sf_dir, "labels")))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.find_spans(table(spark, sf_dir, "documents")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, made = line_dedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"), min_words=50)
    return docs.select("doc_id", f"{made}.n_lines", f"{made}.n_deleted", f"{made}.runs", "text")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_index.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.93)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n_words=1, buckets=10_000, percent=10,
                                min_words=20, seed=2024)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.component_rows(*whitening.whiten(table(spark, sf_dir, "embeddings"), wanted=16))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_token_files, op2_html_main_text, op3_quality_rules, op4_piece_codec, op5_toxicity_chain, op6_line_quality, op7_pii,
             op8_line_dedup, op9_simhash_near_dedup, op10_benchmark_decontamination, op11_embedding_near_dedup, op12_importance_resampling,
             op13_embedding_whitening)
    return {f.__name__: f for f in found}
