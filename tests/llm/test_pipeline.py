"""The pipeline against its stages done row by row, and its stages on edge tables."""

import hashlib
import math

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm import brute
from turnout.llm import quality_rules

PROCESSOR = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def votes(text):
    text = text or ""
    n, chars, symbols, dup, repeat, failed = brute.base_statistics(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    bars, capitals, shouts = text.split().count("|"), sum(c.isupper() for c in text), text.count("!!")

    def vote(bad, good):
        return 0 if bad else 1 if good else None
    return failed, (vote(n < 50, n >= 100), vote(chars < 3 * n or chars > 6.5 * n, 3.5 * n <= chars <= 6 * n),
                    vote(symbols > 0.05 * chars, symbols <= 0.005 * chars), vote(bars > 0.05 * n, bars == 0),
                    vote(dup > 0.5 * len(lines), dup == 0), vote(repeat > 0.3 * n, repeat <= 0.05 * n),
                    vote(capitals > 0.25 * chars, capitals <= 0.1 * chars), vote(shouts > 0.05 * n, shouts == 0))


def good_chances(all_votes, steps=12):
    """EM one document at a time."""
    k = len(quality_rules.RULES)
    start = {1: (0.01, 0.9), 0: (0.35, 0.5)}
    share, rate = 0.85, {c: [list(start[c]) for _ in range(k)] for c in (0, 1)}

    def chance(v):
        logit = math.log(share / (1 - share))
        for r, x in enumerate(v):
            p = [rate[c][r][x] if x is not None else 1 - sum(rate[c][r]) for c in (0, 1)]
            logit += math.log(p[1] / p[0])
        return 1 / (1 + math.exp(-logit))

    n = len(all_votes)
    for _ in range(steps):
        good = [chance(v) for v in all_votes]
        total = sum(good)
        share = (total + 0.1 * n * 0.85) / (1.1 * n)
        rate = {c: [[(sum((g if c else 1 - g) for g, v in zip(good, all_votes) if v[r] == x) + 0.1 * n * start[c][x])
                     / ((total if c else n - total) + 0.1 * n) for x in (0, 1)] for r in range(k)] for c in (0, 1)}
    return [chance(v) for v in all_votes]


def by_hand(rows, items):
    judged = [votes(t) for _, t in rows]
    rows = [r for r, (failed, _), p in zip(rows, judged, good_chances([v for _, v in judged])) if not failed and p >= 0.5]
    left = brute.dedup_lines(rows)
    rows = [(i, left[i, t][0]) for i, t in rows]
    rows = [r for r, (i, _, c) in zip(rows, brute.near_duplicates(rows)) if i == c]
    rows = [r for r, hit in zip(rows, brute.contamination(rows, items)) if not hit[-1]]
    return {i: (PROCESSOR.encode(t or ""), hashlib.sha256(PROCESSOR.decode(PROCESSOR.encode(t or "")).encode()).hexdigest()) for i, t in rows}


@pytest.mark.parametrize("sf_dir", [SMALL, SMALL.replace("0.001", "0.01")])
def test_pipeline_equals_plain_version(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {r.doc_id: (r.ids, r.decoded_sha256) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == by_hand(rows, items)
    assert 0 < len(got) < len(rows)


CLEAN = "Some plain words that stand in a clean text of which no other holds a copy, number {0}, and they go on with more of {0}. " * 6


def test_stages_keep_columns_and_take_edge_rows(spark, docs_of):
    rows = [(None, None), (1, None), (2, ""), (3, CLEAN.format("one")), (3, CLEAN.format("one")), (4, "x"), (5, "a\n" * 2000)]
    for made in (rows, []):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = docs_of(made)
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns, name
            assert out.count() <= len(made)
        assert corpus_pipeline.STAGES[-1][1](spark, docs_of(made), SMALL).count() == len(made)


def test_stages_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "t", 1, 2, 3, [4], 5, 6, 7)], "doc_id long, text string, _rule_s int, component_id int, text_hash int, "
                                 "ids array<int>, _text_hash int, `a.b` int, _group_hash int")
    docs = docs.withColumn("n_chars", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.collect() == docs.collect(), name
    assert corpus_pipeline.STAGES[0][1](spark, docs, SMALL).count() == 0
