"""Importance resampling towards a target distribution over hashed word features.

A text becomes words between single delimiters.  The distinct words of a slice of texts, each bounded by
delimiters, form an Aho-Corasick dictionary whose payload is the place of the word's CRC and length.  One scan
over the slice emits a payload per word.  Payloads of adjacent words are composed: the CRC of ``a b`` follows
from those of ``a `` and ``b`` and the length of ``b``, so runs of words are hashed without building them.  The
CRC modulo ``buckets`` is a feature's bucket.

Buckets are counted over the corpus and the target; a bucket's gain is the floored log of the ratio of its
smoothed shares.  A document's score is its floored mean gain plus Gumbel noise from a hash of its doc_id, and
the highest scores are drawn: sampling without replacement in proportion to the weights.

The buckets of every document are written once, packed, and counting and scoring read those.  The driver gets
one row per bucket, of which there are ``buckets``, and one row per distinct score, whose number follows from
the range of the gains and not from the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.common import fresh, map_arrow, text_slices, written

# A-Z in lower case; every other ASCII byte that is no digit or small letter is a delimiter
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isdigit() or 97 <= b <= 122 else 32 for b in range(256))
CRC_POLYNOMIAL = 0xEDB88320


def _zero_byte_tables() -> np.ndarray:
    """Tables [power, byte of the CRC, its value]: what 2^power appended zero bytes make of a CRC, which is linear."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(CRC_POLYNOMIAL), crc >> 1).astype(np.uint32)
    value = np.arange(256, dtype=np.uint32)
    tables = [np.stack([crc, value << 0, value << 8, value << 16])]
    for _ in range(31):
        tables.append(_shifted(_shifted(np.stack([value << s for s in (0, 8, 16, 24)]), tables[-1]), tables[-1]))
    return np.stack(tables)


def _shifted(crc: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


ZERO_BYTES = _zero_byte_tables()


def compose(left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of each concatenation, from those of its parts and the right part's number of bytes."""
    left = left.copy()
    for power in range(int(length.max(initial=0)).bit_length()):
        at = np.flatnonzero(length >> power & 1)
        left[at] = _shifted(left[at], ZERO_BYTES[power])
    return left ^ right


def word_payloads(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 and byte length of every word of the texts, in order, by one scan of an automaton of the distinct words."""
    import ahocorasick
    distinct = sorted(set(chain.from_iterable(texts)))
    if not distinct:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    words = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, word in enumerate(distinct):
        words.add_word(f" {word.decode()} ", k)
    words.make_automaton()
    crc = np.fromiter(map(zlib.crc32, distinct), np.uint32, len(distinct))
    length = np.fromiter(map(len, distinct), np.int64, len(distinct))
    line = b" ".join([b"", *chain.from_iterable(texts), b""]).decode()
    found = np.fromiter(map(itemgetter(1), words.iter(line)), np.int64, sum(map(len, texts)))
    return crc[found], length[found]


def text_buckets(texts: list[str | None], n_words: int = 1, buckets: int = 10_000) -> list[tuple[int, np.ndarray]]:
    """For each text its number of words and the buckets of all its runs of 1 to ``n_words`` words: single words
    first, then pairs, and so on."""
    split = [(t or "").encode().translate(WORDS).split() for t in texts]
    crc, length = word_payloads(split)
    ends = np.cumsum([len(words) for words in split])
    starts = ends - [len(words) for words in split]
    space = np.full(len(crc), zlib.crc32(b" "), np.uint32)
    runs = [crc]
    for k in range(1, n_words):
        # the run of k words from each place on, a space, and the word behind it; runs past the end wrap and are not read
        run = compose(runs[-1], space, np.ones_like(length))
        runs.append(compose(run, np.roll(crc, -k), np.roll(length, -k)))
    return [(int(b - a), np.concatenate([run[a:max(a, b - k)] for k, run in enumerate(runs)]) % np.uint32(buckets)) for a, b in zip(starts, ends)]


def _featurer(column: str, n_words: int, buckets: int, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, column):
            found = text_buckets(texts, n_words, buckets)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in keep), pa.array([n for n, _ in found], pa.int64()), pa.array([len(x) for _, x in found], pa.int64()),
                 pa.array([x.tobytes() for _, x in found], pa.binary())],
                names=[*keep, "n_words", "n_features", "buckets"])
    return run


def features(docs: DataFrame, keep: list[str], n_words: int = 1, buckets: int = 10_000) -> DataFrame:
    """The written table of ``keep``, n_words, n_features and the buckets of every text (unsigned 32-bit, repeats included)."""
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "n_words long, n_features long, buckets binary"])
    rows = map_arrow(docs.select(*keep, "text"), _featurer("text", n_words, buckets, keep), schema)
    return written(rows, "features", compression="zstd")


def bucket_counts(featured: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """How often each bucket occurs in all rows: partitions count their own, Spark adds ``buckets`` sums up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column("buckets"):
                total += np.bincount(np.frombuffer(packed.as_buffer(), np.uint32), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    counted = np.zeros(buckets, np.int64)
    for bucket, n in map_arrow(featured.select("buckets"), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        counted[bucket] = n
    return counted


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the shares in target and corpus), each count smoothed by one, per bucket."""
    b = len(corpus)
    ratio = (target + 1.0) * float(corpus.sum() + b) / ((corpus + 1.0) * float(target.sum() + b))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def score(featured: DataFrame, gain: np.ndarray, seed: int = 2024) -> DataFrame:
    """``featured`` with ``weight`` (the floored mean gain; 0 without features) and ``score`` instead of its buckets."""
    columns = [c for c in featured.columns if c != "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (np.frombuffer(x.as_buffer(), np.uint32) for x in batch.column("buckets"))
            weight = [int(gain[x].sum()) // len(x) if len(x) else 0 for x in found]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(weight, pa.int64())], names=[*columns, "weight"])

    schema = ", ".join([*(f"`{c}` {featured.schema[c].dataType.simpleString()}" for c in columns), "weight long"])
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8)
    noise = F.floor(-1000 * F.log(-F.log((F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296)))
    return map_arrow(featured, run, schema).withColumn("score", F.col("weight") + noise.cast("long"))


def draw(scored: DataFrame, percent: int = 10, min_words: int = 20) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3, ... for the floor(percent * N / 100) highest scores of the N rows of at least
    ``min_words`` words (``n_words``), ties to the smaller doc_id (null last), then the row hash; null for the others.

    The score at the cut comes from counts per score.  Only rows from there on are sorted, by range, so rank is
    a place within a partition plus the sizes of those before it, and no task sees all of them.
    """
    own = scored.columns
    per_score = scored.filter(F.col("n_words") >= min_words).groupBy("score").count().collect()
    wanted = percent * sum(n for _, n in per_score) // 100
    cut, above = None, 0
    for value, n in sorted(per_score, reverse=True):
        if above >= wanted:
            break
        cut, above = value, above + n
    p = fresh("_draw_", own)
    no_rank = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return scored.select(*own, no_rank)
    reached = (F.col("score") >= cut) & (F.col("n_words") >= min_words)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row_hash")]
    top = scored.filter(reached).repartitionByRange(*order).sortWithinPartitions(*order)
    top = written(top.withColumn(f"{p}at", F.monotonically_increasing_id()), "drawn")
    part = F.shiftright(f"{p}at", 33)
    sizes = dict(top.groupBy(part.alias("part")).count().collect())  # one row per partition
    before, starts = 0, {}
    for k in sorted(sizes):
        starts[k], before = before, before + sizes[k]
    offset = F.element_at(F.create_map(*chain.from_iterable((F.lit(k), F.lit(n).cast("long")) for k, n in starts.items())), part)
    rank = offset + F.col(f"{p}at").bitwiseAND((1 << 33) - 1) + 1
    top = top.select(*own, F.when(rank <= wanted, rank).alias("rank"))
    return scored.filter(~reached).select(*own, no_rank).unionByName(top)


def resample(docs: DataFrame, target: DataFrame, n_words: int = 1, buckets: int = 10_000, percent: int = 10, min_words: int = 20,
             seed: int = 2024) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of ``docs``, weighed towards ``target`` (text).

    A null or empty text has no words: weight 0, never drawn.  Equal rows score alike and take consecutive ranks; a null
    doc_id draws its noise from the empty text and comes last among ties.  An empty corpus gives no row, an empty
    target gains that only undo the corpus's own shares.  Other columns are not read.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("row_hash"))
    featured = features(rows, ["doc_id", "row_hash"], n_words, buckets)
    wanted = features(target.select("text"), [], n_words, buckets)
    scored = score(featured, gains(bucket_counts(featured, buckets), bucket_counts(wanted, buckets)), seed)
    scored = written(scored, "scored")
    return draw(scored, percent, min_words).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
