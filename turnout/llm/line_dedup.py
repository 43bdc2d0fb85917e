"""Line de-duplication: winnowing over line hashes.

A document is its lines that have a word, each by the hash of its words.  Windows are the shortest runs of
lines with at least ``min_words`` words, from each line on and up to each line.  Winnowing selects the smallest
line hash of every window (the last of equal ones): equal windows select equal lines, so any repeated
passage of a window or more shares at least one selected fingerprint with its earlier copy.

Fingerprints that occur twice are joined with their positions.  From such a position the match is
extended both ways over the windows that hold it: a window whose every line equals those of an earlier
window is part of a match, and windows that touch or overlap join into one run.  The windows that begin inside
a repeated run and those that end inside it together reach both its ends, so whole runs go.  All but the first
occurrence, by doc_id and line, are deleted.  Occurrences meet their first one, never each other, so a
passage that a third of all documents share costs one row per occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.common import fresh, map_arrow, text_slices, written
from turnout.session import ship_package

POSTINGS = "fp long, doc_id long, text_hash long, at int, windows array<struct<key: binary, first: int, last: int>>"


def line_windows(text: str | None, min_words: int) -> Iterator[tuple[int, int, list]]:
    """(fingerprint, its line, [(key, first line, last line)]) for every selected line of a text."""
    from xxhash import xxh3_128_digest, xxh64_intdigest
    place, sizes, hashes = [], [], []
    for k, line in enumerate((text or "").encode().split(b"\n")):
        words = line.split()
        if words:
            place.append(k)
            sizes.append(len(words))
            hashes.append(xxh64_intdigest(b" ".join(words)))
    raw = np.array(hashes, dtype="<u8").tobytes()
    until = np.concatenate([[0], np.cumsum(sizes)])
    # the window from line i ends with the first line by which it has min_words words
    last = np.searchsorted(until, until[:-1] + min_words) - 1
    ending: dict = {}  # first line -> last lines of the shortest windows that end there and are not in ``last``
    begin = np.searchsorted(until, until[1:] - min_words, side="right") - 1
    for k, i in enumerate(begin.tolist()):
        if i >= 0 and last[i] != k:
            ending.setdefault(i, []).append(k)
    selected: dict = {}
    best = -1
    for i, j in enumerate(last.tolist()):
        if j >= len(hashes):
            break
        if best < i:
            best = min(range(j, i - 1, -1), key=hashes.__getitem__)
            seen = j
        else:
            for k in range(seen + 1, j + 1):
                if hashes[k] <= hashes[best]:
                    best = k
            seen = j
        # a window ending at k holds the one from its first line on, and so the same fingerprint
        selected.setdefault(best, []).extend((xxh3_128_digest(raw[8 * i:8 * k + 8]), place[i], place[k]) for k in (j, *ending.get(i, ())))
    for k, windows in selected.items():
        yield hashes[k], place[k], windows


def _poster(min_words: int):
    schema = pa.schema([("fp", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("at", pa.int32()),
                        ("windows", pa.list_(pa.struct([("key", pa.binary()), ("first", pa.int32()), ("last", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text"):
            fps, owner, at, counts, keys, firsts, lasts = [], [], [], [0], [], [], []
            for k, text in enumerate(texts):
                for fp, line, windows in line_windows(text, min_words):
                    fps.append(fp)
                    owner.append(k)
                    at.append(line)
                    key, first, last = zip(*windows)
                    keys += key
                    firsts += first
                    lasts += last
                    counts.append(len(keys))
            nested = pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32())],
                                                names=["key", "first", "last"])
            own = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(fps, dtype=np.uint64).view(np.int64)), rows.column("doc_id").take(own), rows.column("text_hash").take(own),
                 pa.array(at, pa.int32()), pa.ListArray.from_arrays(pa.array(counts, pa.int32()), nested)], schema=schema)
    return run


def postings(docs: DataFrame, min_words: int) -> DataFrame:
    """The written table of selected fingerprints with their positions and the windows that hold them."""
    rows = map_arrow(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), _poster(min_words), POSTINGS)
    return written(rows, "lines", compression="zstd")


def _join_runs(firsts: pd.Series, lasts: pd.Series) -> pd.Series:
    def join(first, last) -> list:
        out: list = []
        for a, b in sorted(zip(first.tolist(), last.tolist())):
            if out and a <= out[-1]["last"] + 1:
                out[-1]["last"] = max(out[-1]["last"], b)
            else:
                out.append({"first": a, "last": b})
        return out
    return pd.Series([join(a, b) for a, b in zip(firsts, lasts)])


def repeated_runs(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """doc_id, text_hash, runs: for each document with repeated passages, the line runs to delete (first and last
    line, from 0), in order and apart."""
    posted = postings(docs, min_words)
    # counts are written before they are joined: both sides of the joins are then plain shuffles, of which
    # Spark splits the partitions that a common passage makes large
    shared = written(posted.groupBy("fp").count().filter("count > 1").select("fp"), "shared")
    found = posted.join(shared, "fp").select("doc_id", "text_hash", F.explode("windows").alias("w")).select(
        "w.key", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "w.first").alias("here"), "w.last")
    found = written(found, "windows")
    earliest = found.groupBy("key").agg(F.min("here").alias("earliest"), F.count("*").alias("n")).filter("n > 1")
    later = found.join(written(earliest.drop("n"), "earliest"), "key").filter("here != earliest")
    # equal rows of a document count as one occurrence, so set semantics
    runs = later.groupBy("here.doc_id", "here.text_hash").agg(
        F.collect_set(F.struct(F.col("here.first").alias("first"), "last")).alias("runs"))
    ship_package(docs.sparkSession)
    join = F.pandas_udf(_join_runs, "array<struct<first: int, last: int>>")
    return runs.select("doc_id", "text_hash", join("runs.first", "runs.last").alias("runs"))


def dedup_lines(docs: DataFrame, min_words: int = 50) -> tuple[DataFrame, str]:
    """``docs`` with every line of a run of ``min_words`` words or more that occurred before deleted from ``text``, and a
    struct column (its name is returned too) of n_lines, n_deleted and runs.

    Lines are told apart by their words; a line break is ``\\n``.  The first occurrence, by doc_id (nulls last),
    hash of the text and line, stays; blank lines inside a run go with it.  Equal rows (doc_id and text) count as
    one document and keep the same text.  A null text stays null and has no lines; an empty one has one.
    All columns, and all other rows, stay as they are.
    """
    p = fresh("_line_", docs.columns)
    runs = written(repeated_runs(docs, min_words), "runs")
    runs = runs.select(F.col("doc_id").alias(f"{p}id"), F.col("text_hash").alias(f"{p}hash"), F.col("runs").alias(f"{p}runs"))
    keyed = docs.withColumn(f"{p}text_hash", F.xxhash64("text"))
    # the runs grow with the corpus: always a shuffled join, never a broadcast that only small inputs allow
    joined = keyed.join(runs.hint("merge"), F.col("doc_id").eqNullSafe(F.col(f"{p}id")) & (F.col(f"{p}text_hash") == F.col(f"{p}hash")), "left")
    joined = joined.withColumn(f"{p}lines", F.split("text", "\n", -1))
    # what stays is the lines between the runs
    between = F.expr(f"""flatten(zip_with(concat(array(-1), transform({p}runs, r -> r.last)),
        concat(transform({p}runs, r -> r.first), array(size({p}lines))), (a, b) -> slice({p}lines, a + 2, b - a - 1)))""")
    made = F.struct(F.when(F.col("text").isNull(), 0).otherwise(F.size(f"{p}lines")).cast("long").alias("n_lines"),
                    F.coalesce(F.expr(f"aggregate({p}runs, 0L, (n, r) -> n + r.last - r.first + 1)"), F.lit(0)).cast("long").alias("n_deleted"),
                    F.coalesce(F.expr(f"array_join(transform({p}runs, r -> concat(r.first, '-', r.last)), ',')"), F.lit("")).alias("runs"))
    text = F.when(F.col(f"{p}runs").isNull(), F.col("text")).otherwise(F.array_join(between, "\n"))
    columns = [text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, made.alias(f"{p}made")), f"{p}made"
