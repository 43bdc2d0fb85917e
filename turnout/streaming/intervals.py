"""Exact de-duplication and continuity audit of a log by sets of offset intervals.

What has been seen of a partition is a set of offsets, and a log without losses makes it one interval.  Kept merged, it
needs one row of state per slice with as many intervals as there are gaps, however many messages passed.

A log partition is dealt into ``slices``: blocks of ``block`` offsets in turn.  Within a slice its blocks join on to
each other, so a slice without gaps is one interval too, and a partition that holds most of the log is the work of
``slices`` tasks.

While a log arrives out of order its gaps may be as many as its messages (the odd offsets of a stretch first, say).
Stored, the intervals that share a word of 64 offsets are then one word of bits (``packed``).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from turnout.session import ship_package
from turnout.streaming import state
from turnout.streaming.ingest import log_stream

SLICES, BLOCK = 8, 1024
ARROW_CONF, ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000
STATE = "first array<long>, last array<long>"


def slice_of(offset: str, slices: int = SLICES, block: int = BLOCK) -> Column:
    return F.expr(f"cast(pmod({offset} DIV {block}, {slices}) as int)")


def local_offsets(offsets: np.ndarray, slices: int, block: int) -> np.ndarray:
    """Places within the slice: without the other slices' blocks."""
    return offsets // (block * slices) * block + offsets % block


Intervals = tuple[np.ndarray, np.ndarray]  # first and last offsets, ascending, none touching another


def merged(first: np.ndarray, last: np.ndarray) -> Intervals:
    """Disjoint intervals put in order, and those that touch joined."""
    if not len(first):
        return first, last
    order = np.argsort(first, kind="stable")
    first, last = first[order], last[order]
    apart = np.flatnonzero(first[1:] > last[:-1] + 1)  # all are disjoint, so neighbours decide
    return first[np.append(0, apart + 1)], last[np.append(apart, len(last) - 1)]


class Seen:
    """A set of offsets that grows in small steps: sets of intervals of falling size, a logarithm of them, so that a
    step's work follows its offsets and not the set."""

    def __init__(self, first: np.ndarray, last: np.ndarray):
        self.parts: list[Intervals] = [(first, last)]

    def add(self, offsets: np.ndarray) -> np.ndarray:
        """First positions of the offsets that are new."""
        values, at = np.unique(offsets, return_index=True)
        for first, last in self.parts:
            if len(first):
                k = np.searchsorted(first, values, side="right") - 1
                new = (k < 0) | (values > last[np.maximum(k, 0)])
                values, at = values[new], at[new]
        if len(values):
            breaks = np.flatnonzero(np.diff(values) > 1)
            self.parts.append((values[np.append(0, breaks + 1)], values[np.append(breaks, len(values) - 1)]))
            while len(self.parts) > 1 and len(self.parts[-2][0]) < 2 * len(self.parts[-1][0]):
                self._join()
        return np.sort(at)

    def intervals(self) -> Intervals:
        while len(self.parts) > 1:
            self._join()
        return self.parts[0]

    def _join(self) -> None:
        one, other = self.parts.pop(), self.parts.pop()
        self.parts.append(merged(*map(np.concatenate, zip(other, one))))


def add_offsets(first: np.ndarray, last: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of ``offsets`` are new (their first positions), and the intervals [first, last] with them."""
    seen = Seen(first, last)
    at = seen.add(offsets)
    return at, *seen.intervals()


def packed(first: np.ndarray, last: np.ndarray) -> tuple[list, list]:
    """Intervals as they are stored.  Two or more of them within a word of 64 offsets are one pair: the word's first
    offset and its bits, as a long.  Such pairs stand behind the pair (0, -1), which is no interval.  So there are never
    more pairs than intervals, nor more than about two to a word."""
    word = first >> 6
    dense = word == last >> 6
    _, n = np.unique(word[dense], return_counts=True)
    dense[dense] = np.repeat(n > 1, n)
    if not dense.any():
        return first.tolist(), last.tolist()
    a, length = first[dense], (last - first + 1)[dense].astype(np.uint64)
    bits = ((np.uint64(1) << length) - np.uint64(1)) << (a & 63).astype(np.uint64)
    starts = np.flatnonzero(np.append(True, np.diff(a >> 6) != 0))
    words = np.bitwise_or.reduceat(bits, starts).view(np.int64)
    return ([*first[~dense].tolist(), 0, *(a[starts] >> 6 << 6).tolist()],
            [*last[~dense].tolist(), -1, *words.tolist()])


def unpacked(first: list, last: list) -> Intervals:
    """The intervals that ``packed`` stored."""
    first, last = np.array(first, dtype=np.int64), np.array(last, dtype=np.int64)
    mark = np.flatnonzero(first > last)[:1]
    if not len(mark):
        return first, last
    n = mark[0]
    at, bits = first[n + 1:], last[n + 1:].astype("<i8").view(np.uint8).reshape(-1, 8)
    edges = np.diff(np.unpackbits(bits, axis=1, bitorder="little").view(np.int8), axis=1, prepend=0, append=0)
    (row, a), (_, b) = np.nonzero(edges == 1), np.nonzero(edges == -1)
    return merged(np.concatenate([first[:n], at[row] + a]), np.concatenate([last[:n], at[row] + b - 1]))


def _first_seen(slices: int, block: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        seen = Seen(*unpacked(*(held.get if held.exists else ([], []))))
        for frame in frames:
            offsets = frame["offset"].to_numpy(dtype=np.int64, na_value=0)  # null offsets have a slice of their own
            yield frame.iloc[seen.add(local_offsets(offsets, slices, block))]
        held.update(packed(*seen.intervals()))
    return run


@contextmanager
def small_batches(spark: SparkSession, rows: int = ARROW_ROWS):
    """Streams that start within hand Python ``rows`` rows at a time, also after it: a stream keeps the settings it
    started with.  PySpark holds up to 57 such batches of a group with state (it looks at the first row through
    ``itertools.tee``), and they hold whole messages."""
    before = spark.conf.get(ARROW_CONF, None)
    spark.conf.set(ARROW_CONF, rows)
    try:
        yield
    finally:
        spark.conf.unset(ARROW_CONF) if before is None else spark.conf.set(ARROW_CONF, before)


def dedup_by_intervals(log: DataFrame, slices: int = SLICES, block: int = BLOCK) -> DataFrame:
    """ST6: every message of the log once, however often and in whatever order it is delivered, with a state that grows
    with the gaps of the log and not with its messages.  Messages have a topic, a partition and an offset.  Start the
    stream within ``small_batches``."""
    ship_package(log.sparkSession)
    columns = log.columns
    keyed = log.withColumn("_slice", slice_of("offset", slices, block))
    out = keyed.groupBy("topic", "partition", "_slice").applyInPandasWithState(
        _first_seen(slices, block), keyed.schema, STATE, "append", GroupStateTimeout.NoTimeout)
    return out.select(*columns)


# ---- continuity ------------------------------------------------------------------------------

PARTITION = ["topic", "partition"]


def islands(log: DataFrame, block: int = 1 << 20) -> DataFrame:
    """topic, partition, first, last: the unbroken stretches of offsets of a log, repeats counted once.

    Offsets are numbered within blocks of ``block`` offsets, so no task sorts a partition of the log; the
    stretches of the blocks, a few rows each, are then joined.
    """
    seen = log.select(*PARTITION, "offset").filter("offset IS NOT NULL").distinct()
    placed = seen.withColumn("_block", F.expr(f"offset DIV {block}"))
    w = Window.partitionBy(*PARTITION, "_block").orderBy("offset")
    run = placed.withColumn("_run", F.col("offset") - F.row_number().over(w))
    return merge_islands(run.groupBy(*PARTITION, "_block", "_run").agg(F.min("offset").alias("first"), F.max("offset").alias("last")))


def merge_islands(parts: DataFrame) -> DataFrame:
    """Stretches that touch or overlap become one; the rows are as many as there are gaps and parts."""
    w = Window.partitionBy(*PARTITION).orderBy("first", "last")
    upto = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = parts.select(*PARTITION, "first", "last", F.when(F.col("first") <= upto + 1, 0).otherwise(1).alias("_new"))
    grouped = marked.withColumn("_run", F.sum("_new").over(w))
    return grouped.groupBy(*PARTITION, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_run")


def gaps(found: DataFrame) -> DataFrame:
    """topic, partition, first_missing, last_missing, n_missing between the islands of a log."""
    w = Window.partitionBy(*PARTITION).orderBy("first")
    before = F.lag("last").over(w)
    rows = found.select(*PARTITION, (before + 1).alias("first_missing"), (F.col("first") - 1).alias("last_missing"))
    return rows.filter("first_missing <= last_missing").withColumn("n_missing", F.col("last_missing") - F.col("first_missing") + 1)


def run_offset_audit(spark: SparkSession, source: dict, table_path: str, checkpoint: str):
    """S3/ST2: the islands of all messages read so far, merged batch by batch; ``gaps`` of ``state.current`` names the
    ranges of offsets that never arrived, also those lost while the job was down."""
    def write(batch: DataFrame, batch_id: int) -> None:
        found = islands(batch)
        last = state.version_before(spark, table_path, batch_id)
        if last is not None:
            found = merge_islands(found.unionByName(spark.read.schema(found.schema).parquet(last)))
        state.write_version(found, table_path, batch_id)
    return (log_stream(spark, source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
