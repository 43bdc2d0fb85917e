"""Near-duplicate vectors by cross-polytope hashing.

A hash rotates a unit vector by three rounds of random signs and a fast Hadamard transform and takes the nearest
vertex of the cross-polytope: the coordinate of largest size, with its sign.  A table's bucket is the vertices of
``functions`` such hashes.  Multiprobe: each vector also enters the buckets that it would reach next, by the loss
of the coordinates taken instead of the largest, so few tables find nearly all close pairs.

Vectors meet in the buckets they share and every pair there is verified by its cosine in doubles.  A pair counts
in the first of its common buckets only, so links are counted without a list of pairs, and each bucket gives at
most one link per member for the components.  Copies of a vector are one vector with a count.  Buckets of many
vectors are salted into parts, and every pair of parts is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.common import map_arrow, written
from turnout.llm.simhash_index import _unite, stars

SPLIT = 512  # buckets of more vectors are met in parts
BLOCK = 1 << 20  # cosines held at a time
HELD = 1 << 15  # rows of whole groups held at a time


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows, orthonormal; their length is a power of two."""
    n, step = x.shape[1], 1
    while step < n:
        x = x.reshape(len(x), -1, 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by a power of two first, so no square overflows or vanishes."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def bucket_codes(x: np.ndarray, tables: int = 3, functions: int = 2, probes: int = 6, seed: int = 11) -> np.ndarray:
    """(rows, tables * probes) bucket numbers of unit rows, apart between tables; the nearest bucket of each table first.
    In few dimensions a table has fewer buckets than probes; -1 stands for those missing."""
    d = 1 << (x.shape[1] - 1).bit_length()
    padded = np.zeros((len(x), d))
    padded[:, :x.shape[1]] = x
    most = min(probes, d)
    out = []
    for table in range(tables):
        loss, code = np.zeros((len(x), 1)), np.zeros((len(x), 1), dtype=np.int64)
        for k in range(functions):
            signs = np.random.default_rng((seed, d, table, k)).choice([-1.0, 1.0], size=(3, d))
            turned = padded
            for s in signs:
                turned = hadamard(turned * s)
            size = np.abs(turned)
            best = np.argsort(-size, axis=1, kind="stable")[:, :most]
            top = np.take_along_axis(size, best, 1)
            vertex = 2 * best + (np.take_along_axis(turned, best, 1) < 0)
            loss = (loss[:, :, None] + (top[:, :1] - top)[:, None, :] ** 2).reshape(len(x), -1)
            code = (code[:, :, None] * (2 * d) + vertex[:, None, :]).reshape(len(x), -1)
        near = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        found = np.full((len(x), probes), -1, dtype=np.int64)
        found[:, :near.shape[1]] = np.take_along_axis(code, near, 1) + table * (2 * d) ** functions
        out.append(found)
    return np.hstack(out)


def _hasher(tables: int, functions: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(lengths):
                rows = batch.filter(pa.array(lengths == d))
                x = unit_rows(rows.column("vector").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d))
                for i in range(0, len(x), 4096):
                    codes = bucket_codes(x[i:i + 4096], tables, functions, probes)
                    part = rows.slice(i, 4096)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("key"), part.column("label"), part.column("copies"), part.column("vector"),
                         pa.array(list(codes), pa.list_(pa.int64()))], names=["key", "label", "copies", "vector", "codes"])
    return run


def _groups(vectors: DataFrame) -> DataFrame:
    """A row per vector and bucket, with the group (label, size, code, lo, hi) it meets others in and its part ``salt``:
    buckets of more than SPLIT vectors are salted into q parts, q as the root of their size, and every pair of
    parts is a group."""
    code = F.explode(F.expr("filter(codes, c -> c >= 0)")).alias("code")
    rows = vectors.select("*", F.size("vector").alias("size"), code)
    bucket = ["label", "size", "code"]
    hot = written(vectors.select("label", F.size("vector").alias("size"), code).groupBy(*bucket).count()
                  .filter(F.col("count") > SPLIT).select(*bucket, F.ceil(F.sqrt(F.col("count") / SPLIT)).cast("int").alias("q")), "hot")
    part = rows.join(hot, bucket, "left").withColumn("q", F.coalesce("q", F.lit(1)))
    part = part.withColumn("salt", F.expr("cast(pmod(xxhash64(key, 7), q) as int)"))
    return part.select("*", F.explode(F.expr("sequence(0, q - 1)")).alias("other")).select(
        *bucket, F.least("salt", "other").alias("lo"), F.greatest("salt", "other").alias("hi"), "salt", "key", "copies", "vector", "codes")


class _Groups:
    """Whole groups of sorted rows as arrays."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches).combine_chunks()
        self.group = np.stack([table[c].to_numpy() for c in ("label", "size", "code", "lo", "hi")], axis=1)
        self.starts = np.flatnonzero(np.append(True, (self.group[1:] != self.group[:-1]).any(axis=1)))
        self.ends = np.append(self.starts[1:], len(self.group))
        self.salt, self.key, self.copies = (table[c].to_numpy() for c in ("salt", "key", "copies"))
        n_codes = len(table["codes"][0])
        self.codes = table["codes"].combine_chunks().flatten().to_numpy().reshape(-1, n_codes)
        vectors = table["vector"].combine_chunks()
        self.flat = vectors.flatten().to_numpy(zero_copy_only=False)
        self.offset = np.append(0, np.cumsum(vectors.value_lengths().to_numpy()))

    def near(self, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers (i, j) of the pairs of one group with a cosine of at least ``least``, a block at a time."""
        sizes, d = self.ends - self.starts, self.group[self.starts, 1]
        for size, width in sorted(set(zip(sizes.tolist(), d.tolist()))):
            if size < 2:
                continue
            starts = self.starts[(sizes == size) & (d == width)]
            step = max(1, BLOCK // (size * size)) if size * size <= BLOCK else 1
            for k in range(0, len(starts), step):
                first = starts[k:k + step]
                at = first[:, None] + np.arange(size)
                x = unit_rows(self.flat[self.offset[at.ravel()][:, None] + np.arange(width)].astype(float)).reshape(len(first), size, width)
                band = max(1, BLOCK // size)
                for top in range(0, size, band):
                    g, i, j = np.nonzero(x[:, top:top + band] @ x[:, top:].transpose(0, 2, 1) >= least)
                    keep = i < j
                    yield first[g[keep]] + top + i[keep], first[g[keep]] + top + j[keep]

    def counted(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs that belong to this group: the parts are its own two, and no earlier bucket is common to both."""
        lo, hi = self.group[i, 3], self.group[i, 4]
        keep = (np.minimum(self.salt[i], self.salt[j]) == lo) & (np.maximum(self.salt[i], self.salt[j]) == hi)
        for start in range(0, len(i), 1 << 15):
            at = np.flatnonzero(keep[start:start + (1 << 15)]) + start
            a, b, own = self.codes[i[at]], self.codes[j[at]], self.group[i[at], 2]
            earlier = np.zeros(len(at), bool)
            for k in range(a.shape[1]):
                earlier |= ((a[:, k:k + 1] == b) & (b >= 0) & (b < own[:, None])).any(axis=1)
            keep[at] = ~earlier
        return keep


def _meet(least: float):
    """Sorted rows of whole groups -> key, links (copies of the others it is linked with here) and first (the first
    key of its component in the group) of every linked row."""
    columns = ("label", "size", "code", "lo", "hi")

    def linked(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        groups = _Groups(batches)
        n = len(groups.key)
        links, component = np.zeros(n, np.int64), np.arange(n)
        for i, j in groups.near(least):
            own = groups.counted(i, j)
            np.add.at(links, i[own], groups.copies[j[own]])
            np.add.at(links, j[own], groups.copies[i[own]])
            apart = component[i] != component[j]
            if apart.any():
                component = _unite(component, i[apart], j[apart])
        at = np.flatnonzero((links > 0) | (component != np.arange(n)))
        return pa.RecordBatch.from_arrays([pa.array(groups.key[at]), pa.array(links[at]), pa.array(groups.key[component[at]])],
                                          names=["key", "links", "first"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < HELD:
                continue
            # hand on the groups that are whole, keep the last one, which may go on
            tail = np.stack([batch.column(c).to_numpy() for c in columns], axis=1)
            change = np.flatnonzero((tail != tail[-1]).any(axis=1))
            before = None if len(held) < 2 else [held[-2].column(c)[-1].as_py() for c in columns]
            cut = int(change[-1]) + 1 if len(change) else 0 if before is not None and before != tail[-1].tolist() else None
            if cut is not None and size - batch.num_rows + cut:
                yield linked([*held[:-1], batch.slice(0, cut)] if cut else held[:-1])
                held = [batch.slice(cut)]
                size = held[0].num_rows
        if size:
            yield linked(held)
    return run


def near_duplicates(df: DataFrame, least: float = 0.93, vector: str = "embedding", label: str = "label", tables: int = 3, functions: int = 2,
                    probes: int = 6) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row: rows with equal labels and a cosine of at least ``least`` are linked.

    Compared are vectors of one label and one length; a null label, and a vector that is null, empty, zero or holds
    null or non-finite entries, links with nothing.  Equal vectors of a label are linked with each other and count
    singly.  ``component_id`` is the smallest vec_id reachable; rows with a null vec_id take part, and it is null only
    where the whole component has none.  ``kept``: vec_id equals component_id (both null too); of repeated rows all are.
    One row per input row, other columns are dropped; an empty table gives none.

    Vectors are told apart by a 128-bit hash.  ``functions`` vertices a bucket are for up to some 10^8 vectors of
    64 dimensions and a label; more take three, with more probes.
    """
    fine = F.expr(f"size(`{vector}`) > 0 AND forall(`{vector}`, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity')) "
                  f"AND exists(`{vector}`, c -> c != 0)") & F.col(f"`{label}`").isNotNull()
    rows = df.select("vec_id", F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{vector}`").alias("vector"), F.coalesce(fine, F.lit(False)).alias("fine"))
    # 0.0 is added so that -0.0 and 0.0 are one
    text = F.to_binary(F.concat_ws(",", F.transform("vector", lambda c: (c + F.lit(0.0)).cast("string"))), F.lit("utf-8"))
    marked = rows.withColumn("mark", F.when(F.col("fine"), F.md5(text)))
    distinct = marked.filter("fine").groupBy("label", "mark").agg(
        F.any_value("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("least_id"))
    distinct = written(distinct.withColumn("key", F.monotonically_increasing_id()), "vectors", compression="zstd")
    element = distinct.schema["vector"].dataType.simpleString()
    hashed = written(map_arrow(distinct.select("key", "label", "copies", "vector"), _hasher(tables, functions, probes),
                               f"key long, label long, copies long, vector {element}, codes array<long>"), "codes", compression="zstd")
    group = ["label", "size", "code", "lo", "hi"]
    met = _groups(hashed).repartition(*group).sortWithinPartitions(*group)
    found = written(map_arrow(met, _meet(least), "key long, links long, first long"), "found")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    root = stars(found.filter("key != first").select(F.col("key").alias("a"), F.col("first").alias("b")))
    named = (distinct.select("key", "label", "mark", "copies", "least_id").join(links, "key", "left")
             .join(root.withColumnRenamed("v", "key"), "key", "left").withColumn("root", F.coalesce("root", "key")))
    named = written(named, "named")
    best = written(named.groupBy("root").agg(F.min("least_id").alias("component_id")), "best")
    per = written(named.join(best, "root").select(F.col("label").alias("of"), F.col("mark").alias("own"), "component_id",
                                                 (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "linked")
    joined = marked.select("vec_id", "label", "mark").join(per, (F.col("label") == F.col("of")) & (F.col("mark") == F.col("own")), "left")
    component = F.when(F.col("own").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.col("vec_id").eqNullSafe(component).alias("kept"))
