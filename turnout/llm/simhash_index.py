"""SimHash near-duplicates by a hierarchical index in Gray order.

Fingerprints at most ``max_bits`` apart agree on at least k of ``max_bits + k`` blocks of bits.  For every
choice of k blocks the distinct fingerprints are turned so that these lead, dealt out by their value, and sorted
by Gray rank, which puts fingerprints with few differing bits next to each other.  Over each sorted
group stands a tree: an upper node holds the bits that all fingerprints below it share.  The search
goes down pairs of nodes, adds up the differing shared bits, and drops a pair of whole groups once
they exceed the distance.  Pairs of nodes that are linked already are dropped too, so that a group
gives at most one link per member and not all its pairs.

Links are closed to components by alternating large-star and small-star rounds on written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.common import fresh, map_arrow, text_slices, written

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
FAN = 8  # children of a node
SPLIT = 256  # groups of more than this many fingerprints are searched in tiles


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash over XXH64 (seed 42) of the word shingles, repeats included; 0 without words."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(line, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-shingle]]).tolist()
    hashes = np.array([xxh64_intdigest(line[a:b], 42) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i:i + (1 << 16), None].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text"):
            values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("text_hash"), pa.array(values)],
                                             names=["doc_id", "text_hash", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, text_hash and fp (the 64 bits as a signed long) of every row."""
    return map_arrow(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), _fingerprints(shingle),
                     "doc_id long, text_hash long, fp long")


def _blocks(n: int) -> list[tuple[int, int]]:
    """(shift, width) of ``n`` blocks that cover the 64 bits, from the top."""
    edges = [64 * k // n for k in range(n + 1)]
    return [(64 - b, b - a) for a, b in zip(edges, edges[1:])]


def agreeing_blocks(n_fps: int, max_bits: int) -> int:
    """How many blocks the keys are made of: as few as keep the groups of ``n_fps`` evenly spread fingerprints at SPLIT
    or less, since each fingerprint has a row per choice of blocks (5, 15, 35 or 70 for four bits)."""
    for k in range(1, 5):
        if n_fps >> min(sum(w for _, w in blocks) for blocks in combinations(_blocks(max_bits + k), k)) <= SPLIT:
            break
    return k


def _keys(fps: DataFrame, max_bits: int, agree: int = 1) -> DataFrame:
    """A row per fingerprint and choice of ``agree`` blocks: block (the number of the choice), value of those blocks, and the
    Gray rank of the fingerprint turned so that they lead."""
    blocks = _blocks(max_bits + agree)
    rows = []
    for k, chosen in enumerate(combinations(range(len(blocks)), agree)):
        low, parts = 64, []
        for b in (*chosen, *(b for b in range(len(blocks)) if b not in chosen)):
            shift, width = blocks[b]
            low -= width
            parts.append(f"shiftleft(shiftrightunsigned(fp, {shift}) & {(1 << width) - 1}L, {low})")
        rows.append(f"struct({k} AS block, {' | '.join(parts)} AS turned, {64 - sum(blocks[b][1] for b in chosen)} AS behind)")
    rows = fps.selectExpr("fp", f"inline(array({', '.join(rows)}))").selectExpr("fp", "block", "turned", "shiftrightunsigned(turned, behind) AS value")
    rank = F.col("turned")
    for s in (1, 2, 4, 8, 16, 32):  # inverse of the Gray code: prefix exclusive-or
        rows = rows.withColumn("rank", rank.bitwiseXOR(F.shiftrightunsigned(rank, s)))
        rank = F.col("rank")
    return rows.drop("turned")


def _tiles(keys: DataFrame) -> DataFrame:
    """Keys with (lo, hi): groups of more than SPLIT rows are salted into q parts, q as the root of their size,
    and every pair of parts is a group of its own, so that no task gets a hot group whole."""
    hot = written(keys.groupBy("block", "value").count().filter(F.col("count") > SPLIT).select(
        "block", "value", F.ceil(F.sqrt(F.col("count") / SPLIT)).cast("int").alias("q")), "hot")
    part = keys.join(hot, ["block", "value"], "left").withColumn("q", F.coalesce("q", F.lit(1)))
    part = part.withColumn("salt", F.expr("cast(pmod(xxhash64(fp, 7), q) as int)"))
    return part.select("*", F.explode(F.expr("sequence(0, q - 1)")).alias("other")).select(
        "block", "value", F.least("salt", "other").alias("lo"), F.greatest("salt", "other").alias("hi"), "rank", "fp")


class GrayTree:
    """Levels of shared bits over fingerprints sorted by Gray rank within consecutive groups."""

    def __init__(self, fps: np.ndarray, group_starts: np.ndarray):
        n = len(fps)
        self.low, self.high = [fps], [fps]  # bits set in all, bits set in any
        self.first = [np.arange(n + 1)]  # first child of each node, and the end
        starts = group_starts
        while True:
            ends = np.append(starts[1:], len(self.low[-1]))
            sizes = ends - starts
            nodes = -(-sizes // FAN)
            up = np.concatenate([[0], np.cumsum(nodes)])
            group = np.repeat(np.arange(len(starts)), nodes)
            begin = starts[group] + (np.arange(up[-1]) - up[group]) * FAN
            self.low.append(np.bitwise_and.reduceat(self.low[-1], begin))
            self.high.append(np.bitwise_or.reduceat(self.high[-1], begin))
            self.first.append(np.append(begin, len(self.low[-2])))
            starts = up[:-1]
            if nodes.max() == 1:
                break

    def links(self, max_bits: int, chunk: int = 4096) -> np.ndarray:
        """For every fingerprint, the position of the first one of its component (its own if it has no link)."""
        n = len(self.low[0])
        component = np.arange(n)
        spread = np.arange(FAN)
        top = len(self.low) - 1
        roots = np.arange(len(self.low[top]))
        stack = [(top, roots[i:i + chunk], roots[i:i + chunk]) for i in range(0, len(roots), chunk)]
        while stack:
            level, a, b = stack.pop()
            first = self.first[level]
            ca, cb = first[a][:, None] + spread, first[b][:, None] + spread
            pairs = (ca < first[a + 1][:, None])[:, :, None] & (cb < first[b + 1][:, None])[:, None, :]
            k, i, j = np.nonzero(pairs)
            x, y = ca[k, i], cb[k, j]
            keep = (x < y) if level == 1 else (x <= y)
            x, y = x[keep], y[keep]
            low, high = self.low[level - 1], self.high[level - 1]
            # shared bits of both sides that differ: set in all of one side, in none of the other
            apart = np.bitwise_count((low[x] & ~high[y]) | (low[y] & ~high[x]))
            near = apart <= max_bits
            x, y = x[near], y[near]
            if level == 1:
                fresh = component[x] != component[y]
                if fresh.any():
                    component = _unite(component, x[fresh], y[fresh])
                continue
            x, y = self._unlinked(level - 1, x, y, component)
            stack += [(level - 1, x[i:i + chunk], y[i:i + chunk]) for i in range(0, len(x), chunk)]
        return component

    def _unlinked(self, level: int, x: np.ndarray, y: np.ndarray, component: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Drops the pairs of nodes all of whose fingerprints are in one component already."""
        begin = end = np.unique(np.concatenate([x, y]))
        nodes, end = begin, begin + 1
        for lv in range(level, 0, -1):
            begin, end = self.first[lv][begin], self.first[lv][end]
        edges = np.stack([begin, end], axis=1).ravel()
        padded = np.append(component, 0)
        low = np.minimum.reduceat(padded, edges)[::2]
        high = np.maximum.reduceat(padded, edges)[::2]
        ix, iy = np.searchsorted(nodes, x), np.searchsorted(nodes, y)
        done = (low[ix] == high[ix]) & (low[iy] == high[iy]) & (low[ix] == low[iy])
        return x[~done], y[~done]


def _unite(component: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Components after linking x with y; a component is named by its smallest position."""
    pairs = np.unique(np.stack([component[x], component[y]], axis=1), axis=0)
    names, index = np.unique(pairs, return_inverse=True)
    index = index.reshape(pairs.shape)
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[index[:, 0]], label[index[:, 1]])
        new = label.copy()
        np.minimum.at(new, index[:, 0], low)
        np.minimum.at(new, index[:, 1], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    into = np.arange(len(component))
    into[names] = names[label]
    return into[component]


def _search(max_bits: int, most: int = 1 << 20):
    """Sorted rows of whole groups -> links (a, b) from each linked fingerprint to the first of its local component."""
    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        root = GrayTree(fps, starts).links(max_bits)
        linked = root != np.arange(len(fps))
        return pa.RecordBatch.from_arrays([pa.array(fps[linked].view(np.int64)), pa.array(fps[root[linked]].view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0
        for batch in batches:
            held.append((np.stack([batch.column(c).to_numpy() for c in ("block", "value", "lo", "hi")], axis=1),
                         batch.column("fp").to_numpy().view(np.uint64)))
            size += batch.num_rows
            if size >= most:  # hand on the whole groups, keep the last one, which may go on
                keys, fps = (np.concatenate(x) for x in zip(*held))
                last = int(np.flatnonzero((keys != keys[-1]).any(axis=1))[-1]) + 1 if (keys != keys[-1]).any() else 0
                if last:
                    yield links(keys[:last], fps[:last])
                    held = [(keys[last:], fps[last:])]
                    size = len(fps) - last
        if size:
            yield links(*(np.concatenate(x) for x in zip(*held)))
    return run


def fingerprint_links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of the distinct ``fp`` at most ``max_bits`` apart."""
    keys = ["block", "value", "lo", "hi"]
    agree = agreeing_blocks(fps.agg(F.approx_count_distinct("fp")).first()[0], max_bits)
    rows = _tiles(_keys(fps, max_bits, agree)).repartition(*keys).sortWithinPartitions(*keys, "rank")
    return map_arrow(rows, _search(max_bits), "a long, b long").distinct()


def stars(links: DataFrame) -> DataFrame:
    """(v, root): every linked value with the smallest value of its component, roots excepted."""
    edges = written(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        # written, so that the join has plain shuffles on both sides and Spark splits a hub's partition
        least = written(both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m")), "least")
        large = both.join(least, "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        near = large.join(least, "v")
        small = near.filter("u != m").select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(
            near.select("v", F.col("m").alias("u"))).distinct()
        edges = written(small, "stars")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first())
        if now == state:
            return edges.select("v", F.col("u").alias("root"))
        state = now


def components(marked: DataFrame, max_bits: int = 4) -> DataFrame:
    """(fp, doc_id, text_hash) for each distinct fingerprint: the first row, by doc_id, then text hash, of its component.

    ``marked`` is a written table of ``fingerprints``.  Null doc_ids come last.
    """
    fps = marked.groupBy("fp").agg(_first("doc_id", "text_hash").alias("first"))
    star = written(stars(fingerprint_links(fps.select("fp"), max_bits)), "components")
    members = star.select(F.col("v").alias("fp"), "root").unionByName(star.select(F.col("root").alias("fp"), "root").distinct())
    named = written(fps.join(members, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "named")
    best = written(named.groupBy("root").agg(F.min("first").alias("best")), "best")
    return named.join(best, "root").select("fp", "best.doc_id", "best.text_hash")


def _first(*columns: str):
    """The smallest row, nulls last."""
    return F.min(F.struct(F.col(columns[0]).isNull().alias("no_id"), *columns))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits.

    Null and empty texts have fingerprint zero and link like any other.  Rows with a null doc_id link too;
    component_id is null only if the whole component has none.  One row per input row; other columns are dropped.
    """
    marked = written(fingerprints(docs, shingle), "fingerprints")
    found = components(marked, max_bits).select("fp", F.col("doc_id").alias("component_id"))
    return marked.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` that come first in their component (by doc_id, nulls last, then text hash); equal rows once."""
    p = fresh("_group_", docs.columns)
    marked = written(fingerprints(docs, shingle), "fingerprints")
    first = components(marked, max_bits).select(F.col("doc_id").alias(f"{p}id"), F.col("text_hash").alias(f"{p}first"))
    keep = written(first.distinct(), "kept")
    keyed = docs.withColumn(f"{p}hash", F.xxhash64("text"))
    stay = keyed.join(keep, F.col("doc_id").eqNullSafe(F.col(f"{p}id")) & (F.col(f"{p}hash") == F.col(f"{p}first")), "left_semi")
    return stay.dropDuplicates(["doc_id", f"{p}hash"]).select(*[F.col(f"`{c}`") for c in docs.columns])
