"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the postings of all corpus tokens: each row of the written table is a shard of
whole documents with, for every term, the ascending token positions (as differences).  A shard is
searched on its own.  For a phrase the lists of its terms are brought to the phrase's start by taking
off the term's offset and intersected from the rarest term of the shard on, so a term that is absent
or rare ends the search at once.  Exact phrase matches need every list.  A proximity match is a document and a
start for which every term has a posting of that document at most ``slop`` words off its place; of starts in a
row the one with the least displacement is given.  So it does not depend on the shard.

The benchmark is the stated query set.  It goes to the executors a block of bounded size at a time: the block's
hits are written, and it is destroyed before the next one is read.  Every block meets every shard through its
distinct terms; windows with a term that the shard lacks are never looked at.  Nothing of the corpus is shuffled
but the hits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.common import map_arrow, text_slices, written

# lower-cases A-Z; the ASCII characters that are no letter or digit part words
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 48 or 58 <= b <= 96 or 123 <= b <= 127 else b for b in range(256))
INDEX_SCHEMA = "shard long, doc_ids array<long>, starts binary, terms binary, ends binary, gaps binary"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


def _shard(shard: int, doc_ids: list, lengths: list[int], tokens: list[bytes]) -> pa.RecordBatch:
    vocabulary = dict(zip(dict.fromkeys(tokens), count()))
    ids = np.fromiter(map(vocabulary.__getitem__, tokens), np.int32, len(tokens))
    positions = np.argsort(ids, kind="stable").astype(np.int32)
    ends = np.cumsum(np.bincount(ids, minlength=len(vocabulary))).astype(np.int32)
    gaps = np.diff(positions, prepend=np.int32(0))
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    gaps[begins] = positions[begins]  # each list starts with a position
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64()))] + [pa.array([x], pa.binary()) for x in (
            starts.tobytes(), b" ".join(vocabulary), ends.tobytes(), gaps.astype(np.int32).tobytes())],
        names=["shard", "doc_ids", "starts", "terms", "ends", "gaps"])


def _indexer(shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        doc_ids, lengths, tokens = [], [], []
        for rows, texts in text_slices(batches, "text"):
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), texts):
                found = words(text)
                doc_ids.append(doc_id)
                lengths.append(len(found))
                tokens += found
                if len(tokens) >= shard_tokens:
                    yield _shard(shard, doc_ids, lengths, tokens)
                    shard, doc_ids, lengths, tokens = shard + 1, [], [], []
        if doc_ids:
            yield _shard(shard, doc_ids, lengths, tokens)
    return run


def build_index(docs: DataFrame, shard_tokens: int = 500_000) -> DataFrame:
    """The written index of ``docs`` (doc_id, text); a shard closes at ``shard_tokens`` tokens and holds whole documents."""
    return written(map_arrow(docs.select("doc_id", "text"), _indexer(shard_tokens), INDEX_SCHEMA), "postings", compression="zstd")


class Block:
    """Items as numbers of their distinct terms."""

    def __init__(self, items: list[tuple[str, list[bytes]]]):
        self.names = [name for name, _ in items]
        tokens = [w for _, text in items for w in text]
        self.terms = list(dict.fromkeys(tokens))
        number = {t: k for k, t in enumerate(self.terms)}
        self.ids = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
        self.starts = np.concatenate([[0], np.cumsum([len(text) for _, text in items])]).astype(np.int64)


class Shard:
    """One row of the index, ready to be searched."""

    def __init__(self, row: dict):
        self.shard = row["shard"]
        self.doc_ids = row["doc_ids"]
        self.starts = np.frombuffer(row["starts"], np.int32)
        self.terms = {t: i for i, t in enumerate(row["terms"].split())}
        self.ends = np.frombuffer(row["ends"], np.int32)
        self.gaps = np.frombuffer(row["gaps"], np.int32)
        self.lists: dict = {}

    def size(self, term: int) -> int:
        return int(self.ends[term] - (self.ends[term - 1] if term else 0))

    def postings(self, term: int) -> np.ndarray:
        if term not in self.lists:
            self.lists[term] = np.cumsum(self.gaps[self.ends[term - 1] if term else 0:self.ends[term]])
        return self.lists[term]

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Starts at which the terms stand in order within one document."""
        order = sorted(range(len(terms)), key=lambda k: self.size(terms[k]))
        at = self.postings(terms[order[0]]) - order[0]
        for k in order[1:]:
            if not len(at):
                return at
            there = self.postings(terms[k]) - k
            at = at[there[np.minimum(np.searchsorted(there, at), len(there) - 1)] == at]
        at = at[at >= 0]
        return at[at + len(terms) <= self.starts[self.documents(at) + 1]]

    def near(self, terms: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, starts) for which every term has a posting of the document within ``slop`` of start + its place; of
        starts in a row the first with the least sum of displacements.  A start may lie before its document."""
        order = sorted(range(len(terms)), key=lambda k: self.size(terms[k]))
        first = self.postings(terms[order[0]])
        doc = np.repeat(self.documents(first), 2 * slop + 1)
        at = (first[:, None] - order[0] + np.arange(-slop, slop + 1)).ravel()
        doc, at = np.unique(np.stack([doc, at]), axis=1)
        apart = np.zeros(len(at), np.int64)
        for k in range(len(terms)):
            there = self.postings(terms[k])
            least = np.full(len(at), slop + 1)
            right = np.searchsorted(there, at + k)
            for side in (right - 1, right):  # the nearest posting on either side, if it is of the document
                p = there[np.clip(side, 0, len(there) - 1)]
                own = (side >= 0) & (side < len(there)) & (p >= self.starts[doc]) & (p < self.starts[doc + 1])
                least = np.where(own, np.minimum(least, np.abs(p - at - k)), least)
            keep = least <= slop
            doc, at, apart = doc[keep], at[keep], apart[keep] + least[keep]
        if not len(at):
            return doc, at
        run = np.cumsum(np.append(True, (np.diff(at) != 1) | (np.diff(doc) != 0)))
        best = np.lexsort((at, apart, run))
        best = np.sort(best[np.append(True, np.diff(run[best]) != 0)])
        return doc[best], at[best]

    def search(self, block: Block, window: int, slop: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(item number, length, documents, starts) for every window of every item of the block that occurs."""
        local = np.fromiter((self.terms.get(t, -1) for t in block.terms), np.int64, len(block.terms))
        ids = local[block.ids]
        present = np.concatenate([[0], np.cumsum(ids >= 0)])
        sizes = np.diff(block.starts)
        lengths = np.repeat(np.minimum(sizes, window), sizes)
        item = np.repeat(np.arange(len(sizes)), sizes)
        begin = np.arange(len(ids))
        whole = begin + lengths <= block.starts[item + 1]
        begin, lengths, item = begin[whole], lengths[whole], item[whole]
        there = np.flatnonzero(present[begin + lengths] - present[begin] == lengths)
        for k in there.tolist():
            n = int(lengths[k])
            terms = ids[begin[k]:begin[k] + n].tolist()
            if slop:
                docs, at = self.near(terms, slop)
            else:
                at = self.phrase(terms)
                docs = self.documents(at)
            if len(at):
                yield int(item[k]), n, docs, at

    def documents(self, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, starts, "right") - 1


def item_blocks(benchmark: DataFrame, block_bytes: int = 16 << 20) -> Iterator[Broadcast]:
    """The items with words as broadcast blocks of about ``block_bytes`` of text (whole items, none left out), one at a
    time: a block is destroyed when the next one is asked for."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").filter("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // block_bytes + 1
    if n > 1:
        items = written(items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))), "items", compression="zstd")
    for k in range(n):
        rows = (items.filter(F.col("block") == k) if n > 1 else items).collect()
        block = spark.sparkContext.broadcast(Block([(r.item, w) for r in rows if (w := words(r.text))]))
        yield block
        block.destroy()


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield Shard(batch.slice(k, 1).to_pylist()[0])


HITS = "shard long, doc int, items array<string>, runs array<struct<first: long, last: long>>"


def _hitter(block: Broadcast, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            names, places = defaultdict(set), defaultdict(list)
            for item, n, docs, starts in shard.search(block.value, window):
                for d, at in zip(docs.tolist(), (starts - shard.starts[docs]).tolist()):
                    names[d].add(block.value.names[item] or "")  # a null item_id is named '' in the list
                    places[d].append((at, at + n))
            found = sorted(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard.shard] * len(found), pa.int64()), pa.array(found, pa.int32()), pa.array([sorted(names[d]) for d in found], pa.list_(pa.string())),
                 pa.array([[{"first": a, "last": b} for a, b in joined(places[d])] for d in found], _RUNS)], names=["shard", "doc", "items", "runs"])
    return run


_RUNS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def joined(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches that touch or overlap as one."""
    out: list = []
    for a, b in sorted(set(places)):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def _lister(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of the index: shard, place in it, doc_id and number of words."""
    for batch in batches:
        for shard, ids, starts in zip(*(batch.column(c) for c in ("shard", "doc_ids", "starts"))):
            sizes = np.diff(np.frombuffer(starts.as_py(), np.int32))
            yield pa.RecordBatch.from_arrays([pa.array([shard.as_py()] * len(sizes), pa.int64()), pa.array(np.arange(len(sizes), dtype=np.int32)),
                                              ids.values, pa.array(sizes.astype(np.int64))], names=["shard", "doc", "doc_id", "n_words"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside an occurrence of a window of ``window`` item words),
    n_items, items_sha256 (of the sorted item_ids joined by commas) and contaminated.

    Null and empty texts have no words; null, empty and repeated items add nothing; an item of fewer words
    than the window is one window.  One row per input row; other columns are dropped.
    """
    index = build_index(docs)
    hits = [written(map_arrow(index, _hitter(block, window), HITS), "hits") for block in item_blocks(benchmark)]
    # a document's hits come in one row per block
    found = reduce(DataFrame.unionByName, hits).groupBy("shard", "doc").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"))
    n_hit = F.expr("aggregate(runs, struct(0L AS n, 0L AS upto), (s, r) -> struct(s.n + greatest(0L, r.last - greatest(r.first, s.upto)) AS n, "
                   "greatest(s.upto, r.last) AS upto), s -> s.n)")
    listed = written(map_arrow(index.select("shard", "doc_ids", "starts"), _lister, "shard long, doc int, doc_id long, n_words long"), "listed")
    rows = listed.join(found.select("shard", "doc", "items", n_hit.alias("n_hit")), ["shard", "doc"], "left")
    return rows.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                       F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                       F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                       F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def _matcher(block: Broadcast, window: int, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            for item, n, doc, starts in shard.search(block.value, window, slop):
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard.doc_ids[d] for d in doc.tolist()], pa.int64()), pa.array([block.value.names[item]] * len(starts), pa.string()),
                    pa.array((starts - shard.starts[doc]).astype(np.int64)), pa.array([n] * len(starts), pa.int32())],
                    names=["doc_id", "item_id", "start", "length"])
    return run


def matches(index: DataFrame, benchmark: DataFrame, window: int = 10, slop: int = 0) -> DataFrame:
    """doc_id, item_id, start (word of the document) and length of every occurrence of an item window: exact phrases, or
    proximity matches with each term at most ``slop`` words off its place (the start may then lie before the document)."""
    schema = "doc_id long, item_id string, start long, length int"
    return reduce(DataFrame.unionByName, [written(map_arrow(index, _matcher(block, window, slop), schema), "matches") for block in item_blocks(benchmark)])


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` without any benchmark window.

    The decision is by doc_id: rows that share one (null too) go together if one of them is contaminated.
    """
    hit = written(contamination(docs, benchmark, window).filter("contaminated").select("doc_id").distinct(), "contaminated")
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["doc_id"]), "left_anti")
