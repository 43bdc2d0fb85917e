"""Token-id files in Simple-8b word-aligned coding.

``write_tokens`` encodes documents and writes shards in ascending ``doc_id`` order; ``read_tokens``
reads them back.  A shard is the sorted range of one task, numbered in order.  It is a run of blocks, each a row of a
Parquet file whose ``payload`` is one Simple-8b block, so writing is atomic per task and reading
needs nothing but Spark's own readers.

Block payload, little-endian::

    'S8B2' | n_ids u64 | n_words u64 | n_escapes u64
    frame starts u64[ceil(n_ids / 4096)]   word at which every 4096th id starts
    words u64[n_words]                     selector in the top 4 bits, ids from the low bits up
    escape positions u64[n_escapes] | escape values u64[n_escapes]

Selector ``s`` < 14 packs ``COUNT[s]`` ids of ``BITS[s]`` bits; 14 packs 240 zeros, 15 packs 120 zeros.
Each word takes the most ids that fit.  A frame starts a new word, so frames are packed and read side
by side, and any of them without the others; the last word of a frame may hold fewer ids than its
selector says.  Ids of 60 bits or more do not fit a word: it holds 0 and the block lists place and value.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.common import Bytes, PieceCache, joined_ids, map_arrow, text_slices, written

# Simple-8b selectors: ids per word and bits per id (fixed values of the coding)
COUNT = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 240, 120], dtype=np.int64)
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0, 0], dtype=np.int64)
FRAME = 4096
PAD = 240
HEAD = struct.Struct("<4s3Q")
LIMIT = np.uint64(1 << 60)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    if len(values) and values.max() < 1 << 17:
        return _WIDTH[values]
    return np.searchsorted(1 << np.arange(60, dtype=np.uint64), values, side="right").astype(np.uint8)


_WIDTH = np.searchsorted(1 << np.arange(18), np.arange(1 << 17), side="right").astype(np.uint8)


def pack(ids: np.ndarray) -> bytes:
    """One block of unsigned 64-bit ids as Simple-8b bytes (an empty array gives an empty block)."""
    ids = np.asarray(ids, dtype=np.uint64)
    n = len(ids)
    escapes = np.flatnonzero(ids >= LIMIT)
    n_frames = -(-n // FRAME)
    # one row per frame; zeros behind its end let the last word take any selector
    low = np.zeros((n_frames, FRAME + PAD), dtype=np.uint64)
    flat = np.zeros(n_frames * FRAME, dtype=np.uint64)
    flat[:n] = ids
    flat[escapes] = 0
    low[:, :FRAME] = flat.reshape(n_frames, FRAME)
    choice = _choices(_widths(low))
    starts, rows = [], np.arange(n_frames)
    ends = np.minimum(n - rows * FRAME, FRAME)
    at = np.zeros(n_frames, dtype=np.int64)
    while len(rows):  # one word of every frame that is not at its end
        starts.append(rows * (FRAME + PAD) + at)
        at = at + COUNT[choice[rows, at]]
        more = at < ends[rows]
        rows, at = rows[more], at[more]
    place = np.sort(np.concatenate(starts)) if starts else np.zeros(0, dtype=np.int64)
    selectors = choice.ravel()[place - place // (FRAME + PAD) * PAD] if n else np.zeros(0, dtype=np.uint8)
    frames = np.searchsorted(place, np.arange(n_frames) * (FRAME + PAD))
    words = selectors.astype(np.uint64) << np.uint64(60)
    values = low.ravel()
    for s in np.unique(selectors).tolist():
        if s < 14:
            mine = np.flatnonzero(selectors == s)
            lanes = np.arange(COUNT[s])
            words[mine] |= np.bitwise_or.reduce(values[place[mine][:, None] + lanes] << (lanes * BITS[s]).astype(np.uint64), axis=1)
    return b"".join([HEAD.pack(b"S8B2", n, len(words), len(escapes)), frames.astype("<u8").tobytes(), words.astype("<u8").tobytes(),
                     escapes.astype("<u8").tobytes(), ids[escapes].astype("<u8").tobytes()])


def _choices(width: np.ndarray) -> np.ndarray:
    """For every place of every frame, the selector that takes the most ids from there on."""
    choice = np.full((len(width), FRAME), 13, dtype=np.uint8)
    # widest id of the next 2**k places; selectors from sparse to dense, the densest that fits stays
    doubled = [width]
    for s in [*range(12, -1, -1), 15, 14]:
        count, bits = int(COUNT[s]), int(BITS[s])
        k = count.bit_length() - 1
        while len(doubled) <= k:
            last, half = doubled[-1], 1 << (len(doubled) - 1)
            doubled.append(np.maximum(last[:, :-half], last[:, half:]))
        span = doubled[k]
        fits = np.maximum(span[:, :FRAME], span[:, count - (1 << k):][:, :FRAME]) <= bits
        if fits.any():
            choice[fits] = s
    return choice


def unpack(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` (exclusive; the end if None) of a block; decodes only the frames they are in."""
    magic, n, n_words, n_escapes = HEAD.unpack_from(payload)
    if magic != b"S8B2":
        raise ValueError("not a Simple-8b block")
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, dtype=np.uint64)
    n_frames, at = -(-n // FRAME), HEAD.size
    frames = np.append(np.frombuffer(payload, "<u8", n_frames, at).astype(np.int64), n_words)
    words = np.frombuffer(payload, "<u8", n_words, at + 8 * n_frames)
    escapes = np.frombuffer(payload, "<u8", 2 * n_escapes, at + 8 * (n_frames + n_words))
    f0, f1 = first // FRAME, -(-last // FRAME)
    words = words[frames[f0]:frames[f1]]
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNT[selectors]
    before = np.cumsum(counts) - counts
    heads = frames[f0:f1] - frames[f0]
    row = np.repeat(np.arange(f1 - f0), np.diff(np.append(heads, len(words))))
    place = before - before[heads][row] + row * (FRAME + PAD)
    out = np.zeros((f1 - f0) * (FRAME + PAD), dtype=np.uint64)
    for s in np.unique(selectors).tolist():
        if s < 14:
            mine = np.flatnonzero(selectors == s)
            lanes = np.arange(COUNT[s])
            mask = np.uint64((1 << int(BITS[s])) - 1)
            out[place[mine][:, None] + lanes] = (words[mine][:, None] >> (lanes * BITS[s]).astype(np.uint64)) & mask
    ids = out.reshape(-1, FRAME + PAD)[:, :FRAME].ravel()
    base = f0 * FRAME
    there = escapes[:n_escapes].astype(np.int64) - base
    inside = (there >= 0) & (there < len(ids))
    ids[there[inside]] = escapes[n_escapes:][inside]
    return ids[first - base:last - base]


_LOADED: dict = {}


def _tokenizer(path: str):
    """The tokenizer of ``path`` with the memo of parts, loaded once per worker process."""
    if path not in _LOADED:
        from tokenizers import Tokenizer
        _LOADED[path] = Tokenizer.from_file(path), PieceCache()
    return _LOADED[path]


STOPS = np.zeros(256, bool)
STOPS[list(b".,!?;:")] = True


def _cuts(raw: Bytes) -> np.ndarray:
    """Places where the byte-level pre-tokeniser starts a token whatever stands around: a space between two characters that
    are no white space, a stop behind a letter, a lone line break, and the character behind one."""
    space_before, space_behind = raw.beside_space()
    alone = ~space_before & ~space_behind
    line = (raw.at == 10) & alone
    cut = (raw.at == 32) & alone | STOPS[raw.at] & raw.behind_letter() | line
    cut[1:] |= line[:-1]
    return cut


def token_ids(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """``encode(text, add_special_tokens=False).ids`` of the tokenizers library for all texts in a row, and where each
    text's ids begin (and the last end).

    Texts are cut where the byte-level pre-tokeniser starts a token whatever stands around it.  A part encodes
    alone to what it gives in the text, so the library encodes repeated ones once.
    """
    tokenizer, seen = _tokenizer(path)

    def encode(parts: list[str]) -> Iterator[bytes]:
        for i in range(0, len(parts), 1000):
            for e in tokenizer.encode_batch_fast(parts[i:i + 1000], add_special_tokens=False):
                yield array("I", e.ids).tobytes()

    raw = Bytes(texts)
    parts, which, counts = raw.parts(_cuts(raw))
    return joined_ids(seen.look_up(parts, encode), which, counts)


def range_bounds(docs: DataFrame, n: int) -> list[int]:
    """``n`` - 1 doc_ids that cut the rows into about even ranges; a doc_id that many rows have is named as often as it
    fills ranges (a null one counts as the least).  One pass over doc_id."""
    if n < 2:
        return []
    ids = F.coalesce("doc_id", F.lit(LEAST))
    found = docs.agg(F.percentile_approx(ids, [k / n for k in range(1, n)], 100 * n)).first()[0]
    return found or []


LEAST = -(1 << 63)


def range_of(doc_ids: np.ndarray, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The range of each row, rising with (doc_id, hash): the rows of a doc_id that is a bound are dealt by their hash over
    the ranges that it lies in."""
    low, high = np.searchsorted(bounds, doc_ids, "left"), np.searchsorted(bounds, doc_ids, "right")
    share = (hashes >> 32).astype(float) / 2.0 ** 32 + 0.5
    return low + np.minimum((share * (high - low + 1)).astype(np.int64), high - low)


def _encoder(path: str, end_id: int, bounds: list[int]):
    cuts = np.array(bounds, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text"):
            ids, until = token_ids([t or "" for t in texts], path)
            # the end id behind each document
            ids = np.insert(ids, until[1:], end_id)
            until = until + np.arange(len(until))
            kind = np.uint16 if ids.max(initial=0) < 1 << 16 else np.uint32
            packed = ids.astype(kind)
            doc_ids = rows.column("doc_id").fill_null(LEAST).to_numpy()
            shard = range_of(doc_ids, rows.column("text_hash").to_numpy(), cuts).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), rows.column("doc_id"), rows.column("text_hash"), pa.array([kind().itemsize] * len(texts), pa.int32()),
                 pa.array([packed[a:b].tobytes() for a, b in zip(until, until[1:])], pa.binary())], names=["shard", "doc_id", "text_hash", "width", "ids"])
    return run


BLOCK_SCHEMA = "shard int, block int, first long, doc_ids array<long>, lengths array<long>, n_ids long, payload binary"


def _block_writer(block_ids: int):
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("lengths", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("payload", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, first = 0, 0
        docs, lengths, ids, size = [], [], [], 0

        def flush():
            flat = np.concatenate(ids)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
                [shard, block, first, docs, lengths, len(flat), pack(flat)], schema.types)], schema=schema)

        for batch in batches:
            shard = batch.column("shard")[0].as_py() if batch.num_rows else None  # all rows of a partition are of one
            for doc_id, width, packed in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "width", "ids"))):
                tokens = np.frombuffer(packed, f"<u{width}").astype(np.uint32)
                docs.append(doc_id)
                lengths.append(len(tokens))
                ids.append(tokens)
                size += len(tokens)
                if size >= block_ids:
                    yield flush()
                    block, first, size = block + 1, first + size, 0
                    docs, lengths, ids = [], [], []
        if docs:
            yield flush()

    return write


def write_tokens(docs: DataFrame, path: str, end_id: int = 0, block_ids: int = 1 << 20) -> DataFrame:
    """Encode ``text`` with the tokenizer file ``path``, append ``end_id``, write Simple-8b shards in
    ascending ``doc_id`` order under the shared folder, and return the written table.

    Texts are encoded where they lie; what is shuffled into ranges of (doc_id, hash of the text) is their ids.  The ranges
    come from quantiles of doc_id, and a doc_id that many rows share is dealt over several by hash.  A null text is empty (just the end id).  Null doc_ids come
    first.  Repeated doc_ids stand next to each other, ordered by a hash of their text.  Other columns are ignored.
    A block closes at about ``block_ids`` ids and holds whole documents, one at least.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    encoded = map_arrow(rows, _encoder(path, end_id, range_bounds(rows, n)), "shard int, doc_id long, text_hash long, width int, ids binary")
    ordered = encoded.repartitionById(n, "shard").sortWithinPartitions("doc_id", "text_hash")
    return written(map_arrow(ordered, _block_writer(block_ids), BLOCK_SCHEMA), "tokens", compression="zstd")


def shard_starts(tokens: DataFrame) -> dict[int, int]:
    """The number of ids in the file set before each shard (one row per shard, that is per task that wrote)."""
    before, out = 0, {}
    for shard, n in sorted(map(tuple, tokens.groupBy("shard").agg(F.sum("n_ids")).collect())):
        out[shard] = before
        before += n
    return out


def _reader(starts: dict[int, int], names: list[str], types: list, columns):
    """Rows of every block: doc_id, start, n_tokens and what ``columns(ids, offsets)`` makes of the block's ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), *zip(names, types)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):  # one block at a time
                shard, first, docs, lengths, payload = (batch.column(c)[row].as_py() for c in ("shard", "first", "doc_ids", "lengths", "payload"))
                offsets = np.concatenate([[0], np.cumsum(lengths)])
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts[shard] + first + offsets[:-1]),
                                                  pa.array(lengths, pa.int64()), *columns(unpack(payload), offsets)], schema=schema)
    return run


def read_tokens(tokens: DataFrame) -> DataFrame:
    """Documents of a written table: doc_id, start (ids of all documents before it), n_tokens, ids."""
    def lists(ids: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int64)))]
    run = _reader(shard_starts(tokens), ["ids"], [pa.list_(pa.int64())], lists)
    return map_arrow(tokens, run, "doc_id long, start long, n_tokens long, ids array<long>")


def token_checksums(tokens: DataFrame) -> DataFrame:
    """As ``read_tokens`` with, instead of the ids, the unsigned crc32 of them as little-endian 32-bit integers."""
    def crc(ids: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        raw = memoryview(ids.astype("<u4").tobytes())
        return [pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(offsets, offsets[1:])], pa.int64())]
    run = _reader(shard_starts(tokens), ["ids_crc32"], [pa.int64()], crc)
    return map_arrow(tokens, run, "doc_id long, start long, n_tokens long, ids_crc32 long")
