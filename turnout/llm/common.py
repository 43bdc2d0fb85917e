"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from turnout.session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A given table, read by Spark, cut to ``columns`` (all if none are named)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet under the shared scratch folder and read back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(prefix: str, columns: list[str]) -> str:
    """``prefix``, with underscores before it until no column starts with it."""
    while any(c.lower().startswith(prefix) for c in columns):
        prefix = "_" + prefix
    return prefix


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with this package importable on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, max_chars: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cut Arrow batches into slices of about ``max_chars`` bytes of ``column`` (one row at least),
    each with its texts as a list, so that a task's memory follows the slice and not the batch."""
    for batch in batches:
        texts = batch.column(column)
        start = size = 0
        lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        for i, n in enumerate(lengths):
            if i > start and size + n > max_chars:
                yield batch.slice(start, i - start), texts.slice(start, i - start).to_pylist()
                start, size = i, 0
            size += int(n)
        if batch.num_rows > start:
            yield batch.slice(start), texts.slice(start).to_pylist()


LETTERS, SPACES, ASCII_SPACES = np.zeros(256, bool), np.zeros(256, bool), bytes([*range(9, 14), *range(28, 33)])
LETTERS[[*range(65, 91), *range(97, 123)]] = True
SPACES[list(ASCII_SPACES)] = True


class Bytes:
    """The UTF-8 bytes of a list of texts in a row, with masks of places for cutting them into parts.  A mask is true at
    the first byte of a character; ``shifted`` looks at the byte so many places before or behind."""

    def __init__(self, texts: list[str]):
        encoded = [t.encode() for t in texts]
        self.ends = np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)))
        self.data = b"".join(encoded)
        self.at = np.frombuffer(self.data, np.uint8)

    def shifted(self, k: int) -> np.ndarray:
        """The byte ``k`` places behind (before, if negative) each place; 0 beyond the ends."""
        out = np.zeros(len(self.at), np.uint8)
        if k < 0:
            out[-k:] = self.at[:k]
        else:
            out[:len(out) - k] = self.at[k:]
        return out

    def behind_letter(self) -> np.ndarray:
        """Places behind a Latin letter (A-Z, a-z, À-Ö, Ø-ö, ø-ÿ)."""
        one = self.shifted(-1)
        return LETTERS[one] | (self.shifted(-2) == 0xC3) & (one >= 0x80) & (one != 0x97) & (one != 0xB7)

    def beside_space(self) -> tuple[np.ndarray, np.ndarray]:
        """Places whose character before, and whose character behind (of one byte), is or may be white space.  General
        punctuation and CJK punctuation share lead bytes with white space and count as such."""
        p1, p2, p3 = self.shifted(-1), self.shifted(-2), self.shifted(-3)
        n1, n2 = self.shifted(1), self.shifted(2)
        before = SPACES[p1] | (p2 == 0xC2) & ((p1 == 0x85) | (p1 == 0xA0)) | _wide_space(p3, p2)
        behind = SPACES[n1] | (n1 == 0xC2) & ((n2 == 0x85) | (n2 == 0xA0)) | _wide_space(n1, n2)
        return before, behind

    def parts(self, cut: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The texts cut before every place of the mask: the distinct parts, which of them stands at each place, and the
        number of parts of each text."""
        n = len(self.ends)
        starts = self.ends - np.diff(self.ends, prepend=0)
        cut[starts[starts < len(cut)]] = True
        places = np.flatnonzero(cut)
        offsets = np.append(places, len(cut)).astype(np.int32)
        found = pa.StringArray.from_buffers(len(places), pa.py_buffer(offsets), pa.py_buffer(self.data)).dictionary_encode()
        counts = np.searchsorted(places, self.ends) - np.searchsorted(places, starts) if n else np.zeros(0, np.int64)
        return found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy(zero_copy_only=False), counts


def _wide_space(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first == 0xE1) & (second == 0x9A) | (first == 0xE2) & ((second == 0x80) | (second == 0x81)) | (first == 0xE3) & (second == 0x80)


class PieceCache:
    """Bounded memo of what repeated pieces of text encode to, as bytes: two generations of at most
    ``limit`` entries each; the older one is dropped when the younger is full."""

    def __init__(self, limit: int = 500_000, longest: int = 200):
        self.limit, self.longest, self.young, self.old = limit, longest, {}, {}

    def look_up(self, pieces: list[str], make) -> list[bytes]:
        """The bytes of each of the distinct ``pieces``; ``make(list)`` encodes unseen ones."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found = list(map(young.get, pieces))
        fresh = []
        for k, known in enumerate(found):
            if known is None:
                piece = pieces[k]
                known = old.get(piece)
                if known is None:
                    fresh.append(k)
                else:
                    young[piece] = found[k] = known
        for k, made in zip(fresh, make([pieces[k] for k in fresh])):
            found[k] = made
            if len(pieces[k]) <= self.longest:
                young[pieces[k]] = made
        return found


def joined_ids(known: list[bytes], which: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of texts whose parts are ``which`` of the ``known`` ones (unsigned 32-bit), in a row, and where each text's
    begin (and the last ends); ``counts`` is the number of parts of each text."""
    sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
    flat = np.frombuffer(b"".join(known), np.uint32)
    first = np.cumsum(sizes) - sizes
    lengths = sizes[which]
    until = np.concatenate([[0], np.cumsum(lengths)])
    ids = flat[np.repeat(first[which] - until[:-1], lengths) + np.arange(until[-1])]
    return ids, until[np.concatenate([[0], np.cumsum(counts)])]
