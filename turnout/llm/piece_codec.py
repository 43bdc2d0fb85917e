"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Adjacent symbols that concatenate to a vocabulary piece form a pair; the agenda holds all pairs by
score (highest first, then leftmost).  The best pair is merged and the pairs on both sides of the new
symbol replace the old ones, until no pair is left.  Symbols outside the vocabulary fall back to bytes.

No merge crosses two adjacent characters that are adjacent in no piece.  When the model is loaded, the
space mark and the marks of ``_MARKS`` are checked for standing behind another character, or behind a
letter, in any piece; texts are cut before those that never do (a model without any is encoded text by
text).  The parts of an Arrow batch have agendas of their own, which are worked off side by side: one
matrix row per distinct part, one merge per row and step.  The ids of every whole text are checked against the
sentencepiece library; a text where the two differ gets the library's ids and is counted.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.common import Bytes, PieceCache, joined_ids, map_arrow, text_slices

MARK = "▁"  # what sentencepiece writes for a space
_MARKS = ".,!?;:|#$%&*"
NONE = np.int32(2**31 - 1)
WIDTHS = (4, 8, 12, 16, 24, 32, 64)


class MergeVocabulary:
    """Symbol ids, and for each pair of symbols what it merges to and how early."""

    def __init__(self, processor):
        n = processor.get_piece_size()
        self.processor, self.size = processor, n
        plain = {processor.id_to_piece(i): i for i in range(n)
                 if not (processor.is_control(i) or processor.is_byte(i) or processor.is_unknown(i) or processor.is_unused(i))}
        self.words_alone = not any(MARK in p.lstrip(MARK) for p in plain)
        behind_letters = {b for p in plain for a, b in zip(p, p[1:]) if a.isalpha()}
        marks = "".join(m for m in _MARKS if m not in behind_letters)
        self.stops = np.zeros(256, bool)
        self.stops[list(marks.encode())] = True
        self.byte_ids = [processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = processor.unk_id()
        self.fallback = processor.is_byte(self.byte_ids[0])
        # characters that occur in pieces but are no piece themselves get ids of their own
        inner = sorted({c for p in plain for c in p} - set(plain))
        symbols = {**plain, **{c: n + k for k, c in enumerate(inner)}}
        self.char_id = np.full(0x110000, -1, dtype=np.int32)
        for p, i in symbols.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i
        self.char_of = {n + k: c for k, c in enumerate(inner)}
        scores = {i: processor.get_score(i) for i in plain.values()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = {}
        for p, i in plain.items():
            for cut in range(1, len(p)):
                left, right = symbols.get(p[:cut]), symbols.get(p[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i, order[scores[i]]
        self.pairs = pairs
        # the pairs as a hash table with open places, half empty at least
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.rank, self.merged = np.full(1 << self.bits, NONE, np.int32), np.zeros(1 << self.bits, np.int32)
        left = np.array(list(pairs), dtype=np.int64)
        into = np.array(list(pairs.values()), dtype=np.int32).reshape(-1, 2)
        at, self.probes = self._home(left), 0
        while len(left):  # one key takes each free place, the others go on to the next
            free = np.flatnonzero(self.keys[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.merged[at[put]], self.rank[at[put]] = left[put], into[put, 0], into[put, 1]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, into, at = left[rest], into[rest], (at[rest] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE if they do not merge) and merged symbol of each pair; symbols below 0 never merge."""
        shape = left.shape
        # a symbol below 0 makes a key that no pair has
        key = (left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF).ravel()
        at = self._home(key)
        rank, merged = np.full(len(key), NONE), np.zeros(len(key), np.int32)
        open_ = np.arange(len(key))
        for _ in range(self.probes):
            there = self.keys[at]
            hit = there == key[open_]
            rank[open_[hit]], merged[open_[hit]] = self.rank[at[hit]], self.merged[at[hit]]
            on = ~hit & (there >= 0)
            if not on.any():
                break
            open_, at = open_[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return rank.reshape(shape), merged.reshape(shape)

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, a text without inner word starts; agendas of like length run together."""
        out: list = [None] * len(words)
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        low = 0
        for width in WIDTHS:
            rows = np.flatnonzero((lengths > low) & (lengths <= width))
            for part in np.array_split(rows, len(rows) // 20_000 + 1):
                for row, ids in zip(part.tolist(), self._agendas([words[r] for r in part.tolist()], width)):
                    out[row] = ids
            low = width
        for row in np.flatnonzero(lengths > low).tolist():
            out[row] = self._agenda(words[row])
        return [[] if ids is None else ids for ids in out]

    def _agendas(self, words: list[str], width: int) -> Iterator[list[int]]:
        n = len(words)
        chars = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), dtype=np.uint32).reshape(n, width)
        inside = np.arange(width) < np.array([len(w) for w in words], dtype=np.int64)[:, None]
        # -1 is a character without a symbol, -2 is behind the end
        symbols = np.where(inside, self.char_id[chars], -2).astype(np.int32)
        place = np.where(inside, np.arange(width), -1).astype(np.int32)  # first character of each symbol
        done_symbols, done_place = symbols.copy(), place.copy()
        rank, into = self.look_up(symbols[:, :-1], symbols[:, 1:])
        rows, lanes = np.arange(n), np.arange(width)
        while len(rows):
            best = rank.argmin(axis=1)  # the leftmost of the best
            here = np.arange(len(rows))
            live = rank[here, best] != NONE
            if not live.all():
                done_symbols[rows[~live]], done_place[rows[~live]] = symbols[~live], place[~live]
                symbols, place, rank, into, rows, best = symbols[live], place[live], rank[live], into[live], rows[live], best[live]
                here = np.arange(len(rows))
                if not len(rows):
                    break
            merged = into[here, best]
            # close the gap: what stands behind the pair moves one place to the left
            take = np.minimum(lanes + (lanes > best[:, None]), width - 1)
            symbols, place = np.take_along_axis(symbols, take, 1), np.take_along_axis(place, take, 1)
            symbols[:, -1], place[:, -1] = -2, -1
            symbols[here, best] = merged
            rank, into = np.take_along_axis(rank, take[:, :-1].clip(max=width - 2), 1), np.take_along_axis(into, take[:, :-1].clip(max=width - 2), 1)
            rank[:, -1] = NONE
            for at in (best - 1, best):
                ok = (at >= 0) & (at < width - 1)
                r, a = here[ok], at[ok]
                rank[r, a], into[r, a] = self.look_up(symbols[r, a], symbols[r, a + 1])
        plain = ((done_symbols >= 0) & (done_symbols < self.size) | (done_symbols == -2)).all(axis=1)
        counts = (done_symbols != -2).sum(axis=1)
        for word, row, starts, count, easy in zip(words, done_symbols.tolist(), done_place.tolist(), counts.tolist(), plain.tolist()):
            yield row[:count] if easy else self._with_bytes(word, row[:count], starts[:count])

    def _with_bytes(self, word: str, symbols: list[int], places: list[int]) -> list[int]:
        out: list[int] = []
        for s, at in zip(symbols, places):
            if 0 <= s < self.size:
                out.append(s)
            elif self.fallback:
                out += [self.byte_ids[b] for b in word[at].encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def _agenda(self, word: str) -> list[int]:
        """One long word: the agenda is a heap, the symbols a linked list."""
        symbols = self.char_id[np.frombuffer(word.encode("utf-32-le"), dtype=np.uint32)].tolist()
        n = len(symbols)
        before, behind = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and symbols[left] >= 0 and symbols[right] >= 0:
                hit = self.pairs.get(symbols[left] << 32 | symbols[right])
                if hit:
                    heapq.heappush(heap, (hit[1], left, right, symbols[left], symbols[right], hit[0]))

        for i in range(n - 1):
            offer(i, i + 1)
        gone = [False] * n
        while heap:
            _, left, right, a, b, merged = heapq.heappop(heap)
            if gone[left] or gone[right] or symbols[left] != a or symbols[right] != b or behind[left] != right:
                continue
            symbols[left], gone[right] = merged, True
            behind[left] = behind[right]
            if behind[left] >= 0:
                before[behind[left]] = left
            offer(before[left], left)
            offer(left, behind[left])
        places = [i for i in range(n) if not gone[i]]
        return self._with_bytes(word, [symbols[i] for i in places], places)


_LOADED: dict = {}


def _model(path: str):
    if path not in _LOADED:
        import sentencepiece
        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        _LOADED[path] = processor, MergeVocabulary(processor), PieceCache()
    return _LOADED[path]


def _cuts(raw: Bytes, vocabulary: MergeVocabulary) -> np.ndarray:
    """Places of normalised texts that no merge crosses: space marks that stand behind another character, and marks that no
    piece has behind a letter."""
    if not vocabulary.words_alone:
        return np.zeros(len(raw.at), bool)
    first, second, third = MARK.encode()
    mark = (raw.at == first) & (raw.shifted(1) == second) & (raw.shifted(2) == third)
    after_mark = np.zeros_like(mark)
    after_mark[3:] = mark[:-3]
    return mark & ~after_mark | vocabulary.stops[raw.at] & raw.behind_letter()


def encode_texts(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[int]]]:
    """Ids of all texts in a row, where each text's begin (and the last end), whether the library encodes a text otherwise as
    a whole (its ids are used then), and the library's ids."""
    processor, vocabulary, cache = _model(path)

    def encode(words: list[str]) -> Iterator[bytes]:
        for i in range(0, len(words), 20_000):
            for own in vocabulary.encode(words[i:i + 20_000]):
                yield array("I", own).tobytes()

    raw = Bytes(processor.normalize(texts))
    parts, which, counts = raw.parts(_cuts(raw, vocabulary))
    ids, until = joined_ids(cache.look_up(parts, encode), which, counts)
    checked = processor.encode(texts, num_threads=1)
    whole = [array("I", x).tobytes() for x in checked]
    differ = np.zeros(len(texts), bool)
    if b"".join(whole) != ids.tobytes() or (np.fromiter(map(len, whole), np.int64, len(whole)) != 4 * np.diff(until)).any():
        differ[:] = [w != ids[a:b].tobytes() for w, a, b in zip(whole, until, until[1:])]
        ids = np.frombuffer(b"".join(whole), np.uint32)
        until = np.concatenate([[0], np.cumsum([len(w) // 4 for w in whole])])
    return ids, until, differ, checked


def _codec(path: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _model(path)[0]
        for rows, texts in text_slices(batches, "text"):
            # the library's lists are the ids by now, so they are what is decoded
            ids, until, differ, same = encode_texts([t or "" for t in texts], path)
            decoded = processor.decode(same, num_threads=1)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in keep), pa.ListArray.from_arrays(pa.array(until, pa.int32()), pa.array(ids.astype(np.int32))),
                 pa.array(decoded, pa.string()), pa.array(differ).cast(pa.int32())], names=[*keep, "ids", "decoded", "n_differ"])
    return run


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ``ids`` (pieces of the whole text), ``decoded`` (the library's decode of them) and
    ``n_differ`` (1 where own agenda and library encode the whole text otherwise and the library's ids stand, else 0).

    A null text is empty: no ids, decoded to ''.  One row per input row, repeated rows included; other
    columns are dropped.  Texts of any length are taken whole.
    """
    return map_arrow(docs.select("doc_id", "text"), _codec(path, ["doc_id"]),
                     "doc_id long, ids array<int>, decoded string, n_differ int")


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 of the decimal ids joined by commas, decoded_sha256."""
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"), "n_differ")
