"""Document quality from a linear-chain conditional random field over its lines.

Every line is good or bad.  A line is described by what its characters and words are like and by the
same marks of its neighbours; the chain adds how labels follow each other.  Labelled documents teach it,
their label standing for each of their lines.  Forward-backward gives every line its marginal
probability of being good; the mean of them, weighted by line length, is set to the labels by a
one-variable logistic curve and is the document's quality.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.common import map_arrow, text_slices
from turnout.llm.learning import held_out, taught_sample

# byte classes: 0 other, 1 space, 2 capital, 3 small letter, 4 digit, 5 symbol, 6 bar, 7 exclamation, 8 full stop or comma, 9 inner byte, 10 line end
CLASS = np.zeros(256, dtype=np.int64)
CLASS[[9, 11, 12, 13, 32]] = 1
CLASS[65:91] = 2
CLASS[97:123] = 3
CLASS[0xC0:] = 3
CLASS[48:58] = 4
for _c in b"#*$%&<>@^~\\{}[]=_+":
    CLASS[_c] = 5
CLASS[ord("|")], CLASS[ord("!")], CLASS[10] = 6, 7, 10
CLASS[[ord("."), ord(","), ord(";"), ord(":"), ord("?")]] = 8
CLASS[0x80:0xC0] = 9
N_CLASS = 11

# features of a line, each cut into bins: share of its characters of a class, then what its words are like
EDGES = {
    "capitals": (0.001, 0.03, 0.1, 0.25, 0.5),
    "digits": (0.001, 0.02, 0.1, 0.3),
    "symbols": (0.001, 0.01, 0.05, 0.15, 0.3),
    "bars": (0.001, 0.02, 0.08, 0.15),
    "exclamations": (0.001, 0.02, 0.08),
    "stops": (0.001, 0.01, 0.03, 0.06, 0.12),
    "word_length": (2, 3, 4, 5, 6, 7.5, 10, 15),
    "length": (1, 20, 60, 150, 400, 1500),
    "distinct_words": (0.2, 0.4, 0.6, 0.8, 0.95),
    "like_last_word": (0.001, 0.05, 0.2, 0.6),
    "seen_line": (0.5,),
}
BINS = [len(e) + 1 for e in EDGES.values()]
OFFSETS = np.concatenate([[0], np.cumsum(BINS)])
ALONE = int(OFFSETS[-1])
# a line, its predecessor and its successor have weights of their own; a missing neighbour has one too
N_FEATURES = 3 * (ALONE + 1)


def line_marks(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins (lines x marks), lengths in characters, and number of lines of each text, for lines that have a word."""
    counts, lengths, wordy = [], [], []
    kept = []
    for text in texts:
        seen, n = set(), 0
        for line in text.encode().split(b"\n"):
            words = line.split()
            if not words:
                continue
            n += 1
            kept.append(line)
            same = sum(map(bytes.__eq__, words, words[1:])) if len(words) > 1 else 0
            wordy.append((len(words), len(set(words)) / len(words), same / len(words), line in seen))
            seen.add(line)
        counts.append(n)
    if not kept:
        return np.zeros((0, len(EDGES)), np.uint8), np.zeros(0), np.array(counts, dtype=np.int64)
    raw = np.frombuffer(b"\n".join(kept) + b"\n", np.uint8)
    ends = np.cumsum([len(x) + 1 for x in kept])
    classes = CLASS[raw]
    line_of = np.repeat(np.arange(len(kept)), np.diff(ends, prepend=0))
    seen_of = np.bincount(line_of * N_CLASS + classes, minlength=len(kept) * N_CLASS).reshape(-1, N_CLASS)
    chars = seen_of.sum(axis=1) - seen_of[:, 9] - seen_of[:, 10]
    inked = np.maximum(chars - seen_of[:, 1], 1)
    n_words, distinct, same, again = np.array(wordy, dtype=float).T
    values = [seen_of[:, c] / inked for c in (2, 4, 5, 6, 7, 8)] + [inked / n_words, chars, distinct, same, again]
    bins = np.stack([np.searchsorted(e, v, side="right") for e, v in zip(EDGES.values(), values)], axis=1).astype(np.uint8)
    return bins, chars.astype(float), np.array(counts, dtype=np.int64)


def active_features(bins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Feature numbers of every line (lines x 3 * marks): its own marks, its predecessor's and its successor's."""
    own = bins + OFFSETS[:-1]
    first = np.zeros(len(bins), dtype=bool)
    ends = np.cumsum(counts)
    first[(ends - counts)[counts > 0]] = True
    last = np.zeros(len(bins), dtype=bool)
    last[ends[counts > 0] - 1] = True
    block = ALONE + 1
    before = np.where(first[:, None], ALONE, np.roll(own, 1, axis=0))
    after = np.where(last[:, None], ALONE, np.roll(own, -1, axis=0))
    return np.concatenate([own, before + block, after + 2 * block], axis=1)


class Chains:
    """Texts of one batch as chains of equal step: at step t, the lines of all texts that have more than t."""

    def __init__(self, counts: np.ndarray):
        self.starts = np.cumsum(counts) - counts
        self.order = np.argsort(-counts, kind="stable")
        self.counts = counts[self.order]
        self.first = self.starts[self.order]
        longest = int(counts.max()) if len(counts) else 0
        self.alive = len(counts) - np.searchsorted(self.counts[::-1], np.arange(1, longest + 1), side="left")

    def marginals(self, score: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """P(good) of every line, expected label moves (2 x 2), and the log normaliser, from line scores for good
        against bad and the scores of moves from label to label."""
        n = len(score)
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        moves, log_z = np.zeros((2, 2)), 0.0
        local = np.stack([np.zeros(n), score], axis=1)
        for t, m in enumerate(self.alive):
            at = self.first[:m] + t
            forward[at] = local[at] if t == 0 else local[at] + np.logaddexp(
                forward[at - 1][:, :1] + move[0], forward[at - 1][:, 1:] + move[1])
        for t in range(len(self.alive) - 2, -1, -1):
            at = self.first[:self.alive[t + 1]] + t
            ahead = local[at + 1] + backward[at + 1]
            backward[at] = np.stack([np.logaddexp(move[k, 0] + ahead[:, 0], move[k, 1] + ahead[:, 1]) for k in (0, 1)], axis=1)
        both = forward + backward
        z = np.logaddexp(both[:, 0], both[:, 1])
        has = self.counts > 0
        log_z = float(z[self.first[has]].sum())
        for t in range(1, len(self.alive)):
            at = self.first[:self.alive[t]] + t
            pair = forward[at - 1][:, :, None] + move + (local[at] + backward[at])[:, None, :]
            moves += np.exp(pair - z[at][:, None, None]).sum(axis=0)
        return np.exp(both[:, 1] - z), moves, log_z


class LineModel:
    """Weights of line features and label moves, and the curve from weighted marginals to document quality."""

    def __init__(self):
        self.weight, self.move = np.zeros(N_FEATURES), np.zeros((2, 2))
        self.slope, self.shift, self.empty = 1.0, 0.0, 0.5

    def line_quality(self, bins: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(bins):
            return np.zeros(0)
        return Chains(counts).marginals(self.weight[active_features(bins, counts)].sum(axis=1), self.move)[0]

    def document_score(self, bins: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Quality of each text, 0 to 1; a text without words has that of such texts before any evidence."""
        out = np.full(len(counts), self.empty)
        some = counts > 0
        out[some] = 1 / (1 + np.exp(-(self.slope * self._logit(bins, lengths, counts) + self.shift)))
        return out

    def _logit(self, bins, lengths, counts) -> np.ndarray:
        good = self.line_quality(bins, counts)
        text = np.repeat(np.arange(len(counts)), counts)
        mean = np.bincount(text, good * lengths, len(counts)) / np.maximum(np.bincount(text, lengths, len(counts)), 1e-9)
        mean = np.clip(mean[counts > 0], 1e-4, 1 - 1e-4)
        return np.log(mean / (1 - mean))

    def fit(self, bins: np.ndarray, lengths: np.ndarray, counts: np.ndarray, labels: np.ndarray, steps: int = 80, decay: float = 1e-3) -> LineModel:
        """Gradient ascent (Adam) on the conditional likelihood of the labels; without both labels the start stays."""
        if not len(labels) or labels.min() == labels.max():
            self.empty = float(labels[0]) if len(labels) else 0.5
            self.shift = 0.0 if not len(labels) else 9.0 if labels[0] else -9.0
            return self
        chains, active = Chains(counts), active_features(bins, counts)
        truth = np.repeat(labels, counts).astype(float)
        inner = np.ones(len(truth), dtype=bool)
        inner[chains.starts[counts > 0]] = False
        same = truth[inner]  # all lines of a text have its label
        seen = np.array([[(same == 0).sum(), 0], [0, (same == 1).sum()]], dtype=float)
        theta = np.zeros(N_FEATURES + 4)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for k in range(1, steps + 1):
            good, moves, _ = chains.marginals(theta[:N_FEATURES][active].sum(axis=1), theta[N_FEATURES:].reshape(2, 2))
            slope = np.bincount(active.ravel(), np.repeat(truth - good, active.shape[1]), N_FEATURES)
            gradient = np.concatenate([slope, (seen - moves).ravel()]) / len(truth) - decay * theta
            m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
            theta += 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        self.weight, self.move = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
        x, y = self._logit(bins, lengths, counts), labels[counts > 0].astype(float)
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps of a logistic curve, slightly held to slope 1
            p = 1 / (1 + np.exp(-(a * x + b)))
            w = p * (1 - p) + 1e-9
            g = np.array([((y - p) * x).sum() - (a - 1), (y - p).sum() - 0.01 * b])
            h = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
            step = np.linalg.solve(h, g)
            a, b = a + step[0], b + step[1]
            if np.abs(step).max() < 1e-6:
                break
        self.slope, self.shift = float(max(a, 1e-3)), float(b)
        self.empty = float(labels.mean())
        return self


def _marker(most_lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text"):
            bins, lengths, counts = line_marks([t or "" for t in texts])
            ends = np.cumsum(counts)
            cut = []
            for doc_id, a, b in zip(rows.column("doc_id").to_pylist(), (ends - counts).tolist(), ends.tolist()):
                if b - a > most_lines:  # a stretch of a longer text, from a place drawn by its id
                    a += zlib.crc32(str(doc_id).encode()) % (b - a - most_lines + 1)
                    b = a + most_lines
                cut.append((a, b))
            yield pa.RecordBatch.from_arrays([rows.column("label"), pa.array([bins[a:b].tobytes() for a, b in cut], pa.binary()),
                                              pa.array([lengths[a:b].tobytes() for a, b in cut], pa.binary())], names=["label", "bins", "lengths"])
    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = 6000, most_lines: int = 1000) -> LineModel:
    """A model from at most ``sample`` labelled documents outside the held-out fold, one per doc_id, and at most
    ``most_lines`` lines in a row of each (documented bounds: the driver gets 19 bytes a line)."""
    rows = map_arrow(taught_sample(docs, labels, "quality", sample), _marker(most_lines), "label int, bins binary, lengths binary").collect()
    lengths = [np.frombuffer(r.lengths, float) for r in rows]
    bins = np.frombuffer(b"".join(r.bins for r in rows), np.uint8).reshape(-1, len(EDGES))
    return LineModel().fit(bins, np.concatenate(lengths) if rows else np.zeros(0), np.array([len(x) for x in lengths], dtype=np.int64),
                           np.array([r.label for r in rows], dtype=np.int64))


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text"):
            score = model.value.document_score(*line_marks([t or "" for t in texts]))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("held_out"), pa.array(score)], names=["doc_id", "held_out", "score"])
    return run


def score(docs: DataFrame, model: LineModel) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: better) and predicted (1 from 0.5 on) of every row.

    Null and empty texts, and texts without a word, get the share of good documents among those that
    taught.  One row per input row, repeated rows and null doc_ids included; other columns are dropped.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred weights
    rows = map_arrow(docs.select("doc_id", "text", held_out().alias("held_out")), _scorer(shared), "doc_id long, held_out boolean, score double")
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
