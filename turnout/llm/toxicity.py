"""Toxicity by a chain of linear classifiers.

The chain predicts one labelled category after the other and ends with toxicity itself; with the given labels these are
quality and toxicity.  Every link is a logistic model over the words of a text, their first 4, 5 and 6 letters, and
the probabilities that the earlier links give.  A later link learns from out-of-fold probabilities: each training text
is judged by earlier links that have not seen it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.common import map_arrow, text_slices
from turnout.llm.learning import held_out, taught_sample

CHAIN = ("quality", "toxic")
_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


def feature_hashes(words: set[str]) -> np.ndarray:
    """Sorted 64-bit hashes of the features of a text's words."""
    from xxhash import xxh64_intdigest
    found = {f for w in words for f in features_of(w)}
    return np.unique(np.fromiter((xxh64_intdigest(f) for f in found), np.uint64, len(found)))


class Texts:
    """Training texts as rows of known features (compressed rows)."""

    def __init__(self, rows: list[np.ndarray], known: np.ndarray):
        at = [np.searchsorted(known, r) for r in rows]
        hit = [a[(a < len(known)) & (known[np.minimum(a, len(known) - 1)] == r)] if len(known) else a[:0] for a, r in zip(at, rows)]
        self.n, self.width = len(rows), len(known)
        self.index = np.concatenate(hit) if hit else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(len(rows)), [len(h) for h in hit])

    def dot(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weight[self.index], self.n)

    def back(self, residual: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, residual[self.row], self.width)


def gains(labelled: np.ndarray, seen: np.ndarray, share: float) -> np.ndarray:
    """Gain in log likelihood of features that ``labelled`` of ``seen`` texts with them have, more than the share of all; else 0."""
    expected = max(share, 1e-9) * seen
    return np.where(labelled > expected, labelled * np.log(np.maximum(labelled, 1e-9) / np.maximum(expected, 1e-9)), 0.0)


def fit_link(texts: Texts, extra: np.ndarray, labels: np.ndarray, rows: np.ndarray, steps: int = 200, sparse: float = 5e-4,
             usual: float = 6.0) -> tuple[np.ndarray, np.ndarray]:
    """Logistic weights of features, and of (1, extra columns), on the given rows: accelerated proximal gradient with an
    absolute penalty, so features that tell nothing weigh nothing.  The penalty falls as a feature's gain in log
    likelihood on these rows rises above ``usual``: a word seen in one labelled text has to earn more than one in ten."""
    mask = np.zeros(texts.n)
    mask[rows] = 1 / max(len(rows), 1)
    gain = gains(texts.back((mask > 0) * labels), texts.back((mask > 0).astype(float)), float(labels[rows].mean()) if len(rows) else 0.0)
    penalty = sparse * np.minimum((usual / np.maximum(gain, 1e-9)) ** 1.5, 10)
    dense = np.column_stack([np.ones(texts.n), extra])
    w, d = np.zeros(texts.width), np.zeros(dense.shape[1])
    pw, pd, momentum = w, d, 1.0
    # step by the largest curvature, from a few power iterations
    vw, vd = np.ones(texts.width), np.ones(dense.shape[1])
    curve = 1.0
    for _ in range(15):
        out = (texts.dot(vw) + dense @ vd) * mask
        vw, vd = texts.back(out), dense.T @ out
        curve = max(float(np.sqrt((vw**2).sum() + (vd**2).sum())), 1e-12)
        vw, vd = vw / curve, vd / curve
    rate = 3 / curve
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(texts.dot(pw) + dense @ pd)))
        error = (p - labels) * mask
        nw = pw - rate * texts.back(error)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - rate * penalty, 0)
        nd = pd - rate * (dense.T @ error)
        ahead = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pw, pd = nw + (momentum - 1) / ahead * (nw - w), nd + (momentum - 1) / ahead * (nd - d)
        w, d, momentum = nw, nd, ahead
    return w, d


def chance(texts: Texts, extra: np.ndarray, link: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return 1 / (1 + np.exp(-(texts.dot(link[0]) + np.column_stack([np.ones(texts.n), extra]) @ link[1])))


class ToxicityChain:
    """Known features (hashes) and the links, in order; a link's dense weights are for 1 and the earlier probabilities."""

    def __init__(self, names: list[str], known: np.ndarray, links: list):
        used = np.flatnonzero(np.any([w != 0 for w, _ in links], axis=0)) if len(known) else np.zeros(0, np.int64)
        self.names, self.dense = names, [d for _, d in links]
        self.place = {h: k for k, h in enumerate(known[used].tolist())}
        self.weight = np.array([w[used] for w, _ in links]).reshape(len(links), len(used))
        self.memo: dict = {}

    def features(self, word: str) -> tuple:
        """Places of the word's known features (none for most words)."""
        from xxhash import xxh64_intdigest
        found = tuple(k for f in features_of(word) if (k := self.place.get(xxh64_intdigest(f))) is not None)
        if len(self.memo) > 300_000:
            self.memo.clear()
        self.memo[word] = found
        return found

    def scores(self, text: str | None) -> list[float]:
        words = words_of(text)
        memo = self.memo
        # a prefix shared by two words of a text counts once, as in training
        hit = set().union(*(self.features(w) if (known := memo.get(w)) is None else known for w in words))
        total = self.weight[:, sorted(hit)].sum(axis=1)
        out: list[float] = []
        for sum_, dense in zip(total, self.dense):
            out.append(float(1 / (1 + np.exp(-(sum_ + dense[0] + np.dot(dense[1:], out))))))
        return out


def _best_threshold(chances: np.ndarray, labels: np.ndarray, prior: int = 50, missed: float = 1.5) -> float:
    """Logit at which the fewest texts are judged wrongly, a missed one counting as ``missed`` false ones, in the middle of
    its gap, drawn to 0 as by ``prior`` more toxic texts; 0 without both labels."""
    if labels.min() == labels.max():
        return 0.0
    order = np.argsort(chances, kind="stable")
    p = np.clip(chances[order], 1e-9, 1 - 1e-9)
    x, y = np.log(p / (1 - p)), labels[order]
    wrong = missed * np.cumsum(y)[:-1] + (len(y) - y.sum()) - np.cumsum(1 - y)[:-1]  # toxic below the cut, clean above it
    best = np.flatnonzero(wrong == wrong.min())
    cut = best[np.argmax(x[best + 1] - x[best])]
    return float((x[cut] + x[cut + 1]) / 2 * y.sum() / (y.sum() + prior))


def telling_features(rows: list[np.ndarray], labels: dict[str, np.ndarray], most: int) -> np.ndarray:
    """Sorted hashes of the features that are more common in texts of a label than elsewhere, by the gain in log
    likelihood: for each label the first ``most``."""
    features, index = np.unique(np.concatenate(rows), return_inverse=True)
    text = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    known = []
    for y in labels.values():
        gain = gains(np.bincount(index, y[text].astype(float), len(features)), np.bincount(index, minlength=len(features)), y.mean())
        known.append(features[np.argsort(-gain, kind="stable")[:min(most, int((gain > 0).sum()))]])
    return np.unique(np.concatenate(known))


def outside_chances(texts: Texts, earlier: np.ndarray, y: np.ndarray, fold: np.ndarray, n_folds: int) -> np.ndarray:
    """Each text's probability from a link that learned from the other folds only."""
    out = np.zeros(texts.n)
    for k in range(n_folds):
        away, there = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(there):
            out[there] = chance(texts, earlier, fit_link(texts, earlier, y, away))[there]
    return out


def fit_chain(rows: list[np.ndarray], labels: dict[str, np.ndarray], fold: np.ndarray, n_folds: int = 3, most_features: int = 5000) -> ToxicityChain:
    """The chain over ``labels`` (in order) from training texts' feature hashes; ``fold`` numbers each text's fold."""
    n = len(rows)
    if not n:
        return ToxicityChain(list(labels), np.zeros(0, np.uint64), [(np.zeros(0), np.zeros(1 + k)) for k in range(len(labels))])
    known = telling_features(rows, labels, most_features)
    texts = Texts(rows, known)
    earlier, links = np.zeros((n, 0)), []
    for name in labels:
        y = labels[name].astype(float)
        links.append(fit_link(texts, earlier, y, np.arange(n)))
        earlier = np.column_stack([earlier, outside_chances(texts, earlier, y, fold, n_folds)])
    # the penalty draws chances down: move the last link so that its best out-of-fold threshold is 0.5
    weight, dense = links[-1]
    links[-1] = weight, np.concatenate([dense[:1] - _best_threshold(earlier[:, -1], labels[name]), dense[1:]])
    return ToxicityChain(list(labels), known, links)


def _featuriser(names: list[str], most_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text"):
            hashes = [feature_hashes(words_of(t)) for t in texts]
            # hashes spread features evenly, so the first of a sorted list are a sample of a text's features
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *(rows.column(n) for n in names), pa.array([h[:most_words].tobytes() for h in hashes], pa.binary())],
                names=["doc_id", *names, "features"])
    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = 8000, names: tuple[str, ...] = CHAIN, most_words: int = 4000,
          most_features: int = 5000) -> ToxicityChain:
    """A chain over the label columns ``names`` from at most ``sample`` labelled documents outside the held-out fold, one per
    doc_id.  Documented bounds: ``most_words`` features a document (a sample by hash of longer ones; so the driver gets
    at most 8 bytes x most_words x sample) and ``most_features`` of the model for each label."""
    names = list(names)
    columns = ", ".join(f"{n} int" for n in names)
    rows = map_arrow(taught_sample(docs, labels, names, sample), _featuriser(names, most_words), f"doc_id long, {columns}, features binary")
    rows = rows.withColumn("fold", F.expr("cast(pmod(xxhash64(doc_id, 3), 3) as int)")).toArrow()
    taught = {n: rows.column(n).to_numpy().astype(np.int64) for n in names}
    features = [np.frombuffer(x.as_buffer(), np.uint64) for chunk in rows.column("features").chunks for x in chunk]
    return fit_chain(features, taught, rows.column("fold").to_numpy().astype(np.int64), most_features=most_features)


def _scorer(chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text"):
            scores = np.array([chain.value.scores(t) for t in texts]).reshape(len(texts), -1)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("held_out"), *(pa.array(c) for c in scores.T)],
                                             names=["doc_id", "held_out", *(f"p_{n}" for n in chain.value.names)])
    return run


def score(docs: DataFrame, chain: ToxicityChain) -> DataFrame:
    """doc_id, held_out, p_<category> for every link (the last is p_toxic) and toxic (p_toxic of 0.5 or more) of every row.

    Null and empty texts have no words and get the chain's base rates.  One row per input row, repeated
    rows and null doc_ids included; other columns are dropped.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # at most most_features weights for each label and link
    columns = ", ".join(f"p_{n} double" for n in chain.names)
    rows = map_arrow(docs.select("doc_id", "text", held_out().alias("held_out")), _scorer(shared), f"doc_id long, held_out boolean, {columns}")
    return rows.withColumn("toxic", F.col(f"p_{chain.names[-1]}") >= 0.5)
