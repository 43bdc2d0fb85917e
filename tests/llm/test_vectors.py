"""Operators on vectors and importance resampling, against plain versions."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm import brute
from turnout.llm import embedding_dedup, importance, whitening
from turnout.llm.queries import queries

VECTORS = "vec_id long, embedding array<float>, label int, key string, `a.b` int"


def clustered(seed=3, d=64):
    """Single vectors, groups at cosines about the limit, a large tight group, copies and repeated rows."""
    rng = np.random.default_rng(seed)
    rows = []

    def unit(x):
        return x / np.linalg.norm(x)

    for k in range(400):
        rows.append((k, unit(rng.normal(size=d)), k % 3))
    for g in range(40):  # pairs of every cosine between 0.90 and 0.96
        a = unit(rng.normal(size=d))
        b = rng.normal(size=d)
        b = unit(b - (b @ a) * a)
        c = 0.90 + 0.0015 * g
        rows += [(500 + 2 * g, 3 * a, g % 2), (501 + 2 * g, c * a + math.sqrt(1 - c * c) * b, g % 2)]
    centre = unit(rng.normal(size=d))
    rows += [(1000 + k, unit(centre + 0.02 * rng.normal(size=d)), 1) for k in range(150)]
    rows += [(1200 + k, centre, k % 2) for k in range(30)] + [(1200, centre, 0)] * 2
    return [(i, v.astype(np.float32).tolist(), label) for i, v, label in rows]


def odd_vectors(d=64):
    e = [1.0] * d
    return [(2000, None, 1), (2001, [0.0] * d, 1), (2002, [None, *e[1:]], 1), (2003, [float("nan"), *e[1:]], 1), (2004, [float("inf"), *e[1:]], 1),
            (2005, e, None), (2006, e, 7), (2007, [2.0, 2.0], 7), (2008, [1.0, 1.0], 7), (2009, [], 7), (None, e, 7), (None, [-x for x in e], 7),
            (2010, [-0.0, *e[1:]], 8), (2011, [0.0, *e[1:]], 8), (2012, [3e38, *([0.0] * (d - 1))], 9), (2013, [1e-45, *([0.0] * (d - 1))], 9),
            (2014, [5.0], 9), (2015, [-5.0], 9), (2016, [1.0], 9)]


def near_vectors(rows, least=0.93):
    """[(vec_id, n_links, component_id, kept)] by all pairs."""
    def fine(v, label):
        return label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    places = {}
    for k, (_, v, label) in enumerate(rows):
        if fine(v, label):
            places.setdefault((label, len(v)), []).append(k)
    for at in places.values():
        x = np.array([rows[k][1] for k in at], dtype=float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= least, 1))):
            a, b = at[a], at[b]
            links[a] += 1
            links[b] += 1
            parent[root(a)] = root(b)
    smallest = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            smallest[root(k)] = min(smallest.get(root(k), i), i)
    return [(i, links[k], smallest.get(root(k)), i == smallest.get(root(k))) for k, (i, _, _) in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], VECTORS)


@pytest.mark.parametrize("split", [512, 5])
def test_near_vectors(spark, monkeypatch, split):
    monkeypatch.setattr(embedding_dedup, "SPLIT", split)
    monkeypatch.setattr(embedding_dedup, "HELD", 700 if split == 5 else 1 << 15)
    rows = clustered() + odd_vectors()
    got = sorted(map(tuple, embedding_dedup.near_duplicates(frame(spark, rows)).collect()), key=str)
    want = sorted(near_vectors(rows), key=str)
    assert [g for g, w in zip(got, want) if g != w] == []
    assert len(got) == len(want)


def test_near_vectors_on_empty_tables(spark):
    assert embedding_dedup.near_duplicates(frame(spark, [])).count() == 0
    rows = [(1, None, 1), (2, [1.0], None)]
    assert sorted(map(tuple, embedding_dedup.near_duplicates(frame(spark, rows)).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_rotation_and_probes():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 64))
    h = embedding_dedup.hadamard(x)
    assert np.allclose(h @ h.T, x @ x.T) and np.allclose(embedding_dedup.hadamard(h), x)
    codes = embedding_dedup.bucket_codes(embedding_dedup.unit_rows(x), tables=2, functions=2, probes=5)
    assert codes.shape == (50, 10) and all(len(set(r)) == 10 for r in codes.tolist())
    assert (codes[:, :5] < 128 ** 2).all() and (codes[:, 5:] >= 128 ** 2).all()
    # the first bucket is the nearest vertex: the rotated coordinate of largest size
    signs = np.random.default_rng((11, 64, 0, 0)).choice([-1.0, 1.0], size=(3, 64))
    turned = embedding_dedup.unit_rows(x)
    for s in signs:
        turned = embedding_dedup.hadamard(turned * s)
    at = np.abs(turned).argmax(axis=1)
    assert (codes[:, 0] // 128 == 2 * at + (turned[np.arange(50), at] < 0)).all()


def resampled(rows, items, n_words=1, buckets=10_000, percent=10, least=20, seed=2024):
    """The rows of op12, one document at a time."""
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def runs(text):
        w = word.findall(brute.lower(text or ""))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, n_words + 1) for i in range(len(w) - k + 1)]
    own, wanted = [runs(t) for _, t in rows], [runs(t) for t in items]
    s, t = [0] * buckets, [0] * buckets
    for counts, found in ((s, own), (t, wanted)):
        for _, f in found:
            for b in f:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for (i, text), (n, f) in zip(rows, own):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(order[:percent * len(order) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=str)


def test_importance(spark, docs_of):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    edges = [(900, None), (901, ""), (902, " \n"), (903, "A é\u0085b" * 30), (904, "same words here " * 20), (904, "same words here " * 20),
             (None, "no id but words " * 9), (905, "x" * 30000), (906, "the " * 40000)]
    for docs, bench, options in ((rows, items, {}), (edges + rows[:30], ["", None, "same words"], {"percent": 50}), ([], items, {}), (rows, [], {}),
                                 (edges + rows[:40], items, {"n_words": 3, "buckets": 97, "percent": 100, "least": 1})):
        given = {("min_words" if k == "least" else k): v for k, v in options.items()}
        target = spark.createDataFrame([(t,) for t in bench], "text string")
        assert sorted(map(tuple, importance.resample(docs_of(docs), target, **given).collect()), key=str) == resampled(docs, bench, **options)


def test_composed_payloads():
    words = [b"", b"a", b"longer word", "日本".encode() * 4000, b"z" * 65537]
    pairs = [(a, b) for a in words for b in words]
    got = importance.compose(np.array([zlib.crc32(a) for a, _ in pairs], np.uint32), np.array([zlib.crc32(b) for _, b in pairs], np.uint32),
                             np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_draw_takes_ties_by_id(spark):
    rows = [(i, 30 if i % 7 else 3, 100 - i % 4, i) for i in range(500)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, score long, row_hash long").repartition(7)
    got = {r.doc_id: r["rank"] for r in importance.draw(scored, percent=60).collect()}
    order = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[2], r[0]))
    assert {i: k for i, k in got.items() if k} == {r[0]: k + 1 for k, r in enumerate(order[:60 * len(order) // 100])}


def whitened(rows, wanted=16):
    usable = [(i, v) for i, v, _ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in usable])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    mean = (s // n) + (s % n) / n
    values, vectors = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    deviation = ((n * x - s) ** 2).sum(axis=1)
    return [i for i, _ in usable], n, deviation, (x - mean) @ vectors / np.sqrt(values), values / np.trace((fit - mean).T @ (fit - mean) / n)


@pytest.mark.parametrize("name", ["given", "clustered"])
def test_whitening(spark, name):
    if name == "given":
        rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    else:
        rows = clustered() + [r for r in odd_vectors() if r[1] and len(r[1]) == 64 and not any(c is not None and abs(c) > 1e30 for c in r[1])]
    w, made, model = whitening.whiten(frame(spark, rows))
    assert w.columns == [*frame(spark, []).columns, made] and model.residual < 1e-11 and model.passes > 20
    got = whitening.component_rows(w, made, model).toPandas().sort_values(["vec_id", "component"], na_position="last")
    ids, n, deviation, want, share = whitened(rows)
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0))
    if name == "given":
        y = got.whitened.to_numpy().reshape(-1, 16)
        sign = np.sign((y * want[order]).sum(axis=0))
        assert np.abs(y * sign - want[order]).max() < 1e-8
    assert len(got) == 16 * len(ids) and (got.n == n).all() and got.identity_error.max() < 1e-9
    assert sorted(got[got.component == 3].deviation) == sorted(deviation.tolist())
    assert np.allclose(got.groupby("component").explained.first(), share, rtol=1e-9)


def test_whitening_edges(spark):
    def run(rows, **options):
        w, made, model = whitening.whiten(frame(spark, rows), **options)
        return sorted(map(tuple, whitening.component_rows(w, made, model).collect()), key=str), model
    assert run([])[0] == [] and run([(1, None, 1), (2, [None], 1), (3, [], 1), (4, [float("nan")], 1)])[0] == []
    got, model = run([(1, [1.0, 2.0], 1)])
    assert [(g[0], g[1], g[2], g[3], g[4], g[5]) for g in got] == [(1, 1, 1, 0, None, 0.0), (1, 2, 1, 0, None, 0.0)]
    # two distinct vectors: one component with variance; the commonest length is fitted
    got, model = run([(1, [1.0, 0.0], 1), (2, [-1.0, 0.0], 1), (2, [-1.0, 0.0], 1), (3, [1.0], 1)])
    assert model.n == 2 and [(g[0], g[1], None if g[4] is None else round(abs(g[4]), 12)) for g in got] == [
        (1, 1, 1.0), (1, 2, None), (2, 1, 1.0), (2, 1, 1.0), (2, 2, None), (2, 2, None)]
    got, model = run([(1, [3e38, 0.0], 1), (2, [-3e38, 1.0], 1), (3, [0.5, 0.25], 1)])
    assert model.n == 3 and len(got) == 6 and all(g[3] is None for g in got if g[0] < 3)
    # equal variances in every direction
    axes = [(2 * k + s, [float(4 * (1 - 2 * s)) if j == k else 0.0 for j in range(50)], 1) for k in range(50) for s in (0, 1)]
    assert run(axes)[1].identity_error < 1e-9


def test_new_queries_over_whole_tables(spark):
    found = queries()
    n = spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
    rows = found["op13_embedding_whitening"](spark, SMALL)
    assert rows.count() == 16 * n and dict(rows.dtypes)["component"] == "int"
    assert found["op11_embedding_near_dedup"](spark, SMALL).count() == n
