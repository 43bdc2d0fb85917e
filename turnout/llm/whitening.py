"""Embedding whitening: leading principal components by Chebyshev-filtered subspace iteration.

Entries become integers, the distinct integer vectors are the fit list, and their sums per dimension are exact.
A pass multiplies a block of directions by the covariance without forming it: every task centres its vectors and
adds up Xᵀ(XQ), and Spark adds the small products of the tasks.  A Chebyshev polynomial of the covariance, built up
by its three-term recurrence with one pass a degree, damps the spectrum below the wanted part; QR and a
Rayleigh-Ritz step follow, until the residuals of all wanted components certify them.

The interval to damp runs from a safe lower bound of the spectrum, found by a few block Krylov passes, to the
smallest Ritz value of the block, which holds guard directions beside the wanted ones.  The driver sees blocks
of (dimension x directions) only; the fit list is written once, packed, and reread by every pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.common import fresh, map_arrow, written
from turnout.session import ship_package

SCALE, SHIFT = 64, 1_000_000
LARGEST = 1 << 40  # floor(SCALE * c) is held within +-LARGEST, so that sums of a partition fit a long
PACK = 4096  # vectors in a packed row of the fit list
FLAT = 1e-13  # a variance of less than this share of all is none


@dataclass(frozen=True)
class Whitening:
    """What the fit found; all of it is small (dimension x components)."""

    n: int                  # distinct integer vectors
    sums: tuple[int, ...]   # exact sums per dimension
    values: np.ndarray      # variances of the components, falling
    vectors: np.ndarray     # unit components, one per column
    trace: float
    residual: float         # largest residual of a wanted component, as a share of the largest variance
    identity_error: float   # largest absolute entry of the whitened fit list's covariance less the identity
    passes: int             # over the fit list


def integer_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``df`` without rows whose vector is null, empty or holds null or non-finite entries, and of the lengths left
    only the commonest (ties: the longest); ``x`` is added: floor(64 c) + 1,000,000 per entry, as longs.
    An entry beyond 2^40 / 64 counts as that."""
    name = fresh("_white_", df.columns) + "x"
    fine = f"size(`{vector}`) > 0 AND forall(`{vector}`, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))"
    rows = df.filter(fine)
    lengths = rows.groupBy(F.size(f"`{vector}`").alias("d")).count().collect()  # one row per length
    if not lengths:
        return df.limit(0).withColumn(name, F.lit(None).cast("array<long>"))
    d = max(lengths, key=lambda r: (r["count"], r["d"]))["d"]
    # held before the floor, which of a huge double is no long
    held = f"greatest(least({SCALE} * double(c), double({LARGEST}L)), -double({LARGEST}L))"
    whole = f"transform(`{vector}`, c -> CAST(floor({held}) AS LONG) + {SHIFT}L)"
    return rows.filter(F.size(f"`{vector}`") == d).withColumn(name, F.expr(whole))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _pack(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            blocks = [x[i:i + PACK] for i in range(0, len(x), PACK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(b) for b in blocks], pa.int64()), pa.array([b.sum(axis=0).tolist() for b in blocks], pa.list_(pa.int64())),
                 pa.array([b.tobytes() for b in blocks], pa.binary())], names=["n", "sums", "x"])
    return run


def fit_list(rows: DataFrame, x: str) -> tuple[DataFrame, int, list[int]]:
    """The distinct integer vectors, packed and written, with their number and exact sums per dimension."""
    first = rows.select(F.size(f"`{x}`")).first()
    d = first[0] if first else 0
    distinct = rows.groupBy(F.col(f"`{x}`").alias("x")).agg(F.lit(1).alias("one")).select("x")
    packed = written(map_arrow(distinct, _pack(d), "n long, sums array<long>, x binary"), "fit", compression="zstd")
    n = packed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sums = packed.select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    return packed, n, [int(s) for _, s in sorted(map(tuple, sums))]


def mean_parts(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Whole part and remainder of S/n per dimension, both exact."""
    return np.array([s // n for s in sums], dtype=np.int64), np.array([s % n for s in sums], dtype=np.int64)


def centred(x: np.ndarray, n: int, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x - S/n in doubles: the whole part of the mean goes exactly, as an integer, then the fraction."""
    return (x - whole).astype(float) - rest / n


def multiply(packed: DataFrame, n: int, sums: list[int], q: np.ndarray, gram: bool = False) -> np.ndarray:
    """One pass: the covariance times ``q`` (or, with ``gram``, qᵀ times that, summed from the projected rows)."""
    d = len(sums)
    mean = mean_parts(n, sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for block in batch.column("x"):
                x = centred(np.frombuffer(block.as_buffer(), np.int64).reshape(-1, d), n, *mean)
                y = x @ q
                part = (y if gram else x).T @ y
                out = part if out is None else out + part
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(out.size), pa.int64()), pa.array(out.ravel())], names=["at", "v"])

    product = np.zeros(q.shape[1] * q.shape[1] if gram else q.size)
    for at, v in map_arrow(packed.select("x"), run, "at long, v double").groupBy("at").agg(F.sum("v")).collect():
        product[at] = v
    return product.reshape(q.shape[1] if gram else d, q.shape[1]) / n


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rayleigh-Ritz in the span of orthonormal ``q``: values (falling), vectors, covariance times them, residual norms."""
    h = q.T @ vq
    values, s = np.linalg.eigh((h + h.T) / 2)
    values, s = values[::-1], s[:, ::-1]
    u, vu = q @ s, vq @ s
    return values, u, vu, np.linalg.norm(vu - u * values, axis=0)


def components(packed: DataFrame, n: int, sums: list[int], wanted: int = 16, degree: int = 10, tolerance: float = 1e-12,
               most: int = 60, seed: int = 13) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Variances and unit vectors of the leading components, the largest relative residual, and the passes made.

    Certified when every wanted residual is at most ``tolerance`` of the largest variance, or when residuals below
    1e-9 stop falling, which is where double sums end.  Without that after ``most`` rounds it raises.
    """
    d = len(sums)
    wanted = min(wanted, d)
    width = min(d, 2 * wanted + 4)
    rng = np.random.default_rng(seed)
    passes = 0

    def v(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return multiply(packed, n, sums, q)

    # a few small Krylov blocks give a safe bound below the spectrum
    low = 0.0
    if width < d:
        basis = np.linalg.qr(rng.standard_normal((d, 4)))[0]
        image = block = v(basis)
        for _ in range(min(5, (d - 4) // 4)):
            for _ in range(2):
                block = block - basis @ (basis.T @ block)
            block = np.linalg.qr(block)[0]
            new = v(block)
            basis, image, block = np.hstack([basis, block]), np.hstack([image, new]), new
        ends, _, _, off = _ritz(basis, image)
        low = max(0.0, ends[-1] - off[-1])
    q = np.linalg.qr(rng.standard_normal((d, width)))[0]
    values, u, vu, residual = _ritz(q, v(q))
    last = np.inf
    for _ in range(most):
        top = max(values[0], 0.0)
        worst = float(residual[:wanted].max(initial=0)) / top if top > 0 else 0.0
        if worst <= tolerance or worst <= 1e-9 and worst > last / 2:
            return values[:wanted], u[:, :wanted], worst, passes
        last = worst
        high = values[-1]
        centre, half = (high + low) / 2, max((high - low) / 2, 1e-12 * top)
        # scaled recurrence of the Chebyshev polynomials, 1 at the largest variance
        sigma = first = half / (top - centre)
        before, now = u, (vu - centre * u) * (sigma / half)
        for _ in range(1, degree):
            ahead = 1 / (2 / first - sigma)
            before, now = now, (v(now) - centre * now) * (2 * ahead / half) - sigma * ahead * before
            sigma = ahead
        q = np.linalg.qr(now)[0]
        values, u, vu, residual = _ritz(q, v(q))
    raise RuntimeError(f"components are not certified after {most} rounds: relative residual {worst:.3g}")


def fit(rows: DataFrame, x: str, wanted: int = 16, **options) -> Whitening | None:
    """The whitening of ``rows`` with integer vectors ``x``; None if there is no row."""
    packed, n, sums = fit_list(rows, x)
    if n == 0:
        return None
    d = len(sums)
    values, vectors, residual, passes = components(packed, n, sums, wanted, **options)
    mean = mean_parts(n, sums)

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = [float((centred(np.frombuffer(b.as_buffer(), np.int64).reshape(-1, d), n, *mean) ** 2).sum()) for b in batch.column("x")]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.float64())], names=["s"])

    trace = (map_arrow(packed.select("x"), squares, "s double").agg(F.sum("s")).first()[0] or 0.0) / n
    real = np.flatnonzero(values > FLAT * max(trace, 0.0))
    error = 0.0
    if len(real):
        gram = multiply(packed, n, sums, vectors[:, real] / np.sqrt(values[real]), gram=True)
        error = float(np.abs(gram - np.eye(len(real))).max())
    return Whitening(n, tuple(sums), values, vectors, trace, residual, error, passes + 2)


def whiten(df: DataFrame, vector: str = "embedding", wanted: int = 16, **options) -> tuple[DataFrame, str, Whitening | None]:
    """The rows of ``df`` with usable vectors and a struct column: ``deviation`` and ``whitened`` (one entry per
    component, by falling variance); the column's name and the fit are returned too.

    Rows go whose vector is null, empty, or holds null or non-finite entries, and those of another length than the
    commonest (ties: the longest).  Equal vectors count once in the fit and are all whitened; repeated rows stay.
    ``deviation`` is the sum of (n x - S)^2 over the dimensions, exact, and null where that is no long.  Entries beyond
    2^40 / 64 count as that.  A component without variance (fewer distinct vectors than components) has null entries;
    fewer dimensions than ``wanted`` give as many components.  All columns stay; a table without usable rows is empty.
    """
    rows = integer_vectors(df, vector)
    x = rows.columns[-1]
    model = fit(rows, x, wanted, **options)
    made = fresh("_whitened_", df.columns) + "made"
    if model is None:
        return df.limit(0).withColumn(made, F.lit(None).cast("struct<deviation: long, whitened: array<double>>")), made, None
    n, d = model.n, len(model.sums)
    mean_whole, mean_rest = mean_parts(n, model.sums)
    real = model.values > FLAT * max(model.trace, 0.0)
    project = model.vectors / np.sqrt(np.where(real, model.values, 1.0))

    def whitened(column: pa.Array) -> pa.Array:
        x = _matrix(column, d)
        y = centred(x, n, mean_whole, mean_rest) @ project
        apart = n * (x - mean_whole) - mean_rest
        # the sum of squares wraps where it is no long; its size in doubles tells
        too_large = (centred(x, n, mean_whole, mean_rest) ** 2).sum(axis=1) * float(n) ** 2 >= 2.0 ** 63 * (1 - 1e-9)
        deviation = pa.array((apart * apart).sum(axis=1), mask=too_large)
        flat = pa.array(y.ravel(), mask=np.broadcast_to(~real, y.shape).ravel())
        offsets = pa.array(np.arange(0, y.size + 1, y.shape[1]), pa.int32())
        return pa.StructArray.from_arrays([deviation, pa.ListArray.from_arrays(offsets, flat)], names=["deviation", "whitened"])

    ship_package(df.sparkSession)
    column = F.arrow_udf(whitened, "struct<deviation: long, whitened: array<double>>")
    return rows.withColumn(made, column(F.col(f"`{x}`"))).drop(x), made, model


def component_rows(whitened: DataFrame, made: str, model: Whitening | None) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: one row per row and component."""
    if model is None:
        return whitened.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    share = [float(v) / model.trace if model.trace > 0 else 0.0 for v in np.maximum(model.values, 0.0)]
    rows = whitened.select("vec_id", F.col(f"{made}.deviation").alias("deviation"), F.posexplode(f"{made}.whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       F.element_at(F.array(*map(F.lit, share)), F.col("at") + 1).alias("explained"),
                       F.lit(model.identity_error).alias("identity_error"))
