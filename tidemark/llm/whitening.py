"""Whitening of embeddings by block Jacobi-Davidson on distributed centred products.

The covariance is never formed.  What the solver asks for is ``V w`` for a few vectors w at a
time: every executor reads its part of the fit list, centres it and adds up ``(x - m) ((x - m) . w)``;
Spark sums the parts by dimension, and d numbers a vector come back, whatever the number of rows.

One outer step (Sleijpen and van der Vorst 1996, in a block): Rayleigh-Ritz in the search
space, residuals from stored products; pairs whose residual is at rounding level are locked;
for the others the correction equation, projected on the complement of the locked vectors and
of the pair's own, is solved roughly by MINRES, all of them in step, so that one pass over the
data serves every pair.  Corrections extend the search space, which starts anew from its
leading Ritz vectors when it is full.  At the end the locked vectors are rotated by
a Rayleigh-Ritz step with fresh products, and the search goes on if a residual has come back.

Numbers: an entry c becomes the whole number ``floor(64 c) + 1000000``.  Count and
sums are exact.  Vectors are packed as the smallest of 16, 32 or 64-bit offsets that holds them,
so equal vectors have equal bytes and ``distinct`` is one aggregate over those.

Rows: left out are vectors that are null, empty, or hold a null, a NaN or an infinity, vectors with
an entry beyond 2**52 / 64, and, in a table of vectors of several lengths, all but the most frequent
length (the shorter on ties).  Every other row, repeated or not, is returned once per component.  Components
without variance (eigenvalue under 1e-12 of the largest) have no whitened values and are not
returned; fewer than two different vectors give an empty result.  ``deviation`` is null where it
exceeds 64 bits.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash, table

SCALE, SHIFT = 64, 1_000_000
#: Vectors in a stored block of the fit list.
BLOCK = 4096
#: Residuals, in parts of the largest eigenvalue, at which a pair is locked; MINRES steps per outer step; largest search space, in blocks.
TOLERANCE, INNER, SPACE = 2e-14, 4, 6
#: Eigenvalues under this part of the largest are no components.
FLAT = 1e-12

Product = Callable[[np.ndarray], np.ndarray]


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat values, offsets of the rows, and which rows have a usable vector (not null, not empty, all entries finite and in range)."""
    offsets = np.append(column.offsets.to_numpy(), 0)[: len(column) + 1].astype(np.int64)
    flat = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    bad = ~(np.abs(flat) <= 2.0**52 / SCALE)  # nulls are NaN here
    wrong = np.append(0, np.cumsum(bad))
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (np.diff(offsets) > 0)
    return flat, offsets, usable & (wrong[offsets[1:]] == wrong[offsets[:-1]])


def _offsets(batch: pa.RecordBatch, at: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the batch's usable vectors of ``dim`` entries, and ``floor(SCALE * c)`` of those."""
    flat, offsets, usable = _lists(batch.column(at))
    rows = np.flatnonzero(usable & (np.diff(offsets) == dim))
    picked = flat[offsets[rows][:, None] + np.arange(dim)] if len(rows) else np.zeros((0, dim))
    return rows, np.floor(SCALE * picked).astype(np.int64)


def dimension(vectors: DataFrame, column: str) -> int:
    """The most frequent length of a usable vector, the shorter on ties; 0 if there is none."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for batch in batches:
            _, offsets, usable = _lists(batch.column(0))
            for size, n in zip(*np.unique(np.diff(offsets)[usable], return_counts=True), strict=True):
                counts[int(size)] = counts.get(int(size), 0) + int(n)
        yield pa.RecordBatch.from_pydict({"dim": pa.array(list(counts), pa.int32()), "n": pa.array(list(counts.values()), pa.int64())})

    sizes = vectors.select(F.col(column).cast("array<double>").alias("v")).mapInArrow(run, "dim int, n long")
    best = sizes.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "dim").first()
    return best.dim if best else 0


def fit_list(vectors: DataFrame, column: str, dim: int) -> DataFrame:
    """Every different vector once, in stored blocks ``width, rows`` of packed offsets from ``SHIFT``."""

    def narrow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = _offsets(batch, 0, dim)
            top = np.abs(x).max(axis=1, initial=0)
            packed, widths = [], []
            for width, low, high in ((2, -1, 1 << 15), (4, (1 << 15) - 1, 1 << 31), (8, (1 << 31) - 1, 1 << 62)):
                part = x[(top > low) & (top < high)].astype(f"<i{width}")
                packed += [row.tobytes() for row in part]
                widths += [width] * len(part)
            yield pa.RecordBatch.from_pydict({"width": pa.array(widths, pa.int32()), "x": pa.array(packed, pa.binary())})

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[bytes]] = {}
        for batch in batches:
            for width, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = waiting.setdefault(width, [])
                rows.append(x)
                if len(rows) == BLOCK:
                    yield pa.RecordBatch.from_pydict({"width": pa.array([width], pa.int32()), "rows": pa.array([b"".join(rows)], pa.binary())})
                    rows.clear()
        for width, rows in waiting.items():
            if rows:
                yield pa.RecordBatch.from_pydict({"width": pa.array([width], pa.int32()), "rows": pa.array([b"".join(rows)], pa.binary())})

    packed = vectors.select(F.col(column).cast("array<double>").alias("v")).mapInArrow(narrow, "width int, x binary")
    return stash(packed.distinct().mapInArrow(block, "width int, rows binary"), "fit-list")


def _blocks(batches: Iterable[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for width, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield np.frombuffer(rows.as_buffer(), f"<i{width}").reshape(-1, dim)


def _rows_of(values: np.ndarray) -> pa.RecordBatch:
    """A matrix as rows ``i, c0, c1, ...``."""
    columns = {"i": pa.array(np.arange(len(values)), pa.int32())}
    return pa.RecordBatch.from_pydict(columns | {f"c{j}": pa.array(values[:, j].copy()) for j in range(values.shape[1])})


def _summed(parts: DataFrame, rows: int, columns: int) -> np.ndarray:
    """Sum of the executors' matrices, by row number; ``rows * columns`` numbers come back."""
    out = np.zeros((rows, columns))
    for row in parts.groupBy("i").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(columns)]).collect():
        out[row.i] = row[1:]
    return out


def _doubles(columns: int) -> str:
    return ", ".join(["i int", *[f"c{j} double" for j in range(columns)]])


def totals(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of fitted vectors and the exact sum of each dimension's whole numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = [0] * dim, 0
        for x in _blocks(batches, dim):
            low, high = x.astype(np.int64) & 0xFFFF, x.astype(np.int64) >> 16  # no block sum leaves 64 bits
            sums = [s + int(a) + (int(b) << 16) for s, a, b in zip(sums, low.sum(axis=0), high.sum(axis=0), strict=True)]
            n += len(x)
        from decimal import Decimal

        sums = [Decimal(v) for v in [*sums, n]]
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(dim + 1), pa.int32()), "s": pa.array(sums, pa.decimal128(38, 0))})

    parts = fit.mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    sums = {r.i: int(r.s) for r in parts}
    n = sums.pop(dim, 0)
    return n, [sums[i] + n * SHIFT for i in range(dim)] if n else [0] * dim


def centred_product(fit: DataFrame, dim: int, mean: np.ndarray, n: int) -> Product:
    """``w -> V w`` for a block of vectors, as one job over the stored blocks; ``mean`` is that of the offsets."""

    def product(w: np.ndarray) -> np.ndarray:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros_like(w)
            for x in _blocks(batches, dim):
                centred = x - mean
                out += centred.T @ (centred @ w)
            yield _rows_of(out)

        return _summed(fit.mapInArrow(run, _doubles(w.shape[1])), dim, w.shape[1]) / n

    return product


def trace(fit: DataFrame, dim: int, mean: np.ndarray, n: int) -> float:
    """Total variance."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _rows_of(np.array([[sum(float(np.square(x - mean).sum()) for x in _blocks(batches, dim))]]))

    return float(_summed(fit.mapInArrow(run, _doubles(1)), 1, 1)[0, 0]) / n


def _minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int) -> np.ndarray:
    """MINRES (Paige and Saunders 1975) from zero for each column by itself, their products taken together."""
    x, v0 = np.zeros_like(b), np.zeros_like(b)
    beta = np.linalg.norm(b, axis=0)
    live = beta > 0
    v = np.divide(b, beta, out=np.zeros_like(b), where=live)
    eta, c0, s0, c1, s1 = beta.copy(), np.ones_like(beta), np.zeros_like(beta), np.ones_like(beta), np.zeros_like(beta)
    d1, d2 = np.zeros_like(b), np.zeros_like(b)
    last = np.zeros_like(beta)
    for _ in range(steps):
        w = apply(v)
        alpha = (v * w).sum(axis=0)
        w = w - alpha * v - last * v0
        beta = np.linalg.norm(w, axis=0)
        delta = c1 * alpha - c0 * s1 * last
        rho3, rho2 = s0 * last, s1 * alpha + c0 * c1 * last
        rho = np.hypot(delta, beta)
        live = live & (rho > 0)
        safe = np.where(live, rho, 1.0)
        c0, s0, c1, s1 = c1, s1, delta / safe, beta / safe
        d1, d2 = d2, np.where(live, (v - rho3 * d1 - rho2 * d2) / safe, 0.0)
        x = x + np.where(live, c1 * eta, 0.0) * d2
        eta = -s1 * eta
        live = live & (beta > 1e-14 * np.abs(alpha))
        v0, v = v, np.divide(w, beta, out=np.zeros_like(w), where=live)
        last = beta
        if not live.any():
            break
    return x


def _extend(basis: np.ndarray, new: np.ndarray, room: int) -> np.ndarray:
    """Up to ``room`` orthonormal directions of ``new`` outside ``basis``."""
    for _ in range(2):
        new = new - basis @ (basis.T @ new)
        norms = np.linalg.norm(new, axis=0)
        new = new[:, norms > 1e-300] / norms[norms > 1e-300]
    if not new.shape[1] or not room:
        return new[:, :0]
    u, s, _ = np.linalg.svd(new, full_matrices=False)
    new = u[:, s > 1e-8 * max(1.0, s[0])][:, :room]
    new = new - basis @ (basis.T @ new)
    return np.linalg.qr(new)[0]


def jacobi_davidson(
    product: Product, dim: int, count: int, tolerance: float = TOLERANCE, inner: int = INNER, space: int = SPACE, most: int = 60
) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric operator, falling, and their unit vectors as columns.

    At most ``most`` outer steps; each costs ``inner + 1`` passes.  Raises if pairs stay unconverged beyond rounding.
    """
    rng = np.random.default_rng(7)
    wide = min(dim, count + 4)
    locked, locked_v = np.zeros((dim, 0)), np.zeros((dim, 0))
    basis = np.linalg.qr(rng.standard_normal((dim, wide)))[0]
    image = product(basis)
    scale, before, stalled = 0.0, np.inf, 0
    for _ in range(most):
        # Rayleigh-Ritz in the complement of the locked vectors
        h = basis.T @ image
        values, s = np.linalg.eigh((h + h.T) / 2)
        values, s = values[::-1], s[:, ::-1]
        ritz, ritz_v = basis @ s, image @ s
        scale = max(scale, abs(values[0]) if len(values) else 0.0, *np.abs((locked * locked_v).sum(axis=0)), 1e-300)
        want = min(count - locked.shape[1], len(values))
        residual = ritz_v[:, :want] - ritz[:, :want] * values[:want]
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0) / scale
        whole = basis.shape[1] + locked.shape[1] == dim
        stalled = stalled + 1 if size.max(initial=0) > before / 2 else 0
        before = size.max(initial=0)
        at_rounding = stalled >= 3 and size.max(initial=0) <= 1e-12
        ok = np.full(want, True) if whole or at_rounding else size <= tolerance
        take = int(np.argmin(ok)) if not ok.all() else want  # leading ones, in order
        locked, locked_v = np.hstack([locked, ritz[:, :take]]), np.hstack([locked_v, ritz_v[:, :take]])
        if locked.shape[1] >= count:
            # rotate the locked vectors by fresh products; go on only if that shows a residual again
            locked = np.linalg.qr(locked)[0]
            locked_v = product(locked)
            h = locked.T @ locked_v
            e, s = np.linalg.eigh((h + h.T) / 2)
            e, s = e[::-1], s[:, ::-1]
            locked, locked_v = locked @ s, locked_v @ s
            size = np.linalg.norm(locked_v - locked * e, axis=0) / scale
            if whole or at_rounding or size.max() <= 4 * tolerance:
                return e, locked
            basis, image = locked, locked_v
            locked, locked_v = np.zeros((dim, 0)), np.zeros((dim, 0))
            continue
        values, ritz, ritz_v = values[take:], ritz[:, take:], ritz_v[:, take:]
        residual, want = residual[:, take:], want - take
        if ritz.shape[1] + want > space * wide:  # start anew from the leading Ritz vectors
            ritz, ritz_v, values = ritz[:, : 2 * wide], ritz_v[:, : 2 * wide], values[: 2 * wide]
        own, theta = ritz[:, :want], values[:want]

        def outside(t: np.ndarray, own=own, locked=locked) -> np.ndarray:
            t = t - locked @ (locked.T @ t)
            return t - own * (own * t).sum(axis=0)

        def shifted(t: np.ndarray, theta=theta, outside=outside) -> np.ndarray:
            t = outside(t)
            return outside(product(t) - t * theta)

        more = _minres(shifted, outside(-residual), inner)
        basis, image = ritz, ritz_v
        new = _extend(np.hstack([locked, basis]), more, dim - locked.shape[1] - basis.shape[1])
        if not new.shape[1]:
            new = _extend(np.hstack([locked, basis]), rng.standard_normal((dim, wide)), dim - locked.shape[1] - basis.shape[1])
        if new.shape[1]:
            basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
    raise ArithmeticError(f"no convergence in {most} steps; largest residual {before:.1e}")


def identity_error(fit: DataFrame, dim: int, mean: np.ndarray, n: int, axes: np.ndarray) -> float:
    """Largest absolute entry of (covariance of the whitened fit list - identity)."""
    k = axes.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((k + 1, k))
        for x in _blocks(batches, dim):
            z = (x - mean) @ axes
            out[:k] += z.T @ z
            out[k] += z.sum(axis=0)
        yield _rows_of(out)

    sums = _summed(fit.mapInArrow(run, _doubles(k)), k + 1, k) / n
    return float(np.abs(sums[:k] - np.outer(sums[k], sums[k]) - np.eye(k)).max(initial=0.0))


def whiten(vectors: DataFrame, id_column: str, column: str, components: int = 16, **solver) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = vectors.sparkSession
    dim = dimension(vectors, column)
    if not dim:
        return spark.createDataFrame([], schema)
    fit = fit_list(vectors, column, dim)
    n, sums = totals(fit, dim)
    mean = np.array([(s - n * SHIFT) / n for s in sums])
    variance = trace(fit, dim, mean, n)
    if n < 2 or not variance:
        return spark.createDataFrame([], schema)
    values, axes = jacobi_davidson(centred_product(fit, dim, mean, n), dim, min(components, dim), **solver)
    keep = values > FLAT * values[0]
    values, axes = values[keep], axes[:, keep]
    axes = axes / np.sqrt(values)
    explained, k = values / variance, len(values)
    error = identity_error(fit, dim, mean, n, axes)
    shifted = [s - n * SHIFT for s in sums]  # n * x - S is the same for offsets from SHIFT

    def deviations(x: np.ndarray) -> list[int | None]:
        far = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, shifted))
        exact = x.astype(object) if far * far * dim >= 1 << 63 else x
        total = np.square(n * exact - np.array(shifted, exact.dtype)).sum(axis=1)
        return [int(t) if t < 1 << 63 else None for t in total.tolist()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _offsets(batch, 1, dim)
            if not len(rows):
                continue
            z = (x - mean) @ axes
            deviation = pa.array(deviations(x), pa.int64())
            each = np.repeat(np.arange(len(rows)), k)
            columns = [
                batch.column(0).take(pa.array(rows[each])),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(len(each), n)),
                deviation.take(pa.array(each)),
                pa.array(z.ravel()),
                pa.array(np.tile(explained, len(rows))),
                pa.array(np.full(len(each), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    read = vectors.select(F.col(id_column).cast("long"), F.col(column).cast("array<double>"))
    return read.mapInArrow(run, schema)


def op12(spark, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of all ``embeddings``."""
    return whiten(table(spark, sf_dir, "embeddings", spread=True), "vec_id", "embedding")
