"""Embedding whitening by Chebyshev-filtered subspace iteration.

The covariance V of the distinct vectors is never formed: each step is one pass that multiplies a thin block Q by
the centred rows and by their transpose, summed over all partitions. A Chebyshev polynomial of V, built by its
three-term recurrence from such passes, damps the eigenvalues outside the wanted ones; the filtered block is made
orthonormal by QR, and Rayleigh-Ritz gives eigenvalues, vectors and their residuals. This goes on until the residuals of
all wanted components are at rounding level. One more column of every pass runs a Lanczos recurrence, which bounds
the unwanted spectrum from below. The driver holds a few blocks of dimension times columns, whatever the row count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.session import written

#: Entries are held within this after scaling, so that sums of a block are exact.
BOUND = float(1 << 40)
#: Bytes of a block of rows in a task.
BLOCK_BYTES = 2 << 20
#: First degree of the polynomial, and the most.
DEGREE, MOST_DEGREE = 12, 96
#: Residuals, as a share of the largest eigenvalue: aimed at, and accepted once they no longer shrink.
AIMED, ACCEPTED = 2e-14, 1e-10
ROUNDS = 60
#: An eigenvalue below this share of the largest one counts as zero.
ZERO = 1e-13


@dataclass(frozen=True)
class Whitening:
    """A fitted model: ``base + part`` is the mean; columns of ``vectors`` are unit components by falling eigenvalue."""

    n: int
    sums: list[int]
    base: np.ndarray
    part: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    identity_error: float

    @property
    def scale(self) -> np.ndarray:
        """Columns that project and whiten; 0 where a component has no variance."""
        return self.vectors / np.sqrt(np.where(self.live, self.values, np.inf))

    @property
    def live(self) -> np.ndarray:
        return self.values > ZERO * max(self.values.max(initial=0.0), 1e-300)


def integral(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64, shift: int = 1_000_000) -> DataFrame:
    """(id, x): floor(scale * c) + shift of every entry (action: finds the dimension).

    Rows whose vector is null or holds a null or non-finite entry are left out. Vectors shorter than the longest are
    filled up as if their missing entries were 0; scaled entries are held within 2**40 of 0.
    """
    finite = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(F.col(vector_col), lambda c: F.floor(F.greatest(F.lit(-BOUND), F.least(F.lit(BOUND), c.cast("double") * scale))) + F.lit(shift).cast("long"))
    rows = table.filter(F.col(vector_col).isNotNull() & finite)
    longest = rows.agg(F.max(F.size(vector_col))).first()[0] or 0
    filled = F.concat(x, F.array_repeat(F.lit(shift).cast("long"), F.lit(longest) - F.size(vector_col)))
    return rows.select(F.col(id_col).alias("id"), F.when(F.size(vector_col) < longest, filled).otherwise(x).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _matrices(batches, d: int) -> Iterator[np.ndarray]:
    step = max(1, BLOCK_BYTES // (8 * max(d, 1)))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield matrix(batch.column(0).slice(at, step))


def _sums(d: int):
    def run(batches):
        total, n = [0] * d, 0
        for x in _matrices(batches, d):
            n += len(x)
            total = [a + b for a, b in zip(total, x.sum(axis=0).tolist(), strict=True)]
        yield pa.record_batch([pa.array(range(-1, d), pa.int32()), pa.array([str(n), *map(str, total)])], ["j", "s"])

    return run


def _centred(d: int, base: np.ndarray, part: np.ndarray):
    """Blocks of centred rows, as bytes of doubles."""

    def run(batches):
        for x in _matrices(batches, d):
            yield pa.record_batch([pa.array([((x - base) - part).tobytes()], pa.binary())], ["block"])

    return run


def _products(d: int, q: np.ndarray, square: bool):
    """Sums over a partition of X'XQ, or with ``square`` of (XQ)'(XQ); the last cell is the sum of all squares of X."""

    def run(batches):
        total, squares = None, 0.0
        for batch in batches:
            for raw in batch.column(0):
                x = np.frombuffer(raw.as_buffer(), np.float64).reshape(-1, d)
                y = x @ q
                part = y.T @ y if square else x.T @ y
                total, squares = part if total is None else total + part, squares + float(np.einsum("ij,ij->", x, x))
        if total is not None:
            cells = np.append(total.ravel(), squares)
            yield pa.record_batch([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], ["cell", "v"])

    return run


def _summed(blocks: DataFrame, d: int, q: np.ndarray, square: bool = False) -> tuple[np.ndarray, float]:
    shared = blocks.sparkSession.sparkContext.broadcast(q)  # dimension times columns
    parts = blocks.mapInArrow(lambda batches: _products(d, shared.value, square)(batches), "cell int, v double")
    cells = np.array([r.v for r in sorted(parts.groupBy("cell").agg(F.sum("v").alias("v")).collect())])
    shared.destroy()
    return cells[:-1].reshape(-1, q.shape[1]), float(cells[-1])


class _Lanczos:
    """One more column of the passes: a lower bound of the spectrum from a tridiagonal matrix."""

    def __init__(self, d: int, rng):
        v = rng.standard_normal(d)
        self.kept, self.alpha, self.beta, self.low = [v / np.linalg.norm(v)], [], [], 0.0

    @property
    def column(self) -> np.ndarray:
        return self.kept[-1][:, None]

    def step(self, product: np.ndarray) -> None:
        if len(self.alpha) == len(self.kept):  # the space is exhausted
            return
        self.alpha.append(float(self.kept[-1] @ product))
        basis = np.array(self.kept)
        rest = product - basis.T @ (basis @ product)
        rest -= basis.T @ (basis @ rest)
        beta = float(np.linalg.norm(rest))
        t = np.diag(self.alpha) + np.diag(self.beta, 1) + np.diag(self.beta, -1)
        values, vectors = np.linalg.eigh(t)
        self.low = max(0.0, float(values[0]) - beta * abs(float(vectors[-1, 0])))
        if beta > 1e-10 * max(abs(float(values[-1])), 1e-300) and len(self.kept) < min(len(product), 60):
            self.kept.append(rest / beta)
            self.beta.append(beta)


def fit(vectors: DataFrame, components: int = 16, degree: int = DEGREE, seed: int = 7) -> Whitening | None:
    """Fit on each distinct array of ``x`` once (action: the distinct vectors are written, then one pass a step); None without rows."""
    fitted = written(vectors.select("x").distinct())
    d = fitted.agg(F.max(F.size("x"))).first()[0]
    if d is None:
        return None
    totals = fitted.mapInArrow(_sums(d), "j int, s string").groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    n, *sums = [int(r.s) for r in sorted(totals.collect())]
    base = np.array([s // n for s in sums], np.int64)
    part = np.array([s % n / n for s in sums])
    if not d:
        return Whitening(n, sums, base, part, np.zeros((0, 0)), np.zeros(0), 0.0, 0.0, 0.0)
    blocks = written(fitted.mapInArrow(_centred(d, base, part), "block binary"))

    want, k, rng = min(components, d), min(d, components + max(8, components)), np.random.default_rng(seed)
    q = np.eye(d) if k == d else np.linalg.qr(rng.standard_normal((d, k)))[0]
    lanczos = _Lanczos(d, rng)

    def times(z: np.ndarray) -> np.ndarray:
        """V times the columns of z, and the next step of the Lanczos column."""
        out, squares = _summed(blocks, d, np.concatenate([z, lanczos.column], axis=1))
        lanczos.step(out[:, -1] / n)
        times.trace = squares / n
        return out[:, :-1] / n

    y, best, slow = times(q), np.inf, 0
    for _ in range(ROUNDS):
        small = q.T @ y
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, y = q @ turn, y @ turn
        top = max(float(values[0]), 1e-300)
        residual = float(np.linalg.norm(y - q * values, axis=0)[:want].max()) / top
        slow = 0 if residual < best / 2 else slow + 1
        if residual < best:
            best, kept = residual, (values[:want].copy(), q[:, :want].copy())
        if k == d or best <= AIMED or best <= ACCEPTED and slow:
            break
        if slow:
            degree = min(2 * degree, MOST_DEGREE)
        low, high = min(lanczos.low, float(values[-1])), max(float(values[-1]), 1e-300)
        if high - low < 1e-14 * top:
            low = high - 1e-14 * top
        half, centre = (high - low) / 2, (high + low) / 2
        if top - centre > half * (1 + 1e-12):
            first = ratio = half / (top - centre)
            old, q = q, (y - centre * q) * ratio / half
            for _ in range(degree - 1):
                after = 1 / (2 / first - ratio)
                old, q = q, (times(q) - centre * q) * (2 * after / half) - old * (ratio * after)
                ratio = after
        else:  # all Ritz values are one: a plain power step
            q = y
        q = np.linalg.qr(q)[0]
        y = times(q)
    values, q = kept
    if best > ACCEPTED:
        raise RuntimeError(f"components are not certified after {ROUNDS} rounds: residual {best:.1e}")
    model = Whitening(n, sums, base, part, q, np.maximum(values, 0.0), times.trace, best, 0.0)
    error = 0.0
    if model.live.any():
        gram = _summed(blocks, d, model.scale[:, model.live], square=True)[0] / n
        error = float(np.abs(gram - np.eye(len(gram))).max())
    return Whitening(n, sums, base, part, q, model.values, times.trace, best, error)


def _applied(model: Whitening, id_type: pa.DataType):
    def run(batches):
        d, n, scale = len(model.sums), model.n, model.scale
        for batch in batches:
            x = matrix(batch.column(1)) if d else np.zeros((batch.num_rows, 0), np.int64)
            z = ((x - model.base) - model.part) @ scale
            z = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * z.shape[1], pa.array(z.ravel()))
            most = int(np.abs(x).max(initial=0))
            exact = n * most < 1 << 62
            off = n * (x if exact else x.astype(object)) - np.array(model.sums, np.int64 if exact else object)
            most = int(np.abs(off).max(initial=0))
            if d * most**2 < 1 << 62:
                off = off.astype(np.int64)
                deviation = (off * off).sum(axis=1)
            else:
                deviation = [v if v < 1 << 63 else None for v in (off.astype(object) ** 2).sum(axis=1).tolist()]
            yield pa.record_batch([batch.column(0).cast(id_type), pa.array(deviation, pa.int64()), z], ["id", "deviation", "z"])

    return run


def transformed(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation, z): z is the array of whitened coordinates, deviation the exact sum of (n * x - S)^2, null beyond a long."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = vectors.schema["id"].dataType
    return vectors.select("id", "x").mapInArrow(_applied(model, to_arrow_type(kind)), f"id {kind.simpleString()}, deviation long, z array<double>")


def whitened(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16, scale: float = 64, shift: int = 1_000_000) -> DataFrame:
    """One row per kept row and component: ``id_col``, component, n, deviation, whitened, explained, identity_error, residual (action: fits).

    Repeated rows and ids give a row each, null ids stay. A component without variance (fewer distinct vectors than
    dimensions) has explained 0 or next to it and whitened null; identity_error is over the others and 0 if there is none.
    With equal eigenvalues any basis of their space may come. Vectors of no entries give no component and no row; a
    table without usable rows gives none.
    """
    vectors = integral(table, id_col, vector_col, scale, shift)
    model = fit(vectors, components)
    names = "component int, n long, whitened double, explained double, identity_error double, residual double"
    if model is None:
        empty = vectors.filter("false").select(F.col("id").alias(id_col), F.lit(None).cast("long").alias("deviation"))
        return empty.select(id_col, *[F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in names.split(", "))], "deviation").select(id_col, "component", "n", "deviation", "whitened", "explained", "identity_error", "residual")
    shares = F.array(*(F.lit(float(v / model.trace) if model.trace else 0.0) for v in model.values)) if len(model.values) else F.array().cast("array<double>")
    live = F.array(*(F.lit(bool(v)) for v in model.live)) if len(model.values) else F.array().cast("array<boolean>")
    rows = transformed(vectors, model).select("id", "deviation", F.posexplode(F.arrays_zip("z", shares.alias("share"), live.alias("live"))).alias("k", "c"))
    return rows.select(
        F.col("id").alias(id_col),
        (F.col("k") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.when(F.col("c.live"), F.col("c.z")).alias("whitened"),
        F.col("c.share").alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
        F.lit(model.residual).alias("residual"),
    )
