"""Whitened embeddings by shifted CholeskyQR.

The *fit list* is each distinct vector of whole numbers once. Its centred rows are the matrix
``A``, which is never held: each pass reads the fit list, applies the triangular factors
found so far to its rows, and adds up the Gram matrix of the result. The Cholesky factor of
that is the next triangular factor; it is shifted while the Gram matrix is far from the
identity, so that columns that depend on each other do not stop it. When the rows have become
orthonormal, ``A = Q R`` with ``R`` the product of all factors, and the singular values and
right vectors of ``R`` are the components.

What passes move: one Gram matrix a task, added up in two steps by groups of its rows. The
driver gets one matrix of ``d * d`` a pass. Sums are exact: each number is added up in halves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import work

SCALE = 256
COMPONENTS = 4
#: Passes end earlier when rows are orthonormal to this measure, three in most cases.
CLOSE, MOST_PASSES = 1e-7, 12
#: Groups that add up Gram rows before the last sum.
SLOTS = 64
#: Rows on which a task works at once.
RUN = 20_000

_EPS = float(np.finfo(float).eps)
_LEAST, _MOST = -(2**63), 2**63 - 1


def whole_numbers(vectors: pa.Array, length: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``floor(256 * c)`` as longs, and which vectors they belong to; others hold null or no number, or are not ``length`` long.

    Without ``length`` all vectors of an array must be equally long.
    """
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    length = int(sizes.max(initial=0)) if length is None else length
    which = np.flatnonzero(sizes == length)
    flat = vectors.take(pa.array(which)).flatten()
    bad = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False).reshape(len(which), length)
    with np.errstate(invalid="ignore", over="ignore"):
        good = (np.isfinite(values) & ~bad.reshape(values.shape)).all(axis=1)
        scaled = np.floor(SCALE * values[good])
    out = np.clip(scaled, -(2.0**62) * 2, 2.0**62).astype(np.int64)
    out[scaled >= 2.0**63] = _MOST
    small = (scaled > 2.0**62) & (scaled < 2.0**63)
    out[small] = scaled[small].astype(np.int64)
    return out, which[good]


@dataclass
class Whitening:
    """The fit: ``n`` distinct vectors with exact ``sums``; rows of ``axes`` are components of eigenvalue ``eigenvalues``."""

    length: int
    n: int
    sums: list[int]
    axes: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    eigenvalues: np.ndarray = field(default_factory=lambda: np.empty(0))
    trace: float = 0.0
    identity_error: float = 0.0
    passes: int = 0

    def __post_init__(self):
        pairs = [divmod(s, self.n) for s in self.sums] if self.n else []
        self.quotient = np.array([q for q, _ in pairs], np.int64)
        self.remainder = np.array([r for _, r in pairs], np.int64)
        if not self.axes.size:
            self.axes = np.empty((0, self.length))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n``; the whole part is subtracted exactly."""
        near = np.abs(x.astype(float) - self.quotient) < 2.0**62
        part = np.where(near, x - np.where(near, self.quotient, x), x.astype(float) - self.quotient)
        return part.astype(float) - self.remainder / max(self.n, 1)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.axes / np.sqrt(self.eigenvalues)[:, None]).T

    def deviation(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sum of ``(n * x - sums) ** 2`` of each row, and whether it fits a long.

        Longs wrap at 2 ** 64, so a sum that fits is exact whatever its terms do.
        """
        with np.errstate(over="ignore"):
            part = (x - self.quotient) * np.int64(self.n) - self.remainder
            exact = (part * part).sum(axis=1)
        return exact, ((self.centred(x) * float(self.n)) ** 2).sum(axis=1) < 2.0**63 * (1 - 1e-9)


def _vectors(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, RUN):
            part = batch.slice(i, RUN)
            x, which = whole_numbers(part["embedding"], length)
            yield part, x, which


def _rows(x: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), max(x.shape[1], 1)).cast(pa.list_(pa.int64()))


def codes(vectors: DataFrame, length: int) -> DataFrame:
    """``x`` of each row of ``vectors (embedding)`` that remains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x, _ in _vectors(batches, length):
            yield pa.RecordBatch.from_arrays([_rows(x)], ["x"])

    return vectors.select("embedding").mapInArrow(run, "x array<long>")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for i in range(0, batch.num_rows, RUN):
            rows = batch["x"].slice(i, RUN)
            if len(rows):
                yield rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def _count(fit: DataFrame, length: int) -> tuple[int, list[int]]:
    """How many vectors ``fit`` has, and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.zeros(length, np.int64), np.zeros(length, np.int64)
        for x in _blocks(batches):
            n += len(x)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            high += (x >> 32).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(length, n)), pa.array(np.arange(length, dtype=np.int32)), pa.array(low), pa.array(high)], ["n", "at", "low", "high"])

    big = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    told = fit.mapInArrow(run, "n long, at int, low long, high long").groupBy("at").agg(F.sum("n").alias("n"), big("low"), big("high")).orderBy("at").collect()
    return (told[0].n if told else 0), [int(r.low) + (int(r.high) << 32) for r in told]


def gram(fit: DataFrame, length: int, rows: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum of ``rows(x).T @ rows(x)`` over the fit list; ``rows`` makes ``width`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, slot = np.zeros((width, width)), 0
        for x in _blocks(batches):
            a = rows(x)
            total += a.T @ a
            slot = int(np.bitwise_xor.reduce(x[0]) & 0x7FFFFFFF) % SLOTS
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(width, slot, np.int32)), pa.array(np.arange(width, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], ["slot", "at", "row"])

    def add(table: pa.Table) -> pa.Table:
        values = table["row"].combine_chunks()
        total = values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), width).sum(axis=0)
        return pa.table({"at": table["at"][:1], "row": pa.array([total], pa.list_(pa.float64()))})

    parts = fit.mapInArrow(run, "slot int, at int, row array<double>").groupBy("slot", "at").applyInArrow(add, "at int, row array<double>")
    told = parts.groupBy("at").applyInArrow(add, "at int, row array<double>").toArrow()
    out = np.zeros((width, width))
    for at, row in zip(told["at"].to_pylist(), told["row"].to_pylist()):
        out[at] = row
    return (out + out.T) / 2


def _factor(g: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper Cholesky factor of ``g``, shifted as far as rounding asks for."""
    d = len(g)
    shift = 11 * (float(n) * d + d * (d + 1)) * _EPS / 2 * float(np.linalg.eigvalsh(g)[-1]) if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(2 * shift, _EPS * float(np.trace(g)))


def _solved(a: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``a`` times the inverse of each factor in turn, by triangular solves."""
    for r in factors:
        q = np.empty_like(a)
        for j in range(len(r)):
            q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        a = q
    return a


def _orthogonalised(fit: DataFrame, model: Whitening) -> tuple[np.ndarray, np.ndarray, int]:
    """``R`` of the centred rows, the dimensions that it is of, and the passes that it took.

    Dimensions without variance are left out. Columns are brought to length 1 first, so
    dimensions of any scale go together.
    """
    first = gram(fit, model.length, model.centred, model.length)
    spread = np.sqrt(np.diag(first))
    used = np.flatnonzero(spread > 0)
    spread = spread[used]
    if not len(used):
        return np.empty((0, 0)), used, 1
    g, factors, whole, k = first[np.ix_(used, used)] / np.outer(spread, spread), [], np.diag(spread), 1
    while True:
        values = np.linalg.eigvalsh(g)
        settled = np.abs(values - 1) < 0.5
        lost = np.linalg.svd(whole / spread.max(), compute_uv=False) < _EPS
        done = np.abs(values - 1).max() < CLOSE or k >= MOST_PASSES or (np.abs(values[settled] - 1).max(initial=0) < CLOSE and 0 < (~settled).sum() <= lost.sum())
        r = _factor(g, model.n, shifted=not done and not settled.all())
        factors.append(r)
        whole = r @ whole
        if done:
            return whole, used, k
        g = gram(fit, model.length, lambda x: _solved(model.centred(x)[:, used] / spread, factors), len(used))
        k += 1


def most_frequent_length(vectors: DataFrame) -> int:
    """Of the vectors of numbers only; the greater of equally frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["embedding"].value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            found = [(int(s), len(whole_numbers(batch["embedding"], int(s))[1])) for s in np.unique(sizes[sizes >= 0])]
            yield pa.RecordBatch.from_arrays([pa.array([c[k] for c in found], pa.int64()) for k in (0, 1)], ["length", "n"])

    told = vectors.select("embedding").mapInArrow(run, "length long, n long").groupBy("length").agg(F.sum("n").alias("n")).where("n > 0")
    best = told.orderBy(F.desc("n"), F.desc("length")).first()
    return int(best.length) if best else 0


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct vectors of ``vectors (embedding)``, of up to ``components`` components.

    Left out are vectors that are null, hold a null or no finite number, or are not as long as
    most. Entries beyond the longs are the least or greatest long. Components have falling
    eigenvalues, and the entry of greatest size is positive. There are as many as have
    variance: none for an empty table, equal vectors or empty ones. Components of equal
    eigenvalues are any orthonormal ones of their space.
    """
    length = most_frequent_length(vectors)
    if not length:
        return Whitening(0, 0, [])
    fit = work.written(codes(vectors, length).distinct(), "whitening-fit")
    n, sums = _count(fit, length)
    model = Whitening(length, n, sums)
    r, used, model.passes = _orthogonalised(fit, model)
    if not len(used):
        return model
    _, sigma, right = np.linalg.svd(r)
    rank = int((sigma > sigma[0] * max(n, len(used)) * _EPS).sum())
    model.eigenvalues = sigma[: min(rank, components)] ** 2 / n
    model.trace = float((sigma**2).sum()) / n
    model.axes = np.zeros((len(model.eigenvalues), length))
    model.axes[:, used] = right[: len(model.eigenvalues)]
    top = np.abs(model.axes).argmax(axis=1)
    model.axes *= np.sign(model.axes[np.arange(len(top)), top])[:, None]
    covariance = gram(fit, length, model.whitened, len(top)) / n
    model.identity_error = float(np.abs(covariance - np.eye(len(top))).max())
    return model


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id, deviation, whitened`` of each row of ``vectors (vec_id, embedding)`` that remains.

    ``deviation`` is the sum of ``(n * x - sums) ** 2``, or null if that fits no long;
    ``whitened`` has a number for each component. Rows are left out as by ``fit_whitening``;
    repeated rows and rows without an id each give a row. Other columns are ignored.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for part, x, which in _vectors(batches, fitted.length):
            exact, fits = fitted.deviation(x)
            numbers = pa.array(list(fitted.whitened(x)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part["vec_id"].take(pa.array(which)), pa.array(exact, mask=~fits), numbers], ["vec_id", "deviation", "whitened"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.where("false" if not model.n else "true").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def op11_shifted_cholesky_qr(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    model = fit_whitening(vectors)
    explained = F.array(*(F.lit(float(e / model.trace)) for e in model.eigenvalues)) if len(model.eigenvalues) else F.array().cast("array<double>")
    rows = whiten(vectors, model).select("vec_id", "deviation", F.posexplode(F.arrays_zip(F.col("whitened"), explained.alias("explained"))).alias("place", "of"))
    return rows.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", F.col("of.whitened").alias("whitened"), F.col("of.explained").alias("explained"), F.lit(model.identity_error).alias("identity_error")
    )
