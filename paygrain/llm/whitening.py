"""Whitening of embeddings by an incremental eigendecomposition.

Every task keeps the spectrum of the vectors it has seen: their number, mean, and the eigenvalues and eigenvectors
of their centred scatter. New vectors are rank-one updates: the eigenvalues are the roots of a secular equation
between the old ones, the eigenvectors follow from them; directions the update does not touch, and equal
eigenvalues, are deflated first. A block of vectors is first brought to as many updates as there are dimensions (the
rows of its triangular factor, which have the same scatter) and one for the distance of the means. Spectra of tasks
are combined in the same way, eight at a time, the eigenvectors of one being updates of the other. The basis found
so is refined by a Rayleigh-Ritz step over all vectors: their exact second moments in that basis, diagonalised.

Sums, counts and deviations are whole numbers and exact. Only spectra, of the size of dimensions squared, meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

#: The contract: an entry c becomes floor(SCALE * c) + SHIFT; components returned.
SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Entries of this size or more would not leave room for sums in whole numbers.
LARGEST = float(1 << 40)
#: Spectra or matrices that one task combines.
TOGETHER = 8
_EPS = np.finfo(float).eps
_ROWS = 1 << 14  # vectors of a block


# --- rank-one updates -------------------------------------------------------------------------


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weights / (poles - t)), one above each pole, each as the nearer pole's index and an offset.

    ``poles`` ascend strictly, ``weights`` are positive. All roots are searched at once: two poles around each are
    kept as they are and the rest is taken as constant (the fixed-weight rational step), within brackets that only shrink.
    """
    k = len(poles)
    own = np.arange(k)
    total = weights.sum()
    width = np.append(np.diff(poles), total)
    # The nearer pole is the one on the side where the function at the middle says the root is.
    middle = poles + width / 2
    with np.errstate(divide="ignore"):
        value = 1 + (weights / (poles[None, :] - middle[:, None])).sum(axis=1)
    left = (value >= 0) | (own == k - 1)
    base = np.where(left, own, np.minimum(own + 1, k - 1))
    delta = poles[None, :] - poles[base][:, None]  # exact distances from each root's own pole
    low = np.where(left, 0.0, -width / 2)
    high = np.where(left, np.where(own == k - 1, width, width / 2), 0.0)
    at = (low + high) / 2
    for _ in range(120):
        gap = delta - at[:, None]
        terms = weights / gap
        value = 1 + terms.sum(axis=1)
        # A root is found where the function is nothing but the rounding of its terms, or the bracket is.
        settled = np.abs(value) <= 4 * _EPS * (1 + np.abs(terms).sum(axis=1))
        settled |= high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high))
        if settled.all():
            break
        low, high = np.where(value < 0, at, low), np.where(value < 0, high, at)
        # Near its own pole the function is c + w / (pole - t): solve that for t, with slope and value as they are.
        mine = gap[own, base]
        slope = (terms / gap).sum(axis=1)
        part = slope * mine * mine
        rest = value - part / mine
        with np.errstate(divide="ignore", invalid="ignore"):
            step = mine + part / rest
        new = at + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        at = np.where(settled, at, np.where(inside, new, (low + high) / 2))
    return base, at


def rank_one_update(values: np.ndarray, basis: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of basis diag(values) basis' + u u'."""
    z = basis.T @ u
    scale = max(abs(values[-1]), float(z @ z))
    if scale == 0:
        return values, basis
    tiny = 8 * _EPS * scale
    values, basis = values.copy(), basis.copy()
    # Equal eigenvalues share a space: mirror it so that the update touches one direction of it.
    first = 0
    for last in range(1, len(values) + 1):
        if last < len(values) and values[last] - values[first] <= tiny:
            continue
        size = np.linalg.norm(z[first:last])
        if last - first > 1 and size > 0:
            mirror = z[first:last].copy()
            turned = -size if mirror[-1] >= 0 else size
            mirror[-1] -= turned
            mirror /= np.linalg.norm(mirror)
            basis[:, first:last] -= 2 * np.outer(basis[:, first:last] @ mirror, mirror)
            z[first:last] = 0
            z[last - 1] = turned
        first = last
    live = np.flatnonzero(np.abs(z) * np.abs(z).max() > tiny)
    if len(live):
        poles, weights = values[live], z[live] ** 2
        base, offset = secular_roots(poles, weights)
        gap = (poles[:, None] - poles[base][None, :]) - offset[None, :]  # pole i minus root j
        # Weights for which the roots found are exact make the eigenvectors orthogonal.
        between = poles[:, None] - poles[None, :]
        np.fill_diagonal(between, 1.0)
        ratio = -gap / between
        np.fill_diagonal(ratio, -np.diagonal(gap))
        fitted = np.sqrt(np.prod(np.abs(ratio), axis=1)) * np.sign(z[live])
        vectors = fitted[:, None] / gap
        vectors /= np.linalg.norm(vectors, axis=0)
        values[live] = poles[base] + offset
        basis[:, live] = basis[:, live] @ vectors
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


@dataclass
class Spectrum:
    """Number, mean and eigendecomposition of the centred scatter of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @staticmethod
    def empty(size: int) -> Spectrum:
        return Spectrum(0, np.zeros(size), np.zeros(size), np.eye(size))

    def _take(self, n: int, mean: np.ndarray, updates: np.ndarray) -> None:
        """Take in vectors given by number, mean, and rows whose scatter about that mean is theirs."""
        for u in updates:
            self.values, self.basis = rank_one_update(self.values, self.basis, u)
        if self.n and n:
            apart = (mean - self.mean) * np.sqrt(self.n * n / (self.n + n))
            self.values, self.basis = rank_one_update(self.values, self.basis, apart)
        self.mean = self.mean + (mean - self.mean) * (n / (self.n + n))
        self.n += n

    def add(self, block: np.ndarray) -> None:
        if len(block):
            mean = block.mean(axis=0)
            centred = block - mean
            updates = centred if len(centred) <= centred.shape[1] else np.linalg.qr(centred, mode="r")
            self._take(len(block), mean, updates)

    def combine(self, other: Spectrum) -> Spectrum:
        big, small = (self, other) if self.n >= other.n else (other, self)
        out = Spectrum(big.n, big.mean, big.values, big.basis)
        kept = small.values > 0
        out._take(small.n, small.mean, (small.basis[:, kept] * np.sqrt(small.values[kept])).T)
        return out

    def pack(self) -> bytes:
        return np.concatenate(([float(self.n)], self.mean, self.values, self.basis.ravel())).tobytes()

    @staticmethod
    def unpack(data: bytes) -> Spectrum:
        flat = np.frombuffer(data)
        size = round((1 + len(flat) - 1) ** 0.5) - 1  # 1 + 2 d + d * d numbers
        return Spectrum(int(flat[0]), flat[1 : size + 1], flat[size + 1 : 2 * size + 1], flat[2 * size + 1 :].reshape(size, size))


# --- passes over the vectors ------------------------------------------------------------------


def usable(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key`` and ``x`` (whole numbers) of the vectors whose entries are all there, finite and below ``LARGEST``."""
    inside = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LARGEST))
    kept = df.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(inside)
    return kept.select(F.col(key).alias("key"), F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT).alias("x"))


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def reduced(df: DataFrame, start: Callable[[], object], take: Callable, pack: Callable, unpack: Callable, merge: Callable) -> bytes | None:
    """Fold the vectors of every part, then the parts' results in groups of eight, until one is left.

    ``take(state, matrix)`` adds vectors, ``merge`` brings two states together. Only the last one comes to the driver.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = start(), False
        for batch in _blocks(batches):
            take(state, _matrix(batch.column(0)))
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([pack(state)], pa.binary())], ["node", "state"]
            )

    def together(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column(0).to_pylist(), group.column(1).to_pylist(), strict=True))
        state = reduce(merge, [unpack(s) for _, s in rows])
        return pa.table({"node": pa.array([rows[0][0] // TOGETHER], pa.int64()), "state": pa.array([pack(state)], pa.binary())})

    parts, _ = written(df.select("x").mapInArrow(fold, "node bigint, state binary"), "whitening-parts")
    last = parts.agg(F.max("node")).first()[0]
    if last is None:
        return None
    while last:
        grouped = parts.groupBy(F.expr(f"node div {TOGETHER}")).applyInArrow(together, "node bigint, state binary")
        parts, _ = written(grouped, "whitening-parts")
        last //= TOGETHER
    return bytes(parts.first()["state"])


def _summed(df: DataFrame, size: int, take: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of ``take(matrix)``, an array of ``size`` numbers."""

    def add(state: np.ndarray, matrix: np.ndarray) -> None:
        state += take(matrix)

    data = reduced(df, lambda: np.zeros(size), add, lambda s: s.tobytes(), np.frombuffer, lambda a, b: a + b)
    return np.zeros(size) if data is None else np.frombuffer(data)


@dataclass(frozen=True)
class Whitener:
    """What a fit keeps: the exact sums, and the components by falling eigenvalue."""

    n: int
    sums: np.ndarray  # whole numbers
    values: np.ndarray  # eigenvalues of the covariance
    basis: np.ndarray  # components as columns
    trace: float

    @property
    def origin(self) -> np.ndarray:
        """The mean, rounded down: distances from it are exact."""
        return self.sums // self.n

    @property
    def rest(self) -> np.ndarray:
        """What the mean has beyond ``origin``, times n."""
        return self.sums - self.n * self.origin

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.origin) - self.rest / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.basis / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int]:
        """sum((n x - S)^2) of every row, exact however large."""
        y = self.n * (x - self.origin) - self.rest
        if len(y) and (y.astype(float) ** 2).sum(axis=1).max() >= 2.0**62:
            return [sum(v * v for v in row) for row in y.tolist()]
        return (y * y).sum(axis=1).tolist()


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """The whitener of ``vectors`` (key, x), all of one length; None if there are none.

    Components whose eigenvalue is nothing but rounding are left out; all equal vectors have none.
    """
    totals = vectors.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(F.sum("c").alias("s"), F.count(F.lit(1)).alias("n"))
    rows = sorted(totals.collect())
    if not rows:
        return None
    n, sums, size = rows[0]["n"], np.array([r["s"] for r in rows], np.int64), len(rows)
    start = Whitener(n, sums, np.ones(size), np.eye(size), 0.0)
    origin = start.origin
    data = reduced(
        vectors, lambda: Spectrum.empty(size), lambda s, x: s.add((x - origin).astype(float)), Spectrum.pack, Spectrum.unpack, Spectrum.combine
    )
    basis = np.linalg.qr(Spectrum.unpack(data).basis)[0]

    def moments(x: np.ndarray) -> np.ndarray:
        turned = start.centred(x) @ basis
        return (turned.T @ turned).ravel()

    ritz = _summed(vectors, size * size, moments).reshape(size, size) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    trace = float(np.trace(ritz))
    real = np.flatnonzero(values > trace * size * 4 * _EPS)[:components]
    found = basis @ turn[:, real]
    found = found / np.linalg.norm(found, axis=0)
    biggest = found[np.abs(found).argmax(axis=0), np.arange(len(real))]
    return Whitener(n, sums, values[real], found * np.where(biggest < 0, -1.0, 1.0), trace)


def identity_error(vectors: DataFrame, w: Whitener) -> float:
    """The largest entry of the whitened vectors' covariance less the identity, by one pass over all of them."""
    k = len(w.values)
    if not k:
        return 0.0

    def moments(x: np.ndarray) -> np.ndarray:
        white = w.whiten(x)
        return np.concatenate((white.sum(axis=0), (white.T @ white).ravel()))

    sums = _summed(vectors, k + k * k, moments) / w.n
    # The vectors are centred already; what their mean has left is rounding, and goes as well.
    return float(np.abs(sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k]) - np.eye(k)).max())


def whiten(df: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``key``, ``component`` (from 1), ``n``, ``deviation`` (decimal, exact), ``whitened``, ``explained``, ``identity_error``.

    One row for every usable vector and component. Left out are vectors that are null or empty, have a null, infinite,
    not-a-number or huge entry (``LARGEST``), or are not of the most frequent length (of equally frequent ones the
    longest). There are at most as many components as dimensions, and none for eigenvalues of zero, so equal vectors
    and an empty table give no rows. Null keys and repeated rows stay and count each time. Other columns, whatever
    their names, are not read. Usable vectors are written once; a vector that very many rows share needs no shuffle.
    """
    kept, _ = written(usable(df, key, vector), "whitening-vectors")
    common = kept.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    kind = df.schema[key].dataType.simpleString()
    schema = (
        f"key {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
    if common is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    vectors = kept.where(F.size("x") == common["size"])
    w = fit(vectors, components)
    error, k = identity_error(vectors, w), len(w.values)
    shared = df.sparkSession.sparkContext.broadcast(w)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in _blocks(batches):
            x = _matrix(batch.column(1))
            rows = len(x)
            each = np.repeat(np.arange(rows), k)
            far = pa.array(list(map(Decimal, fitted.deviations(x))), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                 pa.array(np.full(rows * k, fitted.n)), far.take(pa.array(each)), pa.array(fitted.whiten(x).ravel()),
                 pa.array(np.tile(fitted.values / fitted.trace if k else np.zeros(0), rows)), pa.array(np.full(rows * k, error))],
                ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.select("key", "x").mapInArrow(work, schema).withColumnRenamed("key", key)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding on the first eight components, with the figures of the fit; a deviation beyond a long is null."""
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
