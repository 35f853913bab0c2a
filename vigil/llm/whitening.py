"""Whitening of embeddings, with the covariance found by polarisation.

Every finite entry ``c`` becomes the integer ``floor(1024 * c) + 100000``.  Each
dimension is centred on the integer nearest its mean, and three kinds of exact
sums go over all vectors: the squares of every centred dimension, and the
squares of every sum of two centred dimensions.  What the integer centre leaves
of the mean (less than a half) is taken out of the sums in integers, so these are
n times the exact variances.  Polarisation gives every covariance as half of
``var(a + b) - var(a) - var(b)``; the matrix is rounded to doubles once, at the
end, and goes to ``eigh`` on the driver.

Tasks add in 64-bit integers while the largest entry allows and in Python
integers beyond, and send their sums as 32-bit limbs, so sums are exact at any
size.  The driver receives one sum per dimension pair: its memory follows the
square of the dimension, not the rows.

Defined results: null vectors, empty ones and vectors with null or non-finite
entries have no rows.  All others must have one length; of several, the most
frequent one (of equally frequent ones the longest) counts and the others are
dropped like malformed ones.  Entries are held to +-2**62 before the shift.
Repeated rows and null ids count and return each on their own.  A component whose
eigenvalue is zero to rounding has null ``whitened`` and takes no part in the
identity error; with fewer dimensions than components there are fewer components.
Without vectors the result is empty.  Only the id and the vector are read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
LIMBS = 6
ROWS = 4096
_LIMB_DDL = ", ".join(f"l{k} long" for k in range(LIMBS))
_MOST = 2.0**62


def usable(vectors: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector has entries, all of them finite."""
    v = F.col(f"`{vec_col}`")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.filter(F.coalesce((F.size(v) > 0) & ~odd, F.lit(False)))


def integers(column, dim: int) -> np.ndarray:
    """Rows of a list column as integers."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    c = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return np.clip(np.floor(SCALE * c), -_MOST, _MOST).astype(np.int64) + SHIFT


# ---------------------------------------------------------------- exact sums

def exact(x: np.ndarray, bits: int) -> np.ndarray:
    """``x`` itself if sums of ``ROWS`` values made of it stay within 64 bits, which
    needs its entries under ``2 ** bits``; else as Python integers."""
    return x if not x.size or max(int(x.max()), -int(x.min())) < 1 << bits else x.astype(object)


def _sums(frame: DataFrame, per_rows, start: int) -> dict[int, int]:
    """Exact totals by place of the vectors of integers that ``per_rows`` makes of
    at most ``ROWS`` rows of the first column's vectors at a time."""

    def run(batches):
        total = np.zeros(start, object)
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                total = total + per_rows(b.column(0)[lo:lo + ROWS]).astype(object)
        place = np.flatnonzero(total)
        value = total[place]
        limbs = [(value >> 32 * k) & 0xFFFFFFFF for k in range(LIMBS - 1)] + [value >> 32 * (LIMBS - 1)]
        cols = [pa.array(place, pa.int64()), *[pa.array(x.tolist(), pa.int64()) for x in limbs]]
        yield pa.RecordBatch.from_arrays(cols, names=["place", *[f"l{k}" for k in range(LIMBS)]])

    rows = frame.mapInArrow(run, f"place long, {_LIMB_DDL}").groupBy("place").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)]).collect()
    return {r["place"]: sum(int(r[f"l{k}"]) << 32 * k for k in range(LIMBS)) for r in rows}


def pair_squares(y: np.ndarray) -> np.ndarray:
    """Sums over the rows of ``y_i ** 2`` for every dimension, then of
    ``(y_i + y_j) ** 2`` for every pair i < j."""
    y = exact(y, 24)
    return np.concatenate([(y * y).sum(axis=0), *[((y[:, i:i + 1] + y[:, i + 1:]) ** 2).sum(axis=0) for i in range(y.shape[1] - 1)]])


class Whitening(NamedTuple):
    """Fitted on ``n`` vectors of ``dim`` dimensions; a vector's centred value is ``x - centre - rest / n``."""
    n: int
    dim: int
    centre: list[int]
    rest: list[int]
    covariance: np.ndarray
    values: np.ndarray  # eigenvalues, falling
    basis: np.ndarray  # unit eigenvectors in columns, signs fixed

    def share(self) -> np.ndarray:
        """Of the total variance, per component; zeros without any."""
        trace = float(np.trace(self.covariance))
        return np.maximum(self.values, 0) / trace if trace > 0 else np.zeros(len(self.values))

    def sound(self) -> np.ndarray:
        """Components whose eigenvalue is over rounding."""
        return self.values > self.dim * np.finfo(float).eps * max(float(self.values[0]), 0.0)


def covariance(n: int, rest: list[int], sums: dict[int, int]) -> np.ndarray:
    """Covariance matrix (divisor n) from the sums of :func:`pair_squares`."""
    dim = len(rest)
    var = [n * sums.get(i, 0) - rest[i] ** 2 for i in range(dim)]
    out, place = np.zeros((dim, dim)), dim
    for i in range(dim):
        out[i, i] = var[i] / n**2
        for j in range(i + 1, dim):
            both = n * sums.get(place, 0) - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - var[i] - var[j]) / (2 * n**2)
            place += 1
    return out


def fit(vectors: DataFrame, vec_col: str = "embedding") -> Whitening | None:
    """None without a usable vector."""
    good = usable(vectors, vec_col).select(F.col(f"`{vec_col}`").alias("v"))
    common = good.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return None
    n, dim = common["count"], common["dim"]
    good = good.filter(F.size("v") == dim)
    sums = _sums(good, lambda c: exact(integers(c, dim), 50).sum(axis=0), dim)
    totals = [sums.get(i, 0) for i in range(dim)]
    centre = [(2 * s + n) // (2 * n) for s in totals]
    rest = [s - n * m for s, m in zip(totals, centre)]
    squares = _sums(good, lambda c: pair_squares(_centred(integers(c, dim), centre)), dim * (dim + 1) // 2)
    v = covariance(n, rest, squares)
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    sign = np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(dim)])
    return Whitening(n, dim, centre, rest, v, values, basis * sign)


def _centred(x: np.ndarray, centre: list[int]) -> np.ndarray:
    if max(map(abs, centre)) < 1 << 61 and isinstance(exact(x, 61), np.ndarray) and exact(x, 61).dtype != object:
        return x - np.array(centre, np.int64)
    y = x.astype(object) - np.array(centre, object)
    return y.astype(np.int64) if y.size and max(abs(y.max()), abs(y.min())) < 1 << 62 else y


def deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int]:
    """Exact sums over the dimensions of ``(n * y - rest) ** 2``."""
    most = max((abs(int(y.max())), abs(int(y.min())))) if y.size else 0
    if y.dtype == object or n * (most + 1) >= 1 << 50 or y.shape[1] > 4096:
        d = n * y.astype(object) - np.array(rest, object)
        return [int(v) for v in (d * d).sum(axis=1)]
    d = np.abs(n * y - np.array(rest, np.int64))
    high, low = d >> 25, d & ((1 << 25) - 1)
    parts = [(a * b).sum(axis=1).astype(object) for a, b in ((high, high), (high, low), (low, low))]
    return ((parts[0] << 50) + (parts[1] << 26) + parts[2]).tolist()


def transform(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8) -> DataFrame:
    """Per usable vector of the fitted length: id, ``deviation`` (decimal; null
    from 10**38) and ``whitened`` (array, null entries for void components)."""
    k = min(components, model.dim)
    sound = model.sound()[:k]
    project = np.where(sound, model.basis[:, :k] / np.sqrt(np.where(sound, model.values[:k], 1.0)), 0.0)
    kind = vectors.schema[id_col].dataType
    rest = np.array([r / model.n for r in model.rest])
    void = np.tile(~sound, 1)

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                c = b.column(1)[lo:lo + ROWS]
                if not len(c):
                    continue
                y = _centred(integers(c, model.dim), model.centre)
                w = (y.astype(np.float64) - rest) @ project
                far = [d if d < 10**38 else None for d in deviations(y, model.n, model.rest)]
                flat = pa.array(w.ravel(), mask=np.tile(void, len(w)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(w) * k + 1, k), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:lo + ROWS], pa.array(far, pa.decimal128(38)), lists],
                                                 names=[id_col, "deviation", "whitened"])

    good = usable(vectors, vec_col).filter(F.size(f"`{vec_col}`") == model.dim)
    return good.select(F.col(f"`{id_col}`"), F.col(f"`{vec_col}`")).mapInArrow(
        run, f"`{id_col}` {kind.simpleString()}, deviation decimal(38,0), whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitening, components: int = 8) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the
    identity, from one pass over ``transform``'s result; None without components."""
    k = min(components, model.dim)
    use = np.flatnonzero(model.sound()[:k])
    if not len(use):
        return None

    def run(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = np.nan_to_num(b.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, k))
            first, second = first + w.sum(axis=0), second + w.T @ w
        yield pa.RecordBatch.from_pydict({"place": np.arange(k * k + k), "value": np.concatenate((first, second.ravel()))})

    rows = whitened.select("whitened").mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(k * k + k)
    for r in rows:
        total[r["place"]] = r["value"]
    mean = total[:k] / model.n
    cov = total[k:].reshape(k, k) / model.n - np.outer(mean, mean)
    return float(np.abs(cov - np.eye(k))[np.ix_(use, use)].max())


def components(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = 8) -> DataFrame:
    """Fits, transforms and measures: a row per vector and component with the id,
    component (from 1), n, deviation, whitened, explained, identity_error."""
    model = fit(vectors, vec_col)
    kind = vectors.schema[id_col].dataType.simpleString()
    if model is None:
        ddl = f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], ddl)
    out = transform(vectors, model, id_col, vec_col, most)
    error = identity_error(out, model, most)
    share = F.array(*[F.lit(float(x)) for x in model.share()[:most]])
    return out.select(f"`{id_col}`", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        f"`{id_col}`", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
