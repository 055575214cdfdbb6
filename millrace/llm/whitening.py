"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

X holds the vectors, scaled to integers and centred by their exact means.  The
recurrence alternates two products,

    alpha_k u_k = X v_k - beta_k u_(k-1),        beta_(k+1) v_(k+1) = X' u_k - alpha_k v_k,

and leaves X V = U B with a small upper bidiagonal B, whose singular values are
those of X and whose right singular vectors, times V, are the components.  The
left vectors are as long as the table, so u_k is held as X p_k with a p_k of
the vectors' dimension: tasks form X p and X' (X p) of their chunk in one scan,
and only sums of that dimension come to the driver.  Both sides are
reorthogonalised against all earlier vectors, the left ones by their inner
products p_j . X' u.  Where a side breaks down, the recurrence goes on from a
new direction, so tied deviations and constant dimensions are all found.

It ends once the wanted components have converged to double precision and what
is left of the trace outside V is less than the smallest of them, so that no
direction that the recurrence never met can belong before them; at the latest
after as many scans as the vectors have entries.

Defined cases: rows whose vector is null, has no entries, or holds a null or
non-finite entry take no part; of vectors of several lengths, those of the most
frequent length (the longest of equally frequent ones) take part; a null or
repeated id is a row like any other; equal rows count each; components without
deviation are left out, so constant vectors give no rows; an empty table gives
an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize, table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
CHUNK = 4096
#: What rounding leaves: of a vector's length, of a residual, and of a deviation, against the largest of its kind.
BROKEN, CONVERGED, FLAT = 1e-10, 1e-15, 1e-6

CHUNKS = "dim int, ids array<long>, data binary"
WHITENED = "id long, component int, n long, deviation decimal(38,0), whitened double, explained double"


@dataclass(frozen=True)
class Centre:
    """The exact means of n integer vectors: whole + part / n in every dimension, 0 <= part < n."""

    n: int
    whole: np.ndarray
    part: np.ndarray

    def values(self, data: bytes) -> np.ndarray:
        """Centred rows; the integer difference is exact, so large means cost no digits."""
        return self.whole_values(data).astype(float) - self.part / self.n

    def whole_values(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, np.int64).reshape(-1, len(self.whole)) - self.whole


def chunked(vectors: DataFrame, key: str, column: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """Chunks of up to ``CHUNK`` scaled vectors of one length, as binary integers, with their ids."""
    scaled = F.transform(F.col(column), lambda c: F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(shift).cast("long"))
    usable = (F.col(column).isNotNull() & (F.size(column) > 0)
              & ~F.exists(column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch.column(1).value_lengths())
            flat, offset = batch.column(1).flatten().to_numpy(), np.concatenate(([0], np.cumsum(lengths)))
            for dim in np.unique(lengths).tolist():
                every = np.flatnonzero(lengths == dim)
                for at in range(0, len(every), CHUNK):
                    some = every[at:at + CHUNK]
                    block = flat[(offset[some][:, None] + np.arange(dim)).ravel()]
                    ids = batch.column(0).take(pa.array(some)).to_pylist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([block.tobytes()], pa.binary())],
                        names=["dim", "ids", "data"])

    return vectors.where(usable).select(F.col(key).cast("long").alias("id"), scaled.alias("vector")).mapInArrow(pack, CHUNKS)


def summed(chunks: DataFrame, width: int, kind: str, one: Callable[[bytes], np.ndarray]) -> np.ndarray:
    """The sum over all chunks of ``one(data)``, ``width`` numbers; each task adds up its own before they are shuffled."""
    dtype = {"long": np.int64, "double": np.float64}[kind]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype)
        for batch in batches:
            for data in batch.column(0):
                total += one(data.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], names=["slot", "value"])

    sums = chunks.select("data").mapInArrow(partial, f"slot int, value {kind}").groupBy("slot").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(width, dtype)
    for r in sums:
        out[r["slot"]] = r["value"]
    return out


def centre_of(chunks: DataFrame, dim: int) -> Centre:
    sums = summed(chunks, dim + 1, "long", lambda data: _count_and_sums(data, dim))
    n = int(sums[0])
    return Centre(n, sums[1:] // n, sums[1:] % n)


def _count_and_sums(data: bytes, dim: int) -> np.ndarray:
    rows = np.frombuffer(data, np.int64).reshape(-1, dim)
    return np.concatenate(([len(rows)], rows.sum(0)))


def _length(v: np.ndarray) -> float:
    return float(np.sqrt(v @ v))


class Bidiagonal:
    """The recurrence: right vectors, left vectors as combinations of columns, and B.

    ``product(p)`` is (X' X p, |X p|**2).
    """

    def __init__(self, product: Callable[[np.ndarray], tuple[np.ndarray, float]], dim: int, squares: float, seed: int = 7):
        self.product, self.dim, self.squares = product, dim, squares
        self.rng = np.random.default_rng(seed)
        self.scale = np.sqrt(squares)
        self.right, self.left, self.back = np.zeros((0, dim)), np.zeros((0, dim)), np.zeros((0, dim))
        self.diagonal: list[float] = []
        self.above: list[float] = [0.0]
        self.next = self._fresh()

    def _clear(self, v: np.ndarray) -> np.ndarray:
        """``v`` without its parts along the right vectors; twice is enough."""
        for _ in range(2):
            v = v - self.right.T @ (self.right @ v)
        return v

    def _fresh(self) -> np.ndarray:
        v = self._clear(self.rng.standard_normal(self.dim))
        return v / _length(v)

    def step(self) -> None:
        v, beta = self.next, self.above[-1]
        p = v - beta * self.left[-1] if len(self.left) else v
        back, square = self.product(p)
        overlap = self.left @ back
        p, back, square = p - self.left.T @ overlap, back - self.back.T @ overlap, square - overlap @ overlap
        alpha = float(np.sqrt(max(square, 0.0)))
        self.right = np.vstack([self.right, v])
        if alpha <= BROKEN * self.scale:   # v adds nothing to the columns met so far
            alpha, p, back = 0.0, np.zeros(self.dim), np.zeros(self.dim)
        else:
            p, back = p / alpha, back / alpha
        self.left, self.back = np.vstack([self.left, p]), np.vstack([self.back, back])
        self.diagonal.append(alpha)
        if len(self.right) == self.dim:
            self.above.append(0.0)
            return
        rest = self._clear(back - alpha * v)
        beta = _length(rest)
        if beta <= BROKEN * self.scale:
            beta, self.next = 0.0, self._fresh()
        else:
            self.next = rest / beta
            self.next = self._clear(self.next)
            self.next /= _length(self.next)
        self.above.append(beta)

    def matrix(self) -> np.ndarray:
        return np.diag(self.diagonal) + np.diag(self.above[1:-1], 1)

    def singular(self, wanted: int) -> tuple[np.ndarray, np.ndarray, bool]:
        """The largest singular values, their right vectors as columns, and whether they are final."""
        one, values, two = np.linalg.svd(self.matrix())
        few = min(wanted, len(values))
        open_ = self.above[-1] * np.abs(one[-1, :few])
        outside = self.squares - sum(a * a for a in self.diagonal) - sum(b * b for b in self.above[:-1])
        done = len(self.right) == self.dim or (
            few == wanted and bool((open_ <= CONVERGED * values[0]).all()) and outside < values[few - 1] ** 2 * (1 - 1e-9))
        return values[:few], self.right.T @ two[:few].T, done


def components_of(product: Callable[[np.ndarray], tuple[np.ndarray, float]], dim: int, squares: float, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values in falling order and right singular vectors (columns); those without deviation are left out."""
    if squares <= 0:
        return np.zeros(0), np.zeros((dim, 0))
    work = Bidiagonal(product, dim, squares)
    while True:
        work.step()
        values, vectors, done = work.singular(wanted)
        if done:
            kept = values > FLAT * values[0]
            return values[kept], vectors[:, kept]


def _deviations(centre: Centre, data: bytes) -> list[int]:
    """Sum over dimensions of (n x - S)**2 for every row, exact."""
    rows, n = centre.whole_values(data), centre.n
    most = int(np.abs(rows).max(initial=0)) + 1
    if (most * n) ** 2 * rows.shape[1] < 1 << 63:
        return ((rows * n - centre.part) ** 2).sum(1).tolist()
    part = [int(p) for p in centre.part]
    return [sum((n * x - s) ** 2 for x, s in zip(row, part)) for row in rows.tolist()]


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", wanted: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row for each vector that takes part and each component.

    id, component (from 1, by falling deviation), n, deviation (exact squared
    distance from the mean, times n squared), whitened (the coordinate along
    the component in units of its deviation), explained (the component's share
    of the variance), identity_error (how far the whitened rows' covariance is
    from the identity, at most in any entry).
    """
    chunks = materialize(chunked(vectors, key, column, scale, shift), "whitening-chunks")
    counts = chunks.groupBy("dim").agg(F.sum(F.size("ids")).alias("n"))
    usual = counts.agg(F.max_by("dim", F.struct("n", "dim")).alias("dim")).first()["dim"]
    if usual is None:
        return chunks.where("false").select(F.lit(0).cast("long").alias("id"), *_empty())
    chunks = chunks.where(F.col("dim") == usual)
    centre = centre_of(chunks, usual)

    def squares(data: bytes) -> np.ndarray:
        values = centre.values(data)
        return np.array([np.einsum("ij,ij->", values, values)])

    def product(p: np.ndarray) -> tuple[np.ndarray, float]:
        def one(data: bytes) -> np.ndarray:
            values = centre.values(data)
            u = values @ p
            return np.append(values.T @ u, u @ u)

        sums = summed(chunks, usual + 1, "double", one)
        return sums[:-1], float(sums[-1])

    total = float(summed(chunks, 1, "double", squares)[0])
    values, vectors_ = components_of(product, usual, total, wanted)
    found, n = len(values), centre.n
    turn = vectors_ * (np.sqrt(n) / values)
    explained = values ** 2 / total if total else values

    def moments(data: bytes) -> np.ndarray:
        w = centre.values(data) @ turn
        return np.append((w.T @ w).ravel(), w.sum(0))

    error = 0.0
    if found:
        sums = summed(chunks, found * (found + 1), "double", moments) / n
        mean = sums[found * found:]
        error = float(np.abs(sums[:found * found].reshape(found, found) - np.outer(mean, mean) - np.eye(found)).max())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data in zip(batch.column(0), batch.column(1)):
                raw = data.as_buffer()
                rows = len(ids)
                again = pa.array(np.repeat(np.arange(rows), found))
                yield pa.RecordBatch.from_arrays(
                    [ids.values.take(again), pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), rows)),
                     pa.array(np.full(rows * found, n, np.int64)),
                     pa.array(_deviations(centre, raw), pa.decimal128(38, 0)).take(again),
                     pa.array((centre.values(raw) @ turn).ravel()), pa.array(np.tile(explained, rows))],
                    names=["id", "component", "n", "deviation", "whitened", "explained"])

    return chunks.select("ids", "data").mapInArrow(place, WHITENED).withColumn("identity_error", F.lit(error))


def _empty():
    kinds = {"component": "int", "n": "long", "deviation": "decimal(38,0)", "whitened": "double", "explained": "double", "identity_error": "double"}
    return [F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]


def op11_whiten(spark, sf_dir: str) -> DataFrame:
    """The eight whitened coordinates of every embedding.

    The exact deviation is a decimal; the contract's long holds it up to 9.2e18
    (millions of rows with these entries) and is null beyond.
    """
    rows = whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return rows.select(F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
                       "whitened", "explained", "identity_error")
