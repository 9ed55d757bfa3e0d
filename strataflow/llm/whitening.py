"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

A step multiplies the centred rows X with a right vector v, which gives a left vector u with one number per row, and X transposed with u, which gives
the next right vector.  Left vectors stay distributed: every one lies in the range of X, so it is kept as the vector w with u = Xw, and a task
recomputes its part of all of them from its rows.  Both products of a step, and the inner products that reorthogonalise u against
all earlier left vectors, take one pass.  Right vectors are as long as an embedding and are reorthogonalised where they are combined.
The singular values and vectors of the small bidiagonal matrix give deviations and components.

Vectors are put on a grid of whole numbers, so their sums are exact, and a row is centred by the whole part of the mean before anything
is multiplied.  Steps end once the wanted components have converged and the variance outside of what the steps have spanned is too small to hide a
larger one, at the latest after as many steps as a vector has entries.  What reaches the driver in a pass is as long as two vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import table
from strataflow.session import settle

COMPONENTS, SCALE, OFFSET = 8, 1024, 100_000
EPS = float(np.finfo(float).eps)
# A direction whose deviation is below this share of the largest is taken for rounding: it has no variance to scale to one.
RANK = 1e-11
# A left vector is measured again if so much of its length had to be taken away.
AGAIN = 1e-8
WHITENED = "vec_id long, deviation decimal(38,0), whitened array<double>"


@dataclass(frozen=True)
class Centre:
    """The exact mean of ``n`` vectors: their sums, the whole part of the mean and what is left of it, below one."""

    n: int
    sums: tuple[int, ...]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([(s % self.n) / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over the entries of (n x - S) squared, exact; null where it has more than 38 digits."""
        near, left = x - self.whole, [s % self.n for s in self.sums]
        span = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if len(left) * span * span < 1 << 63:
            off = near * self.n - np.array(left, dtype=np.int64)
            return pa.array((off * off).sum(axis=1)).cast(pa.decimal128(38, 0))
        exact = [sum((self.n * int(a) - b) ** 2 for a, b in zip(row, left)) for row in near]
        return pa.array([Decimal(v) if v < 10 ** 38 else None for v in exact], pa.decimal128(38, 0))


@dataclass(frozen=True)
class Whitener:
    """What a fit has learnt: unit components as rows, their deviations and the total variance; falling deviations."""

    centre: Centre
    components: np.ndarray
    deviations: np.ndarray
    variance: float

    @property
    def explained(self) -> np.ndarray:
        return self.deviations ** 2 / self.variance

    def projected(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ (self.components / self.deviations[:, None]).T


def on_grid(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, x): floor(scale * entry) + offset of the vectors that take part.

    Null vectors and vectors with null or non-finite entries are dropped, so are entries beyond 2 ** 62 on the grid, which no long holds, and vectors
    that have not the commonest length (the smaller of equally common ones) or no entry.  Rows that repeat an id, or have none, each take part.
    """
    value = F.col(vector).cast("array<double>")
    held = rows.select(F.col(key).cast("long").alias("vec_id"), value.alias("value")).where(
        "value IS NOT NULL AND size(value) > 0").where(F.forall("value", lambda c: F.coalesce(F.abs(c) * scale < 2.0 ** 62, F.lit(False))))
    grid = held.select("vec_id", F.transform("value", lambda c: F.floor(c * scale) + F.lit(offset).cast("long")).alias("x"))
    grid = settle(grid, "grid")
    common = grid.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return grid.where(F.size("x") == (common.length if common else 0))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _totals(grid: DataFrame, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``of_block`` over all blocks of rows: one row per task, summed by Spark by place."""
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _matrices(batches):
            total = of_block(x) if total is None else total + of_block(x)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"place": np.arange(len(total)), "value": total})

    rows = grid.select("x").mapInArrow(added, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(rows))
    for row in rows:
        out[row.place] = row.value
    return out


def centre(grid: DataFrame) -> Centre | None:
    """Number and exact sums of the vectors; none without vectors."""
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for _, x in _matrices(batches):
            small = int(np.abs(x).max()) * len(x) < 1 << 62
            block = [int(s) for s in (x.sum(axis=0) if small else x.astype(object).sum(axis=0))]
            n, total = n + len(x), block if total is None else [a + b for a, b in zip(total, block)]
        if n:
            yield pa.RecordBatch.from_pydict({
                "place": np.arange(len(total)), "n": np.full(len(total), n), "value": pa.array(map(Decimal, total), pa.decimal128(38, 0))})

    rows = grid.select("x").mapInArrow(added, "place long, n long, value decimal(38,0)").groupBy("place").agg(
        F.sum("n").alias("n"), F.sum("value").alias("value")).orderBy("place").collect()
    return Centre(rows[0].n, tuple(int(row.value) for row in rows)) if rows else None


class Bidiagonal:
    """The steps so far: right vectors, the vectors that give the left ones, X transposed times these, and the small matrix."""

    def __init__(self, grid: DataFrame, middle: Centre, seed: int = 0):
        self.grid, self.middle, self.rng = grid, middle, np.random.default_rng(seed)
        self.size = len(middle.sums)
        self.right = np.zeros((0, self.size))
        self.left = np.zeros((0, self.size))  # row i gives left vector i as X times it
        self.back = np.zeros((0, self.size))  # X transposed times left vector i
        self.rows: list[int] = []  # the row of the small matrix that left vector i stands for
        self.matrix = np.zeros((0, 0))
        self.total = float(_totals(grid, lambda x: np.array([(middle.centred(x) ** 2).sum()]))[0])
        self.least = self.size * EPS * np.sqrt(self.total)

    def _across(self, vector: np.ndarray) -> np.ndarray:
        """The vector without its share in the right vectors, twice for full accuracy."""
        for _ in range(2):
            vector = vector - self.right.T @ (self.right @ vector)
        return vector

    def _fresh(self) -> np.ndarray:
        vector = self._across(self.rng.standard_normal(self.size))
        return vector / np.linalg.norm(vector)

    def _products(self, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """For y = Xw: its squared length, its products with the left vectors, and X transposed times y."""
        middle, left = self.middle, self.left

        def of_block(x: np.ndarray) -> np.ndarray:
            near = middle.centred(x)
            y = near @ w
            return np.concatenate([[y @ y], (near @ left.T).T @ y, near.T @ y])

        got = _totals(self.grid, of_block)
        return got[0], got[1:1 + len(left)], got[1 + len(left):]

    def _left(self, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """The length of Xw across all left vectors, and w and X transposed Xw made to fit that."""
        for _ in range(3):
            square, shares, back = self._products(w)
            taken = shares @ shares
            w, back = w - self.left.T @ shares, back - self.back.T @ shares
            if taken <= AGAIN ** 2 * square:
                break
        return float(np.sqrt(max(square - taken, 0.0))), w, back

    def step(self, vector: np.ndarray | None, beta: float) -> tuple[np.ndarray | None, float]:
        """Adds a right vector, reached from the last left one by ``beta``; the next one and its beta, none where the chain ends."""
        vector = self._fresh() if vector is None else vector
        here = len(self.right)
        self.right = np.vstack([self.right, vector])
        self.matrix = np.pad(self.matrix, (0, 1))
        w = vector
        if beta:
            self.matrix[self.rows[-1], here] = beta
            w = vector - beta * self.left[-1]
        alpha, w, back = self._left(w)
        if alpha <= self.least:
            return None, 0.0
        self.matrix[here, here] = alpha
        self.rows.append(here)
        self.left, self.back = np.vstack([self.left, w / alpha]), np.vstack([self.back, back / alpha])
        onward = self._across(self.back[-1])
        beta = float(np.linalg.norm(onward))
        return (onward / beta, beta) if beta > self.least else (None, 0.0)

    def settled(self, wanted: int, beta: float) -> bool:
        """Whether the largest ``wanted`` directions have converged and none as large can be left outside."""
        if len(self.right) < wanted:
            return False
        turned, sizes, _ = np.linalg.svd(self.matrix)
        outside = max(self.total - float((self.matrix ** 2).sum()), 0.0)
        return bool((beta * np.abs(turned[-1, :wanted]) <= 4 * EPS * sizes[0]).all() and outside <= max(sizes[wanted - 1] ** 2 / 2, self.least ** 2))


def fit(grid: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Components and deviations of the vectors of ``on_grid``; none without vectors.

    There are as many components as the vectors vary in, ``components`` at most: vectors that are all equal, or a single one, have none.
    Either sign of a component would do; its largest entry is positive.
    """
    middle = centre(grid)
    if middle is None:
        return None
    chain, vector, beta, wanted = Bidiagonal(grid, middle), None, 0.0, min(components, len(middle.sums))
    while chain.total > 0 and len(chain.right) < chain.size:
        vector, beta = chain.step(vector, beta)
        if chain.settled(wanted, beta):
            break
    if not len(chain.right):
        return Whitener(middle, np.zeros((0, chain.size)), np.zeros(0), 0.0)
    _, sizes, turned = np.linalg.svd(chain.matrix)
    keep = min(wanted, int((sizes > RANK * sizes[0]).sum()))
    found = turned[:keep] @ chain.right
    found /= np.linalg.norm(found, axis=1, keepdims=True)
    found *= np.sign(found[np.arange(keep), np.abs(found).argmax(axis=1)])[:, None]
    return Whitener(middle, found, sizes[:keep] / np.sqrt(middle.n), chain.total / middle.n)


def identity_error(grid: DataFrame, learnt: Whitener) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, in absolute value; 0 without components."""
    k, n = len(learnt.deviations), learnt.centre.n
    if not k:
        return 0.0

    def of_block(x: np.ndarray) -> np.ndarray:
        white = learnt.projected(x)
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    got = _totals(grid, of_block)
    mean = got[:k] / n
    return float(np.abs(got[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())


def whitened(grid: DataFrame, learnt: Whitener) -> DataFrame:
    """(vec_id, deviation, whitened) of every vector: its exact squared deviation from the mean times n squared, and its whitened entries.

    ``deviation`` is null beyond 38 digits.
    """
    def transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _matrices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), learnt.centre.deviations(x), pa.array(list(learnt.projected(x)), pa.list_(pa.float64()))],
                ["vec_id", "deviation", "whitened"])

    return grid.mapInArrow(transformed, WHITENED)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vector and component; a deviation beyond a long is null."""
    grid = on_grid(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    learnt = fit(grid)
    if learnt is None:
        learnt = Whitener(Centre(1, (0,)), np.zeros((0, 1)), np.zeros(0), 1.0)
    error = identity_error(grid, learnt)
    explained = F.array(*[F.lit(float(v)) for v in learnt.explained]).cast("array<double>")
    rows = whitened(grid, learnt).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(learnt.centre.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"), "whitened", F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"))
