"""Approximate nearest neighbours by vantage-point trees, one per shard.

Rows are dealt into shards of bounded size and queries into blocks of bounded size; a task builds the tree of one shard and
sends one block of queries through it, so a stated set of queries meets all rows in blocks.  The tree splits a shard by distance from
a vantage point.  For inner products vectors get one more component that makes all their lengths equal; the
nearest by Euclidean distance is then the one with the largest inner product, and the triangle inequality holds.

A branch whose distances to the vantage point lie in [lo, hi] is at least ``max(lo - d, d - hi)`` from a query at distance d.  It is passed over if
``relax`` times that bound exceeds the distance of the query's k-th best so far.  ``relax`` 1 is exact; larger values pass
over more.  Equal vectors of a shard are one point of the tree that carries its k + 1 smallest ids, no more of which
can be among k neighbours, so any number of copies costs one comparison.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.llm.common import table
from strataflow.session import settle

LEAF = 256
VALUES = 1 << 19  # numbers in a shard or block, 4 MB as doubles
RELAX = 2.0


class Tree:
    """Vantage-point tree over the rows of a matrix."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        self.root = self._split(np.arange(len(points)), leaf)

    def _split(self, rows: np.ndarray, leaf: int):
        if len(rows) <= leaf:
            return rows
        vantage = self.points[rows[0]]
        away = np.sqrt(np.maximum(((self.points[rows] - vantage) ** 2).sum(axis=1), 0))
        order = np.argsort(away, kind="stable")
        sides = []
        for part in np.array_split(order, 2):
            sides.append((float(away[part[0]]), float(away[part[-1]]), self._split(rows[part], leaf)))
        return vantage, sides

    def search(self, queries: np.ndarray, k: int, relax: float) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances and rows of the ``k`` nearest found, unordered; missing ones are infinite, row -1."""
        best = np.full((len(queries), k), np.inf)
        found = np.full((len(queries), k), -1, dtype=np.int64)
        own, theirs = (queries ** 2).sum(axis=1), (self.points ** 2).sum(axis=1)

        def visit(node, who: np.ndarray) -> None:
            if not len(who):
                return
            if isinstance(node, np.ndarray):
                near = own[who, None] + theirs[node] - 2 * (queries[who] @ self.points[node].T)
                all_d = np.concatenate([best[who], near], axis=1)
                all_i = np.concatenate([found[who], np.broadcast_to(node, near.shape)], axis=1)
                top = np.argpartition(all_d, k - 1, axis=1)[:, :k]
                best[who], found[who] = np.take_along_axis(all_d, top, 1), np.take_along_axis(all_i, top, 1)
                return
            vantage, sides = node
            d = np.sqrt(np.maximum(((queries[who] - vantage) ** 2).sum(axis=1), 0))
            low = np.stack([np.maximum(np.maximum(lo - d, d - hi), 0) for lo, hi, _ in sides], axis=1)
            first = np.where(low[:, 0] == low[:, 1], 0, low.argmin(axis=1))
            for turn in (0, 1):
                for side in (0, 1):
                    mine = np.flatnonzero((first == side) == (turn == 0))
                    worst = np.sqrt(np.maximum(best[who[mine]].max(axis=1), 0))
                    visit(sides[side][2], who[mine[relax * low[mine, side] <= worst * (1 + 1e-9) + 1e-9]])

        if len(self.points):
            visit(self.root, np.arange(len(queries)))
        return best, found


def _level(vectors: np.ndarray) -> np.ndarray:
    """One more component, so that every row has the length of the longest."""
    squares = (vectors ** 2).sum(axis=1)
    return np.column_stack([vectors, np.sqrt(np.maximum(squares.max() - squares, 0))])


def _search_shard(k: int, relax: float):
    columns = ["query_id", "vec_id", "score"]

    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(candidates) or not len(queries):
            return pd.DataFrame({c: pd.Series(dtype="int64" if c != "score" else "float64") for c in columns})
        candidates = candidates.sort_values("vec_id", kind="stable")
        vectors, inverse = np.unique(np.stack(candidates["vector"]), axis=0, return_inverse=True)
        rows = pd.DataFrame({"point": inverse.ravel(), "vec_id": candidates["vec_id"].to_numpy()}).drop_duplicates()
        # Sorted by id, so these are the smallest ids of each point; a query may have to leave out its own.
        rows = rows.groupby("point", sort=False).head(k + 1)
        asked = np.stack(queries["asked"])
        tree = Tree(_level(vectors))
        # A few more than needed: rounding may swap close ones, and the query's own point may fall away.
        _, found = tree.search(np.column_stack([asked, np.zeros(len(asked))]), min(k + 9, len(vectors)), relax)
        at, point = np.repeat(np.arange(len(asked)), found.shape[1]), found.ravel()
        at, point = at[point >= 0], point[point >= 0]
        pairs = pd.DataFrame({"at": at, "point": point, "score": np.einsum("ij,ij->i", asked[at], vectors[point])})
        pairs = pairs.merge(rows, on="point")
        pairs["query_id"] = queries["query_id"].to_numpy()[pairs["at"]]
        pairs = pairs[pairs["query_id"] != pairs["vec_id"]].sort_values(["at", "score", "vec_id"], ascending=[True, False, True])
        return pairs.groupby("at").head(k)[columns]

    return run


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, dim, vector) without null, empty or zero vectors and those with null or non-finite components."""
    whole = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return whole.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine & F.exists("vector", lambda x: x != 0)) \
        .select("vec_id", F.size("vector").alias("dim"), "vector")


def neighbours(vectors: DataFrame, is_query, k: int = 20, relax: float = RELAX, key: str = "vec_id", vector: str = "embedding",
               values: int = VALUES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every query row, ties to the smaller id.

    Vectors of another length than the query's are no candidates; a row with the query's id is its own.  Rows that repeat
    id and vector count once.  An empty table gives an empty result.
    """
    # Repeated rows are combined before anything else, so shards are even however often an id stands in the table.
    rows = settle(usable(vectors, key, vector).distinct(), "vectors")
    asked = rows.where(is_query(F.col("vec_id")))
    # Sizes per vector length: a handful of numbers that set how many shards and blocks there are.
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.sum(is_query(F.col("vec_id")).cast("long")).alias("asked")).select(
        "dim", F.ceil(F.col("n") * F.col("dim") / float(values)).cast("int").alias("shards"),
        F.ceil(F.col("asked") * F.col("dim") / float(values)).cast("int").alias("blocks"))
    sizes = settle(sizes.where("blocks > 0"), "vector-sizes")
    deal = lambda n, salt: F.pmod(F.xxhash64("vec_id", "vector", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(sizes, "dim").select("dim", deal("shards", 1).alias("shard"), every("blocks").alias("block"), "vec_id", "vector")
    right = asked.join(sizes, "dim").select(
        F.col("dim").alias("q_dim"), every("shards").alias("q_shard"), deal("blocks", 2).alias("q_block"),
        F.col("vec_id").alias("query_id"), F.col("vector").alias("asked"))
    found = left.groupBy("dim", "shard", "block").cogroup(right.groupBy("q_dim", "q_shard", "q_block")).applyInPandas(_search_shard(k, relax), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all vectors."""
    return neighbours(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), lambda i: i % 20 == 0)


def exact(vectors: np.ndarray, ids: np.ndarray, query: int, k: int) -> list[int]:
    """Brute force for one query row, for measuring recall."""
    score = np.array([math.fsum(x) for x in vectors * vectors[query]])
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[query]]
    return [int(ids[i]) for i in order[:k]]
