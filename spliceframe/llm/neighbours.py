"""Approximate nearest neighbours by collision-counting hashing.

Vectors are scaled to length 1 and projected on random lines; each line keeps its vectors sorted by their projection. A
query opens a window around its own projection on every line; virtual rehashing widens all windows by a factor at a time
without building anything anew. A vector that lies in the windows of enough lines has collided often enough: it is
verified with its exact cosine. Windows start at what a few of the block's own
vectors need and stop widening once a query has verified the wanted share of the vectors.

Rows are dealt to tiles of bounded size: a block of vectors, with sorted arrays of its own, meets each block of queries.
The best of each tile are merged with a window over the query. No tile depends on the number of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spliceframe.llm.common import cut, table


class SortedLines:
    """Sorted projections of unit vectors on random lines, one line's after another's in one array."""

    def __init__(self, unit: np.ndarray, lines: int, seed: int):
        self.unit = unit
        self.axes = np.random.default_rng(seed).normal(size=(unit.shape[1], lines)).astype(np.float32)
        at = unit.astype(np.float32) @ self.axes
        self.order = np.argsort(at, axis=0, kind="stable").T.copy()
        self.reach = float(np.abs(at).max()) + 1
        self.shift = np.arange(lines) * (2 * self.reach + 1)  # lines don't overlap
        self.flat = (np.take_along_axis(at, self.order.T, 0).T + self.shift[:, None]).ravel()

    def windows(self, centre: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
        """Where each line's window begins and ends."""
        first = np.arange(len(self.shift)) * len(self.unit)
        lo = self.flat.searchsorted(np.clip(centre - half, -self.reach, self.reach) + self.shift)
        return lo - first, self.flat.searchsorted(np.clip(centre + half, -self.reach, self.reach) + self.shift, "right") - first

    def candidates(self, query: np.ndarray, enough: int, share: float, width: float, growth: float) -> tuple[np.ndarray, float]:
        """Vectors in at least the share of the query's windows, at the first width at which there are enough (or all); the width."""
        n, lines = len(self.unit), len(self.order)
        centre = (query.astype(np.float32) @ self.axes).astype(np.float64)
        need, half = max(1, round(share * lines)), width
        counts = np.zeros(n, np.int64)
        a = b = self.windows(centre, 0.0)[0]
        while True:
            lo, hi = self.windows(centre, half)
            rings = [x for line, i, j, k, m in zip(self.order, lo, a, b, hi, strict=True) for x in (line[i:j], line[k:m])]
            counts += np.bincount(np.concatenate(rings), minlength=n)
            met = np.flatnonzero(counts >= need)
            if len(met) >= enough or (hi - lo == n).all():
                return met, half
            a, b, half = lo, hi, half * growth

    def start(self, enough: int, share: float, width: float, growth: float, pilots: int = 8) -> float:
        """The width to start from: what the easiest of a few of the vectors needs, one step less."""
        found = [self.candidates(self.unit[i], enough, share, width, growth)[1] for i in range(0, len(self.unit), -(-len(self.unit) // pilots))]
        return max(width, min(found) / growth)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of 2 that brings the largest component to between 0.5 and 1: exact, and squares stay in range."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not empty, not zero, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.exists(vector, lambda x: x != 0) & ~bad, F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, lines: int = 128, share: float = 0.6, verify: float = 0.1, least: int = 250, width: float = 0.4, growth: float = 1.1, block: int = 10_000, query_block: int = 5_000, seed: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id_col, score): each query's k nearest others by cosine, nearest first, ties to the smaller id.

    Queries are the rows where is_query holds. verify: the share of a block's vectors, and least their number, that
    collide often enough before windows stop (tables of up to least rows are verified whole). block and query_block bound a tile. Vectors that are null, empty, zero or hold a null or
    non-finite component take no part, nor do rows without an id; vectors of other lengths than the query's are no
    candidates. A query that has k others or fewer gets all of them. Scores are exact, in double precision, of vectors
    scaled by powers of 2, so that no finite vector under- or overflows. What is found does not depend on the session.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = cut(rows.filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v")))
    n, n_q = rows.agg(F.count("*"), F.count_if("q")).first()
    blocks, q_blocks = n // block + 1, n_q // query_block + 1
    tiles = lambda c: F.explode(F.sequence(F.lit(0), F.lit(c - 1)))
    data = rows.select("id", "v", "dim", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("b"), tiles(q_blocks).alias("qb"))  # keys of one type on both sides, or tiles don't meet
    queries = rows.filter("q").select("id", "v", "dim", F.pmod(F.xxhash64("id", "v", F.lit(1)), F.lit(q_blocks)).cast("int").alias("qb"), tiles(blocks).alias("b"))

    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "id": [], "score": []}
        if len(left) and len(right):
            left = left.sort_values("id", kind="stable")
            ids, raw = left["id"].to_numpy(), scaled(np.stack(left["v"].to_numpy()))
            norm = np.sqrt((raw * raw).sum(1))
            index = SortedLines(raw / norm[:, None], lines, seed)
            enough = max(k + 1, least, int(np.ceil(verify * len(ids))))
            first = index.start(enough, share, width, growth)
            for q, v in zip(right["id"].to_numpy(), scaled(np.stack(right["v"].to_numpy())), strict=True):
                size = np.sqrt((v * v).sum())
                met, _ = index.candidates(v / size, enough, share, first, growth)
                met = met[ids[met] != q]
                rough = index.unit[met] @ (v / size)
                if len(met) > k:
                    met = met[rough >= np.partition(rough, -k)[-k] - 1e-9]
                score = (raw[met] * v).sum(1) / (norm[met] * size)  # by row, so equal vectors score alike
                best = np.lexsort((ids[met], -score))[:k]
                out["query_id"].append(np.full(len(best), q))
                out["id"].append(ids[met][best])
                out["score"].append(score[best])
        return pd.DataFrame({c: np.concatenate(x) if x else np.zeros(0) for c, x in out.items()}).astype({"query_id": "int64", "id": "int64", "score": "float64"})

    key = ["b", "qb", "dim"]
    found = data.groupBy(*key).cogroup(queries.groupBy(*key)).applyInPandas(tile, "query_id long, id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def op1(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)
