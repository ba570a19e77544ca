"""Exact nearest neighbours of all points, and what is read from them: graphs, label purity, shared neighbours.

Every block of rows meets every strip of points in a task of bounded size; a task gives each row's k best of the strip, and
a window the k best of all. The work grows with the square of the points, as the exact answer's does without an index.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spliceframe.operators.keep import kept

#: Rows that are compared with a strip at a time.
_SLICE = 512


def _tile_best(ids: np.ndarray, x: np.ndarray, other_ids: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in ids, place in other_ids, squared distance) of each row's k nearest others, ties to the smaller id.

    A matrix product finds who comes into question, with a margin for its rounding; distances are then taken by component, so that they
    don't depend on what meets in a task.
    """
    rows, others, squares = [], [], []
    norms = (y * y).sum(1)
    for lo in range(0, len(x), _SLICE):
        part = x[lo : lo + _SLICE]
        rough = norms[None, :] - 2 * part @ y.T
        rough[ids[lo : lo + _SLICE, None] == other_ids[None, :]] = np.inf
        kth = np.partition(rough, k - 1, axis=1)[:, k - 1] if rough.shape[1] > k else np.full(len(part), np.inf)
        margin = 1e-12 * x.shape[1] * ((part * part).sum(1) + norms.max(initial=0))
        i, j = np.nonzero((rough <= (kth + margin)[:, None]) & np.isfinite(rough))
        gap = part[i] - y[j]
        d = (gap * gap).sum(1)
        order = np.lexsort((other_ids[j], d, i))
        i, j, d = i[order], j[order], d[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = place < k
        rows.append(i[keep] + lo)
        others.append(j[keep])
        squares.append(d[keep])
    return tuple(np.concatenate(v) for v in (rows, others, squares))


def knn(points: DataFrame, k: int = 30, id_col: str = "vec_id", vector_col: str | Column = "embedding", block: int = 8192, strip: int = 16384) -> DataFrame:
    """(id, rank, other, distance): each point's k nearest others (Euclid), nearest first, ties to the smaller id.

    Ids are unique whole numbers. Points without an id, or whose vector is null, empty or holds a null or non-finite
    component, take no part; points whose vectors differ in length aren't compared. Fewer than k others: all of them. block, strip: rows of a task's sides.
    """
    vector = F.col(vector_col) if isinstance(vector_col, str) else vector_col
    x = points.select(F.col(id_col).cast("long").alias("id"), vector.cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = kept(x.filter(F.col("id").isNotNull() & (F.size("v") > 0) & F.coalesce(~bad, F.lit(False))).withColumn("dim", F.size("v")))
    n = x.count()
    blocks, strips = n // block + 1, n // strip + 1
    dealt = lambda salt, parts: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = x.select("id", "v", "dim", dealt(1, blocks).alias("b"), every(strips).alias("s"))
    right = x.select("id", "v", "dim", every(blocks).alias("b"), dealt(2, strips).alias("s"))

    def tile(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"id": np.zeros(0, np.int64), "other": np.zeros(0, np.int64), "d": np.zeros(0)})
        ids, others = a["id"].to_numpy(), b["id"].to_numpy()
        i, j, d = _tile_best(ids, np.stack(a["v"].to_numpy()), others, np.stack(b["v"].to_numpy()), k)
        return pd.DataFrame({"id": ids[i], "other": others[j], "d": d})

    key = ["b", "s", "dim"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(tile, "id long, other long, d double")
    rank = F.row_number().over(W.partitionBy("id").orderBy("d", "other"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("id", "rank", "other", F.sqrt("d").alias("distance"))


def neighbour_graph(nearest: DataFrame) -> DataFrame:
    """(a, b, distance, mutual): an edge wherever one of two points is among the other's nearest; mutual: each is."""
    pair = nearest.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), "distance")
    return pair.groupBy("a", "b").agg(F.min("distance").alias("distance"), (F.count("*") > 1).alias("mutual"))


def label_purity(points: DataFrame, k: int = 30, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, purity): the share of a point's k nearest points that have its label. A null label is no one's."""
    labels = points.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"))
    near = knn(points, k, id_col, vector_col).join(labels.withColumnRenamed("label", "own"), "id").join(labels.select(F.col("id").alias("other"), "label"), "other")
    return near.groupBy("id").agg(F.avg(F.coalesce(F.col("own") == F.col("label"), F.lit(False)).cast("int")).alias("purity"))


def neighbour_overlap(points: DataFrame, a: Column, b: Column, k: int = 30, id_col: str = "vec_id") -> DataFrame:
    """(id, overlap): the share of a point's k nearest points by vector a that are among its k nearest by b, for every point with an a."""
    x = knn(points, k, id_col, a).select("id", "other")
    y = knn(points, k, id_col, b).select("id", "other", F.lit(1).alias("both"))
    return x.join(y, ["id", "other"], "left").groupBy("id").agg((F.count("both") / k).alias("overlap"))
