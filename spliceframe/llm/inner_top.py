"""Exact search for the largest integer inner products by a pivot-distance index.

With M the largest length, a vector gets one more component that brings it to length M, and a query is scaled to length M
with a zero there: then the larger the inner product, the smaller the distance. Pivots are centres of a bounded sample.
Every vector is keyed by its nearest pivot and its distance to it; in that order vectors are cut into chunks of bounded
size, each a part of an annulus around its pivot. A ring that holds too many (copies of one vector, say) is dealt to
chunks by hash, so no chunk grows with the data.

A chunk first answers the queries that lie in it. Their k-th scores and the triangle inequality tell which annuli around
each pivot can hold anything as good; the chunk's queries then go to those chunks only. There, annuli of a few vectors are
visited outwards from the queries' distances, and each query stops where its bound falls below its k-th score. How many
chunks that leaves depends on the data: near neighbours in clusters few, random directions of many dimensions nearly all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spliceframe.llm.common import cut, stored, table

#: Rows that the pivots are the centres of, pivots at most, rings by pivot, vectors of an annulus that is visited at once.
SAMPLE, PIVOTS, RINGS, ANNULUS = 4096, 128, 1024, 1024
_FOUND = "q long, query_id long, id long, row long, score long"


class Space:
    """Vectors of length m after one more component, and the pivots. m is None if lengths are beyond double precision; then nothing is bounded."""

    def __init__(self, sample: np.ndarray, m2: float, n: int, seed: int):
        self.m = math.sqrt(m2) if math.isfinite(m2) else None
        self.kind = np.float32 if m2 < 2**24 else np.float64  # sums of products are exact
        self.pivots = np.zeros((1, sample.shape[1] + 1))
        if self.m and len(sample):
            x = self.lifted(sample)
            rng = np.random.default_rng(seed)
            self.pivots = x[rng.choice(len(x), min(len(x), PIVOTS, max(4, n)), replace=False)]
            for _ in range(8):
                near = self.nearest(x)[0]
                self.pivots = np.stack([x[near == j].mean(0) if (near == j).any() else p for j, p in enumerate(self.pivots)])

    def lifted(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.sqrt(np.maximum(self.m * self.m - (x * x).sum(1), 0))[:, None]], 1)

    def nearest(self, lifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot and the distance to it."""
        near = ((self.pivots * self.pivots).sum(1) / 2 - lifted @ self.pivots.T).argmin(1)
        gap = lifted - self.pivots[near]
        return near, np.sqrt((gap * gap).sum(1))

    def keyed(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.m:
            return np.zeros(len(x), int), np.zeros(len(x))
        return self.nearest(self.lifted(x))

    def from_pivots(self, q: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Distances of the scaled queries to all pivots; 0 for the zero query, which nothing bounds."""
        if not self.m:
            return np.zeros((len(q), 1))
        unit = q * (self.m / np.where(norm > 0, norm, 1))[:, None]
        square = self.m * self.m + (self.pivots * self.pivots).sum(1) - 2 * unit @ self.pivots[:, :-1].T
        return np.sqrt(np.maximum(square, 0))

    def reach(self, norm: np.ndarray, least: np.ndarray) -> np.ndarray:
        """How far from a scaled query a vector of score least may lie. (A millionth of the largest score is let by for rounding.)"""
        if not self.m:
            return np.full(len(norm), np.inf)
        with np.errstate(divide="ignore", invalid="ignore"):
            far = np.sqrt(np.maximum(2 * self.m * self.m * (1 + 1e-6) - 2 * self.m * least / norm, 0))
        return np.where((norm > 0) & np.isfinite(least), far, np.inf)


def scores(q: np.ndarray, x: np.ndarray, q_norm: np.ndarray, x_norm: np.ndarray) -> np.ndarray:
    """Inner products as integers; where double precision isn't exact, by whole numbers, at most a long's ends."""
    with np.errstate(over="ignore", invalid="ignore"):
        s = q @ x.T
        s = np.nan_to_num(s, nan=0, posinf=0, neginf=0).astype(np.float64) if not np.isfinite(s).all() else s
        long = np.flatnonzero(x_norm * q_norm.max(initial=0) >= 2**52)
    out = np.clip(s, -(2.0**62), 2.0**62).astype(np.int64)
    if len(long):
        whole = lambda v: np.array([[int(c) for c in r] for r in v], object).reshape(v.shape)
        out[:, long] = np.clip(whole(q) @ whole(x[long]).T, -(2**63), 2**63 - 1).astype(np.int64)
    return out


class Best:
    """The k best of each query so far: scores downwards, ties to the smaller id, then row."""

    def __init__(self, n: int, k: int, least: np.ndarray | None = None):
        self.k, self.least = k, np.full(n, -np.inf) if least is None else least.copy()
        self.q, self.id, self.row, self.score = (np.zeros(0, np.int64) for _ in range(4))

    def add(self, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, score: np.ndarray) -> None:
        if not len(q):
            return
        q, ids, rows, score = (np.concatenate(x) for x in ((self.q, q), (self.id, ids), (self.row, rows), (self.score, score)))
        order = np.lexsort((rows, ids, ~score, q))
        q = q[order]
        first = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        keep = place < self.k
        self.q, self.id, self.row, self.score = q[keep], ids[order][keep], rows[order][keep], score[order][keep]
        last = place[keep] == self.k - 1
        self.least[self.q[last]] = np.maximum(self.least[self.q[last]], self.score[last])


def visit(space: Space, pivot: int, q: np.ndarray, q_rows: np.ndarray, best: Best, x: np.ndarray, dist: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
    """Adds to best what a chunk, in order of distance, holds for the queries: annuli outwards from the queries' distances."""
    with np.errstate(over="ignore"):
        q_norm, x_norm = (np.sqrt((v.astype(np.float64) ** 2).sum(1)) for v in (q, x))
    d = space.from_pivots(q.astype(np.float64), q_norm)[:, pivot]
    starts = np.arange(0, len(x), ANNULUS)
    middle = np.median(d)
    for i in sorted(starts, key=lambda i: max(dist[i] - middle, middle - dist[min(i + ANNULUS, len(x)) - 1])):
        part = slice(i, min(i + ANNULUS, len(x)))
        reach = space.reach(q_norm, best.least)
        open_ = np.flatnonzero((d - reach <= dist[part.stop - 1]) & (d + reach >= dist[i]))
        for lo in range(0, len(open_), ANNULUS):
            own = open_[lo : lo + ANNULUS]
            s = scores(q[own], x[part], q_norm[own], x_norm[part])
            if len(x[part]) > 2 * best.k and not np.isfinite(best.least[own]).all():  # the k-th best of this part alone
                kth = np.partition(s, -best.k - 1, axis=1)[:, -best.k - 1]  # the query's own row may be among them
                at, to = np.nonzero(s >= np.maximum(best.least[own], kth)[:, None])
            else:
                at, to = np.nonzero(s >= best.least[own][:, None])
            to_row, from_row = rows[part][to], q_rows[own[at]]
            other = to_row != from_row
            at, to = at[other], to[other]
            best.add(own[at], ids[part][to], to_row[other], s[at, to])


def largest(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, size: int = 8192, seed: int = 12, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id_col, score): for each row where is_query holds, the k other rows of the largest inner product of
    floor(scale * component), ties to the smaller id. Exact; a query that has fewer others gets all of them.

    Rows without an id, and vectors that are null or hold a null or non-finite component (also after scaling) take no
    part; rows of one id are rows of their own, each with its own answer. Vectors of other lengths than the query's are no
    candidates. Scores beyond a long are given as its ends, and tie. size: vectors of a chunk, twice that at most. The
    driver gets SAMPLE vectors, from which at most PIVOTS pivots are made.
    """
    spark = vectors.sparkSession
    whole = lambda v: F.transform(F.transform(v, lambda x: x * float(scale)), lambda x: F.when(F.abs(x) < 2**53, F.floor(x).cast("double")).otherwise(x))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), whole(F.col(vector_col).cast("array<double>")).alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_q"))
    rows = cut(rows.filter(F.col("id").isNotNull() & F.coalesce(~bad, F.lit(False))).select(F.monotonically_increasing_id().alias("row"), "id", "v", F.size("v").alias("dim"), "is_q"))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, m2, dim = rows.agg(F.count("*"), F.max(square), F.max("dim")).first()
    if not n:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score long")
    padded = lambda v: np.stack([np.pad(np.asarray(x, np.float64), (0, dim - len(x))) for x in v])
    sample = rows.orderBy(F.xxhash64("row", F.lit(seed)), "row").limit(SAMPLE).select("v").collect()
    space = Space(padded(r["v"] for r in sample), m2, n // size, seed)
    width = 2 * space.m / RINGS if space.m else 1.0

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v, d = b.column("v"), np.asarray(b.column("dim"))
            flat = np.asarray(v.flatten(), dtype=np.float64)
            x = flat.reshape(len(d), dim) if (d == dim).all() else padded(np.split(flat, np.cumsum(d)[:-1]))
            pivot, dist = space.keyed(x)
            blobs = [r.tobytes() for r in x.astype(space.kind)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("row", "id", "dim", "is_q")), pa.array(pivot.astype(np.int32)), pa.array((dist // width).astype(np.int32)), pa.array(dist), pa.array(blobs, pa.binary())], names=["row", "id", "dim", "is_q", "pivot", "ring", "dist", "x"])

    keyed = cut(rows.mapInArrow(key, "row long, id long, dim int, is_q boolean, pivot int, ring int, dist double, x binary"))
    ring = ["dim", "pivot", "ring"]
    count = keyed.groupBy(*ring).agg(F.count("*").alias("n"))  # PIVOTS * RINGS rows for each length of vectors at most
    inner = F.coalesce(F.sum("n").over(W.partitionBy("dim", "pivot").orderBy("ring").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    full = F.col("n") > size
    place = count.select(*ring, F.when(full, -1 - F.col("ring")).otherwise(F.floor(inner / size)).alias("part"), F.when(full, F.ceil(F.col("n") / size)).otherwise(1).cast("long").alias("parts"))
    place = cut(place)
    dealt = keyed.join(F.broadcast(place) if place.count() <= 2 * PIVOTS * RINGS else place, ring).withColumn("deal", F.pmod(F.xxhash64("row"), F.col("parts")))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        """A chunk, its queries, what it holds for them, and how far around each pivot they may find as good."""
        pdf = pdf.sort_values(["dist", "row"], ignore_index=True)
        x = np.frombuffer(b"".join(pdf["x"]), space.kind).reshape(len(pdf), dim)
        at = np.flatnonzero(pdf["is_q"].to_numpy(bool))
        rows, ids, dist, pivot = (pdf[c].to_numpy() for c in ("row", "id", "dist", "pivot"))
        best = Best(len(at), k)
        if len(at):
            visit(space, pivot[0], x[at], rows[at], best, x, dist, ids, rows)
        with np.errstate(over="ignore"):
            norm = np.sqrt((x[at].astype(np.float64) ** 2).sum(1))
        d, far = space.from_pivots(x[at].astype(np.float64), norm), space.reach(norm, best.least)[:, None]
        around = [{"pivot": j, "lo": float(lo), "hi": float(hi)} for j, (lo, hi) in enumerate(zip((d - far).min(0), (d + far).max(0), strict=True))] if len(at) else []
        tell = lambda v, kind: np.ascontiguousarray(v, kind).tobytes()
        held = np.stack([rows[at][best.q], ids[at][best.q], best.id, best.row, best.score]) if len(at) else np.zeros((5, 0))
        return pd.DataFrame({"dim": pdf["dim"][:1], "pivot": pivot[:1], "lo": dist[:1], "hi": dist[-1:], "x": [x.tobytes()], "dist": [tell(dist, np.float64)], "ids": [tell(ids, np.int64)], "rows": [tell(rows, np.int64)], "q": [x[at].tobytes()], "q_ids": [tell(ids[at], np.int64)], "q_rows": [tell(rows[at], np.int64)], "least": [tell(best.least, np.float64)], "around": [around], "held": [tell(held, np.int64)]})

    packed = dealt.groupBy("dim", "pivot", "part", "deal").applyInPandas(pack, "dim int, pivot int, lo double, hi double, x binary, dist binary, ids binary, rows binary, q binary, q_ids binary, q_rows binary, least binary, around array<struct<pivot:int,lo:double,hi:double>>, held binary")
    chunks = stored(packed.withColumn("chunk", F.monotonically_increasing_id()), "chunks")

    # Each chunk's queries, to each chunk that may hold as good.
    sent = chunks.select("dim", F.col("chunk").alias("origin"), F.inline("around")).withColumnsRenamed({"lo": "from", "hi": "to"})
    tiles = sent.join(chunks.select("dim", "pivot", "chunk", "lo", "hi"), ["dim", "pivot"]).filter("lo <= to and hi >= from and chunk != origin").select("origin", "chunk")
    tiles = tiles.join(chunks.select(F.col("chunk").alias("origin"), "q", "q_ids", "q_rows", "least"), "origin").drop("origin")
    tiles = tiles.join(chunks.select("chunk", "pivot", "x", "dist", "ids", "rows"), "chunk").drop("chunk")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _FOUND.split(", ")]
        for b in batches:
            for t in b.to_pylist():
                of = lambda c, kind: np.frombuffer(t[c], kind)  # noqa: B023, E731
                best = Best(len(of("q_rows", np.int64)), k, of("least", np.float64))
                visit(space, t["pivot"], of("q", space.kind).reshape(-1, dim), of("q_rows", np.int64), best, of("x", space.kind).reshape(-1, dim), of("dist", np.float64), of("ids", np.int64), of("rows", np.int64))
                if len(best.q):
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (of("q_rows", np.int64)[best.q], of("q_ids", np.int64)[best.q], best.id, best.row, best.score)], names=names)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _FOUND.split(", ")]
        for b in batches:
            for blob in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in np.frombuffer(blob, np.int64).reshape(5, -1)], names=names)

    found = chunks.select("held").mapInArrow(first, _FOUND).unionByName(tiles.mapInArrow(search, _FOUND))
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.col("score").desc(), "id", "row"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def op12(spark, sf_dir: str) -> DataFrame:
    return largest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)
