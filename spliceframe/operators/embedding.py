"""Normalised expression, its variable features and principal components, and nulls of random gene pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def normalised(counts: DataFrame, target: float = 1e4) -> DataFrame:
    """counts with y = log1p of the count per target of its cell. Absent rows stay 0."""
    total = F.sum("count").over(W.partitionBy("cell_id"))
    return counts.withColumn("y", F.log1p(F.col("count") / total * target))


def variable_features(y: DataFrame, n_cells: int, top: int) -> DataFrame:
    """(feature_id, mean, variance) of the top features by variance over all cells, zeros included; ties: the smaller id."""
    x = y.groupBy("feature_id").agg(F.sum("y").alias("_s"), F.sum(F.col("y") * F.col("y")).alias("_q"))
    mean = F.col("_s") / n_cells
    return x.select("feature_id", mean.alias("mean"), (F.col("_q") / n_cells - mean * mean).alias("variance")).orderBy(F.col("variance").desc(), "feature_id").limit(top)


def principal_components(y: DataFrame, features: DataFrame, n_cells: int, k: int, clip: float = 10.0) -> tuple[np.ndarray, np.ndarray]:
    """(variances, axes) of the k first components of features scaled to unit variance and clipped at clip.

    The features' cross products are one matrix (their number is chosen, 2,000 or so): every partition adds up its cells'
    rows, and only these sums reach the driver. Zeros of a feature are one value after scaling, so a cell's row is that
    row plus what its nonzero features change.
    """
    rows = features.orderBy("feature_id").collect()
    place = {r["feature_id"]: i for i, r in enumerate(rows)}
    mean, sd = np.array([r["mean"] for r in rows]), np.sqrt(np.maximum([r["variance"] for r in rows], 1e-12))
    base, n = np.clip(-mean / sd, -clip, clip), len(rows)
    held = y.sparkSession.sparkContext.broadcast((place, mean, sd, base))
    cells = y.join(F.broadcast(features.select("feature_id")), "feature_id", "left_semi").groupBy("cell_id").agg(F.collect_list(F.struct("feature_id", "y")).alias("v"))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, mean, sd, base = held.value
        gram, total, seen = np.zeros((n, n)), np.zeros(n), 0
        for pdf in batches:
            m = np.tile(base, (len(pdf), 1))
            for i, v in enumerate(pdf["v"]):
                at = [place[r["feature_id"]] for r in v]
                m[i, at] = np.minimum((np.array([r["y"] for r in v]) - mean[at]) / sd[at], clip)
            gram, total, seen = gram + m.T @ m, total + m.sum(0), seen + len(m)
        yield pd.DataFrame({"n": [seen], "gram": [gram.tobytes()], "total": [total.tobytes()]})

    gram, total, seen = np.zeros((n, n)), np.zeros(n), 0
    for r in cells.mapInPandas(sums, "n long, gram binary, total binary").toLocalIterator():
        gram, total, seen = gram + np.frombuffer(r["gram"]).reshape(n, n), total + np.frombuffer(r["total"]), seen + r["n"]
    left = n_cells - seen  # cells without any of the features
    gram, total = gram + left * np.outer(base, base), total + left * base
    values, axes = np.linalg.eigh(gram / n_cells - np.outer(total, total) / n_cells**2)
    return values[::-1][:k], axes[:, ::-1][:, :k]


def component_scores(y: DataFrame, features: DataFrame, axes: np.ndarray, clip: float = 10.0) -> DataFrame:
    """(cell_id, scores): the places of cells on axes of principal_components(), from its features. Cells without any of the features have no row:
    all of them lie where zeros do."""
    rows = features.orderBy("feature_id").collect()
    place = {r["feature_id"]: i for i, r in enumerate(rows)}
    mean, sd = np.array([r["mean"] for r in rows]), np.sqrt(np.maximum([r["variance"] for r in rows], 1e-12))
    held = y.sparkSession.sparkContext.broadcast((place, mean, sd, np.clip(-mean / sd, -clip, clip), axes))
    cells = y.join(F.broadcast(features.select("feature_id")), "feature_id", "left_semi").groupBy("cell_id").agg(F.collect_list(F.struct("feature_id", "y")).alias("v"))

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, mean, sd, base, axes = held.value
        for pdf in batches:
            m = np.tile(base, (len(pdf), 1))
            for i, v in enumerate(pdf["v"]):
                at = [place[r["feature_id"]] for r in v]
                m[i, at] = np.minimum((np.array([r["y"] for r in v]) - mean[at]) / sd[at], clip)
            yield pd.DataFrame({"cell_id": pdf["cell_id"], "scores": list(m @ axes)})

    return cells.mapInPandas(project, f"cell_id {dict(y.dtypes)['cell_id']}, scores array<double>")


def variable_features_by_batch(counts: DataFrame, cells: DataFrame, batch: str, top: int, bins: int = 20, target: float = 1e4) -> DataFrame:
    """(feature_id, n_batches, dispersion) of the top features that vary in most batches, then by mean standardised dispersion, then the smaller id.

    Within a batch: the log of variance over mean of counts per target, standardised within bins of equal width of log1p of the
    mean; the top features (ties included) vary there. A feature alone in its bin gets 1, one that a batch never shows 0.
    """
    size = cells.groupBy(batch).agg(F.count("*").alias("_n"))
    total = F.sum("count").over(W.partitionBy("cell_id"))
    x = counts.filter("count > 0").withColumn("_x", F.col("count") / total * target).join(cells.select("cell_id", batch), "cell_id")
    x = x.groupBy(batch, "feature_id").agg(F.sum("_x").alias("_s"), F.sum(F.col("_x") * F.col("_x")).alias("_q")).join(F.broadcast(size), batch)  # a row for each batch
    mean = F.col("_s") / F.col("_n")
    x = x.select(batch, "feature_id", F.log1p(mean).alias("_m"), F.log(F.nullif(F.greatest(F.try_divide(F.col("_q") - F.col("_n") * mean * mean, F.col("_n") - 1), F.lit(0.0)) / mean, F.lit(0.0))).alias("_d"))
    low, high = (f("_m").over(W.partitionBy(batch)) for f in (F.min, F.max))
    x = x.withColumn("_bin", F.coalesce(F.greatest(F.lit(1), F.ceil(F.try_divide(F.col("_m") - low, (high - low) / bins))), F.lit(1)))
    own = W.partitionBy(batch, "_bin")
    sd = F.stddev_samp("_d").over(own)
    x = x.withColumn("_z", F.when(F.col("_d").isNotNull(), F.when(sd.isNull(), 1.0).otherwise(F.try_divide(F.col("_d") - F.avg("_d").over(own), sd))))
    place = F.rank().over(W.partitionBy(batch).orderBy(F.col("_z").desc_nulls_last()))
    x = x.withColumn("_top", (F.col("_z").isNotNull() & (place <= top)).cast("long"))
    batches = size.count()
    x = x.groupBy("feature_id").agg(F.sum("_top").alias("n_batches"), F.try_divide(F.coalesce(F.sum("_z"), F.lit(0.0)), batches - F.count_if(F.col("_z").isNull())).alias("dispersion"))
    return x.orderBy(F.col("n_batches").desc(), F.col("dispersion").desc_nulls_last(), "feature_id").limit(top)


def matched_pair_null(detected: DataFrame, n_cells: int, first: float, second: float, pairs: int = 200, band: float = 0.1, seed: int = 0) -> DataFrame:
    """(a, b, odds): odds ratios of random gene pairs whose detection rates are within band of first and second.

    detected: distinct (cell_id, gene). Pairs are drawn by a seeded hash of rank among each rate's candidates; 0.5 is added
    to all four cells of a table.
    """
    rate = detected.groupBy("gene").agg((F.count("*") / n_cells).alias("rate"))

    def near(name: str, r: float, salt: int) -> DataFrame:
        x = rate.filter(F.abs(F.col("rate") - r) <= band * r).select(F.col("gene").alias(name))
        return x.withColumn("i", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.xxhash64(name, F.lit(seed + salt)), name)) - 1)  # a row for each gene of the band

    a, b = near("a", first, 1), near("b", second, 2)
    na, nb = a.count(), b.count()
    if not na or not nb:
        return detected.sparkSession.createDataFrame([], "a string, b string, odds double")
    draws = detected.sparkSession.range(pairs).select(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(na)).cast("int").alias("ia"), F.pmod(F.xxhash64("id", F.lit(seed + 7)), F.lit(nb)).cast("int").alias("ib"))
    chosen = draws.join(a.withColumnRenamed("i", "ia"), "ia").join(b.withColumnRenamed("i", "ib"), "ib").filter("a <> b").select("a", "b").distinct()
    x = detected.select(F.col("gene").alias("a"), "cell_id")
    both = chosen.join(x, "a").join(detected.select(F.col("gene").alias("b"), "cell_id"), ["b", "cell_id"]).groupBy("a", "b").agg(F.count("*").alias("n"))
    t = chosen.join(both, ["a", "b"], "left").fillna(0, ["n"]).join(rate.select(F.col("gene").alias("a"), F.col("rate").alias("ra")), "a").join(rate.select(F.col("gene").alias("b"), F.col("rate").alias("rb")), "b")
    n, na_, nb_ = F.col("n"), F.col("ra") * n_cells, F.col("rb") * n_cells
    return t.select("a", "b", (((n + 0.5) * (n_cells - na_ - nb_ + n + 0.5)) / ((na_ - n + 0.5) * (nb_ - n + 0.5))).alias("odds"))
