"""Isoform fractions, usage profiles and their diversity."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def plogp(p: Column) -> Column:
    return -p * F.log2(p)


def isoform_fractions(counts: DataFrame, genes: DataFrame) -> DataFrame:
    """counts with gene and fraction = count over the cell's count of the gene. genes: (feature_id, gene).

    Rows of count 0 get the fraction 0; a gene with one isoform gets 1. One shuffle, on (cell_id, gene).
    """
    x = counts.join(genes, "feature_id")
    total = F.sum("count").over(W.partitionBy("cell_id", "gene"))
    return x.withColumn("fraction", F.when(total > 0, F.col("count") / total).otherwise(0.0))


def mean_usage(fractions: DataFrame, obs: DataFrame, by: list[str], min_cells: int = 10, min_expressing: int = 5) -> DataFrame:
    """(by, gene, feature_id, usage, n_expr, n_iso): mean fraction over the cells that express the gene.

    Groups under min_cells cells, and genes under min_expressing expressing cells there, are left out.
    """
    cells = obs.groupBy(*by).agg(F.count("*").alias("_cells")).filter(F.col("_cells") >= min_cells).drop("_cells")
    x = first_of_gene(fractions.filter("count > 0 and gene is not null"), "_first").join(obs.select("cell_id", *by), "cell_id")
    whole = W.partitionBy(*by, "gene")
    sums = x.groupBy(*by, "gene", "feature_id").agg(F.sum("fraction").alias("_sum"), F.sum("_first").alias("_n"))
    out = sums.withColumn("n_expr", F.sum("_n").over(whole)).withColumn("n_iso", F.count("*").over(whole)).filter(F.col("n_expr") >= min_expressing).join(cells, by)
    return out.select(*by, "gene", "feature_id", (F.col("_sum") / F.col("n_expr")).alias("usage"), "n_expr", "n_iso")


def first_of_gene(fractions: DataFrame, out: str) -> DataFrame:
    """fractions with out: 1 in one row of each cell and gene, else 0, so that sums of it count cells.

    isoform_fractions() leaves its rows in that partition and order, and this needs no other.
    """
    row = F.col("_row") == F.min("_row").over(W.partitionBy("cell_id", "gene"))
    return fractions.withColumn("_row", F.monotonically_increasing_id()).withColumn(out, row.cast("int")).drop("_row")


def shannon(profile: DataFrame, by: list[str], min_isoforms: int = 2) -> DataFrame:
    """Entropy in bits of each profile with min_isoforms isoforms or more."""
    x = profile.filter("usage > 0").groupBy(*by, "gene").agg(F.sum(plogp(F.col("usage"))).alias("h"), F.count("*").alias("n_iso"), F.first("n_expr").alias("n_expr"))
    return x.filter(F.col("n_iso") >= min_isoforms)


def renyi(profile: DataFrame, by: list[str], alpha: float = 2.0, min_isoforms: int = 2, normalise: bool = False) -> DataFrame:
    """Rényi entropy in bits: order 1 is Shannon's, infinity the min-entropy. normalise: profiles summed to 1 first."""
    p = F.col("usage") / F.sum("usage").over(W.partitionBy(*by, "gene")) if normalise else F.col("usage")
    x = profile.filter("usage > 0").withColumn("_p", p)
    if alpha == 1:
        h = F.sum(plogp(F.col("_p")))
    elif math.isinf(alpha):
        h = -F.log2(F.max("_p"))
    else:
        h = F.log2(F.sum(F.pow("_p", F.lit(float(alpha))))) / (1 - alpha)
    return x.groupBy(*by, "gene").agg(h.alias("h"), F.count("*").alias("n_iso")).filter(F.col("n_iso") >= min_isoforms)


def matrix_renyi(fractions: DataFrame, obs: DataFrame, by: list[str], alpha: float = 2.0, min_cells: int = 10, min_expressing: int = 5) -> DataFrame:
    """Matrix-based Rényi entropy of the cells' fractions, of the eigenvalues of the Gram matrix over its trace.

    Order 2 is -log2 of the squared norm and needs no eigenvalues; others take those of isoforms by isoforms, gene by gene. Isoforms
    that no chain of cells connects are blocks of their own. Order 1 eliminates large sparse blocks (block_shannon()); for other orders
    the largest block is a dense matrix.
    """
    keys = [*by, "gene"]
    cells = obs.groupBy(*by).agg(F.count("*").alias("_cells")).filter(F.col("_cells") >= min_cells).drop("_cells")
    x = fractions.filter("count > 0 and gene is not null").join(obs.select("cell_id", *by), "cell_id").groupBy(*keys, "cell_id").agg(F.collect_list(F.struct("feature_id", "fraction")).alias("_l"))
    x = x.select(*keys, "_l", F.posexplode("_l").alias("_i", "_a")).select(*keys, "_i", "_a", F.posexplode("_l").alias("_j", "_b"))
    dot, own = F.col("_a.fraction") * F.col("_b.fraction"), F.col("_i") == F.col("_j")
    dots = x.groupBy(*keys, F.col("_a.feature_id").alias("feature_id"), F.col("_b.feature_id").alias("_other")).agg(F.sum(dot).alias("_dot"), F.sum(F.when(own, dot)).alias("_square"), F.count_if(own & (F.col("_i") == 0)).alias("_n"))
    if alpha == 2:
        norm = dots.groupBy(*keys).agg(F.sum(F.col("_dot") * F.col("_dot")).alias("_norm"), F.sum("_square").alias("_trace"), F.sum("_n").alias("n_expr")).filter(F.col("n_expr") >= min_expressing)
        return norm.join(cells, by).select(*keys, "n_expr", (-F.log2(F.col("_norm") / (F.col("_trace") * F.col("_trace")))).alias("h"))
    types = dict(dots.dtypes)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["_n"].sum())
        if n < min_expressing:
            return pd.DataFrame(columns=[*keys, "n_expr", "h"])
        names, at = np.unique(np.concatenate([pdf["feature_id"].to_numpy(), pdf["_other"].to_numpy()]), return_inverse=True)
        i, j, dot = at[: len(pdf)], at[len(pdf) :], pdf["_dot"].to_numpy()
        dot = dot / dot[i == j].sum()
        if alpha == 1:
            h = block_shannon(len(names), i, j, dot)
        else:
            p = block_eigenvalues(len(names), i, j, dot)
            p = p[p > 1e-12]
            h = -np.log2(p.max()) if math.isinf(alpha) else np.log2((p**alpha).sum()) / (1 - alpha)
        return pdf[keys].head(1).assign(n_expr=n, h=float(h))

    h = dots.select(*keys, "feature_id", "_other", "_dot", "_n").groupBy(*keys).applyInPandas(one, ", ".join(f"`{c}` {types[c]}" for c in keys) + ", n_expr long, h double")
    return h.join(cells, by).select(*keys, "n_expr", "h")


def components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of n nodes with these edges, the least node that each is connected with."""
    label = np.arange(n)
    while True:
        least, new = np.minimum(label[i], label[j]), label.copy()
        for at in (label[i], label[j]):
            np.minimum.at(new, at, least)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def block_eigenvalues(n: int, i: np.ndarray, j: np.ndarray, value: np.ndarray, most: int = 4_000_000) -> np.ndarray:
    """The eigenvalues of a symmetric matrix of n rows, given by its entries in both triangles: those of its connected blocks, of one
    size at a time, most entries or one block at once."""
    _, block, size = np.unique(components(n, i, j), return_inverse=True, return_counts=True)
    order = np.argsort(block, kind="stable")
    place = np.empty(n, int)
    place[order] = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
    by_block = np.argsort(block[i], kind="stable")
    i, j, value = i[by_block], j[by_block], value[by_block]
    start = np.searchsorted(block[i], np.arange(len(size) + 1))
    out = []
    for m in np.unique(size):
        of = np.flatnonzero(size == m)
        for lo in range(0, len(of), max(1, most // (m * m))):
            some = of[lo : lo + max(1, most // (m * m))]
            rows = np.concatenate([np.arange(start[b], start[b + 1]) for b in some])
            dense = np.zeros((len(some), m, m))
            np.add.at(dense, (np.searchsorted(some, block[i[rows]]), place[i[rows]], place[j[rows]]), value[rows])
            out.append((dense if m == 1 else np.linalg.eigvalsh(dense)).ravel())
    return np.concatenate(out)


def block_shannon(n: int, i: np.ndarray, j: np.ndarray, value: np.ndarray, dense: int = 256) -> float:
    """-sum p log2 p of the eigenvalues p of a positive semidefinite matrix of n rows, given by its entries in both triangles.

    Blocks of at most dense rows, and such as have over two entries a row beside the diagonal, take their eigenvalues, all others resolvent_entropy().
    """
    _, block, size = np.unique(components(n, i, j), return_inverse=True, return_counts=True)
    links = np.bincount(block[i[i < j]], minlength=len(size))
    large = (size > dense) & (links <= 2 * size)
    place = np.cumsum(~large[block]) - 1
    few = ~large[block[i]]
    p = block_eigenvalues(int((~large[block]).sum()), place[i[few]], place[j[few]], value[few]) if few.any() else np.zeros(0)
    p = p[p > 1e-12]
    h = -float((p * np.log2(p)).sum())
    for b in np.flatnonzero(large):
        mine, of = block[i] == b, np.cumsum(block == b) - 1
        h += resolvent_entropy(int(size[b]), of[i[mine]], of[j[mine]], value[mine])
    return h


def resolvent_entropy(n: int, i: np.ndarray, j: np.ndarray, value: np.ndarray, step: float = 0.7) -> float:
    """-sum p log2 p of the eigenvalues of a sparse positive semidefinite matrix, without them.

    With x = p / c, -sum x log x is the integral over t > 0 of sum x / (x + t) - sum x / (1 + t); for c = sum p^2 / sum p it falls off as t^-3.
    By the logarithm of t the trapezoid rule errs by exp(-2 pi^2 / step). sum 1 / (x + t) is the slope of log det(X + t), from
    the pivots and their slopes for all t at once: ends of chains of isoforms go first, in rounds, then the isoform with the fewest links.
    """
    trace, c = value[i == j].sum(), (value * value).sum() / value[i == j].sum()
    x = value / c
    reach = float(np.bincount(i, np.abs(x), n).max())
    t = np.exp(np.arange(math.log(1e-11), math.log(1e4 * reach), step))
    own = np.bincount(i[i == j], x[i == j], n)
    pivot, slope = own[:, None] + t, np.ones((n, len(t)))
    inverse = np.zeros(len(t))
    up = i < j
    a, b, w = i[up], j[up], x[up]
    while len(a):  # ends of chains: their links stay as they are
        degree = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
        end = (degree[a] == 1) | (degree[b] == 1)
        if not end.any():
            break
        leaf, other = np.where(degree[a] == 1, a, b)[end], np.where(degree[a] == 1, b, a)[end]
        by = w[end, None] / pivot[leaf]
        inverse += (slope[leaf] / pivot[leaf]).sum(0)
        np.subtract.at(pivot, other, w[end, None] * by)
        np.add.at(slope, other, by * by * slope[leaf])
        own[leaf] = np.nan  # gone
        a, b, w = a[~end], b[~end], w[~end]
    linked: dict[int, dict[int, int]] = {v: {} for v in np.flatnonzero(~np.isnan(own)).tolist()}
    link, tilt = np.zeros((2 * len(a) + 64, len(t))), np.zeros((2 * len(a) + 64, len(t)))
    link[: len(a)] = w[:, None]
    for k, (u, v) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        linked[u][v] = linked[v][u] = k
    used, heap = len(a), [(len(near), v) for v, near in linked.items()]
    heapq.heapify(heap)
    while heap:
        degree, v = heapq.heappop(heap)
        if v not in linked or degree != len(linked[v]):
            continue
        if degree > 24:  # the rest has links between most
            break
        near = linked.pop(v)
        d, ds, ends, at = pivot[v], slope[v], list(near), list(near.values())
        inverse += ds / d
        if not ends:
            continue
        e, es = link[at], tilt[at]
        f = e / d
        fs = (es - f * ds) / d
        pivot[ends] -= e * f
        slope[ends] -= es * f + e * fs
        first, second, to = [], [], []
        for k, u in enumerate(ends):
            del linked[u][v]
            for q in range(k):
                o = ends[q]
                z = linked[u].get(o)
                if z is None:
                    z = linked[u][o] = linked[o][u] = used
                    used += 1
                first.append(k)
                second.append(q)
                to.append(z)
        if used > len(link):
            link, tilt = (np.concatenate([y, np.zeros((used, len(t)))]) for y in (link, tilt))
        if to:
            link[to] -= e[first] * f[second]
            tilt[to] -= es[first] * f[second] + e[first] * fs[second]
        for u in ends:
            heapq.heappush(heap, (len(linked[u]), u))
    rest = list(linked)
    at = {v: k for k, v in enumerate(rest)}
    pairs = [(at[u], at[v], k) for u in rest for v, k in linked[u].items()]
    r, s, k = (np.array(y, int) for y in zip(*pairs, strict=True)) if pairs else (np.zeros(0, int),) * 3
    for q in range(len(t) if rest else 0):
        whole, turn = np.diag(pivot[rest, q]), np.diag(slope[rest, q])
        whole[r, s], turn[r, s] = link[k, q], tilt[k, q]
        inverse[q] += np.trace(np.linalg.solve(whole, turn))
    area = step * ((n - t * inverse - trace / c / (1 + t)) * t).sum()
    return float((c * area - trace * math.log(c)) / math.log(2))


def tau(usage: DataFrame, entity: list[str], value: str = "usage") -> DataFrame:
    """Specificity over groups: sum of 1 - value / max, over n - 1; entities in one group are left out."""
    top = F.max(value).over(W.partitionBy(*entity))
    x = usage.withColumn("_rel", F.when(top > 0, 1 - F.col(value) / top).otherwise(0.0))
    x = x.groupBy(*entity).agg(F.sum("_rel").alias("_sum"), F.count("*").alias("n_groups")).filter("n_groups > 1")
    return x.select(*entity, "n_groups", (F.col("_sum") / (F.col("n_groups") - 1)).alias("tau"))


def quadrants(entropy: DataFrame) -> DataFrame:
    """Per gene the mean and sample variance of its entropy over groups (two or more), split at both medians."""
    x = entropy.groupBy("gene").agg(F.avg("h").alias("mean_h"), F.var_samp("h").alias("var_h"), F.count("*").alias("n_groups")).filter("n_groups >= 2")
    mid = x.agg(F.percentile("mean_h", 0.5).alias("_m"), F.percentile("var_h", 0.5).alias("_v"))
    high = lambda c, m: F.when(F.col(c) >= F.col(m), "high").otherwise("low")
    return x.crossJoin(F.broadcast(mid)).select("gene", "mean_h", "var_h", "n_groups", F.concat_ws("_", high("mean_h", "_m"), high("var_h", "_v")).alias("quadrant"))


def cell_gene_entropy(fractions: DataFrame) -> DataFrame:
    """(cell_id, gene, total, k, h): count, expressed isoforms and entropy of each gene in each cell."""
    return fractions.filter("count > 0").groupBy("cell_id", "gene").agg(F.sum("count").alias("total"), F.count("*").alias("k"), F.sum(plogp(F.col("fraction"))).alias("h"))


def cell_entropy(cell_genes: DataFrame, min_isoforms: int = 2, min_count: int = 0, none: float | None = 0.0) -> DataFrame:
    """Mean entropy of a cell's genes with min_isoforms expressed isoforms and min_count counts; none, if it has no such gene."""
    use = (F.col("k") >= min_isoforms) & (F.col("total") >= min_count)
    mean = F.avg(F.when(use, F.col("h")))
    return cell_genes.groupBy("cell_id").agg((F.coalesce(mean, F.lit(none)) if none is not None else mean).alias("h"), F.count_if(use).alias("n_genes"))


def identity_parts(cell_genes: DataFrame) -> DataFrame:
    """Per cell D (share of expressed genes with two isoforms or more), M (their mean entropy) and D * M, the mean over all."""
    many = F.col("k") >= 2
    x = cell_genes.groupBy("cell_id").agg(F.count("*").alias("n_expr"), F.count_if(many).alias("n_meas"), F.sum(F.when(many, F.col("h"))).alias("_sum"))
    return x.select("cell_id", "n_expr", "n_meas", (F.col("n_meas") / F.col("n_expr")).alias("d"), (F.col("_sum") / F.col("n_meas")).alias("m"), (F.coalesce("_sum", F.lit(0.0)) / F.col("n_expr")).alias("h_unc"))


def chao_shen(fractions: DataFrame, min_isoforms: int = 2) -> DataFrame:
    """Per cell the mean Chao-Shen entropy of its genes with min_isoforms expressed isoforms; 0 without any."""
    of_gene = W.partitionBy("cell_id", "gene")
    x = fractions.filter("count > 0").withColumn("_n", F.sum("count").over(of_gene)).withColumn("_k", F.count("*").over(of_gene)).withColumn("_f1", F.sum((F.col("count") == 1).cast("int")).over(of_gene))
    cover = 1 - F.col("_f1") / F.col("_n")
    x = x.withColumn("_p", F.when(cover > 0, cover).otherwise(1 / F.col("_n")) * F.col("count") / F.col("_n"))
    h = plogp(F.col("_p")) / (1 - F.pow(1 - F.col("_p"), F.col("_n")))
    genes = x.groupBy("cell_id", "gene").agg(F.sum(h).alias("h"), F.first("_k").alias("_k"))
    return genes.groupBy("cell_id").agg(F.coalesce(F.avg(F.when(F.col("_k") >= min_isoforms, F.col("h"))), F.lit(0.0)).alias("h"))


def detection_evenness(cell_genes: DataFrame, obs: DataFrame) -> DataFrame:
    """Per gene the arms' difference of mean entropy as a part of detection (M1 * dD) and one of evenness (D0 * dM)."""
    x = cell_genes.join(obs.select("cell_id", "arm"), "cell_id").groupBy("gene")
    many = F.col("k") >= 2
    sums = []
    for tag, arm in (("1", F.col("arm")), ("0", ~F.col("arm"))):
        sums += [F.count_if(arm).alias("n" + tag), F.count_if(arm & many).alias("k" + tag), F.sum(F.when(arm & many, F.col("h"))).alias("s" + tag)]
    x = x.agg(*sums).filter("k1 > 0 and k0 > 0").select("gene", *((F.col("k" + t) / F.col("n" + t)).alias("d" + t) for t in "10"), *((F.col("s" + t) / F.col("k" + t)).alias("m" + t) for t in "10"))
    d, m = F.col("d1") - F.col("d0"), F.col("m1") - F.col("m0")
    return x.select("gene", (F.col("d1") * F.col("m1") - F.col("d0") * F.col("m0")).alias("delta"), (F.col("m1") * d).alias("detection"), (F.col("d0") * m).alias("evenness"))


def variable_isoforms(fractions: DataFrame, n_cells: int, top: int = 2000) -> DataFrame:
    """The features whose fraction varies most over all n_cells cells, absent ones counted as 0. Ties: the smaller id."""
    x = fractions.groupBy("feature_id").agg(F.sum("fraction").alias("_s"), F.sum(F.col("fraction") * F.col("fraction")).alias("_q"))
    x = x.withColumn("variance", F.col("_q") / n_cells - (F.col("_s") / n_cells) * (F.col("_s") / n_cells))
    return x.select("feature_id", "variance").orderBy(F.col("variance").desc(), "feature_id").limit(top)


def class_share(counts: DataFrame, mask: DataFrame) -> DataFrame:
    """Per cell the share of its count in masked features. mask: (feature_id, hit)."""
    x = counts.join(mask.select("feature_id", "hit"), "feature_id", "left")
    return x.groupBy("cell_id").agg((F.sum(F.when(F.col("hit"), F.col("count")).otherwise(0)) / F.sum("count")).alias("share"))


def abundance_r2(counts: DataFrame, genes: DataFrame, min_cells: int = 50, min_count: int = 50) -> DataFrame:
    """Per isoform: how much of log1p of its count the gene's count explains, over the cells with the gene; zeros count.

    (feature_id, n_cells, r2, own = 1 - r2); genes in fewer cells and isoforms of fewer counts are left out. Zeros enter
    as sums: a cell without the isoform adds to the gene's sums only, so nothing is filled in.
    """
    totals = counts.join(genes, "feature_id").withColumn("g", F.sum("count").over(W.partitionBy("cell_id", "gene")))
    totals = totals.withColumn("x", F.log1p("g")).withColumn("y", F.log1p("count"))
    per_gene = totals.select("cell_id", "gene", "x").distinct().groupBy("gene").agg(F.count("*").alias("n_cells"), F.sum("x").alias("sx"), F.sum(F.col("x") * F.col("x")).alias("sxx"))
    per_iso = totals.groupBy("gene", "feature_id").agg(F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy"), F.sum(F.col("x") * F.col("y")).alias("sxy"), F.sum("count").alias("total"))
    j = per_iso.join(per_gene, "gene").filter((F.col("n_cells") >= min_cells) & (F.col("total") >= min_count))
    n = F.col("n_cells")
    cov, vx, vy = n * F.col("sxy") - F.col("sx") * F.col("sy"), n * F.col("sxx") - F.col("sx") * F.col("sx"), n * F.col("syy") - F.col("sy") * F.col("sy")
    r2 = F.when((vx > 0) & (vy > 0), cov * cov / (vx * vy))
    return j.select("feature_id", "n_cells", r2.alias("r2"), (1 - r2).alias("own"))


def composition(profile: DataFrame, gene: str, novel) -> DataFrame:
    """One gene's usage by class, its novel isoforms in one band. novel: a condition on feature_id."""
    key = F.when(novel, F.lit("novel")).otherwise(F.col("feature_id").cast("string"))
    return profile.filter(F.col("gene") == gene).groupBy("class", key.alias("band")).agg(F.sum("usage").alias("usage"), F.count("*").alias("n_iso"))
