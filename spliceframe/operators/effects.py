"""Tests and effect sizes in grouped sums and ranks; only tails of distributions leave the JVM."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spliceframe.functions import tails
from spliceframe.operators.keep import kept
from spliceframe.operators.tables import adjusted, average_rank

# ---- sums of an arm: n, s (sum), q (sum of squares)


def arm_sums(df: DataFrame, value: str, arm: str, *by: str) -> DataFrame:
    """n1, s1, q1 of the rows where arm holds and n0, s0, q0 of the others. Null values don't count."""
    v, a = F.col(value), F.col(arm)
    cols = []
    for tag, on in (("1", a), ("0", ~a)):
        x = F.when(on, v)
        cols += [F.count(x).alias("n" + tag), F.coalesce(F.sum(x), F.lit(0.0)).alias("s" + tag), F.coalesce(F.sum(x * x), F.lit(0.0)).alias("q" + tag)]
    return df.groupBy(*by).agg(*cols)


def variance(n: Column, s: Column, q: Column) -> Column:
    """The sample variance from sums."""
    m = s / n
    return F.greatest(F.lit(0.0), q / n - m * m) * n / (n - 1)


def effects(sums: DataFrame, min_cells: int = 2) -> DataFrame:
    """sums with effect (mean1 - mean0), se, z and the variances; null where an arm has under min_cells."""
    c = {k: F.col(k) for k in ("n1", "s1", "q1", "n0", "s0", "q0")}
    ok = (c["n1"] >= min_cells) & (c["n0"] >= min_cells)
    x = sums.withColumn("effect", F.when(ok, c["s1"] / c["n1"] - c["s0"] / c["n0"])).withColumn("var1", F.when(ok, variance(c["n1"], c["s1"], c["q1"]))).withColumn("var0", F.when(ok, variance(c["n0"], c["s0"], c["q0"])))
    x = x.withColumn("se", F.sqrt(F.col("var1") / F.col("n1") + F.col("var0") / F.col("n0")))
    return x.withColumn("z", F.when(F.col("se") > 0, F.col("effect") / F.col("se")))


def welch(sums: DataFrame) -> DataFrame:
    """effects() with t, df and the two-sided p of Welch's test; (0, 1) where it is undefined."""
    x = effects(sums)
    a, b = F.col("var1") / F.col("n1"), F.col("var0") / F.col("n0")
    x = x.withColumn("t", F.col("z")).withColumn("df", F.when(a + b > 0, (a + b) * (a + b) / (a * a / (F.col("n1") - 1) + b * b / (F.col("n0") - 1))))
    p = 2 * tails.t_sf_udf(F.coalesce(F.abs("t"), F.lit(0.0)), F.coalesce("df", F.lit(1.0)))
    return x.withColumn("p", F.when(F.col("t").isNull(), 1.0).otherwise(p)).withColumn("t", F.coalesce("t", F.lit(0.0)))


def sparse_arm_sums(nonzero: DataFrame, sizes: DataFrame, value: str, arm: str, *by: str) -> DataFrame:
    """arm_sums() where absent rows are zeros: sizes (n1, n0) are the arms' numbers of cells."""
    return arm_sums(nonzero, value, arm, *by).drop("n1", "n0").crossJoin(F.broadcast(sizes.select("n1", "n0")))  # sizes is one row


def mann_whitney(df: DataFrame, value: str, arm: str, *by: str, sizes: DataFrame | None = None) -> DataFrame:
    """(by, n1, n0, u, cliff, z): the arm's U with tie and continuity corrections, and Cliff's delta 2U / (n1 n0) - 1.

    sizes (n1, n0, for each value of those of by that it has): rows absent from df are zeros, and df's values must be positive; the zeros are one tie below all.
    """
    x = average_rank(df.filter(F.col(value).isNotNull()), value, *by, out="_r").withColumn("_t", F.count("*").over(W.partitionBy(*by, value)))
    a = F.col(arm)
    x = x.groupBy(*by).agg(F.count_if(a).alias("k1"), F.count_if(~a).alias("k0"), F.coalesce(F.sum(F.when(a, F.col("_r"))), F.lit(0.0)).alias("_rs"), F.sum(F.col("_t") * F.col("_t") - 1).cast("double").alias("_ties"))
    if sizes is None:
        x = x.withColumn("n1", F.col("k1")).withColumn("n0", F.col("k0")).withColumn("_zeros", F.lit(0))
    else:
        own = [c for c in by if c in sizes.columns]
        x = (x.join(sizes.select(*own, "n1", "n0"), own) if own else x.crossJoin(F.broadcast(sizes.select("n1", "n0")))).withColumn("_zeros", F.col("n1") + F.col("n0") - F.col("k1") - F.col("k0"))  # one row
    zeros = F.col("_zeros").cast("double")
    ranks = F.col("_rs") + F.col("k1") * zeros + (F.col("n1") - F.col("k1")) * (zeros + 1) / 2
    x = x.withColumn("u", ranks - F.col("n1") * (F.col("n1") + 1) / 2).withColumn("_tie", F.col("_ties") + zeros * zeros * zeros - zeros)
    n, m = F.col("n1") + F.col("n0"), F.col("n1").cast("double") * F.col("n0")
    sd = F.sqrt(m / 12 * ((n + 1) - F.col("_tie") / (n * (n - 1))))
    gap = F.abs(F.col("u") - m / 2) - 0.5
    x = x.filter("n1 > 0 and n0 > 0").withColumn("cliff", 2 * F.col("u") / m - 1)
    return x.withColumn("z", F.when(sd > 0, F.signum(F.col("u") - m / 2) * F.greatest(F.lit(0.0), gap) / sd).otherwise(0.0)).select(*by, "n1", "n0", "u", "cliff", "z")


def rest_ranks(tally: DataFrame, sizes: DataFrame, value: str, times: str, group: str, *by: str) -> DataFrame:
    """(group, by, n1, n0, u, z): mann_whitney() of every group against all other cells, from how many cells (times) of a group have a value.

    Values are positive, and cells without a row are zeros. sizes (group, n1, n0): a group's cells and all others. Ranks are taken once, over the
    distinct values of all cells; the rest's are what the group leaves of them.
    """
    met = tally.groupBy(*by, value).agg(F.sum(times).cast("double").alias("_t"))
    met = met.withColumn("_rank", F.sum("_t").over(W.partitionBy(*by).orderBy(value)) - (F.col("_t") - 1) / 2)
    whole = met.groupBy(*by).agg(F.sum("_t").alias("_some"), F.sum(F.col("_t") * F.col("_t") * F.col("_t") - F.col("_t")).alias("_ties"))
    x = tally.join(met, [*by, value]).groupBy(group, *by).agg(F.sum(times).alias("_k"), F.sum(F.col(times) * F.col("_rank")).alias("_rs"))
    x = x.join(whole, list(by)).join(F.broadcast(sizes), group)  # a row for each group
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    zeros, n = n1 + n0 - F.col("_some"), n1 + n0
    u = F.col("_rs") + F.col("_k") * zeros + (n1 - F.col("_k")) * (zeros + 1) / 2 - n1 * (n1 + 1) / 2
    var = F.try_divide(F.col("_ties") + zeros * zeros * zeros - zeros, n * (n - 1))
    sd = F.sqrt(n1 * n0 / 12 * (n + 1 - var))
    gap = u - n1 * n0 / 2
    return x.select(group, *by, "n1", "n0", u.alias("u"), F.when(sd > 0, F.signum(gap) * F.greatest(F.lit(0.0), F.abs(gap) - 0.5) / sd).otherwise(0.0).alias("z"))


def two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * tails.norm_sf_udf(F.abs(z)))


def fraction_sums(fractions: DataFrame, obs: DataFrame, group: str, min_cells: int = 10, min_share: float = 0.05) -> DataFrame:
    """For every group and isoform of a gene tested there, the cells (n1, n0), and of the nonzero fractions: the group's number k1,
    rank sum rs, sum s1 and sum of squares q1, and all cells' k, ties (sum of t * t - 1), s and q.

    A gene is tested where the cells that express it are min_cells and min_share of the cells, on both sides. Ranks are taken once, over all
    cells; everything else is sums of groups, which add up to those of all cells.
    """
    cells = obs.select("cell_id", F.col(group).alias("group"))
    n = cells.groupBy("group").agg(F.count("*").alias("n1")).withColumn("n0", F.sum("n1").over(W.partitionBy()) - F.col("n1"))
    x = fractions.filter("count > 0").join(cells, "cell_id")
    gene = x.groupBy("group", "gene").agg(F.countDistinct("cell_id").alias("e1")).withColumn("e0", F.sum("e1").over(W.partitionBy("gene")) - F.col("e1")).join(F.broadcast(n), "group")  # a row for each group
    ok = lambda e, n: (F.col(e) >= min_cells) & (F.col(e) >= min_share * F.col(n))
    gene = gene.filter(ok("e1", "n1") & ok("e0", "n0"))
    ranked = average_rank(x, "fraction", "gene", "feature_id", out="_r").withColumn("_t", F.count("*").over(W.partitionBy("gene", "feature_id", "fraction")))
    f = F.col("fraction")
    own = kept(ranked.groupBy("group", "gene", "feature_id").agg(F.count("*").alias("k1"), F.sum("_r").alias("rs"), F.sum(F.col("_t") * F.col("_t") - 1).cast("double").alias("t1"), F.sum(f).alias("s1"), F.sum(f * f).alias("q1")))
    whole = own.groupBy("gene", "feature_id").agg(*(F.sum(a).alias(b) for a, b in (("k1", "k"), ("t1", "ties"), ("s1", "s"), ("q1", "q"))))
    return gene.join(whole, "gene").join(own.drop("t1"), ["group", "gene", "feature_id"], "left").fillna(0, ["k1", "rs", "s1", "q1"]).select("group", "gene", "feature_id", "n1", "n0", "k", "k1", "rs", "ties", "s", "s1", "q", "q1")


def rank_isoform_fractions(fractions: DataFrame, obs: DataFrame, group: str, method: str = "mannwhitney", min_cells: int = 10, min_share: float = 0.05) -> DataFrame:
    """Differential isoform fractions of every group against the rest, zeros of all cells included, over fraction_sums().

    (group, gene, feature_id, score, delta, p, padj) by method mannwhitney or welch; padj within the group. Method both: delta, then
    u, p_u, padj_u and t, p_t, padj_t, from the same sums.
    """
    if method not in ("mannwhitney", "welch", "both"):
        raise ValueError("method must be mannwhitney, welch or both")
    keys = ["group", "gene", "feature_id"]
    x = fraction_sums(fractions, obs, group, min_cells, min_share)
    x = x.withColumn("delta", F.col("s1") / F.col("n1") - (F.col("s") - F.col("s1")) / F.col("n0"))
    if method != "welch":
        m, total = F.col("n1").cast("double") * F.col("n0"), F.col("n1") + F.col("n0")
        zeros = (total - F.col("k")).cast("double")
        u = F.col("rs") + F.col("k1") * zeros + (F.col("n1") - F.col("k1")) * (zeros + 1) / 2 - F.col("n1") * (F.col("n1") + 1) / 2
        sd = F.sqrt(m / 12 * ((total + 1) - (F.col("ties") + zeros * zeros * zeros - zeros) / (total * (total - 1))))
        z = F.when(sd > 0, F.greatest(F.lit(0.0), F.abs(u - m / 2) - 0.5) / sd).otherwise(0.0)
        x = x.withColumn("u", u).withColumn("p_u", two_sided(z))
        if method == "mannwhitney":
            return adjusted(x.select(*keys, F.col("u").alias("score"), "delta", F.col("p_u").alias("p")), "p", "group")
    sums = x.withColumn("s0", F.col("s") - F.col("s1")).withColumn("q0", F.col("q") - F.col("q1"))
    if method == "welch":
        return adjusted(welch(sums).select(*keys, F.col("t").alias("score"), F.col("effect").alias("delta"), "p"), "p", "group")
    both = welch(sums).select(*keys, "delta", "u", "p_u", "t", F.col("p").alias("p_t"))
    return adjusted(adjusted(both, "p_u", "group", out="padj_u"), "p_t", "group", out="padj_t").select(*keys, "delta", "u", "p_u", "padj_u", "t", "p_t", "padj_t")


# ---- pooling


def stratified_effects(df: DataFrame, value: str, arm: str, unit: str, stratum: str, least: int = 3) -> DataFrame:
    """(unit, effect, se, n_strata): inverse-variance mean over strata with least cells in both arms and some variance."""
    x = effects(arm_sums(df, value, arm, unit, stratum), least).filter("effect is not null and se > 0").withColumn("_w", 1 / (F.col("se") * F.col("se")))
    return x.groupBy(unit).agg((F.sum(F.col("_w") * F.col("effect")) / F.sum("_w")).alias("effect"), (1 / F.sqrt(F.sum("_w"))).alias("se"), F.count("*").alias("n_strata"))


def depth_stratified(df: DataFrame, value: str, arm: str, bin: str, *by: str, least: int = 3) -> DataFrame:
    """Mann-Whitney by bin, combined as sum of w z over its norm, w = sqrt(n1 n0 / (n1 + n0)). (by, bins, z)."""
    x = mann_whitney(df, value, arm, *by, bin).filter(F.least("n1", "n0") >= least)
    w = F.sqrt(F.col("n1") * F.col("n0") / (F.col("n1") + F.col("n0")))
    return x.groupBy(*by).agg(F.count("*").alias("bins"), (F.sum(w * F.col("z")) / F.sqrt(F.sum(w * w))).alias("z"))


def dersimonian_laird(df: DataFrame, *by: str, knapp_hartung: bool = True) -> DataFrame:
    """Random-effects pooling of (effect, se): k, effect, se, q, tau2, i2. One study: itself. Rows without both don't count.

    The Knapp-Hartung factor is floored at 1.
    """
    x = df.filter("effect is not null and se > 0").withColumn("_w", 1 / (F.col("se") * F.col("se")))
    x = x.withColumn("_fixed", F.sum(F.col("_w") * F.col("effect")).over(W.partitionBy(*by)) / F.sum("_w").over(W.partitionBy(*by)))
    gap = F.col("effect") - F.col("_fixed")
    sums = x.groupBy(*by).agg(F.count("*").alias("k"), F.sum("_w").alias("_sw"), F.sum(F.col("_w") * F.col("_w")).alias("_sww"), F.sum(F.col("_w") * gap * gap).alias("q"))
    c = F.col("_sw") - F.col("_sww") / F.col("_sw")
    sums = sums.withColumn("tau2", F.when((F.col("k") > 1) & (c > 0), F.greatest(F.lit(0.0), (F.col("q") - (F.col("k") - 1)) / c)).otherwise(0.0))
    sums = sums.withColumn("i2", F.when(F.col("q") > 0, F.greatest(F.lit(0.0), (F.col("q") - (F.col("k") - 1)) / F.col("q"))).otherwise(0.0))
    y = x.join(sums.select(*by, "k", "tau2", "q", "i2"), list(by)) if by else x.crossJoin(F.broadcast(sums.select("k", "tau2", "q", "i2")))  # one row
    y = y.withColumn("_v", 1 / (F.col("se") * F.col("se") + F.col("tau2")))
    y = y.withColumn("_mean", F.sum(F.col("_v") * F.col("effect")).over(W.partitionBy(*by)) / F.sum("_v").over(W.partitionBy(*by)))
    off = F.col("effect") - F.col("_mean")
    out = y.groupBy(*by).agg(F.first("k").alias("k"), F.first("_mean").alias("pooled"), F.sum("_v").alias("_sv"), F.sum(F.col("_v") * off * off).alias("_h"), F.first("q").alias("q"), F.first("tau2").alias("tau2"), F.first("i2").alias("i2"))
    factor = F.when(F.col("k") > 1, F.greatest(F.lit(1.0), F.col("_h") / (F.col("k") - 1))).otherwise(1.0) if knapp_hartung else F.lit(1.0)
    return out.select(*by, "k", F.col("pooled").alias("effect"), F.sqrt(factor / F.col("_sv")).alias("se"), "q", "tau2", "i2")


def sign_flip(df: DataFrame, value: str, *by: str, most: int = 16, exact: int = 24, samples: int = 200_000, seed: int = 0) -> DataFrame:
    """Sign-flip p of the mean of value: every one of 2^k sign patterns, for groups of over exact values a sample of them.

    Up to most values in expressions; larger groups (of units, not of cells) in a task each. A sampled p is 2^(1 - k) at least.
    """
    x = df.groupBy(*by).agg(F.sort_array(F.collect_list(F.col(value).cast("double"))).alias("_v")).withColumn("k", F.size("_v"))
    seen = F.abs(F.aggregate("_v", F.lit(0.0), lambda a, v: a + v))

    def total(mask: Column) -> Column:
        signed = F.transform("_v", lambda v, i: F.when(F.expr("1") == F.call_function("getbit", mask, i), -v).otherwise(v))
        return F.abs(F.aggregate(signed, F.lit(0.0), lambda a, v: a + v))

    masks = F.sequence(F.lit(0).cast("bigint"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.least("k", F.lit(most))) - 1)
    hits = F.size(F.filter(masks, lambda m: total(m) >= seen - 1e-12))

    def large(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for v in pdf["_v"]:
                v = np.asarray(v)
                if len(v) <= exact:
                    sums = np.zeros(1)
                    for one in v:
                        sums = np.concatenate([sums + one, sums - one])
                    out.append(float((np.abs(sums) >= abs(v.sum()) - 1e-12).mean()))
                else:
                    rng, hit = np.random.default_rng(seed), 0
                    for at in range(0, samples, 1000):
                        flips = rng.integers(0, 2, (min(1000, samples - at), len(v))) * 2 - 1
                        hit += int((np.abs(flips @ v) >= abs(v.sum()) - 1e-12).sum())
                    out.append(max(hit / samples, 2.0 ** (1 - len(v))))
            yield pdf.drop(columns="_v").assign(p=out)

    small = x.filter(F.col("k") <= most).select(*by, "k", (hits / F.pow(F.lit(2.0), F.col("k"))).alias("p"))
    types = dict(x.dtypes)
    rest = x.filter(F.col("k") > most).select(*by, "k", "_v").mapInPandas(large, ", ".join(f"`{c}` {types[c]}" for c in (*by, "k")) + ", p double")
    return small.unionByName(rest)


def cluster_t(df: DataFrame, value: str, *by: str) -> DataFrame:
    """(by, k, mean, se, t) of values by cluster; se and t need two."""
    x = df.groupBy(*by).agg(F.count(value).alias("k"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("_sd"))
    return x.withColumn("se", F.when(F.col("k") > 1, F.col("_sd") / F.sqrt("k"))).withColumn("t", F.when(F.col("se") > 0, F.col("mean") / F.col("se"))).drop("_sd")


def nested_meta(df: DataFrame, parent: str) -> DataFrame:
    """Effects of units pooled within each parent, then the parents' mean with its t. (k, mean, se, t)."""
    return cluster_t(dersimonian_laird(df, parent), "effect")


def tost(sums: DataFrame, margin: float) -> DataFrame:
    """Two one-sided tests of equivalence within the margin: t_low, t_high, df and p, the larger; null for n under 3 or se 0."""
    x = effects(sums, 3)
    a, b = F.col("var1") / F.col("n1"), F.col("var0") / F.col("n0")
    ok = F.col("se") > 0
    x = x.withColumn("t_low", F.when(ok, (F.col("effect") + margin) / F.col("se"))).withColumn("t_high", F.when(ok, (F.col("effect") - margin) / F.col("se"))).withColumn("df", F.when(ok, (a + b) * (a + b) / (a * a / (F.col("n1") - 1) + b * b / (F.col("n0") - 1))))
    p = F.greatest(tails.t_sf_udf(F.coalesce("t_low", F.lit(0.0)), F.coalesce("df", F.lit(1.0))), 1 - tails.t_sf_udf(F.coalesce("t_high", F.lit(0.0)), F.coalesce("df", F.lit(1.0))))
    return x.withColumn("p", F.when(F.col("t_low").isNotNull(), p))


def detectable(sd: Column, n1: Column, n0: Column, power: float = 0.8, alpha: float = 0.05) -> Column:
    """The smallest mean difference found with this power."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(1 - alpha / 2) + NormalDist().inv_cdf(power)
    return F.lit(z) * sd * F.sqrt(1 / n1 + 1 / n0)


def mantel_haenszel(df: DataFrame, x: str, y: str, stratum: str, *by: str) -> DataFrame:
    """(by, n, or_mh, or_crude): odds ratios over strata; infinite where the other diagonal is empty."""
    cell = lambda i, j: F.count_if((F.col(x) == i) & (F.col(y) == j))
    t = df.groupBy(*by, stratum).agg(cell(1, 1).alias("a"), cell(1, 0).alias("b"), cell(0, 1).alias("c"), cell(0, 0).alias("d"))
    n = F.col("a") + F.col("b") + F.col("c") + F.col("d")
    s = t.groupBy(*by).agg(F.sum(n).alias("n"), F.sum(F.col("a") * F.col("d") / n).alias("_u"), F.sum(F.col("b") * F.col("c") / n).alias("_v"), *(F.sum(c).alias(c) for c in "abcd"))
    ratio = lambda u, v: F.when(v > 0, u / v).otherwise(F.lit(math.inf))
    return s.select(*by, "n", ratio(F.col("_u"), F.col("_v")).alias("or_mh"), ratio(F.col("a") * F.col("d"), F.col("b") * F.col("c")).alias("or_crude"))


def codetection(df: DataFrame, x: str, y: str, stratum: str, *by: str) -> DataFrame:
    """(by, observed, expected): joint detections, and what independence within strata expects."""
    t = df.groupBy(*by, stratum).agg(F.count("*").alias("n"), F.sum(F.col(x).cast("int")).alias("nx"), F.sum(F.col(y).cast("int")).alias("ny"), F.sum((F.col(x).cast("int") * F.col(y).cast("int"))).alias("o"))
    return t.groupBy(*by).agg(F.sum("o").alias("observed"), F.sum(F.col("nx") * F.col("ny") / F.col("n")).alias("expected"))


def codetection_null(df: DataFrame, x: str, y: str, stratum: str, *by: str, perms: int = 1000, seed: int = 0) -> DataFrame:
    """(by, observed, mean, sd, p): joint detections against y shuffled within strata. A stratum's share of a shuffle is
    hypergeometric, so the strata's counts are all that a task needs. p is one-sided and counts the true order as one."""
    t = df.groupBy(*by, stratum).agg(F.count("*").alias("n"), F.sum(F.col(x).cast("int")).alias("nx"), F.sum(F.col(y).cast("int")).alias("ny"), F.sum((F.col(x).cast("int") * F.col(y).cast("int"))).alias("o"))
    types = dict(t.dtypes)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(stratum)
        rng = np.random.default_rng(seed)
        null = sum((rng.hypergeometric(a, n - a, b, perms) for n, a, b in zip(pdf["n"], pdf["nx"], pdf["ny"], strict=True)), np.zeros(perms, np.int64))
        o = int(pdf["o"].sum())
        return pdf[list(by)].head(1).assign(observed=o, mean=null.mean(), sd=null.std(), p=((null >= o).sum() + 1) / (perms + 1))

    return t.groupBy(*by).applyInPandas(one, "".join(f"`{c}` {types[c]}, " for c in by) + "observed long, mean double, sd double, p double")


def codetection_by_unit(df: DataFrame, x: str, y: str, stratum: str, unit: str, least: int = 3) -> DataFrame:
    """Per unit log(O / E) and its se; strata where a marginal is 0 don't count, nor units under least observed."""
    t = df.groupBy(unit, stratum).agg(F.count("*").alias("n"), F.sum(F.col(x).cast("int")).alias("nx"), F.sum(F.col(y).cast("int")).alias("ny"), F.sum((F.col(x).cast("int") * F.col(y).cast("int"))).alias("o")).filter("nx > 0 and ny > 0")
    t = t.groupBy(unit).agg(F.sum("o").alias("observed"), F.sum(F.col("nx") * F.col("ny") / F.col("n")).alias("expected")).filter(F.col("observed") >= least)
    return t.select(unit, "observed", "expected", F.log(F.col("observed") / F.col("expected")).alias("effect"), F.sqrt(1 / F.col("observed") + 1 / F.col("expected")).alias("se"))


def correlations(df: DataFrame, x: str, y: str, *by: str, least: int = 50) -> DataFrame:
    """(by, n, pearson, spearman) over rows with both values; null under least rows."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    r = average_rank(average_rank(both, x, *by, out="_rx"), y, *by, out="_ry")
    ok = F.count("*") >= least
    return r.groupBy(*by).agg(F.count("*").alias("n"), F.when(ok, F.corr(x, y)).alias("pearson"), F.when(ok, F.corr("_rx", "_ry")).alias("spearman"))


def kolmogorov(df: DataFrame, value: str, arm: str, *by: str) -> DataFrame:
    """(by, d): the largest gap of the arms' distribution functions."""
    n = W.partitionBy(*by)
    w = n.orderBy(value).rangeBetween(W.unboundedPreceding, 0)
    share = lambda c: F.sum(c.cast("int")).over(w) / F.sum(c.cast("int")).over(n)
    x = df.withColumn("_g", F.abs(share(F.col(arm)) - share(~F.col(arm))))
    return x.groupBy(*by).agg(F.max("_g").alias("d"))


def kruskal(df: DataFrame, value: str, group: str, *by: str) -> DataFrame:
    """(by, groups, h): the Kruskal-Wallis statistic with tie correction."""
    x = average_rank(df, value, *by, out="_r").withColumn("_t", F.count("*").over(W.partitionBy(*by, value)))
    g = x.groupBy(*by, group).agg(F.count("*").alias("n"), F.sum("_r").alias("r"), F.sum((F.col("_t") * F.col("_t") - 1).cast("double")).alias("ties"))
    s = g.groupBy(*by).agg(F.count("*").alias("groups"), F.sum("n").alias("n"), F.sum(F.col("r") * F.col("r") / F.col("n")).alias("r2"), F.sum("ties").alias("ties"))
    n = F.col("n").cast("double")
    h = (12 / (n * (n + 1)) * F.col("r2") - 3 * (n + 1)) / (1 - F.col("ties") / (n * n * n - n))
    return s.select(*by, "groups", h.alias("h"))


def fisher(df: DataFrame, x: str, y: str, *by: str) -> DataFrame:
    """(by, a, b, c, d, odds, p): the two-by-two table of flags x and y, its odds ratio and Fisher's exact p."""
    cell = lambda i, j: F.count_if((F.col(x).cast("int") == i) & (F.col(y).cast("int") == j))
    t = df.groupBy(*by).agg(cell(1, 1).alias("a"), cell(1, 0).alias("b"), cell(0, 1).alias("c"), cell(0, 0).alias("d"))
    cross = F.col("b") * F.col("c")
    return t.withColumn("odds", F.when(cross > 0, F.col("a") * F.col("d") / cross)).withColumn("p", tails.fisher_udf("a", "b", "c", "d"))


def more_than_half(df: DataFrame, flag: str, *by: str) -> DataFrame:
    """(by, k, n, p): how many rows have the flag, and the exact one-sided binomial p of so many or more at one half."""
    t = df.groupBy(*by).agg(F.count_if(F.col(flag)).alias("k"), F.count(flag).alias("n"))
    return t.withColumn("p", tails.binom_sf_udf("k", "n"))


def wilcoxon(df: DataFrame, first: str, second: str, *by: str) -> DataFrame:
    """(by, n, w, z, p): the signed-rank test of pairs. Zero differences go; ties share ranks; normal with tie correction."""
    x = df.withColumn("_d", F.col(first) - F.col(second)).filter("_d <> 0").withColumn("_a", F.abs("_d"))
    x = average_rank(x, "_a", *by, out="_r").withColumn("_t", F.count("*").over(W.partitionBy(*by, "_a")))
    t = x.groupBy(*by).agg(F.count("*").alias("n"), F.sum(F.when(F.col("_d") > 0, F.col("_r")).otherwise(0.0)).alias("w"), F.sum((F.col("_t") * F.col("_t") - 1).cast("double")).alias("_ties"))
    n = F.col("n").cast("double")
    sd = F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.col("_ties") / 48)
    z = F.when(sd > 0, (F.col("w") - n * (n + 1) / 4) / sd).otherwise(0.0)
    return t.withColumn("z", z).withColumn("p", two_sided(F.col("z"))).drop("_ties")


#: At most so many ranked genes (16 bytes each) are held by each task of enrichment().
MOST_GENES = 1_000_000


def enrichment(ranked: DataFrame, sets: DataFrame, low: int = 10, high: int = 500, perms: int = 1000, seed: int = 0, overlap: float = 0.3) -> DataFrame:
    """(term, size, es, p): the largest deviation of the running sum of |score| over genes by falling score, for each set.

    ranked: (gene, score), sets: (term, gene). Sets of low to high ranked genes count. p: of random sets of the size, the
    share as extreme on the same side. Fewer than the share overlap of the sets' genes among the ranked is an error (other
    symbols), and so are more than MOST_GENES.
    """
    genes = ranked.select("gene", "score").filter("score is not null")
    known = sets.select("gene").distinct()
    n, met = known.count(), known.join(genes, "gene", "left_semi").count()
    if n and met < overlap * n:
        raise ValueError(f"{met} of the sets' {n} genes are ranked")
    count = genes.count()
    if count > MOST_GENES:
        raise ValueError(f"{count} genes are too many to rank in a task")
    rows = genes.orderBy(F.col("score").desc(), "gene").collect()
    place = {r["gene"]: i for i, r in enumerate(rows)}
    held = ranked.sparkSession.sparkContext.broadcast((place, np.abs(np.array([r["score"] for r in rows], float))))

    def deviation(at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Of sets as rows of sorted places: just before a hit the sum is lowest, just after it highest."""
        w = weight[at]
        own = w.sum(1, keepdims=True)
        hit = np.divide(w.cumsum(1), own, out=np.zeros_like(w), where=own > 0)
        miss = (at - np.arange(at.shape[1])) / max(1, len(weight) - at.shape[1])
        gaps = np.concatenate([hit - miss, np.concatenate([np.zeros((len(at), 1)), hit[:, :-1]], 1) - miss], 1)
        return gaps[np.arange(len(at)), np.abs(gaps).argmax(1)]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        place, weight = held.value
        at = np.array(sorted({place[g] for g in pdf["gene"] if g in place}), int)
        if not low <= len(at) <= high or len(at) >= len(weight):
            return pd.DataFrame({"term": [], "size": [], "es": [], "p": []}).astype({"term": "object", "size": "int64"})
        es = float(deviation(at[None, :], weight)[0])
        rng = np.random.default_rng(seed)
        null = np.concatenate([deviation(np.sort(rng.random((min(50, perms - i), len(weight))).argpartition(len(at), 1)[:, : len(at)], 1), weight) for i in range(0, perms, 50)])
        side = null[null > 0] if es > 0 else -null[null < 0]
        return pd.DataFrame({"term": [str(pdf["term"].iat[0])], "size": [len(at)], "es": [es], "p": [float(((side >= abs(es)).sum() + 1) / (len(side) + 1))]})

    return sets.select("term", "gene").groupBy("term").applyInPandas(one, "term string, size long, es double, p double")


# ---- verdicts


def reproducible(df: DataFrame, value: str, arm: str, donor: str, *by: str, least: int = 10, agree: int = 3) -> DataFrame:
    """Per key how many donors can be estimated (least cells an arm), how many go up and down, and whether agree of them agree."""
    x = effects(arm_sums(df, value, arm, *by, donor), least)
    x = x.groupBy(*by).agg(F.count("effect").alias("estimable"), F.count_if(F.col("effect") > 0).alias("up"), F.count_if(F.col("effect") < 0).alias("down"))
    return x.withColumn("reproducible", ((F.col("up") >= agree) | (F.col("down") >= agree)) & (F.col("estimable") >= agree))


def leave_one_out(df: DataFrame, value: str, arm: str, unit: str, *by: str, z: float = 1.96, least: int = 3) -> DataFrame:
    """Effects without each unit, by subtraction of its sums: robust (all stay significant in one direction), fragile, unresolved."""
    per = arm_sums(df, value, arm, *by, unit)
    w = W.partitionBy(*by)
    for c in ("n1", "s1", "q1", "n0", "s0", "q0"):
        per = per.withColumn(c, F.sum(c).over(w) - F.col(c))
    x = effects(per, least).groupBy(*by).agg(F.count("*").alias("folds"), F.count("z").alias("decided"), F.count_if(F.abs("z") >= z).alias("significant"), F.count_if(F.col("effect") > 0).alias("up"))
    same = (F.col("up") == F.col("decided")) | (F.col("up") == 0)
    return x.withColumn("verdict", F.when(F.col("decided") < 2, "unresolved").when((F.col("significant") == F.col("decided")) & same, "robust").otherwise("fragile"))


def restriction(effects_: DataFrame, z: float = 1.96) -> DataFrame:
    """Per (gene, class) with effect, se: affected, genuinely null or underpowered, by what could be detected.

    The reference is the median size of the significant effects; 2.802 se is detected with 80% power.
    """
    ref = effects_.filter(F.abs(F.col("effect") / F.col("se")) >= z).agg(F.percentile(F.abs("effect"), 0.5).alias("_ref"))
    x = effects_.filter("se > 0").crossJoin(F.broadcast(ref)).withColumn("mde", 2.802 * F.col("se"))  # one row
    return x.withColumn("verdict", F.when(F.abs(F.col("effect") / F.col("se")) >= z, "affected").when(F.col("mde") <= F.col("_ref"), "genuinely_null").otherwise("underpowered")).drop("_ref")


def ci_verdict(effects_: DataFrame, reference: Column, z: float = 1.96) -> DataFrame:
    """affected, genuinely null (the interval lies within the reference), underpowered or not estimable."""
    e, s = F.col("effect"), F.col("se")
    return effects_.withColumn("verdict", F.when(e.isNull() | s.isNull() | (s <= 0), "not_estimable").when(F.abs(e) > z * s, "affected").when(F.abs(e) + z * s < reference, "genuinely_null").otherwise("underpowered"))


def gene_direction(effects_: DataFrame, z: float = 1.96) -> DataFrame:
    """Over classes: confident calls up and down, net, and increasing, decreasing or mixed."""
    sure = F.abs(F.col("z")) >= z
    x = effects_.groupBy("gene").agg(F.count_if(sure & (F.col("effect") > 0)).alias("n_up"), F.count_if(sure & (F.col("effect") < 0)).alias("n_down"), F.avg(F.when(sure, F.col("effect"))).alias("mean_effect")).filter("n_up + n_down > 0")
    return x.withColumn("net", F.col("n_up") - F.col("n_down")).withColumn("direction", F.when(F.col("n_down") == 0, "increasing").when(F.col("n_up") == 0, "decreasing").otherwise("mixed"))
