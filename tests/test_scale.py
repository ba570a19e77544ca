"""Steps that must neither grow with the square of a gene's isoforms nor lose what they replace."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from spliceframe.functions import tails
from spliceframe.operators import effects, models, usage
from spliceframe.plans import QUERIES
from spliceframe.plans.carriers import Carriers


def test_beta_regression_from_sums(spark):
    """Against finite differences of the likelihood over rows; fractions that are all 1 have no effect, a null makes a group fail."""
    rng = np.random.default_rng(1)
    arm = np.arange(60) % 3 == 0
    fits = {g: (rng.beta(2 + g * arm, 3), arm) for g in range(4)}
    rows = [(g, float(v), bool(a)) for g, (y, x) in fits.items() for v, a in zip(y, x, strict=True)]
    rows += [(7, 1.0, i < 11) for i in range(27)] + [(8, 0.5, True)] * 3 + [(9, 0.2, True), (9, 0.4, False), (9, None, True)]
    df = spark.createDataFrame(rows, "g int, v double, a boolean")
    got = {r.g: (r.z, r.p) for r in models.beta_regression(df, "v", "a", "g").collect()}
    assert set(got) == {*range(4), 7, 8, 9} and got[8] == got[9] == (0.0, 1.0)
    assert got[7] == pytest.approx((0, 1), abs=1e-6)
    for g, (y, x) in fits.items():
        n = np.array([[(~x).sum(), x.sum()]], float)
        low, high = (np.array([[f(y[~x]).sum(), f(y[x]).sum()]]) for f in (np.log, lambda v: np.log1p(-v)))

        def loglik(w, y=y, x=x):
            mu, phi = 1 / (1 + np.exp(-w[0] - w[1] * x)), np.exp(w[2])
            return float((tails.lgamma(phi) - tails.lgamma(mu * phi) - tails.lgamma((1 - mu) * phi) + (mu * phi - 1) * np.log(y) + ((1 - mu) * phi - 1) * np.log1p(-y)).sum())

        w, h, e = np.array([0.1, 0.3, 1.2]), 1e-4, np.eye(3)
        slope, second = models._beta_slopes(w[None], n, low, high)
        assert slope[0] == pytest.approx([(loglik(w + h * d) - loglik(w - h * d)) / (2 * h) for d in e], rel=1e-5)
        assert second[0] == pytest.approx(np.array([[(loglik(w + h * (a + b)) - loglik(w + h * (a - b)) - loglik(w + h * (b - a)) + loglik(w - h * (a + b))) / (4 * h * h) for b in e] for a in e]), rel=1e-4, abs=1e-4)
        assert np.sign(got[g][0]) == np.sign(y[x].mean() - y[~x].mean())
        assert got[g][1] == pytest.approx(2 * float(tails.norm_sf(abs(got[g][0]))))


def test_partition_of_sparse_profiles(spark):
    """Overlaps give the distances of whole profiles, and the partition the same as on arrays; isoforms that profiles lack have no rows."""
    rng = np.random.default_rng(2)
    rows = [(str(c), d, f, float(rng.random())) for c in "abc" for d in range(4) for f in range(40) if rng.random() < 0.4]
    df = spark.createDataFrame(rows, "class string, donor long, feature_id long, usage double").selectExpr("'g' AS gene", "*")
    lists = models.by_isoform(df, models.profile_id("class", "donor"), "gene")
    units = df.select("class", "donor", models.profile_id("class", "donor").alias("_u")).distinct()
    got = models.permanova_of_sums(models.profile_sums(lists, "gene").join(units, "_u"), models.profile_overlaps(lists, "gene"), ["class", "donor"], "gene")
    want = models.permanova(models.cell_profile_arrays(df, "class", "donor"), ["class", "donor"], "gene")
    key = lambda x: {r.factor: (r.n, r.r2, r.omega2) for r in x.collect()}
    got, want = key(got), key(want)
    assert set(got) == set(want) == {"class", "donor"}
    for f in got:
        assert got[f] == pytest.approx(want[f], abs=1e-9)


def test_eigenvalues_by_block():
    """40,000 isoforms in small blocks, whose matrix would take 12.8 GB, and one block against the dense matrix."""
    rng = np.random.default_rng(3)
    n, i, j = 40_000, np.arange(0, 40_000, 2), np.arange(1, 40_000, 2)
    got = usage.block_eigenvalues(n, np.r_[i, j, i, j], np.r_[i, j, j, i], np.r_[np.full(n, 2.0), np.full(n, 0.5)])
    assert sorted(got)[::10_000] == pytest.approx([1.5, 1.5, 2.5, 2.5])
    edges = {(int(a), int(b)) for a, b in rng.integers(0, 60, (35, 2))}
    dense = np.zeros((60, 60))
    for a, b in edges:
        dense[a, b] = dense[b, a] = a + b + 1
    i, j = np.nonzero(dense + np.eye(60))
    assert sorted(usage.block_eigenvalues(60, i, j, dense[i, j])) == pytest.approx(np.linalg.eigvalsh(dense), abs=1e-9)


def shuffled(spark):
    """Bytes that shuffles have written so far."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    executors = sc.statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def test_one_vs_rest_shuffles_no_cells(spark):
    """Cells with one isoform of a gene are tallied where they lie: rows are shuffled to find them, and not three times more."""
    rows = spark.range(200_000).selectExpr("id AS cell_id", "'g' || id % 4 AS gene", "pmod(hash(id), 40) * 4 + id % 4 AS feature_id", "1 + pmod(hash(id, 7), 5) AS count", "1.0D AS fraction")
    obs = spark.range(200_000).selectExpr("id AS cell_id", "'c' || pmod(hash(id, 3), 3) AS class")
    start = shuffled(spark)
    rows.repartition("cell_id", "gene").write.format("noop").mode("overwrite").save()
    once = shuffled(spark) - start
    got = models.one_vs_rest(rows, obs, "class").filter("tested").select("of", "gene", "dm_stat").distinct().collect()
    assert len(got) == 12
    assert shuffled(spark) - start - once < 3 * once


def test_one_vs_rest_of_pooled_isoforms(spark):
    """Cells with one and with several isoforms, whose rare isoforms are one slot, against fits of the pooled matrix; a gene of one isoform is not tested."""
    rng = np.random.default_rng(4)
    matrix = np.stack([rng.multinomial(rng.integers(1, 7), rng.dirichlet(np.r_[4, 3, 2, np.full(5, 0.3)] if c % 2 else np.r_[1, 3, 4, np.full(5, 0.3)])) for c in range(150)])
    rows = [(c, f, "g", int(n), float(n / matrix[c].sum())) for c in range(150) for f, n in enumerate(matrix[c]) if n] + [(c, 99, "h", 3, 1.0) for c in range(150)]
    df = spark.createDataFrame(rows, "cell_id long, feature_id long, gene string, count long, fraction double")
    obs = spark.createDataFrame([(c, f"c{c % 3}") for c in range(150)], "cell_id long, class string")
    order = sorted(range(8), key=lambda f: (-matrix[:, f].sum(), f))
    pooled = np.column_stack([matrix[:, order[:3]], matrix[:, order[3:]].sum(1)])
    assert ((matrix > 0).sum(1) == 1).sum() > 20 and (pooled[:, 3] > matrix[:, order[3:]].max(1)).any()
    got = {(r.gene, r.of): (r.dm_stat, r.dm_pval) for r in models.one_vs_rest_fits(df, obs, "class", max_isoforms=4).collect()}
    assert set(got) == {("g", "c0"), ("g", "c1"), ("g", "c2")}
    for (_, of), result in got.items():
        own = np.array([f"c{c % 3}" == of for c in range(150)])
        assert result == pytest.approx(models.dm_test(pooled[own], pooled[~own]), abs=1e-6)
    whole = models.one_vs_rest(df, obs, "class", max_isoforms=4)
    assert {(r.gene, r.of): (r.dm_stat, r.dm_pval) for r in whole.filter("tested").collect()} == got
    assert {(r.of, r.n_cells_group, r.n_cells_ref) for r in whole.filter(F.col("gene") == "g").collect()} == {(f"c{i}", 50, 100) for i in range(3)}


def test_ranks_against_the_rest(spark):
    """From a tally of counts, against mann_whitney() of every group's cells and all others, zeros filled in; a gene that all cells share evenly is one tie."""
    rng = np.random.default_rng(5)
    of = {c: f"c{rng.integers(0, 3)}" for c in range(90)}
    counts = {(c, g): int(rng.poisson(1 + (g == "a") * (of[c] == "c1"))) for c in of for g in "ab"} | {(c, "even"): 2 for c in of}
    rows = spark.createDataFrame([(of[c], g, v) for (c, g), v in counts.items() if v], "class string, gene string, s long")
    tally = rows.groupBy("class", "gene", "s").agg(F.count("*").alias("c"))
    n = {k: sum(v == k for v in of.values()) for k in set(of.values())}
    sizes = spark.createDataFrame([(k, v, 90 - v) for k, v in n.items()], "class string, n1 long, n0 long")
    got = {(r["class"], r.gene): r for r in effects.rest_ranks(tally, sizes, "s", "c", "class", "gene").collect()}
    assert set(got) == {(k, g) for k in n for g in ("a", "b", "even")}
    for k in n:
        filled = spark.createDataFrame([(g, float(v), of[c] == k) for (c, g), v in counts.items()], "gene string, v double, own boolean")
        for want in effects.mann_whitney(filled, "v", "own", "gene").collect():
            r = got[k, want.gene]
            assert (r.n1, r.n0, r.u, r.z) == pytest.approx((want.n1, want.n0, want.u, want.z))
    assert got["c1", "a"].z > 2 and got["c1", "even"].z == 0


def test_one_vs_rest_is_tested(spark):
    """The adjusted p of j17_one_vs_rest is that of ranks against the rest, not a number made of the sums."""
    c = Carriers(spark, "/root/testdata/sf0.001")
    rows = {(r["class"], r.gene): r.padj for r in QUERIES["j17_one_vs_rest"](spark, c.dir).collect()}
    x = c.counts.join(c.var.select("feature_id", F.col("fine").alias("gene")), "feature_id").groupBy("cell_id", "gene").agg(F.sum("count").alias("v")).toPandas()
    of = c.obs.select("cell_id", "class").toPandas().set_index("cell_id")["class"]
    wide = x.pivot(index="cell_id", columns="gene", values="v").reindex(of.index).fillna(0)
    k = of.iloc[0]
    n1, n0 = (of == k).sum(), (of != k).sum()
    ps = {}
    for gene in wide.columns:
        if (wide.loc[of == k, gene] > 0).any():
            ranks, ties = wide[gene].rank(), wide[gene].value_counts()
            gap = abs(ranks[of == k].sum() - n1 * (n1 + 1) / 2 - n1 * n0 / 2) - 0.5
            ps[gene] = 2 * float(tails.norm_sf(max(0, gap) / np.sqrt(n1 * n0 / 12 * (n1 + n0 + 1 - (ties**3 - ties).sum() / (n1 + n0) / (n1 + n0 - 1)))))
    order, least = sorted(ps, key=ps.get), 1.0
    for i in range(len(order), 0, -1):
        least = min(least, ps[order[i - 1]] * len(order) / i)
        assert rows[k, order[i - 1]] == pytest.approx(least, abs=2e-6)


def test_permanova_splits_the_interaction(spark, tmp_path):
    """s45_permanova tells the interaction of class and donor from the error by the tubes of a donor, as permanova() of arrays does."""
    for t in ("nation", "region", "part", "orders", "lineitem", "customer"):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
        if t == "part":  # two genes, so that every tube has cells with them
            df = df.withColumn("p_brand", F.lit("b")).withColumn("p_type", F.when(F.col("p_partkey") % 2 == 0, "x").otherwise("y"))
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    got = {(r.gene, r.factor): (r.n, r.r2, r.omega2) for r in QUERIES["s45_permanova"](spark, str(tmp_path)).collect()}
    assert {f for _, f in got} == {"class", "donor", "interaction"}
    c = Carriers(spark, str(tmp_path))
    x = usage.mean_usage(c.fractions, c.obs, ["class", "donor", "tube"], 2, 2)
    want = {(r.gene, r.factor): (r.n, r.r2, r.omega2) for r in models.permanova(models.cell_profile_arrays(x, "class", "donor", "tube"), ["class", "donor"], "gene").collect()}
    assert set(got) == set(want)
    for k in got:
        assert got[k] == pytest.approx(want[k], abs=2e-6)


def test_shannon_of_large_blocks():
    """A chain of 20,000 isoforms, whose eigenvalues are known and whose matrix would take 3.2 GB, and random blocks with rings against the dense eigenvalues."""
    n = 20_000
    i, j = np.arange(n - 1), np.arange(1, n)
    got = usage.block_shannon(n, np.r_[np.arange(n), i, j], np.r_[np.arange(n), j, i], np.r_[np.full(n, 2.0), np.ones(2 * n - 2)] / (2 * n))
    p = (2 + 2 * np.cos(np.arange(1, n + 1) * np.pi / (n + 1))) / (2 * n)
    assert got == pytest.approx(-(p * np.log2(p)).sum(), abs=1e-8)
    rng = np.random.default_rng(6)
    for links in (0.7, 1.0, 1.8):
        cells = [rng.choice(500, 2, replace=False) for _ in range(int(500 * links))] + [[f] for f in rng.integers(0, 500, 300)]
        x = np.zeros((len(cells), 500))
        for c, fs in enumerate(cells):
            x[c, fs] = rng.dirichlet(np.ones(len(fs)))
        gram = x.T @ x / (x * x).sum()
        i, j = np.nonzero(gram)
        p = np.linalg.eigvalsh(gram)
        p = p[p > 1e-12]
        assert usage.block_shannon(500, i, j, gram[i, j], dense=8) == pytest.approx(-(p * np.log2(p)).sum(), abs=1e-8)


def test_groups_of_isoforms_lie_together(spark):
    """A group's isoforms are written by a quarter of the 4 tasks, so that a pair of its profiles is shuffled once and not by all; and as Parquet."""
    rows = spark.range(4000).selectExpr("'g' || id % 3 AS gene", "id AS feature_id", "id % 7 AS u", "1.0D AS usage")
    lists = models.by_isoform(rows, F.col("u"), "gene")
    places = {(r.gene, r.f) for r in lists.select("gene", F.input_file_name().alias("f")).collect()}
    assert len(places) == 3 and {g for g, _ in places} == {"g0", "g1", "g2"} and lists.count() == 4000
    assert all(f.endswith(".zstd.parquet") for _, f in places)
