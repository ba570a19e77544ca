"""Hand-computed values and invariants."""

import math
import time

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spliceframe.functions import tails
from spliceframe.operators import effects, models, tables, usage
from spliceframe.sources import files


def counts(spark):
    return spark.createDataFrame([(1, 10, 3), (1, 11, 1), (1, 20, 5), (2, 10, 2), (2, 21, 2), (2, 20, 2)], "cell_id long, feature_id long, count long")


def genes(spark):
    return spark.createDataFrame([(10, "a"), (11, "a"), (20, "b"), (21, "b")], "feature_id long, gene string")


def test_fractions_sum_to_one(spark):
    x = usage.isoform_fractions(counts(spark), genes(spark))
    assert {(r.cell_id, r.feature_id): r.fraction for r in x.collect()} == {(1, 10): 0.75, (1, 11): 0.25, (1, 20): 1.0, (2, 10): 1.0, (2, 21): 0.5, (2, 20): 0.5}
    assert all(abs(r.s - 1) < 1e-12 for r in x.groupBy("cell_id", "gene").agg(F.sum("fraction").alias("s")).collect())


def test_entropies(spark):
    p = spark.createDataFrame([("x", "g", i, 0.25, 4) for i in range(4)], "class string, gene string, feature_id long, usage double, n_expr long")
    assert usage.shannon(p, ["class"]).first().h == 2
    for alpha in (2.0, 1.0, 0.5, math.inf):
        assert usage.renyi(p, ["class"], alpha).first().h == pytest.approx(2)
    one = usage.tau(spark.createDataFrame([("g", 1.0), ("g", 0.0), ("g", 0.0)], "gene string, usage double"), ["gene"]).first()
    assert one.tau == 1


def test_identity_closes(spark):
    x = usage.identity_parts(usage.cell_gene_entropy(usage.isoform_fractions(counts(spark), genes(spark))))
    for r in x.filter("m is not null").collect():
        assert abs(r.d * r.m - r.h_unc) < 1e-9


def test_benjamini_hochberg(spark):
    df = spark.createDataFrame([(0.01,), (0.04,), (0.03,), (None,)], "p double")
    one = {r.p: r.padj for r in tables.adjusted(df, "p").collect()}
    assert one[0.01] == pytest.approx(0.04) and one[0.04] == pytest.approx(0.04 * 4 / 3) and one[None] == 1
    keep = {r.p: r.padj for r in tables.adjusted(df, "p", nulls="keep").collect()}
    assert keep[0.01] == pytest.approx(0.03) and keep[0.03] == pytest.approx(0.04) and keep[None] is None


def test_tails():
    assert tails.chi2_sf(3.0, 2) == pytest.approx(math.exp(-1.5), rel=1e-12)
    assert tails.t_sf(1.0, 1) == pytest.approx(0.25, rel=1e-12)
    assert tails.norm_sf(1.959963984540054) == pytest.approx(0.025, rel=1e-9)
    assert tails.digamma(np.array([1.0]))[0] == pytest.approx(-0.5772156649015329, abs=1e-12)
    assert tails.binom_two_sided(0, 5) == pytest.approx(2 / 32)


@settings(max_examples=30, deadline=None)
@given(st.floats(0.1, 30), st.integers(1, 60))
def test_t_tail_is_symmetric(t, df):
    assert float(tails.t_sf(t, df)) + float(tails.t_sf(-t, df)) == pytest.approx(1)


def test_cliff_is_antisymmetric(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, True), (2.0, False), (3.0, False), (0.5, False)], "v double, arm boolean")
    a = effects.mann_whitney(df, "v", "arm").first()
    b = effects.mann_whitney(df.withColumn("arm", ~F.col("arm")), "v", "arm").first()
    assert a.cliff == pytest.approx(-b.cliff) and a.u + b.u == a.n1 * a.n0


def test_implicit_zeros_equal_explicit(spark):
    rows = [("g", float(v), a) for v, a in ((1, True), (2, True), (3, False), (1, False))]
    sizes = spark.createDataFrame([(4, 5)], "n1 long, n0 long")
    full = rows + [("g", 0.0, True)] * 2 + [("g", 0.0, False)] * 3
    schema = "gene string, v double, arm boolean"
    a = effects.mann_whitney(spark.createDataFrame(rows, schema), "v", "arm", "gene", sizes=sizes).first()
    b = effects.mann_whitney(spark.createDataFrame(full, schema), "v", "arm", "gene").first()
    assert (a.u, a.cliff) == pytest.approx((b.u, b.cliff)) and a.z == pytest.approx(b.z)


def test_dm_fit_is_a_maximum():
    rng = np.random.default_rng(0)
    x = np.array([rng.multinomial(30, rng.dirichlet([2, 5, 1])) for _ in range(400)])
    alpha, value = models.dm_fit(x)
    assert alpha == pytest.approx([2, 5, 1], rel=0.25)
    for i in range(3):
        for d in (-0.05, 0.05):
            theta = np.log(alpha)
            theta[i] += d
            assert models.dm_loglik(theta, x)[0] <= value + 1e-6
    _, slope = models.dm_loglik(np.log(alpha), x)
    assert np.abs(slope).max() < 0.05 * len(x)
    assert models.dm_test(x[:200], x[200:])[1] > 1e-4


def test_skipping_equals_triple_join(spark):
    rng = np.random.default_rng(1)
    rows = {("g", "t", int(a), int(a + b)) for a, b in zip(rng.integers(0, 15, 60), rng.integers(1, 9, 60), strict=True)}
    j = spark.createDataFrame(sorted(rows), "gene string, tissue string, start long, end long")
    got = {(r.start, r.end) for r in tables.skipping(j).collect()}
    want = {(s, e) for *_, s, e in rows if any(a[2] == s and a[3] < e and b[3] == e and b[2] > s and a[3] < b[2] for a in rows for b in rows)}
    assert got == want
    skips = tables.skipping(j)
    left = {(r.start, r.end) for r in tables.cassettes(skips, j).collect()}
    naive = {(r.start, r.end) for r in skips.collect() if not any(a >= r.near_end and b <= r.far_start for *_, a, b in rows)}
    assert left == naive


def test_lpt():
    assert tables.lpt_shards([("a", 5), ("b", 4), ("c", 3), ("d", 3)], 2) == [("a", 0), ("b", 1), ("d", 1), ("c", 0)]
    with pytest.raises(ValueError):
        tables.lpt_shards([("a", 1)], 2)


def test_mtx_and_bundle(spark, tmp_path):
    (tmp_path / "matrix.mtx").write_text("%%MatrixMarket\n% c\n2 2 3\n1 1 4\n2 1 1\n2 2 7\n")
    (tmp_path / "features.tsv").write_text("F1\tx\nF2\ty\n")
    (tmp_path / "barcodes.tsv").write_text("AA\nCC\n")
    x = files.read_mtx(spark, str(tmp_path))
    assert {tuple(r) for r in x.collect()} == {("AA", "F1", 4), ("AA", "F2", 1), ("CC", "F2", 7)}
    b = files.Bundle(x, spark.createDataFrame([("AA",)], "cell_id string"), spark.createDataFrame([("F1",)], "feature_id string"))
    b.write(str(tmp_path / "b"))
    assert files.Bundle.read(spark, str(tmp_path / "b")).counts.count() == 3
    files.write_new(x.limit(1), str(tmp_path / "b" / "counts"))
    assert spark.read.parquet(str(tmp_path / "b" / "counts")).count() == 3
    assert files.kept(x, str(tmp_path / "k")).count() == 3 and files.kept(x.limit(0), str(tmp_path / "k")).count() == 3


def test_tables_by_name(spark, tmp_path):
    for s in ("liver", "lung"):
        (tmp_path / f"{s}.tsv").write_text("id\tx\n1\tNA\n2\t3\n")
    x = files.read_tagged(spark, str(tmp_path / "*.tsv"), ["id", "x"], r"([a-z]+)\.tsv")
    assert {(r.sample, r.id, r.x) for r in x.collect()} == {(s, i, v) for s in ("liver", "lung") for i, v in (("1", None), ("2", "3"))}
    with pytest.raises(ValueError, match="no columns"):
        files.read_strings(spark, str(tmp_path / "lung.tsv"), ["nope"])
    with pytest.raises(ValueError, match="repeats"):
        files.sample_sheet(x, "id")


def test_streams(spark, tmp_path):
    from spliceframe.streaming.reads import molecules, running_counts

    rows = [(f"2024-01-01 00:0{i}:00", "c1", u) for i, u in enumerate(["a", "a", "b", "-"])]
    spark.createDataFrame(rows, "ts string, cb string, umi string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, cb string, umi string").parquet(str(tmp_path / "in"))
    for f, mode, n in ((molecules, "append", 2), (running_counts, "complete", 1)):
        q = f(stream).writeStream.outputMode(mode).format("memory").queryName(f.__name__).start()
        q.processAllAvailable()
        q.stop()
        assert spark.table(f.__name__).count() == n


def test_thinning_reaches_target(spark):
    x = spark.range(200).select(F.lit(1).alias("cell_id"), F.col("id").alias("feature_id"), F.lit(100).cast("long").alias("count"))
    total = models.thinned(x, 5000).agg(F.sum("count")).first()[0]
    assert abs(total - 5000) < 400


def brute_dm(x):
    """The maximum of the Dirichlet-multinomial likelihood cell by cell, by golden sections along each log alpha in turn."""
    x = x[x.sum(1) > 0]
    lg = math.lgamma

    def f(theta):
        a = [math.exp(t) for t in theta]
        return sum(lg(sum(a)) - lg(r.sum() + sum(a)) + sum(lg(c + b) - lg(b) for c, b in zip(r, a, strict=True)) for r in x)

    theta, best, step = [0.0] * x.shape[1], -math.inf, 2.0
    best = f(theta)
    moves = [*np.eye(len(theta)), np.ones(len(theta))]
    while step > 1e-4:
        tries = [np.clip(np.array(theta) + s * step * d, math.log(1e-8), math.log(1e8)) for d in moves for s in (1, -1)]
        values = [f(t) for t in tries]
        if max(values) > best:
            best, theta = max(values), list(tries[int(np.argmax(values))])
        else:
            step /= 2
    return best


def test_dm_loglik_cell_by_cell():
    rng = np.random.default_rng(3)
    x = rng.poisson(0.8, (40, 5))
    x[0] = 0
    theta = rng.normal(0, 1, 5)
    a = np.exp(theta)
    want = sum(math.lgamma(a.sum()) - math.lgamma(r.sum() + a.sum()) + sum(math.lgamma(c + b) - math.lgamma(b) for c, b in zip(r, a, strict=True)) for r in x)
    assert models.dm_loglik(theta, x)[0] == pytest.approx(want, rel=1e-12)
    for few in (x[:12, :3], x[12:30, :2]):
        assert models.dm_fit(few)[1] == pytest.approx(brute_dm(few), abs=1e-3)


class Fixture:
    """Carriers of 120 cells in two classes and three genes of two brands, of two isoforms each."""

    def __init__(self, spark):
        rng = np.random.default_rng(7)
        self.rows = [(c, 10 * g + i, f"Brand#{(1, 4, 7)[g]}/X", int(n), None) for c in range(120) for g in range(3) for i, n in enumerate(rng.multinomial(6, rng.dirichlet([2, 2 + 3 * (g == 1 and c % 2)]))) if n]
        total = {}
        for c, _, g, n, _ in self.rows:
            total[c, g] = total.get((c, g), 0) + n
        self.rows = [(c, f, g, n, n / total[c, g]) for c, f, g, n, _ in self.rows]
        self.cells = {c: ("u" if c < 60 else "v", c % 2 == 1) for c in range(120)}
        self.fractions = spark.createDataFrame(self.rows, "cell_id long, feature_id long, gene string, count long, fraction double")
        self.obs = spark.createDataFrame([(c, k, a) for c, (k, a) in self.cells.items()], "cell_id long, class string, arm boolean")
        self.var = spark.createDataFrame(sorted({(f, g) for _, f, g, *_ in self.rows}), "feature_id long, fine string")

    def statistics(self, keep, group):
        """(gene: likelihood ratio) over the cells of keep, by brute force."""
        out = {}
        for g in sorted({r[2] for r in self.rows}):
            mine = [r for r in self.rows if r[2] == g and keep(r[0])]
            at, iso = sorted({r[0] for r in mine}), sorted({r[1] for r in mine})
            x = np.zeros((len(at), len(iso)))
            for r in mine:
                x[at.index(r[0]), iso.index(r[1])] = r[3]
            arm = np.array([group(c) for c in at])
            out[g] = max(0.0, 2 * (brute_dm(x[arm]) + brute_dm(x[~arm]) - brute_dm(x)))
        return out


def test_every_gene_is_fitted(spark, monkeypatch):
    """s10, s11 and s04 cover genes of all brands, and p is adjusted over all of them."""
    from spliceframe.plans import QUERIES, registry

    c = Fixture(spark)
    monkeypatch.setattr(registry, "Carriers", lambda *_: c)
    for name, of, split in (("s10_usage_dm_by_class", "class", lambda v: (lambda i: c.cells[i][0] == v, lambda i: c.cells[i][1])), ("s11_one_vs_rest", "of", lambda v: (lambda i: True, lambda i: c.cells[i][0] == v))):
        got = {(r[of], r.gene): (r.dm_stat, r.dm_padj) for r in QUERIES[name](spark, "").collect()}
        assert len(got) == 6
        for v in ("u", "v"):
            stat = c.statistics(*split(v))
            p = sorted((math.exp(-s / 2), g) for g, s in stat.items())  # chi-squared, two isoforms
            for i, (_, g) in enumerate(p):
                assert got[v, g] == pytest.approx((stat[g], min(1.0, *(q * len(p) / (j + 1) for j, (q, _) in enumerate(p) if j >= i), 1.0)), abs=3e-3)
    got = {r.feature_id: (r.z, r.p) for r in QUERIES["s04_beta_regression"](spark, "").collect()}
    one = c.fractions.join(c.obs, "cell_id")
    assert set(got) == {r[1] for r in c.rows}
    for f in got:
        y = np.array([r.fraction for r in one.filter(F.col("feature_id") == f).collect()])
        assert len(y) and 0 <= got[f][1] <= 1 and np.isfinite(got[f][0])
    again = {r.feature_id: round(r.z, 4) + 0.0 for r in models.beta_regression(one, "fraction", "arm", "feature_id").collect()}
    assert {f: z for f, (z, _) in got.items()} == again


def test_cliffs_delta_of_every_gene(spark):
    """Pair by pair, for all genes whose cells are in both arms."""
    from spliceframe.plans import QUERIES
    from spliceframe.plans.carriers import Carriers
    from spliceframe.plans.q_effects import entropies

    d = "/root/testdata/sf0.001"
    cells = {}
    for r in entropies(Carriers(spark, d)).collect():
        cells.setdefault(r.gene, {True: [], False: []})[r.arm].append(round(r.h, 12))
    want = {g: np.sign(np.subtract.outer(a[True], a[False])).mean() for g, a in cells.items() if a[True] and a[False]}
    assert len(want) > 3 and {r.gene: r.cliff for r in QUERIES["s23_cliffs_delta"](spark, d).collect()} == pytest.approx(want, abs=1e-6)


def junctions_fixture(spark):
    """Isoforms with ids far apart: 7 and 5007 have one structure each in two tissues."""
    from types import SimpleNamespace

    rows = [(g, t, 1, 9, i) for g, i in (("g", 7), ("h", 5007)) for t in "AR"] + [("h", "N", 2, 8, 5008)]
    return SimpleNamespace(spark=spark, junctions=spark.createDataFrame(rows, "gene string, tissue string, start long, end long, isoform long"))


def test_structures_of_every_isoform(spark, monkeypatch):
    from spliceframe.plans import QUERIES, registry

    c = junctions_fixture(spark)
    monkeypatch.setattr(registry, "Carriers", lambda *_: c)
    assert sorted(tuple(r) for r in QUERIES["j13_structure_match"](spark, "").collect()) == [("g", "1", 2), ("h", "1", 2)]
    assert sorted(tuple(r) for r in QUERIES["a20_global_ids"](spark, "").collect()) == [("A", 7, "PB.sync.1"), ("A", 7, "PB.sync.2"), ("N", 8, "PB.sync.3"), ("R", 7, "PB.sync.1"), ("R", 7, "PB.sync.2")]


def test_sources_and_joins_of_every_isoform(spark, monkeypatch):
    from spliceframe.plans import QUERIES, registry
    from spliceframe.plans.carriers import Carriers

    d = "/root/testdata/sf0.001"
    all_counts = Carriers(spark, d).counts.agg(F.sum("count")).first()[0]
    x = QUERIES["j04_full_outer"](spark, d).agg(*(F.sum(n) for n in "abk")).first()
    assert min(x) > 0 and sum(x) == all_counts == QUERIES["j05_lookup"](spark, d).agg(F.sum("a")).first()[0]
    assert QUERIES["w13_ordered"](spark, d).count() == Carriers(spark, d).var.count()
    c = junctions_fixture(spark)
    monkeypatch.setattr(registry, "Carriers", lambda *_: c)
    assert {r.transcript_id: r.exons for r in QUERIES["io08_gff_transcripts"](spark, "").collect()} == {"T7": "1-9", "T5007": "1-9", "T5008": "2-8"}
    assert sorted(tuple(r) for r in QUERIES["io12_rewrite_attributes"](spark, "").collect()) == [(0, 1), (1, 2)]


def test_codetection_null_matches_shuffles(spark):
    rng = np.random.default_rng(0)
    x, y, s = rng.integers(0, 2, 400), rng.integers(0, 2, 400), rng.integers(0, 4, 400)
    df = spark.createDataFrame([(1, int(a), int(b), int(c)) for a, b, c in zip(x, y, s, strict=True)], "k int, x int, y int, s int")
    r = effects.codetection_null(df, "x", "y", "s", "k", perms=4000).first()
    null = []
    for _ in range(2000):
        z = y.copy()
        for c in range(4):
            z[s == c] = rng.permutation(z[s == c])
        null.append((x & z).sum())
    assert r.observed == (x & y).sum() and r["mean"] == pytest.approx(np.mean(null), abs=0.7) and r.sd == pytest.approx(np.std(null), rel=0.15)


def test_enrichment(spark):
    rng = np.random.default_rng(1)
    score = np.sort(rng.normal(size=200))[::-1]
    sets = {"top": list(range(0, 40, 2)), "any": sorted(rng.choice(200, 30, replace=False).tolist()), "small": [1, 2]}
    ranked = spark.createDataFrame([(f"g{i}", float(v)) for i, v in enumerate(score)], "gene string, score double")
    df = spark.createDataFrame([(t, f"g{i}") for t, v in sets.items() for i in v], "term string, gene string")
    got = {r.term: r for r in effects.enrichment(ranked, df).collect()}
    for t in ("top", "any"):
        hit = np.isin(np.arange(200), sets[t])
        w = np.abs(score) * hit
        gap = w.cumsum() / w.sum() - (~hit).cumsum() / (~hit).sum()
        assert got[t].es == pytest.approx(gap[np.abs(gap).argmax()])
    assert got["top"].p < 0.01 and got["any"].p > 0.02 and "small" not in got
    with pytest.raises(ValueError, match="ranked"):
        effects.enrichment(ranked, df.select("term", F.concat(F.lit("other"), "gene").alias("gene")))


def test_sign_flips_of_many(spark):
    rng = np.random.default_rng(2)
    rows = [("exact", float(v)) for v in rng.normal(0.5, 1, 18)] + [("sampled", float(v)) for v in rng.normal(0.3, 1, 40)]
    got = {r.k: r.p for r in effects.sign_flip(spark.createDataFrame(rows, "g string, v double"), "v", "g").collect()}
    v = np.array([x for g, x in rows if g == "exact"])
    flips = (np.arange(2**18)[:, None] >> np.arange(18) & 1) * 2 - 1
    assert got[18] == pytest.approx((np.abs(flips @ v) >= abs(v.sum()) - 1e-12).mean()) and 0 < got[40] < 0.5


def test_matrix_entropy_of_any_order(spark):
    rng = np.random.default_rng(3)
    rows = [(c, "g", f, int(rng.integers(1, 9))) for c in range(20) for f in range(4) if rng.random() < 0.7]
    f = usage.isoform_fractions(spark.createDataFrame([(c, f, n) for c, _, f, n in rows], "cell_id long, feature_id long, count long"), spark.createDataFrame([(f, "g") for f in range(4)], "feature_id long, gene string"))
    obs = spark.createDataFrame([(c, "x") for c in range(20)], "cell_id long, class string")
    m = np.zeros((20, 4))
    for r in f.collect():
        m[r.cell_id, r.feature_id] = r.fraction
    p = np.linalg.eigvalsh(m @ m.T / np.trace(m @ m.T))
    p = p[p > 1e-12]
    for alpha, want in ((1.0, -(p * np.log2(p)).sum()), (2.0, -np.log2((p**2).sum())), (3.0, -np.log2((p**3).sum()) / 2), (math.inf, -np.log2(p.max()))):
        assert usage.matrix_renyi(f, obs, ["class"], alpha).first().h == pytest.approx(want, abs=1e-9)


def test_thinning_keeps_molecules(spark):
    df = spark.createDataFrame([(c, f, 400 * (f + 1)) for c in range(30) for f in range(3)] + [(99, 1, 7)], "cell_id long, feature_id long, count long")
    out = {(r.cell_id, r.feature_id): r["count"] for r in models.thinned(df, 600).collect()}
    assert out[99, 1] == 7 and all(0 <= n <= 400 * (f + 1) for (c, f), n in out.items() if c < 30)
    totals = [sum(out[c, f] for f in range(3)) for c in range(30)]
    assert np.mean(totals) == pytest.approx(600, abs=15) and 10 < np.std(totals) < 40
    assert out == {(r.cell_id, r.feature_id): r["count"] for r in models.thinned(df.repartition(7), 600).collect()}


def test_interaction_is_split(spark):
    rng = np.random.default_rng(4)
    rows = [("g", a, b, float(2 * (a == b) + 0.1 * rng.normal())) for a in "xy" for b in "xy" for _ in range(8)]
    got = {r.factor: r.eta2 for r in models.anova(spark.createDataFrame(rows, "gene string, a string, b string, h double"), "h", ["a", "b"], "gene").collect()}
    y = np.array([r[3] for r in rows])
    means = {k: np.mean([r[3] for r in rows if (r[1], r[2]) == k]) for k in {(r[1], r[2]) for r in rows}}
    cells = sum((means[r[1], r[2]] - y.mean()) ** 2 for r in rows)
    one = lambda i: sum((np.mean([q[3] for q in rows if q[i] == r[i]]) - y.mean()) ** 2 for r in rows)
    assert got["interaction"] == pytest.approx((cells - one(1) - one(2)) / ((y - y.mean()) ** 2).sum()) and got["interaction"] > 0.9


def test_associated_genes(spark):
    rng = np.random.default_rng(5)
    obs = [(c, "big" if c < 120 else "small", c % 4 == 0 if c < 120 else c == 120) for c in range(130)]
    counts = [(c, g, int(n)) for c, _, arm in obs for g in range(6) if (n := rng.poisson(20 + 60 * (arm and g == 0)))]
    genes, splits = models.associated_genes(spark.createDataFrame(counts, "cell_id long, gene long, count long"), spark.createDataFrame(obs, "cell_id long, class string, arm boolean"), "arm", [], "class", ratio=2)
    assert {(r["class"], r.n1, r.n0, r.skipped) for r in splits.collect()} == {("big", 30, 60, None), ("small", 1, 2, models.FEW_CASES)}
    names = models.listed(genes, "names", "class").collect()
    assert len(names) == 1 and names[0].genes[0] == 0 and models.listed(genes, "df").count() == 6
    assert models.listed(genes, "lfc", "class").columns == ["class", "gene", "lfc"]


def test_adjusted_p_takes_time_in_proportion(spark):
    """100,000 values, as many ties as not, against the definition."""
    p = np.round(np.random.default_rng(3).random(100_000), 5)
    df = spark.createDataFrame(pd.DataFrame({"i": np.arange(len(p)), "p": p}))
    start = time.time()
    got = tables.adjusted(df, "p").orderBy("i").toPandas()["padj"].to_numpy()
    assert time.time() - start < 60
    order = np.argsort(p, kind="stable")
    want = np.empty(len(p))
    want[order] = np.minimum(1, np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1])
    assert got == pytest.approx(want, abs=1e-12)
