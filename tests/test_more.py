"""Neighbours, tallies, folds, shuffles, hierarchy, numbering and running saturation against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spliceframe.operators import embedding, keep, knn, models, tables
from spliceframe.plans.carriers import Carriers

SMALL = "/root/testdata/sf0.001"


def near(ids, x, k):
    out = {}
    for i, v in zip(ids, x, strict=True):
        gap = x - v
        d = (gap * gap).sum(1)
        order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
        out[i] = [(ids[j], math.sqrt(d[j])) for j in order]
    return out


@pytest.mark.parametrize(("block", "strip"), [(8192, 16384), (150, 400)])
def test_knn_of_all_points(spark, block, strip):
    """2,000 points, with copies, in one tile and in many."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(1900, 8)), np.repeat(rng.normal(size=(2, 8)), 50, 0)])
    ids = rng.permutation(2000) * 3
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    want, got = near(ids, x, 10), {}
    for r in knn.knn(df, 10, block=block, strip=strip).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.other, r.distance))
    assert {i: [a for a, _ in v] for i, v in got.items()} == {i: [a for a, _ in v] for i, v in want.items()}
    assert all(d == pytest.approx(e, abs=1e-12) for i in got for (_, d), (_, e) in zip(got[i], want[i], strict=True))


def test_knn_odd_points(spark):
    rows = [(1, [0.0, 0.0], "a"), (2, [1.0, 0.0], "a"), (3, [0.0, 2.0], None), (4, None, "a"), (5, [None, 1.0], "a"), (None, [0.0, 1.0], "a"), (6, [math.nan, 0.0], "a"), (7, [5.0], "a"), (8, [], "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    assert {(r.id, r.rank, r.other) for r in knn.knn(df, 5).collect()} == {(1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 1), (3, 2, 2)}
    assert {r.id: r.purity for r in knn.label_purity(df, 5).collect()} == {1: 0.5, 2: 0.5, 3: 0.0}
    edges = {(r.a, r.b): r.mutual for r in knn.neighbour_graph(knn.knn(df, 1)).collect()}
    assert edges == {(1, 2): True, (1, 3): False}
    assert knn.knn(df.limit(0), 5).count() == 0


def test_components_and_scores(spark):
    c = Carriers(spark, SMALL)
    n, y = c.obs.count(), embedding.normalised(c.counts)
    features = embedding.variable_features(y, n, 20)
    values, axes = embedding.principal_components(y, features, n, 5)
    names = [r.feature_id for r in features.orderBy("feature_id").collect()]
    cells = sorted(r.cell_id for r in c.obs.collect())
    m = np.zeros((n, 20))
    for r in y.collect():
        if r.feature_id in names:
            m[cells.index(r.cell_id), names.index(r.feature_id)] = r.y
    sd = m.std(0)
    z = np.clip((m - m.mean(0)) / sd, -10, 10)
    assert values == pytest.approx(np.linalg.eigvalsh(np.cov(z.T, bias=True))[::-1][:5], abs=1e-9)
    scores = embedding.component_scores(y, features, axes).collect()
    assert scores and all(r.scores == pytest.approx(list(z[cells.index(r.cell_id)] @ axes), abs=1e-9) for r in scores)


def test_numbers_by_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x"), F.lit("a").alias("_at2")).repartition(7)
    got = keep.numbered(df, F.col("x").desc()).collect()
    assert [r.x for r in sorted(got, key=lambda r: r.n)] == sorted((r.x for r in got), reverse=True) and sorted(r.n for r in got) == list(range(1, 5001))


def test_numbers_of_lines(spark, tmp_path):
    (tmp_path / "ids.tsv").write_text("".join(f"line{i}\tx\n" for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        got = keep.numbered_lines(spark.read.text(str(tmp_path / "ids.tsv"))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {r.n: r.value for r in got} == {i + 1: f"line{i}\tx" for i in range(5000)}


def test_tallied_fit_equals_whole(spark):
    rng = np.random.default_rng(8)
    rows, table = [], {}
    for cell in range(120):
        p = rng.dirichlet([4, 2, 1] if cell % 3 else [1, 3, 3])
        for f, n in enumerate(rng.multinomial(rng.integers(3, 12), p)):
            if n:
                rows.append((cell, f, "g", int(n), float(n), f"c{cell % 3}"))
                table.setdefault(cell, np.zeros(3))[f] = n
    df = spark.createDataFrame(rows, "cell_id long, feature_id long, gene string, count long, fraction double, class string")
    obs = df.select("cell_id", "class").distinct()
    got = {r.of: (r.dm_stat, r.dm_pval) for r in models.one_vs_rest(df.drop("class"), obs, "class", min_group=10).filter("tested").collect()}
    assert set(got) == {"c0", "c1", "c2"}
    for of, (stat, p) in got.items():
        own, rest = (np.stack([v for c, v in table.items() if (f"c{c % 3}" == of) == same]) for same in (True, False))
        assert (stat, p) == pytest.approx(models.dm_test(own, rest), abs=1e-6)
    assert "CartesianProduct" not in (plan := models.one_vs_rest(df.drop("class"), obs, "class", min_group=10)._jdf.queryExecution().toString()) and "NestedLoop" not in plan


def genes(c):
    return c.counts.join(c.var.select("feature_id", "gene"), "feature_id").groupBy("cell_id", "gene").agg(F.sum("count").alias("count"))


@pytest.mark.parametrize("covariates", [[], ["class"]])
def test_folds_equal_refits(spark, covariates):
    c = Carriers(spark, SMALL)
    counts, obs = genes(c), c.obs
    got = {(r.fold, r.gene): (r.beta, r.t, r.df, r.p, r.padj) for r in models.leave_one_out_fits(counts, obs, "arm", "donor", covariates, least=2).collect()}
    assert got
    for fold in sorted({f for f, _ in got}):
        left = obs.filter(F.col("donor") != fold)
        for r in models.linear_de(counts.join(left.select("cell_id"), "cell_id", "left_semi"), left, "arm", covariates).collect():
            assert got.pop((fold, r.gene)) == pytest.approx((r.beta, r.t, r.df, r.p, r.padj), abs=1e-8)
    assert not got


def test_linear_model_with_covariates(spark):
    """Against least squares on the whole cells by genes matrix."""
    from spliceframe.functions import tails

    c = Carriers(spark, SMALL)
    obs = sorted(c.obs.join(c.depth, "cell_id").collect(), key=lambda r: r.cell_id)
    y = {(r.cell_id, r.gene): r["count"] for r in genes(c).collect()}
    levels = sorted({r["class"] for r in obs})[1:]
    x = np.array([[1.0, r.arm, *(float(r["class"] == v) for v in levels)] for r in obs])
    for r in models.linear_de(genes(c), c.obs, "arm", ["class"]).collect():
        v = np.array([math.log1p(y.get((o.cell_id, r.gene), 0) / o.depth * 1e4) for o in obs])
        beta, *_ = np.linalg.lstsq(x, v, rcond=None)
        left = len(obs) - np.linalg.matrix_rank(x)
        se = math.sqrt(((v - x @ beta) ** 2).sum() / left * np.linalg.pinv(x.T @ x)[1, 1])
        assert (r.beta, r.t, r.p) == pytest.approx((beta[1], beta[1] / se, 2 * float(tails.t_sf(np.array([abs(beta[1] / se)]), np.array([left]))[0])), abs=1e-7)


def test_composed_search_is_its_parts(spark):
    c = Carriers(spark, SMALL)
    counts, obs = genes(c), c.obs
    found = models.composed_search(counts, obs, "arm", "donor", ["donor"], "class", least=2)
    cells = models.searched_cells(obs, "arm", "class", least=2)[0]
    own = counts.join(cells.select("cell_id"), "cell_id", "left_semi")
    rows = lambda df: sorted(map(str, df.select(*(F.round(x, 8).alias(x) if t == "double" else x for x, t in sorted(df.dtypes))).collect()))
    assert rows(found["lm"]) == rows(models.linear_de(own, cells, "arm", ["donor"], "class"))
    assert rows(found["wilcoxon"]) == rows(models.rank_genes(own, cells, "arm", "class"))
    one = cells.first()["class"]
    part = cells.filter(F.col("class") == one)
    assert rows(found["wilcoxon"].filter(F.col("class") == one).drop("class")) == rows(models.rank_genes(own.join(part.select("cell_id"), "cell_id", "left_semi"), part, "arm"))
    assert rows(found["lodo"].filter(F.col("class") == one).drop("class")) == rows(models.leave_one_out_de(own.join(part.select("cell_id"), "cell_id", "left_semi"), part, "arm", "donor", []))


@pytest.mark.parametrize(("block", "rows"), [(16_384, 50_000), (40, 30)])
def test_shuffled_arms_and_shares(spark, block, rows, monkeypatch):
    rng = np.random.default_rng(1)
    arms = {i: (bool(rng.random() < 0.4), f"u{i % 3}") for i in range(300)}
    data = [(i, f"g{j}", float(rng.normal()), *arms[i]) for i in arms for j in range(12) if rng.random() < 0.3]
    df = spark.createDataFrame(data, "cell_id long, gene string, h double, arm boolean, unit string")
    monkeypatch.setattr(models.shuffled_arms, "__defaults__", (0, block))
    bits = {r.cell_id: np.unpackbits(np.frombuffer(r.bits, np.uint8), count=51) for r in models.shuffled_arms(df, "arm", "unit", 50).collect()}
    for u in ("u0", "u1", "u2"):
        own = [i for i in bits if arms[i][1] == u]
        assert (np.sum([bits[i] for i in own], axis=0) == sum(arms[i][0] for i in own)).all()
    assert all(bits[i][0] == arms[i][0] for i in bits) and len({b.tobytes() for b in bits.values()}) > 200
    got = {r.perm: (r.n, r.up) for r in models.permuted_share(df, "arm", "unit", 50, rows=rows).collect()}
    for p in range(51):
        n = up = 0
        for g in {x[1] for x in data}:
            a, b = ([h for i, gene, h, *_ in data if gene == g and bits[i][p] == side] for side in (1, 0))
            n, up = n + bool(a and b), up + bool(a and b and np.mean(a) > np.mean(b))
        assert got[p] == (n, up)


def omega(inner, *designs):
    """Type-II shares and partial omega squared from hat matrices."""
    n = len(inner)
    hat = lambda *x: (lambda m: m @ np.linalg.pinv(m))(np.column_stack([np.ones(n), *x]))
    full, rank = np.trace(hat(*designs) @ inner), np.linalg.matrix_rank(np.column_stack([np.ones(n), *designs]))
    ms = (np.trace(inner) - full) / (n - rank)
    out = []
    for i in range(len(designs)):
        rest = [d for j, d in enumerate(designs) if j != i]
        ss = full - np.trace(hat(*rest) @ inner)
        df = rank - np.linalg.matrix_rank(np.column_stack([np.ones(n), *rest]))
        out.append((ss / np.trace(inner), (ss - df * ms) / (ss + (n - df) * ms)))
    return out


def test_two_levels(spark):
    rng = np.random.default_rng(6)
    tubes = {t: (f"s{t % 3}", f"d{t % 4}") for t in range(12)}
    rows = [("all", "g", f"c{k}", t, *tubes[t], rng.dirichlet([3, 2 + k, 1 + t % 3]).tolist()) for t in tubes for k in range(4) if k < 3 or t < 3]
    df = spark.createDataFrame(rows, "level string, gene string, label string, tube int, site string, donor string, profile array<double>")
    got = {(r.stage, r.measure, r.factor): (r.n, r.share, r.omega2) for r in models.two_level_partition(df, "label", "tube", ["site", "donor"], "level", "gene").collect()}
    dummies = lambda v: np.array([[float(x == y) for y in sorted(set(v))[1:]] for x in v])

    def inner(m):
        d = np.abs(m[:, None] - m[None]).sum(2) / (m[:, None] + m[None]).sum(2)
        centre = np.eye(len(m)) - 1 / len(m)
        return -0.5 * centre @ (d * d) @ centre

    def diversity(m):
        h = -np.log2((m * m).sum(1) / m.sum(1) ** 2)
        return np.outer(h - h.mean(), h - h.mean())

    each = np.array([r[-1] for r in rows])
    mean = np.array([each[[r[3] == t for r in rows]].mean(0) for t in tubes])
    for stage, m, factors in (("within", each, {"label": [r[2] for r in rows], "tube": [r[3] for r in rows]}), ("between", mean, {"site": [tubes[t][0] for t in tubes], "donor": [tubes[t][1] for t in tubes]})):
        for measure, f in (("composition", inner), ("diversity", diversity)):
            for factor, want in zip(factors, omega(f(m), *map(dummies, factors.values())), strict=True):
                assert got[stage, measure, factor] == pytest.approx((len(m), *want), abs=1e-9)
    assert {r.label for r in models.spanning(df, "label", "tube", 5, "level", "gene").collect()} == {"c0", "c1", "c2"}


def test_count_matrix(spark):
    reads = spark.createDataFrame([(1, "c", "u"), (2, "c", "u"), (3, "c", "v"), (4, "d", "u"), (5, None, "u"), (6, "-", "u"), (7, "d", None), (8, "d", "w")], "qname long, cb string, umi string")
    groups = spark.createDataFrame([("i", [1, 2, 3]), ("j", [4, 8, 5, 6, 7]), ("k", [99])], "isoform string, members array<long>")
    got = {(r.cell_id, r.feature_id): r["count"] for r in tables.count_matrix(groups, reads, groups.filter("isoform <> 'k'")).collect()}
    assert got == {("c", "i"): 2, ("d", "j"): 2}
    assert tables.count_matrix(groups, reads, groups.limit(0)).count() == 0


def test_running_saturation_with_late_reads_and_a_restart(spark, tmp_path):
    from spliceframe.streaming.reads import running_saturation

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    batches = [
        [("2024-01-01 00:00:00", "c", "a"), ("2024-01-01 00:01:00", "c", "a"), ("2024-01-01 00:02:00", "d", "a"), (None, "c", "-"), (None, None, "a")],
        [("2024-03-01 00:00:00", "c", "b"), ("2023-01-01 00:00:00", "c", "a")],
        [("2020-01-01 00:00:00", "d", "a"), ("2020-01-01 00:00:00", "d", "z")],
    ]
    seen = {}
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "ts string, cb string, umi string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("ts string, cb string, umi string").parquet(str(tmp_path / "in"))
        keep_rows = lambda df, _: seen.update({r.cb: (r.reads, r.molecules, r.saturation) for r in df.collect()})
        q = running_saturation(stream).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "state")).foreachBatch(keep_rows).trigger(availableNow=True).start()
        q.awaitTermination()  # each round is a query of its own, from the state of the last
        if i == 0:
            assert seen == {"c": (2, 1, 0.5), "d": (1, 1, 0.0)}
    assert seen == {"c": (4, 2, 0.5), "d": (3, 2, round(1 - 2 / 3, 6))}
