"""Queries of isoform fractions, profiles and diversity."""

from __future__ import annotations

from pyspark.sql import functions as F

from spliceframe.operators import usage
from spliceframe.plans.registry import query, rounded


@query("a01_isoform_fraction", "SELECT cell_id, feature_id, gene, count, round(fraction, 6) AS fraction FROM co", "co")
def _(c):
    return rounded(c.coarse.select("cell_id", "feature_id", "gene", "count", "fraction"))


@query("a10_mean_usage", "SELECT class, gene, feature_id, round(usage, 6) AS usage, n_expr, n_iso FROM profile", "profile")
def profile(c):
    return rounded(usage.mean_usage(c.fractions, c.obs, ["class"]))


@query("a11_class_share", "SELECT class, round(avg(share), 6) AS share FROM (SELECT cell_id, sum(CASE WHEN category = 'ECONOMY' THEN count ELSE 0 END) / sum(count) AS share FROM counts JOIN var USING (feature_id) GROUP BY 1) JOIN obs USING (cell_id) GROUP BY 1", "counts", "var", "obs")
def _(c):
    share = usage.class_share(c.counts, c.var.select("feature_id", (F.col("category") == "ECONOMY").alias("hit")))
    return rounded(share.join(c.obs, "cell_id").groupBy("class").agg(F.avg("share").alias("share")))


@query("s12_shannon", "SELECT class, gene, round(h, 6) AS h, n_iso, n_expr FROM entropy", "entropy")
def _(c):
    return rounded(usage.shannon(usage.mean_usage(c.fractions, c.obs, ["class"]), ["class"]))


@query("s13_renyi", "SELECT class, gene, round(-log2(sum(usage * usage)), 6) AS h, count(*) AS n_iso FROM profile GROUP BY ALL HAVING count(*) >= 2", "profile")
def _(c):
    return rounded(usage.renyi(usage.mean_usage(c.fractions, c.obs, ["class"]), ["class"]))


@query("s13_min_entropy", "SELECT class, gene, round(-log2(max(usage / t)), 6) AS h, count(*) AS n_iso FROM (SELECT *, sum(usage) OVER (PARTITION BY class, gene) AS t FROM profile) GROUP BY ALL HAVING count(*) >= 2", "profile")
def _(c):
    return rounded(usage.renyi(usage.mean_usage(c.fractions, c.obs, ["class"]), ["class"], float("inf"), normalise=True))


@query("s14_matrix_renyi", """, x AS (SELECT class, gene, cell_id, feature_id, fraction FROM fr JOIN obs USING (cell_id)),
d AS (SELECT a.class, a.gene, a.feature_id AS i, b.feature_id AS j, sum(a.fraction * b.fraction) AS dot FROM x a JOIN x b ON a.cell_id = b.cell_id AND a.gene = b.gene GROUP BY ALL),
t AS (SELECT class, gene, sum(fraction * fraction) AS tr, count(DISTINCT cell_id) AS n_expr FROM x GROUP BY ALL)
SELECT class, gene, any_value(n_expr) AS n_expr, round(-log2(sum(dot * dot) / (any_value(tr) * any_value(tr))), 6) AS h FROM d JOIN t USING (class, gene) WHERE n_expr >= 5 GROUP BY ALL""", "fr", "obs")
def _(c):
    return rounded(usage.matrix_renyi(c.fractions, c.obs, ["class"]))


@query("s14_matrix_shannon")
def _(c):
    return rounded(usage.matrix_renyi(c.fractions, c.obs, ["class"], 1.0))


@query("s15_tau", "SELECT gene, feature_id, count(*) AS n_groups, round(sum(1 - usage / m) / (count(*) - 1), 6) AS tau FROM (SELECT *, max(usage) OVER (PARTITION BY gene, feature_id) AS m FROM profile) GROUP BY ALL HAVING count(*) > 1", "profile")
def _(c):
    return rounded(usage.tau(usage.mean_usage(c.fractions, c.obs, ["class"]), ["gene", "feature_id"]))


@query("s16_quadrants", """, g AS (SELECT gene, avg(h) AS mean_h, var_samp(h) AS var_h, count(*) AS n_groups FROM entropy GROUP BY 1 HAVING count(*) >= 2)
SELECT gene, round(mean_h, 6) AS mean_h, round(var_h, 6) AS var_h, n_groups,
  CASE WHEN mean_h >= (SELECT median(mean_h) FROM g) THEN 'high' ELSE 'low' END || '_' || CASE WHEN var_h >= (SELECT median(var_h) FROM g) THEN 'high' ELSE 'low' END AS quadrant FROM g""", "entropy")
def _(c):
    return rounded(usage.quadrants(usage.shannon(usage.mean_usage(c.fractions, c.obs, ["class"]), ["class"])))


@query("s17_cell_entropy", "SELECT cell_id, round(coalesce(avg(h) FILTER (k >= 2), 0), 6) AS h, count(*) FILTER (k >= 2) AS n_genes FROM cellgene GROUP BY 1", "cellgene")
def _(c):
    return rounded(usage.cell_entropy(usage.cell_gene_entropy(c.coarse)))


@query("s18_identity", "SELECT cell_id, count(*) AS n_expr, count(*) FILTER (k >= 2) AS n_meas, round(count(*) FILTER (k >= 2) / count(*), 6) AS d, round(avg(h) FILTER (k >= 2), 6) AS m, round(coalesce(sum(h) FILTER (k >= 2), 0) / count(*), 6) AS h_unc FROM cellgene GROUP BY 1", "cellgene")
def _(c):
    return rounded(usage.identity_parts(usage.cell_gene_entropy(c.coarse)))


@query("s19_cell_entropy_floor", "SELECT cell_id, round(avg(h) FILTER (k >= 2 AND total >= 60), 6) AS h, count(*) FILTER (k >= 2 AND total >= 60) AS n_genes FROM cellgene GROUP BY 1", "cellgene")
def _(c):
    return rounded(usage.cell_entropy(usage.cell_gene_entropy(c.coarse), min_count=60, none=None))


@query("s20_chao_shen", """, x AS (SELECT *, sum(count) OVER w AS n, count(*) OVER w AS k, count(*) FILTER (count = 1) OVER w AS f1 FROM co WINDOW w AS (PARTITION BY cell_id, gene)),
p AS (SELECT *, CASE WHEN 1 - f1 / n > 0 THEN 1 - f1 / n ELSE 1 / n END * count / n AS p FROM x),
g AS (SELECT cell_id, gene, any_value(k) AS k, sum(-p * log2(p) / (1 - pow(1 - p, n))) AS h FROM p GROUP BY ALL)
SELECT cell_id, round(coalesce(avg(h) FILTER (k >= 2), 0), 6) AS h FROM g GROUP BY 1""", "co")
def _(c):
    return rounded(usage.chao_shen(c.coarse))


@query("s22_detection_evenness", """, x AS (SELECT gene, arm, count(*) AS n, count(*) FILTER (k >= 2) AS k, sum(h) FILTER (k >= 2) AS s FROM cellgene JOIN obs USING (cell_id) GROUP BY ALL),
y AS (SELECT a.gene, a.k / a.n AS d1, a.s / a.k AS m1, b.k / b.n AS d0, b.s / b.k AS m0 FROM x a JOIN x b ON a.gene = b.gene AND a.arm AND NOT b.arm WHERE a.k > 0 AND b.k > 0)
SELECT gene, round(d1 * m1 - d0 * m0, 6) + 0 AS delta, round(m1 * (d1 - d0), 6) + 0 AS detection, round(d0 * (m1 - m0), 6) + 0 AS evenness FROM y""", "cellgene", "obs")
def _(c):
    return rounded(usage.detection_evenness(usage.cell_gene_entropy(c.coarse), c.obs))


@query("s49_variable_isoforms", "SELECT feature_id, round(sum(fraction * fraction) / n - (sum(fraction) / n) * (sum(fraction) / n), 9) AS variance FROM fr, (SELECT count(*) AS n FROM obs) GROUP BY feature_id, n ORDER BY sum(fraction * fraction) / n - (sum(fraction) / n) * (sum(fraction) / n) DESC, feature_id LIMIT 200", "fr", "obs")
def _(c):
    return rounded(usage.variable_isoforms(c.fractions, c.obs.count(), 200), digits=9)


@query("s52_abundance_r2", """, t AS (SELECT cell_id, fine AS gene, sum(count) AS g FROM counts JOIN var USING (feature_id) GROUP BY ALL),
x AS (SELECT v.feature_id, t.cell_id, ln(1 + g) AS x, ln(1 + coalesce(count, 0)) AS y, coalesce(count, 0) AS count FROM t JOIN var v ON v.fine = t.gene LEFT JOIN counts c ON c.cell_id = t.cell_id AND c.feature_id = v.feature_id)
SELECT feature_id, count(*) AS n_cells, round(corr(x, y) ** 2, 6) AS r2, round(1 - corr(x, y) ** 2, 6) AS own FROM x GROUP BY 1 HAVING count(*) >= 50 AND sum(count) >= 50""", "counts", "var")
def _(c):
    return rounded(usage.abundance_r2(c.counts, c.var.select("feature_id", F.col("fine").alias("gene"))))


@query("s70_composition", "SELECT class, CASE WHEN feature_id % 3 = 0 THEN 'novel' ELSE feature_id::VARCHAR END AS band, round(sum(usage), 6) AS usage, count(*) AS n_iso FROM profile WHERE gene = 'Brand#1/ECONOMY' GROUP BY ALL", "profile")
def _(c):
    return rounded(usage.composition(usage.mean_usage(c.fractions, c.obs, ["class"]), "Brand#1/ECONOMY", F.col("feature_id") % 3 == 0))
