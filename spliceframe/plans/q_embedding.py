"""Queries of normalised expression, components, neighbour sets and pair nulls."""

from __future__ import annotations

from pyspark.sql import functions as F

from spliceframe.operators import embedding as m
from spliceframe.operators import knn as n
from spliceframe.operators import tables as t
from spliceframe.plans.registry import query, rounded


@query("s50_normalised", "SELECT cell_id, feature_id, round(ln(1 + count / depth * 1e4), 6) AS y FROM counts JOIN depth USING (cell_id)", "counts", "depth")
def _(c):
    return rounded(m.normalised(c.counts).select("cell_id", "feature_id", "y"))


@query("s50_variable_features", ", y AS (SELECT feature_id, ln(1 + count / depth * 1e4) AS y FROM counts JOIN depth USING (cell_id)), n AS (SELECT count(*) AS n FROM obs) SELECT feature_id, round(sum(y) / n, 6) AS mean, round(sum(y * y) / n - (sum(y) / n) * (sum(y) / n), 6) AS variance FROM y, n GROUP BY feature_id, n ORDER BY sum(y * y) / n - (sum(y) / n) * (sum(y) / n) DESC, feature_id LIMIT 200", "counts", "depth", "obs")
def _(c):
    return rounded(m.variable_features(m.normalised(c.counts), c.obs.count(), 200))


@query("s50_components")
def _(c):
    """Variances of the first ten components of 100 variable features (S50)."""
    cells = c.obs.count()
    y = m.normalised(c.counts)
    values, _ = m.principal_components(y, m.variable_features(y, cells, 100), cells, 10)
    return c.spark.createDataFrame([(i + 1, round(float(v), 6)) for i, v in enumerate(values)], "component int, variance double")


@query("s50_variable_by_batch", """, t AS (SELECT donor, count(*) AS n FROM obs GROUP BY 1), x AS (SELECT donor, feature_id, sum(count / depth * 1e4) AS s, sum((count / depth * 1e4) * (count / depth * 1e4)) AS q FROM counts JOIN depth USING (cell_id) JOIN obs USING (cell_id) GROUP BY ALL),
d AS (SELECT donor, feature_id, ln(1 + s / n) AS m, ln(nullif(greatest((q - n * (s / n) * (s / n)) / (n - 1), 0) / (s / n), 0)) AS d FROM x JOIN t USING (donor)),
b AS (SELECT *, coalesce(greatest(1, ceil((m - min(m) OVER w) / nullif((max(m) OVER w - min(m) OVER w) / 20, 0))), 1) AS bin FROM d WINDOW w AS (PARTITION BY donor)),
z AS (SELECT donor, feature_id, CASE WHEN d IS NULL THEN NULL WHEN stddev_samp(d) OVER w IS NULL THEN 1 ELSE (d - avg(d) OVER w) / nullif(stddev_samp(d) OVER w, 0) END AS z FROM b WINDOW w AS (PARTITION BY donor, bin)),
r AS (SELECT *, rank() OVER (PARTITION BY donor ORDER BY z DESC NULLS LAST) AS r FROM z)
SELECT feature_id, (count(*) FILTER (z IS NOT NULL AND r <= 200))::BIGINT AS n_batches, round(coalesce(sum(z), 0) / nullif((SELECT count(*) FROM t) - count(*) FILTER (z IS NULL), 0), 6) AS dispersion FROM r GROUP BY 1
ORDER BY n_batches DESC, coalesce(sum(z), 0) / nullif((SELECT count(*) FROM t) - count(*) FILTER (z IS NULL), 0) DESC NULLS LAST, feature_id LIMIT 200""", "counts", "depth", "obs")
def _(c):
    """Features that vary in most donors (S50)."""
    return rounded(m.variable_features_by_batch(c.counts, c.obs, "donor", 200))


_KNN = "{name} AS (SELECT a.vec_id AS id, b.vec_id AS other, list_distance(a.{v}, b.{v}) AS d, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.{v}, b.{v}), b.vec_id) AS rank FROM e a JOIN e b ON a.vec_id <> b.vec_id QUALIFY rank <= {k})"
_EMB = "WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, list_slice(embedding, 1, 32)::DOUBLE[] AS p, list_slice(embedding, 17, 48)::DOUBLE[] AS q FROM embeddings), "


@query("s50_neighbours", _EMB + _KNN.format(name="n", v="v", k=15) + " SELECT id, rank, other, round(d, 6) AS distance FROM n")
def _(c):
    """The 15 nearest others of every point."""
    return rounded(n.knn(c.table("embeddings"), 15))


@query("s50_neighbour_graph", _EMB + _KNN.format(name="n", v="v", k=15) + " SELECT least(id, other) AS a, greatest(id, other) AS b, round(min(d), 6) AS distance, count(*) > 1 AS mutual FROM n GROUP BY ALL")
def _(c):
    return rounded(n.neighbour_graph(n.knn(c.table("embeddings"), 15)))


@query("s50_cell_neighbours")
def _(c):
    """Neighbours of cells by their first ten components of 100 variable features."""
    cells = c.obs.count()
    y = m.normalised(c.counts)
    features = m.variable_features(y, cells, 100)
    scores = m.component_scores(y, features, m.principal_components(y, features, cells, 10)[1])
    return rounded(n.knn(scores, 15, "cell_id", "scores"))


@query("s51_label_purity", _EMB + _KNN.format(name="n", v="v", k=30) + " SELECT n.id, round(avg((x.label = y.label)::INT), 6) AS purity FROM n JOIN e x ON x.vec_id = n.id JOIN e y ON y.vec_id = n.other GROUP BY 1")
def _(c):
    return rounded(n.label_purity(c.table("embeddings")))


@query("u06_neighbour_overlap", _EMB + _KNN.format(name="f", v="p", k=30) + ", " + _KNN.format(name="g", v="q", k=30) + " SELECT f.id, round(count(g.other) / 30, 6) AS overlap FROM f LEFT JOIN g ON f.id = g.id AND f.other = g.other GROUP BY 1")
def _(c):
    return rounded(n.neighbour_overlap(c.table("embeddings"), F.slice("embedding", 1, 32), F.slice("embedding", 17, 32)))


@query("s37_matched_pair_null")
def _(c):
    seen = c.counts.join(c.var.select("feature_id", F.col("fine").alias("gene")), "feature_id").select("cell_id", "gene").distinct()
    return rounded(m.matched_pair_null(seen, c.obs.count(), 0.25, 0.25))


@query("r04_rarefied_reference", """, m AS (SELECT cell_id, arm, row_number() OVER (PARTITION BY donor, class, arm ORDER BY (cell_id * 48271 + 7) % 2147483647, cell_id) AS rn, count(*) FILTER (arm) OVER (PARTITION BY donor, class) AS a, count(*) FILTER (NOT arm) OVER (PARTITION BY donor, class) AS b FROM obs)
SELECT cell_id, arm FROM m WHERE rn <= CASE WHEN arm THEN CASE WHEN b > 0 THEN a ELSE 0 END ELSE least(b, 4 * a) END""", "obs")
def _(c):
    return t.matched(c.obs, "arm", F.expr("struct((cell_id * 48271 + 7) % 2147483647, cell_id)"), "donor", "class", ratio=4).select("cell_id", "arm")
