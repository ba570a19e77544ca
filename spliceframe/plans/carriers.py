"""The tables that stand in for isoform data, as DataFrames and as the same relations in SQL.

counts(cell_id, feature_id, count): sparse, an absent row is 0. var: features with two gene grains. obs: cells with class,
subclass, tube, donor and arm. reads, runs, junctions: sequencing reads, barcodes by run, splice junctions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spliceframe.operators import usage


class Carriers:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def counts(self) -> DataFrame:
        x = self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return x.groupBy(F.col("o_custkey").alias("cell_id"), F.col("l_partkey").alias("feature_id")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("count"))

    @property
    def var(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("feature_id"), F.col("p_brand").alias("gene"), F.concat_ws("/", "p_brand", "p_type").alias("fine"), F.col("p_type").alias("category"), F.col("p_size").alias("exons"), F.col("p_retailprice").alias("length"), F.col("p_name").alias("name"))

    @property
    def obs(self) -> DataFrame:
        x = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        return x.select(F.col("c_custkey").alias("cell_id"), F.col("c_mktsegment").alias("class"), F.col("n_name").alias("subclass"), F.col("c_nationkey").alias("tube"), F.col("n_regionkey").alias("donor"), (F.col("c_acctbal") < 0).alias("arm"), F.col("c_acctbal").alias("score"))

    @property
    def fractions(self) -> DataFrame:
        """counts with the fine gene and the isoform fraction."""
        return usage.isoform_fractions(self.counts, self.var.select("feature_id", F.col("fine").alias("gene")))

    @property
    def coarse(self) -> DataFrame:
        return usage.isoform_fractions(self.counts, self.var.select("feature_id", "gene"))

    @property
    def depth(self) -> DataFrame:
        return self.counts.groupBy("cell_id").agg(F.sum("count").alias("depth"), F.count("*").alias("n_features"))

    @property
    def reads(self) -> DataFrame:
        return self.table("events").select(F.col("event_id").alias("qname"), F.col("user_id").alias("cb"), F.col("props").alias("umi"))

    @property
    def runs(self) -> DataFrame:
        k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
        return self.table("events").select(F.col("event_type").alias("donor"), F.col("ts").cast("date").alias("run"), (F.col("user_id") * 100 + k).alias("barcode"))

    @property
    def junctions(self) -> DataFrame:
        x = self.table("lineitem").join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        start = F.pmod(F.col("l_partkey") * 7, F.lit(97))
        gene = F.concat_ws("/", "p_brand", "p_type", F.pmod("l_partkey", F.lit(3)).cast("string"))
        strand = F.when(F.col("l_linestatus") == "F", "+").otherwise("-")
        return x.select(gene.alias("gene"), F.col("l_returnflag").alias("tissue"), strand.alias("strand"), start.alias("start"), (start + 1 + F.pmod(F.col("l_suppkey") * 11, F.lit(53))).alias("end"), F.col("l_partkey").alias("isoform"), F.pmod("l_suppkey", F.lit(20)).alias("tube"), F.col("l_linenumber").alias("number"))

    @property
    def xy(self) -> DataFrame:
        x = self.table("labels").join(self.table("documents"), "doc_id")
        return x.select("doc_id", F.col("quality").alias("x"), F.col("toxic").alias("y"), F.col("lang").alias("stratum"), F.col("source").alias("unit"))


#: Each name's SQL and what it builds on.
_SQL = {
    "counts": ("SELECT o_custkey AS cell_id, l_partkey AS feature_id, sum(l_quantity::BIGINT)::BIGINT AS count FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL", ()),
    "var": ("SELECT p_partkey AS feature_id, p_brand AS gene, p_brand || '/' || p_type AS fine, p_type AS category, p_size AS exons, p_retailprice AS length, p_name AS name FROM part", ()),
    "obs": ("SELECT c_custkey AS cell_id, c_mktsegment AS class, n_name AS subclass, c_nationkey AS tube, n_regionkey AS donor, c_acctbal < 0 AS arm, c_acctbal AS score FROM customer JOIN nation ON c_nationkey = n_nationkey", ()),
    "fr": ("SELECT cell_id, feature_id, fine AS gene, count, count / sum(count) OVER (PARTITION BY cell_id, fine) AS fraction FROM counts JOIN var USING (feature_id)", ("counts", "var")),
    "co": ("SELECT cell_id, feature_id, gene, count, count / sum(count) OVER (PARTITION BY cell_id, gene) AS fraction FROM counts JOIN var USING (feature_id)", ("counts", "var")),
    "depth": ("SELECT cell_id, sum(count)::BIGINT AS depth, count(*) AS n_features FROM counts GROUP BY 1", ("counts",)),
    "prof0": ("SELECT class, fr.gene, feature_id, sum(fraction) AS s FROM fr JOIN obs USING (cell_id) GROUP BY ALL", ("fr", "obs")),
    "expr": ("SELECT class, gene, count(DISTINCT cell_id) AS n_expr FROM fr JOIN obs USING (cell_id) GROUP BY ALL", ("fr", "obs")),
    "profile": ("SELECT class, gene, feature_id, s / n_expr AS usage, n_expr, count(*) OVER (PARTITION BY class, gene) AS n_iso FROM prof0 JOIN expr USING (class, gene) JOIN (SELECT class, count(*) AS n_cells FROM obs GROUP BY 1) USING (class) WHERE n_cells >= 10 AND n_expr >= 5", ("prof0", "expr", "obs")),
    "entropy": ("SELECT class, gene, sum(-usage * log2(usage)) AS h, count(*) AS n_iso, any_value(n_expr) AS n_expr FROM profile GROUP BY ALL HAVING count(*) >= 2", ("profile",)),
    "cellgene": ("SELECT cell_id, gene, sum(count)::BIGINT AS total, count(*) AS k, sum(-fraction * log2(fraction)) AS h FROM co GROUP BY ALL", ("co",)),
    "reads": ("SELECT event_id AS qname, user_id AS cb, props AS umi FROM events", ()),
    "runs": ("SELECT event_type AS donor, ts::DATE AS run, user_id * 100 + regexp_extract(props, '([0-9]+)', 1)::BIGINT AS barcode FROM events", ()),
    "junctions": ("SELECT p_brand || '/' || p_type || '/' || (l_partkey % 3) AS gene, l_returnflag AS tissue, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, (l_partkey * 7) % 97 AS start, (l_partkey * 7) % 97 + 1 + (l_suppkey * 11) % 53 AS \"end\", l_partkey AS isoform, l_suppkey % 20 AS tube, l_linenumber AS number FROM lineitem JOIN part ON l_partkey = p_partkey", ()),
    "xy": ("SELECT doc_id, quality AS x, toxic AS y, lang AS stratum, source AS unit FROM labels JOIN documents USING (doc_id)", ()),
    "arms": ("SELECT gene, class, arm, count(*) AS n, sum(h) AS s, sum(h * h) AS q FROM cellgene JOIN obs USING (cell_id) WHERE k >= 2 GROUP BY ALL", ("cellgene", "obs")),
    "bygene": ("SELECT gene, arm, count(*) AS n, sum(h) AS s, sum(h * h) AS q FROM cellgene JOIN obs USING (cell_id) WHERE k >= 2 GROUP BY ALL", ("cellgene", "obs")),
}


def sql(body: str, *names: str) -> str:
    """body over these carriers and all that they build on."""
    order: list[str] = []

    def visit(name: str) -> None:
        for x in _SQL[name][1]:
            visit(x)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return ("WITH " + ", ".join(f"{n} AS ({_SQL[n][0]})" for n in order) + " " if order else "") + body.removeprefix(", ") if not body.startswith(", ") else "WITH " + ", ".join(f"{n} AS ({_SQL[n][0]})" for n in order) + body
