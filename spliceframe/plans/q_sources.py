"""Queries of parsers and rewrites, over text made from the carriers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from spliceframe.operators import tables as t
from spliceframe.plans.registry import query, rounded
from spliceframe.sources import files as s


def gff(c):
    """Exon lines in GTF and GFF3 style by turns, with a comment among them."""
    j = c.junctions.select("gene", "isoform", "start", "end").distinct()
    attrs = F.when(F.col("isoform") % 2 == 0, F.concat(F.lit('gene_id "'), "gene", F.lit('"; transcript_id "T'), "isoform", F.lit('"; tag')))
    attrs = attrs.otherwise(F.concat(F.lit("ID=e"), "start", F.lit(";Parent=T"), "isoform", F.lit(",X")))
    line = F.concat_ws("\t", F.lit("chr1"), F.lit("x"), F.lit("exon"), "start", "end", F.lit("."), F.lit("+"), F.lit("."), attrs)
    return j.select(line.alias("value")).union(c.spark.sql("SELECT '# comment' AS value"))


def folder(c) -> str:
    """A new folder in the warehouse, which driver and executors share."""
    return f"{c.spark.conf.get('spark.sql.warehouse.dir')}/spliceframe/{uuid.uuid4().hex}"


@query("io02_bundle", "SELECT class, gene, sum(count)::BIGINT AS count FROM counts JOIN obs USING (cell_id) JOIN var USING (feature_id) GROUP BY ALL", "counts", "obs", "var")
def _(c):
    s.Bundle(c.counts, c.obs, c.var).write(path := folder(c))
    b = s.Bundle.read(c.spark, path)
    return b.counts.join(b.obs, "cell_id").join(b.var, "feature_id").groupBy("class", "gene").agg(F.sum("count").alias("count"))


@query("io04_pseudobulk_scan", ", g AS (SELECT class, gene, sum(count)::BIGINT AS total FROM counts JOIN obs USING (cell_id) JOIN var USING (feature_id) GROUP BY ALL) SELECT class, gene, total, round(ln(1 + total / sum(total) OVER (PARTITION BY class) * 1e4), 6) AS log_cp10k FROM g", "counts", "obs", "var")
def _(c):
    """Sums by class over a bundle on disk: only the columns that they need are read, and every task adds up its own."""
    s.Bundle(c.counts, c.obs, c.var).write(path := folder(c))
    b = s.Bundle.read(c.spark, path)
    return rounded(t.pseudobulk(b.counts, b.obs, b.var, "class"))


@query("io05_strings", "SELECT cell_id::VARCHAR AS cell_id, class FROM obs", "obs")
def _(c):
    s.write_table(c.obs.select("class", "cell_id", "donor"), path := folder(c))
    return s.read_strings(c.spark, path, ["cell_id", "class"])


@query("io06_headerless", "SELECT cell_id::VARCHAR AS a, class AS b FROM obs", "obs")
def _(c):
    c.obs.select("cell_id", "class").write.option("sep", "\t").csv(path := folder(c))
    return s.read_strings(c.spark, path, ["a", "b"], header=False)


@query("io07_tagged", "SELECT cell_id::VARCHAR AS cell_id, class AS sample FROM obs", "obs")
def _(c):
    """Files of several samples as one table, tagged from their paths."""
    c.obs.select("cell_id", "class").write.partitionBy("class").option("sep", "\t").option("header", True).csv(path := folder(c))
    return s.read_tagged(c.spark, f"{path}/*/*.csv", ["cell_id"], "class=([^/]+)/")


@query("io10_rewrite_fasta", "SELECT CASE WHEN feature_id % 2 = 0 THEN '>t|' || gene || '|t|' || exons || ':' || name ELSE 'ACGT' END AS line FROM var", "var")
def _(c):
    line = F.when(F.col("feature_id") % 2 == 0, F.concat(F.lit(">"), "gene", F.lit("|"), "exons", F.lit(":"), "name")).otherwise("ACGT")
    c.var.select(line).write.text(path := folder(c))
    s.rewrite_fasta(c.spark, path, new := folder(c), "t")
    return c.spark.read.text(new).withColumnRenamed("value", "line")


@query("io16_table", "SELECT cell_id::VARCHAR AS cell_id, class, donor::VARCHAR AS donor FROM obs", "obs")
def _(c):
    s.write_table(c.obs.select("cell_id", "class", "donor"), path := folder(c), ",")
    return c.spark.read.option("header", True).csv(path)


@query("io17_write_new", "SELECT cell_id FROM obs", "obs")
def _(c):
    path = folder(c)
    s.write_new(c.obs.select("cell_id"), path)
    s.write_new(c.obs.select("cell_id").limit(1), path)  # something is there: it stays
    return c.spark.read.parquet(path)


@query("io18_alias", "SELECT class, count(*) AS n FROM obs GROUP BY 1", "obs")
def _(c):
    s.alias(c.obs, name := f"cells_{uuid.uuid4().hex}")
    return c.spark.sql(f"SELECT class, count(*) AS n FROM {name} GROUP BY 1")


@query("io19_kept", "SELECT cell_id, donor, class FROM obs", "obs")
def _(c):
    path = folder(c)
    s.kept(c.obs.select("cell_id", "class"), path)
    return s.kept(c.obs.select("cell_id", "donor", "class"), path)  # lacks a column: written anew


@query("io03_annotations_only", "SELECT cell_id, class FROM obs", "obs")
def _(c):
    return c.obs.select("cell_id", "class")


@query("io08_gff_transcripts", ", j AS (SELECT DISTINCT 'T' || isoform AS transcript_id, start, \"end\" FROM junctions) SELECT transcript_id, min(start)::INT AS tx_start, max(\"end\")::INT AS tx_end, string_agg(start || '-' || \"end\", ',' ORDER BY start, \"end\") AS exons FROM j GROUP BY 1", "junctions")
def _(c):
    x = s.transcripts(s.gff_records(gff(c)))
    return x.select("transcript_id", "tx_start", "tx_end", F.array_join(F.transform("exons", lambda e: F.concat_ws("-", e["start"].cast("string"), e["end"].cast("string"))), ",").alias("exons"))


@query("io09_attributes", "SELECT feature_id, gene AS gene_id, 'T' || feature_id AS transcript_id, 'gene_id=' || gene || ';ID=T' || feature_id || ';tag=' AS text FROM var", "var")
def _(c):
    raw = F.concat(F.lit('gene_id "'), "gene", F.lit('"; ID=T'), "feature_id", F.lit("; tag;"))
    x = c.var.select("feature_id", s.attributes(raw).alias("a"))
    return x.select("feature_id", s.attribute(F.col("a"), "gene_id").alias("gene_id"), s.transcript_id(F.col("a")).alias("transcript_id"), s.format_attributes(F.col("a")).alias("text"))


@query("io11_pooled_mapping", "SELECT gene AS pooled_id, feature_id::VARCHAR AS old_id FROM var WHERE feature_id % 3 = 1", "var")
def _(c):
    member = F.concat_ws("|", F.concat(F.lit("t"), (F.col("feature_id") % 3).cast("string")), F.col("feature_id").cast("string"))
    groups = c.var.groupBy(F.col("gene").alias("pooled_id")).agg(F.array_join(F.collect_list(member), ",").alias("members"))
    return s.pooled_mapping(groups, "t1")


@query("io12_rewrite_ids", "SELECT feature_id, CASE WHEN feature_id % 4 = 0 THEN 'N' || exons ELSE feature_id::VARCHAR END AS pbid FROM var", "var")
def _(c):
    m = c.var.filter("feature_id % 4 = 0").select(F.col("feature_id").cast("string").alias("old"), F.concat(F.lit("N"), "exons").alias("new"))
    return s.rewritten(c.var.select("feature_id", F.col("feature_id").cast("string").alias("pbid")), "pbid", m)


@query("io12_rewrite_attributes", "SELECT isoform % 2 AS style, count(DISTINCT isoform) AS n FROM junctions GROUP BY 1", "junctions")
def _(c):
    m = c.junctions.select(F.concat(F.lit("T"), "isoform").alias("old"), F.concat(F.lit("NEW"), "isoform").alias("new")).distinct()
    x = s.transcripts(s.rewritten_attributes(s.gff_records(gff(c)), m)).filter("transcript_id like 'NEW%'")
    return x.groupBy((F.substring("transcript_id", 4, 18).cast("bigint") % 2).alias("style")).agg(F.count("*").alias("n"))


@query("io13_tagged_reads", "SELECT qname, cb FROM reads WHERE cb IS NOT NULL AND umi <> '-'", "reads")
def _(c):
    return c.reads.filter("cb is not null and umi <> '-'").select("qname", "cb")


@query("io14_real_cells", "SELECT cb AS barcode, least(count(*), 70) AS reads FROM reads GROUP BY 1 HAVING count(*) > 60", "reads")
def _(c):
    stats = c.reads.groupBy(F.col("cb").alias("barcode")).agg(F.count("*").alias("reads")).withColumn("real_cell", F.when(F.col("reads") > 60, "cell").otherwise("non-cell"))
    return s.real_cells(stats, 70)


@query("io15_sample_sheet", "SELECT n_name, n_regionkey FROM nation WHERE n_regionkey NOT IN (1, 3)")
def _(c):
    return s.sample_sheet(c.table("nation"), "n_name", [1, 3], "n_regionkey").select("n_name", "n_regionkey")
