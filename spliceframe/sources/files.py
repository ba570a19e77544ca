"""Sources and sinks: sparse matrices, bundles, delimited tables, GFF, FASTA, pooled groups, sample sheets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spliceframe.operators.keep import numbered_lines
from spliceframe.operators.tables import fasta_prefix


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(n, line) of one small file, numbered from 1 in file order."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n"))).select((F.col("pos") + 1).alias("n"), F.col("col").alias("line"))


def read_mtx(spark: SparkSession, folder: str, matrix: str = "matrix.mtx", features: str = "features.tsv", barcodes: str = "barcodes.tsv") -> DataFrame:
    """counts(cell_id, feature_id, count) from triplets of features by cells; ids are the first column of both lists.

    Comment lines and the line of sizes are skipped; the matrix is read in parallel, the lists are looked up by number.
    """
    first = lambda p: numbered_lines(spark.read.text(f"{folder}/{p}")).select("n", F.split("value", "\t")[0].alias("id"))
    x = spark.read.text(f"{folder}/{matrix}").filter(~F.col("value").startswith("%") & (F.trim("value") != ""))
    x = x.select(F.split(F.trim("value"), r"\s+").alias("p"), F.monotonically_increasing_id().alias("_at"))
    size = x.agg(F.min("_at").alias("_first"))  # the line of sizes is the first that is no comment
    x = x.join(F.broadcast(size), F.col("_at") > F.col("_first")).select(F.col("p")[0].cast("bigint").alias("f"), F.col("p")[1].cast("bigint").alias("c"), F.col("p")[2].cast("double").cast("bigint").alias("count"))
    f, c = first(features), first(barcodes)
    return x.join(f.select(F.col("n").alias("f"), F.col("id").alias("feature_id")), "f").join(c.select(F.col("n").alias("c"), F.col("id").alias("cell_id")), "c").select("cell_id", "feature_id", "count")


@dataclass
class Bundle:
    """An experiment: sparse counts with the annotations of cells and features."""

    counts: DataFrame
    obs: DataFrame
    var: DataFrame

    def write(self, path: str, mode: str = "error") -> None:
        for name in ("counts", "obs", "var"):
            getattr(self, name).write.mode(mode).parquet(f"{path}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Bundle:
        return cls(*(spark.read.parquet(f"{path}/{name}") for name in ("counts", "obs", "var")))


def read_strings(spark: SparkSession, path: str, columns: list[str], sep: str = "\t", header: bool = True) -> DataFrame:
    """A delimited file, all strings, NA as null. With a header columns are chosen by name, without they name all."""
    reader = spark.read.option("sep", sep).option("nullValue", "NA")
    if not header:
        return reader.schema(", ".join(f"`{c}` string" for c in columns)).csv(path)
    found = reader.option("header", True).csv(path)
    missing = [c for c in columns if c not in found.columns]
    if missing:
        raise ValueError(f"no columns {missing}; there are {found.columns}")
    return found.select(*columns)


def read_tagged(spark: SparkSession, glob: str, columns: list[str], pattern: str, tag: str = "sample", sep: str = "\t") -> DataFrame:
    """Many files as one table, each row with what the pattern's group finds in its file's path."""
    x = spark.read.option("sep", sep).option("header", True).option("nullValue", "NA").csv(glob)
    return x.select(*columns, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).alias(tag))


# ---- GFF


def attributes(text: Column) -> Column:
    """key=value or key "value" parts between semicolons, in order: array of (key, value); a bare key has the value ''."""
    parts = F.filter(F.transform(F.split(text, ";"), lambda s: F.trim(s)), lambda s: s != "")

    def pair(s: Column) -> Column:
        key = F.when(s.contains("="), F.substring_index(s, "=", 1)).when(s.contains(" "), F.substring_index(s, " ", 1)).otherwise(s)
        value = F.when(s.contains("="), F.regexp_replace(s, "^[^=]*=", "")).when(s.contains(" "), F.regexp_replace(F.trim(F.regexp_replace(s, "^[^ ]* ", "")), '^"+|"+$', "")).otherwise("")
        return F.struct(key.alias("key"), value.alias("value"))

    return F.transform(parts, pair)


def attribute(pairs: Column, key: str) -> Column:
    """The value of the last part with this key; null without one."""
    return F.try_element_at(F.transform(F.filter(pairs, lambda p: p["key"] == key), lambda p: p["value"]), F.lit(-1))


def format_attributes(pairs: Column) -> Column:
    return F.array_join(F.transform(pairs, lambda p: F.concat_ws("=", p["key"], p["value"])), ";")


def transcript_id(pairs: Column) -> Column:
    """ID, else transcript_id, else the first Parent."""
    return F.coalesce(attribute(pairs, "ID"), attribute(pairs, "transcript_id"), F.split(attribute(pairs, "Parent"), ",")[0])


def gff_records(text_lines: DataFrame, column: str = "value", *keys: str) -> DataFrame:
    """The nine-field lines of a GFF or GTF file, with the columns keys; comments, blank lines and lines of other widths are skipped."""
    names = ("seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes")
    p = F.split(column, "\t", -1)
    x = text_lines.filter(~F.col(column).startswith("#") & (F.size(p) == 9)).select(*keys, *(F.get(p, F.lit(i)).alias(n) for i, n in enumerate(names)))
    return x.withColumn("start", F.col("start").cast("int")).withColumn("end", F.col("end").cast("int")).withColumn("attributes", attributes(F.col("attributes")))


def transcripts(records: DataFrame, *keys: str) -> DataFrame:
    """(keys, transcript_id, seqid, strand, tx_start, tx_end, exons): exons in order; bounds are those of the exons."""
    x = records.filter("type = 'exon'").withColumn("transcript_id", F.coalesce(attribute(F.col("attributes"), "transcript_id"), F.split(attribute(F.col("attributes"), "Parent"), ",")[0], attribute(F.col("attributes"), "ID")))
    return x.groupBy(*keys, "transcript_id", "seqid", "strand").agg(F.min("start").alias("tx_start"), F.max("end").alias("tx_end"), F.array_sort(F.collect_set(F.struct("start", "end"))).alias("exons"))


# ---- pooled identifiers


def pooled_mapping(groups: DataFrame, tissue: str) -> DataFrame:
    """(pooled_id, old_id) of one tissue from (pooled_id, members): members are tissue|id, comma-joined."""
    x = groups.select("pooled_id", F.explode(F.split("members", ",")).alias("m")).filter(F.col("m").startswith(tissue + "|"))
    return x.select("pooled_id", F.substr("m", F.lit(len(tissue) + 2)).alias("old_id"))


def rewritten(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """df with column through mapping (old, new); what it doesn't know stays. Rows that become alike are not merged."""
    m = mapping.select(F.col("old").alias("_old"), F.col("new").alias("_new"))
    return df.join(m, F.col(column) == F.col("_old"), "left").withColumn(column, F.coalesce("_new", column)).drop("_old", "_new")


def rewritten_attributes(records: DataFrame, mapping: DataFrame, keys: tuple[str, ...] = ("ID", "Parent", "transcript_id")) -> DataFrame:
    """records with the ids in these attributes through mapping (old, new); lists in them by element."""
    x = records.withColumn("_row", F.monotonically_increasing_id())
    parts = x.select("_row", F.posexplode("attributes").alias("_at", "_p")).select("_row", "_at", F.col("_p.key").alias("key"), F.explode(F.when(F.col("_p.key").isin(*keys), F.split("_p.value", ",")).otherwise(F.array("_p.value"))).alias("value"), F.monotonically_increasing_id().alias("_n"))
    m = mapping.select(F.col("old").alias("_old"), F.col("new").alias("_new"))
    parts = parts.join(m, (F.col("value") == F.col("_old")) & F.col("key").isin(*keys), "left").withColumn("value", F.coalesce("_new", "value"))
    parts = parts.groupBy("_row", "_at", "key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "value"))), lambda v: v["value"]), ",").alias("value"))
    back = parts.groupBy("_row").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "key", "value"))), lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value"))).alias("_new_attributes"))
    return x.join(back, "_row", "left").withColumn("attributes", F.coalesce("_new_attributes", "attributes")).drop("_row", "_new_attributes")


def real_cells(stats: DataFrame, cap: int | None = None) -> DataFrame:
    """(barcode, reads) of real cells, capped."""
    n = F.col("reads").cast("bigint")
    return stats.filter("real_cell = 'cell'").select("barcode", (F.least(n, F.lit(cap)) if cap else n).alias("reads"))


def sample_sheet(sheet: DataFrame, key: str, exclude: list[str] | None = None, excluded_column: str = "donor") -> DataFrame:
    """The sheet without excluded donors; a key that repeats is an error."""
    twice = [r[0] for r in sheet.groupBy(key).count().filter("count > 1").limit(5).collect()]
    if twice:
        raise ValueError(f"{key} repeats: {twice}")
    return sheet.filter(~F.col(excluded_column).isin(*exclude)) if exclude else sheet


def rewrite_fasta(spark: SparkSession, source: str, target: str, tag: str) -> None:
    """Writes the lines of source with headers >a|a:rest as >tag|a|tag|a:rest. Every block of lines becomes a part file, in order."""
    spark.read.text(source).select(fasta_prefix(F.col("value"), F.lit(tag)).alias("value")).write.text(target)


# ---- sinks


def write_new(df: DataFrame, path: str) -> None:
    """Writes Parquet unless something is there."""
    df.write.mode("ignore").parquet(path)


def write_table(df: DataFrame, path: str, sep: str = "\t") -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def kept(df: DataFrame, path: str, refresh: bool = False) -> DataFrame:
    """df from its file at path, written first where it is missing, lacks columns, or refresh is set."""
    spark = df.sparkSession
    if not refresh:
        try:
            old = spark.read.parquet(path)
            if set(df.columns) <= set(old.columns):
                return old.select(df.columns)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def alias(df: DataFrame, name: str) -> None:
    """Makes df known to SQL under the name that a consumer reads."""
    df.createOrReplaceTempView(name)
