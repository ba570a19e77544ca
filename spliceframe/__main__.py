"""python -m spliceframe COMMAND INPUT... OUTPUT: the library from the command line. Tables are Parquet unless said otherwise."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spliceframe.operators import models, tables, usage
from spliceframe.sources import files

Args = argparse.Namespace


def fractions(spark: SparkSession, a: Args) -> DataFrame:
    b = files.Bundle.read(spark, a.input[0])
    return usage.isoform_fractions(b.counts, b.var.select("feature_id", "gene"))


def entropy(spark: SparkSession, a: Args) -> DataFrame:
    obs = files.Bundle.read(spark, a.input[0]).obs
    return usage.renyi(usage.mean_usage(fractions(spark, a), obs, [a.by]), [a.by], a.alpha)


def differential(spark: SparkSession, a: Args) -> DataFrame:
    return models.usage_tests(fractions(spark, a), files.Bundle.read(spark, a.input[0]).obs, a.arm)


def one_vs_rest(spark: SparkSession, a: Args) -> DataFrame:
    return models.one_vs_rest(fractions(spark, a), files.Bundle.read(spark, a.input[0]).obs, a.by)


def subsample(spark: SparkSession, a: Args) -> DataFrame:
    return tables.sampled(spark.read.parquet(a.input[0]).filter("cb is not null"), a.most, F.xxhash64("qname"), "cb")


def structures(spark: SparkSession, a: Args) -> DataFrame:
    """Transcripts of GFF files with the tissue that a file's path names."""
    lines = spark.read.text(a.input).select("value", F.regexp_extract(F.col("_metadata.file_path"), a.tag, 1).alias("tissue"))
    return files.transcripts(files.gff_records(lines, "value", "tissue"), "tissue").select("tissue", F.col("transcript_id").alias("old_id"), "seqid", "strand", "exons")


def pooled(spark: SparkSession, a: Args) -> DataFrame:
    """Numbers in the order in which --order names the tissues."""
    place = F.create_map(*(F.lit(x) for i, name in enumerate(a.order.split(",")) for x in (name, i)))
    ids = tables.global_ids(structures(spark, a).withColumn("tissue", F.struct(place[F.col("tissue")].alias("place"), F.col("tissue").alias("name"))), "PB.pool.")
    return ids.select(F.col("tissue.name").alias("tissue"), "old_id", "new_id")


def members(spark: SparkSession, a: Args) -> DataFrame:
    return files.pooled_mapping(files.read_strings(spark, a.input[0], ["pooled_id", "members"], header=False), a.tissue)


def classified(spark: SparkSession, a: Args) -> DataFrame:
    classes = spark.read.option("sep", "\t").option("header", True).option("nullValue", "NA").csv(a.input[1])
    return tables.classify(spark.read.parquet(a.input[0]), classes, *(F.col(c) for c in classes.columns))


def planned(spark: SparkSession, a: Args) -> DataFrame:
    """The barcodes of one sample pass through the driver, as the plan needs all of them in order."""
    stats = spark.read.option("sep", "\t").option("header", True).csv(a.input[0])
    rows = [(r["barcode"], r["reads"]) for r in files.real_cells(stats, a.most).collect()]
    return spark.createDataFrame(tables.lpt_shards(rows, a.shards), "cb string, shard int")


def routed(spark: SparkSession, a: Args) -> DataFrame:
    """Reads with the shard of their barcode; the others are left out."""
    return spark.read.parquet(a.input[0]).join(spark.read.parquet(a.input[1]), "cb")


#: For each command: what it makes, its help, the number of inputs (None: any), and the column that the output is partitioned by.
COMMANDS: dict[str, tuple[Callable[[SparkSession, Args], DataFrame], str, int | None, str | None]] = {
    "fractions": (fractions, "isoform fractions of a bundle", 1, None),
    "entropy": (entropy, "Rényi entropy by gene and class", 1, None),
    "usage": (differential, "differential usage between arms", 1, None),
    "one-vs-rest": (one_vs_rest, "differential usage of every class against the rest", 1, None),
    "saturation": (lambda s, a: tables.saturation(s.read.parquet(a.input[0])), "saturation by barcode", 1, None),
    "rarefaction": (lambda s, a: tables.rarefaction(s.read.parquet(a.input[0])), "rarefaction curve", 1, None),
    "subsample": (subsample, "cap reads per barcode", 1, None),
    "sync": (lambda s, a: tables.global_ids(structures(s, a)), "ids shared by the GFF files of several tissues", None, None),
    "pool": (pooled, "the same, tissues in the order of --order", None, None),
    "recol": (members, "a tissue's ids in a pooled group file (TSV)", 1, None),
    "classify": (classified, "features (Parquet) with the columns of a classification (TSV)", 2, None),
    "plan": (planned, "barcode statistics (TSV) to shards of even load", 1, None),
    "split": (routed, "reads by the shards of a plan", 2, "shard"),
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="spliceframe")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, (_, text, n, _) in COMMANDS.items():
        p = sub.add_parser(name, help=text)
        p.add_argument("input", nargs="+" if n is None else n)
        p.add_argument("output")
        p.add_argument("--by", default="class")
        p.add_argument("--arm", default="arm")
        p.add_argument("--alpha", type=float, default=2.0)
        p.add_argument("--most", type=int, default=300_000, help="reads of a barcode at most")
        p.add_argument("--tag", default=r"([^/]+)/[^/]+$", help="finds the tissue in a file's path")
        p.add_argument("--order", default="", help="tissues, comma-separated")
        p.add_argument("--tissue", default="")
        p.add_argument("--shards", type=int, default=20)
    a = parser.parse_args(argv)
    make, _, _, by = COMMANDS[a.command]
    df = make(SparkSession.builder.appName("spliceframe").getOrCreate(), a)
    if by is None:
        files.write_new(df, a.output)
    else:
        df.write.mode("ignore").partitionBy(by).parquet(a.output)


if __name__ == "__main__":
    main()
