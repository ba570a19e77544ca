"""Results that are written once: for plans that must not run anew, and numbers by position."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; under a local master that names none, a temporary one."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if sc.getCheckpointDir() is None:
        if named is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = named or os.path.join(tempfile.gettempdir(), "checkpoints")
        sc.setCheckpointDir(named)
    return named


def kept(df: DataFrame) -> DataFrame:
    """df, written to the checkpoint folder and read from there."""
    _folder(df.sparkSession)
    return df.checkpoint()


def packed(df: DataFrame) -> DataFrame:
    """kept() as compressed Parquet, for large results: checkpoints are rows as they lie in memory."""
    path = f"{_folder(df.sparkSession)}/packed-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _offsets(df: DataFrame, part: Column, counted: Iterable[tuple[int, int]], at: Column, out: str) -> DataFrame:
    """df with out: at, counted from 1 on through the parts in order. A part is a task's or a file block's, so there are few."""
    before, start = {}, 0
    for p, n in counted:
        before[p] = start
        start += n
    rows = df.sparkSession.createDataFrame(list(before.items()), "_part long, _before long")
    return df.withColumn("_part", part).join(F.broadcast(rows), "_part").withColumn(out, F.col("_before") + at + 1).drop("_part", "_before")


def numbered(df: DataFrame, *order: str | Column, out: str = "n") -> DataFrame:
    """df with out: places from 1 in this order, which has to be total.

    Ranges of the order are sorted in tasks of their own and written; a place is the one within the range and the rows of the
    ranges before, so that no task sees all rows.
    """
    rows = kept(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = rows.groupBy(part.alias("part")).count().orderBy("part").collect()
    return _offsets(rows, part, [(r["part"], r["count"]) for r in counts], at, out).drop("_at")


def numbered_lines(lines: DataFrame, out: str = "n") -> DataFrame:
    """(out, value): a text file's lines, as spark.read.text gives them, numbered from 1 in file order, by the blocks that tasks read."""
    rows = lines.select("value", F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    blocks = rows.groupBy("_block").agg(F.count("*").alias("n"), F.min("_at").alias("first")).orderBy("_block").collect()
    first = rows.sparkSession.createDataFrame([(r["_block"], r["first"]) for r in blocks], "_block long, _first long")
    x = rows.join(F.broadcast(first), "_block")
    return _offsets(x, F.col("_block"), [(r["_block"], r["n"]) for r in blocks], F.col("_at") - F.col("_first"), out).select(out, "value")
