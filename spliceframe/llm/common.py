"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space of the contracts: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is. lower() does the same, and faster, where no other capital occurs."""
    return F.when(text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def n_words(text: Column) -> Column:
    """Number of runs of characters that aren't white space; 0 for null. (regexp_count copies the text for every match.)"""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(F.coalesce(inner, F.lit("")) == "", 0).otherwise(F.size(F.split(inner, r"[\x20\x09-\x0D]+", -1))).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


class Sealed:
    """A table whose columns have names of their own (in0, in1, ...), so that none clashes with an operator's."""

    def __init__(self, df: DataFrame, *made: str):
        """made: the operator's columns, which replace those of these names."""
        df = df.drop(*made)
        self.names = df.columns
        self.df = df.toDF(*(f"in{i}" for i in range(len(self.names))))

    def __getitem__(self, name: str) -> str:
        """What a column is called inside."""
        at = self.names.index(name) if name in self.names else [x.lower() for x in self.names].index(name.lower())
        return f"in{at}"

    def opened(self, df: DataFrame, *made: str | Column, without: tuple[str, ...] = ()) -> DataFrame:
        """df with the old names, but for the columns without, then the columns made."""
        gone = {self[x] for x in without}
        return df.select(*(F.col(f"in{i}").alias(n) for i, n in enumerate(self.names) if f"in{i}" not in gone), *made)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one where none is named and all runs on one machine, as in tests."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = os.path.join(tempfile.gettempdir(), "checkpoints")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


#: What cut(), stored() and temporary() have made, for cleared().
_written: list[str] = []


def cut(df: DataFrame) -> DataFrame:
    """df, written to the cluster's checkpoint folder and read from there, so that a lost executor loses nothing."""
    shared_folder(df.sparkSession)
    out = df.checkpoint()
    file = out._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        _written.append(file.get())
    return out


def temporary(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder, which cleared() deletes too."""
    _written.append(f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    return _written[-1]


def written() -> int:
    """How many folders cut() and stored() of this process have written and cleared() has left."""
    return len(_written)


def cleared(spark: SparkSession, since: int, last: int = 0) -> None:
    """Deletes what cut() and stored() have written since written() was so much, but for the last. Call it when nothing reads that any more."""
    end = len(_written) - last
    for path in _written[since:end]:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    del _written[since:end]


def slim(df: DataFrame) -> DataFrame:
    """cut(df) in as few partitions as its rows need, so that what follows writes few files."""
    out = cut(df)
    return out.coalesce(out.count() // 100_000 + 1)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read again."""
    path = temporary(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
