"""Read streams: molecules without duplicates within a watermark, counts by window, and running saturation by barcode."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def molecules(reads: DataFrame, time: str = "ts", late: str = "1 hour") -> DataFrame:
    """The first read of each (cb, umi) within the watermark; rows without cb or umi, or with '-', are left out."""
    ok = reads.filter("cb is not null and umi is not null").filter((F.col("cb").cast("string") != "-") & (F.col("umi") != "-"))
    return ok.withWatermark(time, late).dropDuplicatesWithinWatermark(["cb", "umi"])


def running_counts(reads: DataFrame, time: str = "ts", window: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """Reads by barcode and window; a window is final once the watermark passes it."""
    x = reads.withWatermark(time, late).groupBy(F.window(time, window), "cb").agg(F.count("*").alias("reads"), F.approx_count_distinct("umi").alias("molecules"))
    return x.select(F.col("window.start").alias("start"), "cb", "reads", "molecules")


class _Saturation(StatefulProcessor):
    """A barcode's UMIs, its reads and molecules so far."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.umis = handle.getMapState("umis", "umi string", "seen boolean")
        self.totals = handle.getValueState("totals", "reads bigint, molecules bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        reads, unique = self.totals.get() if self.totals.exists() else (0, 0)
        for pdf in rows:
            for umi, n in pdf["umi"].value_counts().items():
                if not self.umis.containsKey((umi,)):
                    self.umis.updateValue((umi,), (True,))
                    unique += 1
                reads += int(n)
        self.totals.update((reads, unique))
        yield pd.DataFrame({"cb": [key[0]], "reads": [reads], "molecules": [unique], "saturation": [round(1 - unique / reads, 6)]})

    def close(self) -> None:
        pass


def running_saturation(reads: DataFrame) -> DataFrame:
    """(cb, reads, molecules, saturation) of the barcodes that a batch brings reads of, over all reads so far, exactly.

    A molecule counts once however late its reads come: its UMI stays in the barcode's state, a map that the store keeps by
    entry, so a barcode with many is not held in memory. Rows without cb or umi, or with '-', are left out. Output mode
    update; spark.sql.streaming.stateStore.providerClass has to be RocksDB's, and a checkpoint folder makes it go on after a restart.
    """
    ok = reads.select("cb", F.col("umi").cast("string").alias("umi")).filter("cb is not null and umi is not null").filter((F.col("cb").cast("string") != "-") & (F.col("umi") != "-"))
    schema = f"cb {dict(reads.dtypes)['cb']}, reads bigint, molecules bigint, saturation double"
    return ok.groupBy("cb").transformWithStateInPandas(statefulProcessor=_Saturation(), outputStructType=schema, outputMode="Update", timeMode="None")
