"""Line dedup: a sharded minimal perfect hash over distinct line hashes indexes fingerprint and count arrays.

Build: every distinct key hash of the corpus goes to a shard; a shard's keys get a minimal perfect hash (levels of bit
arrays, about 4 bits a key) whose slots index three arrays: a 32-bit fingerprint, the number of documents (8 bits,
saturating), and the largest document id. Probe: documents send only key hashes; a task streams them past the arrays of
one shard at a time. Lines are never joined with lines.

A shard that gets many probes (one line may be in a third of all documents) is dealt to several tasks, each with a copy
of the arrays. Memory is bounded by one shard's arrays and one Arrow batch.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from spliceframe.llm.common import SPACES, Sealed, ascii_lower, cut, partitions

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # splitmix64
_NO_ID = -(2**63)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash over distinct pairs of 64-bit words, in levels of bit arrays.

    Level i holds the keys that are alone in their cell there; a key's slot is the number of set bits before its cell.
    Keys that no level separates are kept in a sorted list.
    """

    LEVELS, SLACK = 24, 2.0

    def __init__(self, bits: list[np.ndarray], rest: np.ndarray):
        self.bits, self.rest = bits, rest
        self.sizes = [len(b) * 8 for b in bits]
        self.before, total = [], 0
        for b in bits:
            ones = np.unpackbits(b).cumsum(dtype=np.int64)
            self.before.append(total + ones)
            total += int(ones[-1]) if len(ones) else 0
        self.n_levels = total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        bits, left = [], keys
        for level in range(cls.LEVELS):
            if not len(left):
                break
            size = max(8, int(len(left) * cls.SLACK) // 8 * 8 + 8)
            at = (_mix(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(np.packbits(alone))
            left = left[~alone[at]]
        return cls(bits, np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot; for keys outside the set, any slot or -1."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (b, size, before) in enumerate(zip(self.bits, self.sizes, self.before, strict=True)):
            if not len(todo):
                return out
            at = (_mix(keys[todo], level) % np.uint64(size)).astype(np.int64)
            hit = (b[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            out[todo[hit]] = before[at[hit]] - 1
            todo = todo[~hit]
        if len(todo) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            out[todo] = np.where(self.rest[at] == keys[todo], self.n_levels + at, -1)
        return out


def _key(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    return _mix(h.astype(np.uint64), 91) ^ g.astype(np.uint64)


def pack_shard(h: np.ndarray, g: np.ndarray, n: np.ndarray, last: np.ndarray) -> bytes:
    keys = _key(h, g)
    perfect = PerfectHash.build(keys)
    at = perfect.slots(keys)
    prints, counts, lasts = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint8), np.zeros(len(keys), np.int64)
    prints[at] = (g.astype(np.uint64) >> np.uint64(32)).astype(np.uint32)
    counts[at] = np.minimum(n, 255)
    lasts[at] = last
    out = io.BytesIO()
    np.savez(out, rest=perfect.rest, prints=prints, counts=counts, lasts=lasts, **{f"b{i}": b for i, b in enumerate(perfect.bits)})
    return out.getvalue()


class Shard:
    def __init__(self, blob: bytes):
        with np.load(io.BytesIO(blob)) as x:
            self.perfect = PerfectHash([x[f"b{i}"] for i in range(len(x.files) - 4)], x["rest"])
            self.prints, self.counts, self.lasts = x["prints"], x["counts"], x["lasts"]

    def probe(self, h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of documents (0: unknown line) and the largest document id."""
        at = self.perfect.slots(_key(h, g))
        known = (at >= 0) & (self.prints[at] == (g.astype(np.uint64) >> np.uint64(32)).astype(np.uint32))
        return np.where(known, self.counts[at], 0), self.lasts[at]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _h(key: Column) -> Column:
    return F.xxhash64(key)


def repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, shard_keys: int = 50_000, probe_rows: int = 100_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, drops): for each document id with lines to drop, the hashes of their keys.

    shard_keys: distinct lines in a shard. probe_rows: rows that one task sends past a shard's arrays.
    A null id counts as one document, smaller than any other.
    """
    spark = docs.sparkSession
    keyed = F.filter(F.transform(_lines(ascii_lower(F.col(text_col))), lambda x: F.btrim(x, F.lit(SPACES))), lambda x: F.length(x) >= min_chars)
    found = docs.select(F.coalesce(F.col(id_col), F.lit(_NO_ID)).cast("long").alias("doc"), F.explode_outer(F.array_distinct(keyed)).alias("key")).filter("key is not null")
    found = cut(found.select("doc", _h(F.col("key")).alias("h"), F.xxhash64(F.lit(7), F.col("key")).alias("g")).distinct())
    lines = cut(found.groupBy("h", "g").agg(F.count("*").alias("n"), F.max("doc").alias("last")))
    n_shards = lines.count() // shard_keys + 1
    shard = F.pmod(F.col("h"), F.lit(n_shards)).alias("shard")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        blob = pack_shard(*(pdf[c].to_numpy() for c in ("h", "g", "n", "last")))
        return pd.DataFrame({"shard": pdf["shard"][:1].to_numpy(), "blob": [blob]})

    arrays = lines.select(shard, "h", "g", "n", "last").groupBy("shard").applyInPandas(build, "shard long, blob binary")

    # Shards with over a thousandth of all probes, and over probe_rows: there are a thousand at most.
    probes = found.select(shard, "h", "g", "doc")
    most = max(probe_rows, found.count() // 1000)
    hot = probes.groupBy("shard").count().filter(F.col("count") > most).collect()
    copies = F.lit(1)
    if hot:
        copies = F.coalesce(F.create_map(*(F.lit(x) for r in hot for x in (r["shard"], int(r["count"]) // most + 1)))[F.col("shard")], F.lit(1))
    arrays = arrays.select("shard", F.explode(F.sequence(F.lit(0), copies - 1)).alias("part"), *(F.lit(0).cast("long").alias(c) for c in ("h", "g", "doc")), "blob")  # no nulls: pandas would make 64-bit words floats
    probes = probes.select("shard", F.pmod(F.xxhash64("doc", "h"), copies).cast("int").alias("part"), "h", "g", "doc", F.lit(None).cast("binary").alias("blob"))
    dealt = arrays.unionByName(probes).repartition(partitions(spark), "shard", "part").sortWithinPartitions("shard", "part", F.col("blob").isNull())

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        arrays_now = None
        for pdf in batches:
            starts = [*np.flatnonzero(pdf["blob"].notna().to_numpy()), len(pdf)]
            for lo, hi in zip([-1, *starts[:-1]], starts, strict=True):
                if lo >= 0:
                    arrays_now = Shard(pdf["blob"].iloc[lo])
                rows = pdf.iloc[lo + 1 : hi]
                if len(rows):
                    doc = rows["doc"].to_numpy(np.int64)
                    n, last = arrays_now.probe(rows["h"].to_numpy(np.int64), rows["g"].to_numpy(np.int64))
                    drop = (n >= min_docs) & (doc != last)
                    yield pd.DataFrame({"doc": doc[drop], "h": rows["h"].to_numpy(np.int64)[drop]})

    return dealt.mapInPandas(probe, "doc long, h long").groupBy("doc").agg(F.collect_set("h").alias("drops"))


def _gone(places: pd.Series, hashes: pd.Series, drops: pd.Series) -> pd.Series:
    """The places of a document's long lines whose hashes are among those to drop; null where there are none."""
    return pd.Series([None if d is None else np.asarray(p, np.int32)[np.isin(h, d)] for p, h, d in zip(places, hashes, drops, strict=True)], dtype=object)


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text", **more: int) -> DataFrame:
    """docs with text_col rewritten, and n_lines (before dropping) and n_dropped.

    A text splits at \\n; a line's key is the line without white space at both ends and with A-Z in lower case. A key of
    min_chars code points or more that min_docs documents or more hold loses all its lines, except those in the largest
    id_col that holds it. Null or empty: one empty line, text "". Rows with one id count as one document. min_docs is
    255 at most, the counts' limit. Columns n_lines and n_dropped of docs are replaced.

    The join that brings a document its lines to drop moves texts by id, unless that side is small enough to broadcast.
    """
    if not 1 <= min_docs <= 255:
        raise ValueError("min_docs must be from 1 to 255")
    drops = repeated_lines(docs, min_chars, min_docs, id_col=id_col, text_col=text_col, **more)
    s = Sealed(docs, "n_lines", "n_dropped")
    text = F.col(s[text_col])
    x = s.df.join(drops, F.coalesce(F.col(s[id_col]), F.lit(_NO_ID)).cast("long") == F.col("doc"), "left").withColumn("lines", _lines(text))
    keyed = F.transform("lines", lambda line, i: F.struct(i.alias("i"), F.btrim(ascii_lower(line), F.lit(SPACES)).alias("key")))
    long = F.transform(F.filter(keyed, lambda v: F.length(v["key"]) >= min_chars), lambda v: F.struct(v["i"].alias("i"), _h(v["key"]).alias("h")))
    x = x.withColumn("long", F.when(F.col("drops").isNotNull(), long)).withColumn("gone", F.pandas_udf(_gone, ArrayType(IntegerType()))("long.i", "long.h", "drops"))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")), lambda i: F.col("lines")[i])
    kept = F.when(F.col("gone").isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(left, "\n"))
    x = x.withColumn(s[text_col], kept).withColumn("n_lines", F.size("lines").cast("long")).withColumn("n_dropped", F.coalesce(F.size("gone"), F.lit(0)).cast("long"))
    return s.opened(x, "n_lines", "n_dropped")


def op10(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)) AS key FROM l),
s AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, (s.key IS NOT NULL AND doc_id <> s.last) AS gone FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
