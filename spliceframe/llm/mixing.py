"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the mix stands at the fractional part of i times the golden ratio (in 32-bit integers, so every machine gets
the same points); the source whose stretch of the cumulative target weights holds the point owns the slot. Slots are
ranked within their source. A source's documents, shuffled by a hash, lie on a line of words that is cut into blocks of
equal size; slot k of the source takes block k, starting over at the line's end. Slots beyond a source's quota of words
are passed over, the few that the sequence has not dealt by its end follow there, and a source's last slot is cut, so
that a source's taken words are its target to the word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spliceframe.llm.common import Sealed, cut, n_words, table

_GOLDEN = 2654435769  # 2**32 over the golden ratio, to the nearest odd number
_CELLS, _CHUNK = 4096, 65536


def source_targets(sized: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(src, source_size, n_rows, target) from (src, size): weights repeat over the sources by code point, null last.

    share of all words is dealt by weight; a target stops at most times its source's size and the excess goes to the
    others by weight. In order of size over weight: a source is full if the level at its turn exceeds its own limit.
    """
    sums = sized.groupBy("src").agg(F.sum("size").cast("long").alias("source_size"), F.count("*").alias("n_rows"))
    turn = F.pmod(F.row_number().over(W.orderBy(F.col("src").asc_nulls_last())) - 1, F.lit(len(weights)))
    sums = sums.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    limit = F.col("source_size") * F.lit(float(most))
    by = W.orderBy(limit / F.col("w"), F.col("src").asc_nulls_first())
    before = by.rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("source_size").over(W.partitionBy()) * F.lit(float(share))
    sums = sums.withColumn("left", total - F.coalesce(F.sum(limit).over(before), F.lit(0.0))).withColumn("open", F.sum("w").over(by.rowsBetween(0, W.unboundedFollowing)))
    sums = sums.withColumn("full", F.col("left") / F.col("open") > limit / F.col("w"))
    level = F.min(F.when(~F.col("full"), F.struct(-F.col("open"), (F.col("left") / F.col("open")).alias("level")))).over(W.partitionBy())["level"]
    return sums.withColumn("level", level).select("src", "source_size", "n_rows", F.when(F.col("full"), limit).otherwise(F.col("level") * F.col("w")).alias("target"))


def _schedule(sources: DataFrame, n_slots: int) -> DataFrame:
    """(pos, src, rank): every slot of the mix in order. sources: src, target, quota (slots), ..."""
    spark = sources.sparkSession
    order = W.orderBy(F.col("src").asc_nulls_last())
    reach = sources.withColumn("hi", F.sum("target").over(order) / F.sum("target").over(W.partitionBy())).withColumn("lo", F.coalesce(F.lag("hi").over(order), F.lit(0.0)))
    reach = reach.withColumn("hi", F.when(F.row_number().over(W.orderBy(F.col("src").desc_nulls_first())) == 1, F.lit(1.0)).otherwise(F.col("hi"))).filter("hi > lo")
    reach = reach.select("src", "quota", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * _CELLS), F.floor(F.col("hi") * _CELLS))).alias("cell"))
    slots = spark.range(n_slots).select(F.col("id").alias("pos"), (F.pmod(F.pmod(F.col("id"), F.lit(2**31)) * F.lit(_GOLDEN), F.lit(2**32)) / F.lit(float(2**32))).alias("u"))
    slots = slots.withColumn("cell", F.floor(F.col("u") * _CELLS)).withColumn("chunk", F.floor(F.col("pos") / _CHUNK))
    dealt = slots.join(reach, "cell").filter("u >= lo and u < hi").select("pos", "chunk", "src", "quota")
    counts = dealt.groupBy("src", "chunk").agg(F.count("*").alias("n"))
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(W.partitionBy("src").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    counts = counts.select(F.col("src").alias("_src"), F.col("chunk").alias("_chunk"), "before", "n")
    ranked = dealt.withColumn("nth", F.row_number().over(W.partitionBy("src", "chunk").orderBy("pos")))
    ranked = ranked.join(counts, F.col("src").eqNullSafe(F.col("_src")) & (F.col("chunk") == F.col("_chunk"))).select("pos", "src", "quota", (F.col("before") + F.col("nth") - 1).alias("rank"))
    ranked = ranked.filter("rank < quota").select("pos", "src", "rank")
    had = counts.groupBy("_src").agg(F.sum("n").alias("had"))
    late = sources.join(had, F.col("src").eqNullSafe(F.col("_src")), "left").withColumn("had", F.coalesce("had", F.lit(0))).filter("had < quota")
    late = late.select("src", F.explode(F.sequence(F.col("had"), F.col("quota") - 1)).alias("rank"))
    return ranked.unionByName(late.select((F.lit(n_slots) + F.col("rank")).alias("pos"), "src", "rank"))


def mix(docs: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, most: float = 2.0, block_words: int = 1024, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(placed, taken blocks) of docs (id, src, size, copies), where size is of all copies together.

    placed: docs with source_size, target and at (the document's first word on its source's line). Taken blocks:
    (src, block, first_pos, whole, part, block_words): the slot that takes the block first, the times it is taken whole,
    and the words of it that the source's last slot takes.
    """
    if share >= most:
        raise ValueError("share must be below most")
    sources = cut(source_targets(docs.select("src", "size"), weights, share, most))
    words, rows = sources.agg(F.sum("target"), F.sum("n_rows")).first()
    block = max(block_words, int(words or 0) // 2**30)  # the integer points repeat after 2**31 slots
    goal = F.floor("target")
    sources = sources.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long"))
    sources = sources.withColumn("more", (goal - F.col("passes") * F.col("source_size")).cast("long"))
    sources = sources.withColumn("blocks", F.ceil(F.col("source_size") / block)).withColumn("quota", F.col("passes") * F.col("blocks") + F.ceil(F.col("more") / block))

    # A document's place: its source's buckets of the shuffle hash, summed, then the order within its bucket.
    digits = 1
    while 16**digits * 20_000 < (rows or 0):
        digits += 1
    key = F.md5(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(seed))))
    dealt = docs.withColumn("key", key).withColumn("bucket", F.substring("key", 1, digits))
    sums = dealt.groupBy(F.col("src").alias("s"), F.col("bucket").alias("b")).agg(F.sum("size").alias("n"))
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(W.partitionBy("s").orderBy("b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("n")
    facts = sources.select(F.col("src").alias("s2"), "source_size", "target")
    sums = sums.join(facts, F.col("s").eqNullSafe(F.col("s2"))).drop("s2")
    inside = W.partitionBy("src", "bucket").orderBy("key", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = dealt.join(sums, F.col("src").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    placed = placed.withColumn("at", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))).select("id", "src", "size", "copies", "source_size", "target", "at")

    slots = _schedule(sources, int(sources.agg(F.sum("quota")).first()[0] or 0))
    slots = slots.join(sources.select(F.col("src").alias("s"), "source_size", "blocks", "quota", "more"), F.col("src").eqNullSafe(F.col("s")))
    slots = slots.withColumn("block", F.pmod("rank", "blocks")).withColumn("long", F.least(F.lit(block), F.col("source_size") - F.col("block") * block))
    slots = slots.withColumn("take", F.when((F.col("more") > 0) & (F.col("rank") == F.col("quota") - 1), F.least("long", F.col("more") - F.col("block") * block)).otherwise(F.col("long")))
    whole = F.col("take") == F.col("long")
    taken = slots.groupBy("src", "block").agg(F.min("pos").alias("first_pos"), F.count_if(whole).alias("whole"), F.coalesce(F.max(F.when(~whole, F.col("take"))), F.lit(0)).alias("part"))
    return placed, taken.withColumn("block_words", F.lit(block))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size", **how) -> DataFrame:
    """docs with size_col, source_size, target, taken (words that the mix takes, repeats counted) and mix_at.

    mix_at: the slot of the mix that brings the document first; null if nothing of it is taken. size_col null or negative
    counts as 0; a null source is a source. A document that lies over several blocks is joined to each of them. Rows with
    one id, source and size lie on the line as one and share its words alike, rounded down. Only these three columns go
    through the mix; the others (texts) are joined once, to the result. Columns source_size, target, taken and mix_at of
    docs are replaced.
    """
    s = Sealed(docs, "source_size", "target", "taken", "mix_at")
    size = F.greatest(F.coalesce(F.col(s[size_col]), F.lit(0)), F.lit(0)).cast("long")
    rows = s.df.withColumn(s[size_col], size)
    keys = [s[id_col], s[source_col], s[size_col]]
    narrow = cut(rows.groupBy(*(F.col(k).alias(n) for k, n in zip(keys, ("id", "src", "one"), strict=True))).agg(F.count("*").alias("copies")).withColumn("size", F.col("one") * F.col("copies")).drop("one"))
    placed, blocks = mix(narrow, **how)
    block = blocks.select("block_words").first()
    block = block[0] if block else 1
    lies = placed.filter(F.col("size") > 0).select("src", "at", (F.col("at") + F.col("size")).alias("end"))
    lies = lies.withColumn("b", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("end") - 1) / block))))
    b = blocks.select(F.col("src").alias("s"), "block", "first_pos", "whole", "part")
    lo, hi = F.greatest(F.col("at"), F.col("b") * block), F.least(F.col("end"), (F.col("b") + 1) * block)
    words = F.col("whole") * (hi - lo) + F.greatest(F.lit(0), F.least(hi, F.col("b") * block + F.col("part")) - lo)
    got = lies.join(b, F.col("src").eqNullSafe(F.col("s")) & (F.col("b") == F.col("block"))).withColumn("words", words).filter("words > 0")
    got = got.groupBy(F.col("src").alias("s"), F.col("at").alias("a")).agg(F.sum("words").alias("words"), F.min("first_pos").alias("mix_at"))
    dealt = placed.join(got, F.col("src").eqNullSafe(F.col("s")) & (F.col("at") == F.col("a")) & (F.col("size") > 0), "left")
    taken = F.floor(F.coalesce(F.col("words"), F.lit(0)) / F.col("copies")).cast("long")
    dealt = dealt.select("id", "src", (F.col("size") / F.col("copies")).cast("long").alias("one"), "source_size", "target", taken.alias("taken"), "mix_at")
    out = rows.join(dealt, F.col(keys[0]).eqNullSafe(F.col("id")) & F.col(keys[1]).eqNullSafe(F.col("src")) & (F.col(keys[2]) == F.col("one")))
    return s.opened(out, "source_size", "target", "taken", F.when(F.col("taken") > 0, F.col("mix_at")).alias("mix_at"))


def op6(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("size"))
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "mix_at")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w, source_size * 2.0::DOUBLE AS lim FROM s),
o AS (SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
    - coalesce(sum(lim) OVER (ORDER BY lim / w, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
    sum(w) OVER (ORDER BY lim / w, source NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS opn FROM w),
f AS (SELECT *, lft / opn > lim / w AS is_full FROM o),
t AS (SELECT source, source_size, CASE WHEN is_full THEN lim ELSE w * (SELECT arg_max(lft / opn, opn) FROM f WHERE NOT is_full) END AS target FROM f),
p AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS goal,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(concat_ws(':', doc_id::VARCHAR, '0')), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
bw AS (SELECT greatest(1024, floor(coalesce(sum(target), 0))::BIGINT // 1073741824) AS bw FROM t),
q AS (SELECT source, source_size, target, bw, floor(target)::BIGINT % source_size AS more, ceil(source_size / bw)::BIGINT AS blocks,
    (floor(target)::BIGINT // source_size) * ceil(source_size / bw)::BIGINT + ceil((floor(target)::BIGINT % source_size) / bw)::BIGINT AS quota FROM t, bw WHERE source_size > 0),
r AS (SELECT *, coalesce(sum(target) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) / sum(target) OVER (), 0) AS lo,
    CASE WHEN row_number() OVER (ORDER BY source DESC NULLS FIRST) = 1 THEN 1 ELSE sum(target) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) / sum(target) OVER () END AS hi FROM q),
g AS (SELECT sum(quota)::BIGINT AS n FROM q),
u AS (SELECT pos, (pos % 2147483648 * 2654435769) % 4294967296 / 4294967296 AS u FROM (SELECT unnest(range(0, n)) AS pos FROM g)),
v AS (SELECT source, pos, row_number() OVER (PARTITION BY source ORDER BY pos) - 1 AS rk FROM u JOIN r ON u >= lo AND u < hi),
had AS (SELECT source, count(*) AS had FROM v GROUP BY source),
l AS (SELECT q.source, unnest(range(coalesce(had, 0), quota)) AS rk FROM q LEFT JOIN had ON q.source IS NOT DISTINCT FROM had.source WHERE coalesce(had, 0) < quota),
z AS (SELECT source, pos, rk FROM v UNION ALL SELECT source, n + rk, rk FROM l, g),
y AS (SELECT z.source, bw, rk % blocks AS block, min(pos) AS pos, count(*) FILTER (more = 0 OR rk < quota - 1 OR more - rk % blocks * bw >= least(bw, source_size - rk % blocks * bw)) AS n_whole,
    coalesce(max(more - rk % blocks * bw) FILTER (more > 0 AND rk = quota - 1 AND more - rk % blocks * bw < least(bw, source_size - rk % blocks * bw)), 0) AS part
  FROM z JOIN q ON z.source IS NOT DISTINCT FROM q.source WHERE rk < quota GROUP BY ALL),
f1 AS (SELECT p.doc_id, min(pos) AS mix_at FROM p JOIN y ON p.source IS NOT DISTINCT FROM y.source AND block BETWEEN a // bw AND (a + size - 1) // bw
  WHERE size > 0 AND (n_whole > 0 OR block * bw + part > a) GROUP BY p.doc_id)
SELECT p.doc_id, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE (goal // source_size) * size + greatest(0, least(a + size, goal % source_size) - a) END::BIGINT AS taken, mix_at
FROM p LEFT JOIN f1 ON p.doc_id = f1.doc_id
"""
