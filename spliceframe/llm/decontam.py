"""Benchmark decontamination by winnowing.

A text's words give k-gram hashes; of every 8 consecutive 6-gram hashes the least is kept (the leftmost, if several are).
Two texts that share 13 consecutive words share a window of 8 hashes and so keep the same one at the same place in it:
no shared span of 13 words is missed. Kept hashes of documents are joined with those of the benchmark; a hit extends to the
windows of 13 words around it, which are looked up by digest among the items' windows.
Items under 13 words are looked up whole: every document position gives a hash for each such length that occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spliceframe.llm.common import Sealed, ascii_lower, cut, let, table

WINDOW, _K, _KEEP = 13, 6, 8  # _K + _KEEP - 1 words: the least shared span
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: At most so many benchmark hashes (of 32 bytes or so a row) are broadcast; more are joined by shuffling.
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(ascii_lower(text), F.lit("")), _GAP, -1), lambda w: w != "")


def _grams(hashes: Column, n: int, *seed: Column, low: int = 0) -> Column:
    """The hashes of every n words, with the low bits clear."""
    starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (n - 1), F.lit(0)))
    return F.transform(starts, lambda _, i: F.xxhash64(*seed, *(hashes[i + j] for j in range(n))).bitwiseAND(F.lit(-(1 << low))))


def fingerprints(df: DataFrame, words: str, short: list[int]) -> DataFrame:
    """df with fps: array of (pos, hash): the winnowed hashes and those of every short length, with positions from 0."""
    df = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn("_m", _grams(F.col("_h"), _K, low=3))
    for step in (1, 2, 4):  # the low bits tell how far right the least of a window is
        least = F.col("_m")
        starts = F.slice(least, 1, F.greatest(F.size(least) - step, F.lit(0)))
        df = df.withColumn("_n", _halves(least, starts, step)).drop("_m").withColumnRenamed("_n", "_m")
    m = F.col("_m")

    def new(x: Column, i: Column) -> Column:
        return (i == 0) | (x.bitwiseAND(F.lit(7)) + 1 != m[F.greatest(i - 1, F.lit(0))].bitwiseAND(F.lit(7)))

    kept = F.transform(m, lambda x, i: F.when(new(x, i), F.struct((i + x.bitwiseAND(F.lit(7))).cast("int").alias("pos"), F.lit(WINDOW).alias("n"), x.bitwiseAND(F.lit(-8)).alias("hash"))))
    kept = F.filter(kept, lambda x: x.isNotNull())
    more = [F.transform(_grams(F.col("_h"), n, F.lit(n)), lambda g, i: F.struct(i.cast("int").alias("pos"), F.lit(n).alias("n"), g.alias("hash"))) for n in short]
    return df.withColumn("fps", F.concat(kept, *more) if more else kept).drop("_h", "_m")


def _halves(least: Column, starts: Column, step: int) -> Column:
    return F.transform(starts, lambda x, i: F.least(x, least[i + step].bitwiseOR(F.lit(step))))


def _digests(window: Column) -> list[Column]:
    """128 bits of a window's text."""
    return [F.xxhash64(window).alias("d1"), F.xxhash64(F.lit(7), window).alias("d2")]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs with n_words, n_hit, n_items, items (ids as strings, sorted), hits (array of start and end word) and contaminated.

    A window is 13 consecutive words of an item, or a whole item of fewer; a document word inside any occurrence of a
    window is hit; contaminated if at least one word and at least a twentieth of the words are. hits: the stretches of
    words that are hit. Null and empty texts have no words. Repeated ids are judged row by row. Items without words are
    never hit; a null item id counts as "". Columns of docs with these names are replaced.

    A document's texts meet its own candidate places only: what joins the benchmark are hashes and digests. Windows are
    told by 128 bits.
    """
    s = Sealed(docs, "n_words", "n_hit", "n_items", "items", "hits", "contaminated")
    text = F.col(s[text_col])
    items = cut(benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words_of(F.col(item_text)).alias("words")).filter(F.size("words") > 0))
    short = sorted(r[0] for r in items.filter(F.size("words") < WINDOW).select(F.size("words")).distinct().collect())
    # explode() would push a test of the array's size, and so a second, nested evaluation, below these steps
    theirs = fingerprints(items, "words", []).withColumn("all", F.col("fps"))
    for n in short:
        whole = F.array(F.struct(F.lit(0).alias("pos"), F.lit(n).alias("n"), F.xxhash64(F.lit(n), *(F.xxhash64(F.col("words")[j]) for j in range(n))).alias("hash")))
        theirs = theirs.withColumn("all", F.when(F.size("words") == n, whole).otherwise(F.col("all")))
    theirs = _small(theirs.select(F.explode_outer("all.hash").alias("hash")).distinct())
    length = F.least(F.size("words"), F.lit(WINDOW))
    windows = items.select("item", F.explode_outer(F.transform(F.sequence(F.lit(0), F.size("words") - length), lambda i: F.array_join(F.slice("words", i + 1, length), " "))).alias("w"))
    # A window stands for the set of its items: what meets the documents is one row for each window, however many items share it.
    windows = windows.select("item", *_digests(F.col("w"))).groupBy("d1", "d2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    windows = cut(windows.withColumn("set", F.md5(F.to_json("items"))))
    members = windows.select("set", "items").dropDuplicates(["set"])
    windows = _small(windows.select("d1", "d2", "set"))

    # A row is its id and its text's hash: rows alike in both have the same hits.
    texts = s.df.select(F.col(s[id_col]).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    ours = fingerprints(texts.select("id", "h", words_of(F.col("text")).alias("words")), "words", short)
    met = ours.select("id", "h", F.explode_outer("fps").alias("fp")).select("id", "h", "fp.*").join(theirs, "hash", "left_semi")
    first = F.when(F.col("n") == WINDOW, F.greatest(F.col("pos") - (_KEEP - 1), F.lit(0))).otherwise(F.col("pos"))
    met = met.select("id", "h", F.explode(F.transform(F.sequence(first, F.col("pos")), lambda i: F.struct(i.alias("start"), F.col("n").alias("n")))).alias("at"))
    places = cut(met.groupBy("id", "h").agg(F.collect_set("at").alias("places")))
    if (places.agg(F.sum(F.size("places"))).first()[0] or 0) <= BROADCAST_ROWS:  # of 8 bytes each
        places = F.broadcast(places)
    places = places.withColumnsRenamed({"id": "i", "h": "g"})
    near = texts.join(places, F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("g"))).select("id", "h", "places", words_of(F.col("text")).alias("words"))
    inside = F.filter("places", lambda p: p["start"] + p["n"] <= F.size("words"))
    near = near.withColumn("seen", F.transform(inside, lambda p: F.struct(p["start"].alias("start"), (p["start"] + p["n"]).alias("end"), F.array_join(F.slice(F.col("words"), p["start"] + 1, p["n"]), " ").alias("w"))))
    near = near.select("id", "h", F.explode_outer("seen").alias("at")).select("id", "h", "at.start", "at.end", *_digests(F.col("at.w")))
    hits = cut(near.join(windows, ["d1", "d2"]).select("id", "h", "start", "end", "set").distinct())

    by = W.partitionBy("id", "h").orderBy("start", "end")
    reach = F.coalesce(F.max("end").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1))
    spans = hits.select("id", "h", "start", "end").distinct().withColumn("reach", reach)
    spans = spans.withColumn("run", F.sum((F.col("start") > F.col("reach")).cast("long")).over(by.rowsBetween(W.unboundedPreceding, 0)))
    spans = spans.groupBy("id", "h", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = spans.groupBy("id", "h").agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("hits"))
    # Documents that hit the same sets have the same items, which are gathered once.
    met = cut(hits.groupBy(F.col("id").alias("i"), F.col("h").alias("g")).agg(F.array_sort(F.collect_set("set")).alias("sets")).withColumn("sets_key", F.md5(F.array_join("sets", ","))))
    gathered = met.select("sets_key", "sets").dropDuplicates(["sets_key"]).select("sets_key", F.explode("sets").alias("set")).join(members, "set")
    gathered = gathered.groupBy("sets_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    found = met.drop("sets").join(gathered, "sets_key").drop("sets_key")
    found = found.join(spans, F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("g"))).drop("id", "h")

    out = s.df.withColumn("n_words", _count(text)).withColumn("h", F.xxhash64(text)).join(found, F.col(s[id_col]).eqNullSafe(F.col("i")) & (F.col("h") == F.col("g")), "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    none = {"items": "array<string>", "hits": "array<struct<start:int,end:int>>"}
    items, hits = (F.coalesce(F.col(c), F.array().cast(t)).alias(c) for c, t in none.items())
    return s.opened(out, "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), items, hits, ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"))


def _small(df: DataFrame) -> DataFrame:
    """df, cut, and broadcast if it has at most BROADCAST_ROWS rows."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _count(text: Column) -> Column:
    """Number of words."""
    parts = F.split(F.coalesce(text, F.lit("")), _GAP.replace(r"\x60", r"\x40\x5B-\x60"), -1)  # the text has its capitals
    return let(parts, lambda p: F.size(p) - (p[0] == "").cast("int") - ((F.size(p) > 1) & (F.element_at(p, -1) == "")).cast("int")).cast("long")


def op3(spark, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP3_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, ws, least(13, len(ws)) AS n, unnest(range(1, greatest(len(ws) - 13, 0) + 2)) AS i FROM b WHERE len(ws) > 0)),
ls AS (SELECT DISTINCT n FROM bw),
dx AS (SELECT doc_id, i, list(w) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS x
  FROM (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d)),
dw AS (SELECT doc_id, n, i, array_to_string(x[1:n], ' ') AS g FROM dx, ls WHERE len(x) >= n),
h AS (SELECT DISTINCT dw.doc_id, bw.item_id, dw.i, dw.n FROM dw JOIN bw USING (n, g)),
p AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS q FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS its FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(its, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""
