"""Secret scans with an incremental ledger of blobs.

Every version of every text is a blob, addressed by the SHA-256 of its bytes. The ledger holds the pairs of blob and rule
version that were scanned, and what they gave. A scan takes the pairs that the ledger lacks, looks once at each such
blob, however many paths hold it, and joins all findings back to all paths.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spliceframe.llm.common import Sealed, table, temporary
from spliceframe.llm.pii import _sql_spans
from spliceframe.llm.spans import count, marked, placed, told

_FOUND = "array<struct<kind:string,start:bigint,end:bigint>>"
SCHEMA = f"blob string, rule string, spans {_FOUND}"


@dataclass(frozen=True)
class Rule:
    name: str
    version: int
    pattern: str
    holds: Callable[[Column], Column]
    base: bool = True

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


_ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?"""
_JWT = r"^eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}$"
#: The base rules' patterns are fixed by the contract; the last two are added.
RULES = (
    Rule("assign", 1, _ASSIGN + r"[A-Za-z0-9+/_.=-]+", lambda m: F.length(F.regexp_replace(m, "^" + _ASSIGN, "")) >= 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", lambda m: F.lit(True)),  # AKIA[A-Z0-9]+ of 16 characters or more
    Rule("hex", 1, r"[0-9a-f]{32,}", lambda m: F.lit(True)),  # [0-9a-f]+ of 32 characters or more
    Rule("jwt", 1, r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]++)++", lambda m: m.rlike(_JWT), base=False),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", lambda m: F.lit(True), base=False),
)


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """(blob, rule, spans): new rows of the ledger, for the pairs of blob and rule that it lacks. A blob is read once.

    ledger: (blob, rule, spans) of former scans. Null texts are the empty blob. spans: array of (kind, start, end) in
    code points, end exclusive; a rule's matches are leftmost and do not overlap, those that fail its check are dropped.
    """
    blobs = docs.select(F.col(text_col).alias("text"), blob_of(F.col(text_col)).alias("blob"))
    names = F.array(*(F.lit(r.key) for r in rules))
    todo = blobs.dropDuplicates(["blob"])  # copies of a text end where they are read; one for each task goes on
    if ledger is None:
        todo = todo.withColumn("todo", names)
    else:
        seen = ledger.groupBy(F.col("blob").alias("_blob")).agg(F.collect_set("rule").alias("seen"))
        todo = todo.join(seen, F.col("blob") == F.col("_blob"), "left").drop("_blob")
        todo = todo.withColumn("todo", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))).drop("seen").filter(F.size("todo") > 0)
    for i, r in enumerate(rules):
        todo = todo.withColumn(f"m{i}", F.when(F.array_contains("todo", r.key), marked(F.col("text"), r.pattern)))

    def spans(i: int, r: Rule) -> Column:
        kept = F.filter(placed(F.col(f"m{i}")), lambda s: r.holds(s["match"]))
        return F.transform(kept, lambda s: F.struct(F.lit(r.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    none = F.array().cast(_FOUND)
    results = F.array(*(F.struct(F.lit(r.key).alias("rule"), F.when(F.size(f"m{i}") > 1, spans(i, r)).otherwise(none).alias("spans")) for i, r in enumerate(rules)))
    todo = todo.select("blob", "todo", F.explode_outer(results).alias("r"))  # explode() would have the results worked out twice
    return todo.filter(F.array_contains("todo", F.col("r.rule"))).select("blob", "r.rule", "r.spans")


def findings(paths: DataFrame, known: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """paths (with blob) with secrets: array of (kind, start, end) from the ledger's rows of these rules, by start, then rule."""
    order = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)))
    known = known.filter(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0))
    known = known.groupBy("blob", "rule").agg(F.any_value("spans").alias("spans"))  # two scans at one time may both have added a pair
    per_blob = known.groupBy(F.col("blob").alias("b")).agg(F.flatten(F.collect_list("spans")).alias("secrets"))
    ordered = F.array_sort(F.transform("secrets", lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("o"), s["end"].alias("end"), s["kind"].alias("kind"))))
    per_blob = per_blob.select("b", F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("secrets"))
    s = Sealed(paths, "secrets")
    joined = s.df.join(per_blob, F.col(s["blob"]) == F.col("b"), "left")
    return s.opened(joined, F.coalesce("secrets", F.array().cast(_FOUND)).alias("secrets"))


class Ledger:
    """The ledger as a folder of Parquet files in the shared store, which grow with each scan."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def update(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> None:
        """Scans the pairs of blob and rule version that the ledger lacks and adds them."""
        scan(docs, self.read(), rules, text_col).write.mode("append").parquet(self.path)


def find_secrets(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """docs without text_col but with blob and secrets, from the ledger, to which is added what it lacks.

    Columns blob and secrets of docs are replaced. Null texts are the empty blob, which holds nothing.
    """
    ledger.update(docs, rules, text_col)
    s = Sealed(docs, "blob", "secrets")
    return findings(s.opened(s.df, blob_of(F.col(s[text_col])).alias("blob"), without=(text_col,)), ledger.read(), rules)


def op9(spark, sf_dir: str) -> DataFrame:
    """A ledger of its own for each call, which cleared() deletes; a deployment names one folder, and scans what is new there."""
    ledger = Ledger(spark, temporary(spark, "secrets"))
    out = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), ledger)
    base = [r.name for r in RULES if r.base]
    counts = [count(F.col("secrets"), k) for k in base]
    return out.select("doc_id", *counts, F.sha2(told(F.filter("secrets", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), told(F.col("secrets")).alias("spans"))


_SQL_ASSIGN = _ASSIGN.replace("'", "''")
_SQL_HOLDS = {"assign": f"length(regexp_replace(m, '^{_SQL_ASSIGN}', '')) >= 8", "jwt": f"regexp_matches(m, '{_JWT}')"}
_SQL_PATTERN = {"jwt": r"[A-Za-z0-9_-]+(\.[A-Za-z0-9_-]+)+"}
OP9_SQL = f"""
WITH f AS ({" UNION ALL ".join(_sql_spans(r.name, _SQL_PATTERN.get(r.name, r.pattern).replace("'", "''"), _SQL_HOLDS.get(r.name, "true")) for r in RULES)}),
k AS (SELECT *, list_position([{", ".join(f"'{r.name}'" for r in RULES)}], kind) AS o, kind || ':' || s || ':' || e AS told FROM f)
SELECT d.doc_id, {", ".join(f"count(*) FILTER (kind = '{r.name}') AS n_{r.name}" for r in RULES if r.base)},
  sha256(coalesce(string_agg(told, ',' ORDER BY s, o) FILTER (o <= 3), '')) AS base_sha256, coalesce(string_agg(told, ',' ORDER BY s, o), '') AS spans
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id GROUP BY d.doc_id
"""
