"""PII: regular expressions propose spans, checksums confirm them, and words nearby adjust the score.

The patterns are possessive, so the regular-expression engine takes linear time and constant stack on any text; each finds
what its plain form (kept beside it) finds. A run of local-part characters or digits has its leftmost match at the
run's start or where the match before ended, hence the look-behind with \\G.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spliceframe.llm.common import LOWER, UPPER, Sealed
from spliceframe.llm.spans import count, marked, placed, told


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    turned = F.reverse(number)

    def worth(i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(number)), worth), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def mod97(code: Column) -> Column:
    """Whether letters and digits, moved and spelled as an IBAN's are, leave 1 over 97."""
    plain = F.upper(F.regexp_replace(code, "[^A-Za-z0-9]", ""))
    moved = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(c < 65, (acc * 10 + c - 48) % 97).otherwise((acc * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(plain)), F.lit(0), step) == 1


def octet(part: Column) -> Column:
    """Whether a string of digits is 255 at most, leading zeros aside."""
    bare = F.ltrim(part, F.lit("0"))
    return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    holds: Callable[[Column], Column]
    near: str  # words nearby that raise the score
    score: float
    base: bool = True
    least: float = 0.0  # spans of a lower score are dropped


#: The base kinds' patterns are fixed by the contract; iban and ssn (which counts only with a word of its kind before it) are added.
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda m: F.lit(True), "mail|contact|write|kontakt|correo", 0.8),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda m: F.forall(F.split(m, r"\."), octet), "host|server|address|ip", 0.5),
    # [0-9]([\x20-]?[0-9])+
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", lambda m: F.length(digits(m)).between(16, 19) & luhn(digits(m)), "card|visa|credit|karte|carte|tarjeta", 0.7),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: F.length(digits(m)).between(8, 15), "phone|call|tel|mobile|fax", 0.6),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?", mod97, "iban|bank|account|konto|compte|cuenta", 0.8, base=False),
    # [0-9]+(-[0-9]+)+
    Kind("ssn", r"(?<![0-9])[0-9]++(?:-[0-9]++)++", lambda m: m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn|social security|tax id", 0.4, base=False, least=0.6),
)
_FOUND = "array<struct<kind:string,start:bigint,end:bigint,match:string,score:double>>"


def near(words: str) -> str:
    """The pattern of one of these words, whole, in a text in lower case."""
    return f"(^|[^a-z])({words})([^a-z]|$)"


def _scored(kind: Kind, parts: Column, context: int) -> Column:
    def scored(s: Column) -> Column:
        close = F.translate(s["before"], UPPER, LOWER).rlike(near(kind.near))
        score = F.when(close, round(kind.score + 0.2, 2)).otherwise(kind.score)
        return F.struct(F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match"), score.alias("score"))

    spans = F.transform(F.filter(placed(parts, context), lambda s: kind.holds(s["match"])), scored)
    return F.when(F.size(parts) > 1, F.filter(spans, lambda s: s["score"] >= kind.least)).otherwise(F.array().cast(_FOUND))


def find_pii(docs: DataFrame, text_col: str = "text", context: int = 40, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """docs with pii: array of (kind, start, end, match, score), by kind in order, then start.

    Positions are code points, end exclusive. A kind's matches are leftmost and do not overlap; those that fail its
    check are dropped and not tried again further in. score, from 0 to 1, is 0.2 above the kind's own if a word of the kind
    stands in the context code points before the span, back to the match before at most; spans below the kind's least
    score are dropped (of the added kinds only, the base ones have none). Null and empty texts have none. A column pii
    of docs is replaced.
    """
    s = Sealed(docs, "pii")
    out = s.df
    for i, k in enumerate(kinds):
        out = out.withColumn(f"m{i}", marked(F.col(s[text_col]), k.pattern))
    for i, k in enumerate(kinds):
        out = out.withColumn(f"m{i}", _scored(k, F.col(f"m{i}"), context))
    return s.opened(out, F.concat(*(F.col(f"m{i}") for i in range(len(kinds)))).alias("pii"))


def op7(spark, sf_dir: str) -> DataFrame:
    docs = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = [k.name for k in KINDS if k.base]
    counts = [count(F.col("pii"), k) for k in base]
    scores = F.array_join(F.transform("pii", lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",")  # of the spans, in hundredths
    return docs.select("doc_id", *counts, F.sha2(told(F.filter("pii", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), told(F.col("pii")).alias("spans"), scores.alias("scores"))


def _sql_spans(kind: str, pattern: str, holds: str) -> str:
    """(doc_id, kind, start, end, what stands before) of the matches that pass."""
    return f"""SELECT doc_id, kind, p AS s, p + length(m) AS e, before FROM (
      SELECT doc_id, '{kind}' AS kind, ms[i] AS m, right(gaps[i], 40) AS before,
        list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS p
      FROM (SELECT doc_id, ms, gaps, unnest(range(1, len(ms) + 1)) AS i FROM (
        SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS gaps FROM documents))) WHERE {holds}"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LOWER = f"translate(before, '{UPPER}', '{LOWER}')"
_BARE = "upper(regexp_replace(m, '[^A-Za-z0-9]', '', 'g'))"
OP7_SQL = f"""
WITH f AS (
  {_sql_spans("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true")}
  UNION ALL {_sql_spans("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_max(list_transform(string_split(m, '.'), lambda x: try_cast(x AS HUGEINT))) <= 255")}
  UNION ALL {_sql_spans("card", r"[0-9]([\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN substr(reverse({_DIGITS}), i, 1)::INT ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][substr(reverse({_DIGITS}), i, 1)::INT + 1] END)) % 10 = 0")}
  UNION ALL {_sql_spans("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15")}
  UNION ALL {_sql_spans("iban", r"[A-Z]{{2}}[0-9]{{2}}(\x20?[A-Z0-9]{{4}}){{2,7}}(\x20?[A-Z0-9]{{1,3}})?".replace("{{", "{").replace("}}", "}"), f"list_reduce(list_transform(string_split({_BARE}[5:] || {_BARE}[:4], ''), lambda c: CASE WHEN c <= '9' THEN c::BIGINT ELSE ascii(c) - 55 END), lambda a, d: (CASE WHEN d < 10 THEN a * 10 ELSE a * 100 END + d) % 97) = 1")}
  UNION ALL {_sql_spans("ssn", "[0-9]+(-[0-9]+)+", "regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}')")}
), g AS (SELECT *, CASE kind {" ".join(f"WHEN '{k.name}' THEN {round(k.score * 100)} + 20 * regexp_matches({_LOWER}, '{near(k.near)}')::INT" for k in KINDS)} END AS score FROM f),
k AS (SELECT *, list_position([{", ".join(f"'{k.name}'" for k in KINDS)}], kind) AS o, kind || ':' || s || ':' || e AS told FROM g WHERE kind <> 'ssn' OR score >= 60)
SELECT d.doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card,
  count(*) FILTER (kind = 'phone') AS n_phone, sha256(coalesce(string_agg(told, ',' ORDER BY o, s) FILTER (o < 5), '')) AS base_sha256,
  coalesce(string_agg(told, ',' ORDER BY o, s), '') AS spans, coalesce(string_agg(score::VARCHAR, ',' ORDER BY o, s), '') AS scores
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id GROUP BY d.doc_id
"""
