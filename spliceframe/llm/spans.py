"""Positions of regular-expression matches in built-in functions, in time n log n of a text and its matches.

regexp_extract_all copies the text for every match; one regexp_replace that marks the matches, split at the marks, does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spliceframe.llm.common import let

_OPEN, _SHUT = "\x01", "\x02"


def marked(text: Column, pattern: str) -> Column:
    """The text split at the matches of a Java pattern: what is before the first, then each match with what follows it.

    No pattern here may match U+0001 to U+0003; the two marks are replaced where the text holds them (not by U+0000, which
    translate() drops). Null: null.
    """
    plain = F.when(text.contains(_OPEN) | text.contains(_SHUT), F.translate(text, _OPEN + _SHUT, "\x03\x03")).otherwise(text)
    return F.split(F.regexp_replace(plain, pattern, f"{_OPEN}$0{_SHUT}"), _OPEN, -1)


def running(values: Column) -> Column:
    """Running sums of an array of bigint. Every pass adds what lies twice as far back as in the one before: n log n steps."""
    steps = F.filter(F.array(*(F.lit(1 << k) for k in range(31))), lambda step: step < F.size(values))
    return F.aggregate(steps, values, lambda sums, step: F.transform(sums, lambda x, i: x + F.when(i >= step, sums[i - step]).otherwise(0)))


def placed(parts: Column, context: int = 0) -> Column:
    """The matches in marked() as (start, end, match, before): code points, end exclusive; none for null.

    before: what stands between the match before and this one, the last context code points of it.
    """

    def spans(parts: Column) -> Column:
        lengths = F.transform(parts, lambda p, i: (F.length(p) - F.when(i > 0, 1).otherwise(0)).cast("bigint"))

        def span(ends: Column, p: Column, i: Column) -> Column:
            match = F.substring_index(p, _SHUT, 1)
            before = F.right(F.substring_index(parts[i], _SHUT, -1), F.lit(context)) if context else F.lit("")
            return F.struct(ends[i].alias("start"), (ends[i] + F.length(match)).alias("end"), match.alias("match"), before.alias("before"))

        return let(running(lengths), lambda ends: F.transform(F.slice(parts, 2, F.size(parts) - 1), lambda p, i: span(ends, p, i)))

    return F.when(F.size(parts) > 1, let(parts, spans)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,match:string,before:string>>"))


def told(spans: Column) -> Column:
    """kind:start:end, comma-joined, from an array of structs with these fields."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
