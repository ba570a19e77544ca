"""Runs of words that repeat with a period, by partition refinement of equal-factor classes.

For a length l, positions are in one class if the factors of l words that begin there are equal. Going from l to l + 1
splits a class by the classes of its members' successors. For the first lengths, at which nearly every class changes,
numpy refines all classes at once; from then on only the smaller parts of what has just split are looked at (of a class
that falls apart the largest part can't split anything further that the others don't), so a document of n words takes
time n log n, however long its repeats. Two neighbouring members of a class whose distance is the length are a square of
that period; squares that begin at consecutive words make a run. A link between neighbours tells the length at which it
arose, so that a square is found when its link breaks and no length has to look at what did not change.

Documents are refined together in blocks of bounded size, each within itself. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from spliceframe.llm.common import SPACES, Sealed, let, table

#: Lengths that are refined for all classes at once.
DENSE = 4
#: Words that are refined together; a longer document makes a block of its own.
BLOCK = 250_000
RUNS = ArrayType(StructType([StructField(c, LongType()) for c in ("start", "length", "period")]))


def _by_class(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and positions, ordered by key, then position. Positions come in ascending order."""
    n = int(at[-1]) + 1
    if int(key.max()) < 2**62 // n:
        both = np.sort(key * n + at)
        key = both // n
        return key, both - key * n
    order = np.argsort(key, kind="stable")
    return key[order], at[order]


class Refinement:
    """Classes of the positions whose factor occurs again, as neighbours in order of position. Lists are by rank of the position."""

    def __init__(self, at: np.ndarray, cls: np.ndarray, level: int):
        """at: positions in ascending order; cls: their classes of factors of length level, from 0."""
        self.level, self.at = level, at.tolist()
        self.follows = np.append(False, np.diff(at) == 1).tolist()
        self.cls = cls.tolist()
        order = np.lexsort((np.arange(len(at)), cls))
        same = cls[order][1:] == cls[order][:-1]
        nxt, prv = np.full(len(at), -1), np.full(len(at), -1)
        nxt[order[:-1][same]], prv[order[1:][same]] = order[1:][same], order[:-1][same]
        self.nxt, self.prv, self.born = nxt.tolist(), prv.tolist(), [level + 1] * len(at)  # squares of up to level are known
        self.size = np.bincount(cls).tolist()
        self.head = order[np.append(True, ~same)].tolist()
        self.squares: list[tuple[int, int]] = []

    def members(self, c: int) -> list[int]:
        out, r = [], self.head[c]
        while r >= 0:
            out.append(r)
            r = self.nxt[r]
        return out

    def broken(self, a: int, b: int) -> None:
        gap = self.at[b] - self.at[a]
        if self.born[a] <= gap <= self.level:
            self.squares.append((gap, self.at[a]))

    def joined(self, a: int, b: int) -> None:
        if a >= 0:
            self.nxt[a], self.born[a] = b, self.level + 1
        if b >= 0:
            self.prv[b] = a

    def leaves(self, r: int, c: int) -> None:
        a, b = self.prv[r], self.nxt[r]
        if a >= 0:
            self.broken(a, r)
        else:
            self.head[c] = b
        if b >= 0:
            self.broken(r, b)
        self.joined(a, b)

    def refine(self, small: list[list[int]], gone: list[int]) -> tuple[list[list[int]], list[int]]:
        """From factors of length level to level + 1. small: the smaller parts of what split last, in ascending order;
        gone: ranks whose successor's factor occurs nowhere else. Both are given back for the next length."""
        parts: dict[int, list[list[int]]] = {}
        for part in small:
            by: dict[int, list[int]] = {}
            for r in part:
                if self.follows[r] and self.cls[r - 1] >= 0:
                    by.setdefault(self.cls[r - 1], []).append(r - 1)
            for c, found in by.items():
                parts.setdefault(c, []).append(found)
        for r in gone:
            if self.cls[r] >= 0:
                parts.setdefault(self.cls[r], []).append([r])
        small, gone = [], []
        for c, found in parts.items():
            rest = self.size[c] - sum(map(len, found))
            if not rest:
                if len(found) == 1 and self.size[c] > 1:
                    continue
                found.sort(key=len)
                rest = len(found.pop())  # the largest keeps the name
            largest = max(map(len, found), default=0)
            self.size[c] = rest
            for part in found:
                for r in part:
                    self.leaves(r, c)
            for part in found:
                new = len(self.size) if len(part) > 1 else -1
                for r in part:
                    self.cls[r] = new
                if new >= 0:
                    self.size.append(len(part))
                    self.head.append(part[0])
                    self.prv[part[0]] = self.nxt[part[-1]] = -1
                    for a, b in zip(part, part[1:]):
                        self.joined(a, b)
                if new < 0:
                    gone.append(part[0])
                elif rest >= largest or len(part) < largest:
                    small.append(part)
                else:
                    largest += 1  # of parts of one size the first is let off
            if rest == 1:
                r = self.head[c]
                self.cls[r] = -1
                gone.append(r)
            elif rest < largest:
                small.append(self.members(c))
        self.level += 1
        return small, [r - 1 for r in gone if self.follows[r]]


def squares(code: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all squares of primitive words. code: the words; end: where each one's document ends."""
    starts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at, cls = np.arange(len(code)), np.full(len(code) + 1, -1)
    key, old = end * (int(code.max(initial=0)) + 1) + code, cls
    for level in range(1, DENSE + 1):
        if not len(at):
            break
        old = cls.copy()
        key, at = _by_class(key, at)
        same = key[1:] == key[:-1]
        square = same & (at[1:] - at[:-1] == level)
        starts.append(at[:-1][square])
        periods.append(np.full(len(starts[-1]), level))
        live = np.append(False, same) | np.append(same, False)
        name = np.cumsum(np.append(True, ~same))[live]
        at = at[live]
        cls[:] = -1
        if len(at):
            cls[at] = np.cumsum(np.append(0, np.diff(name) > 0))  # without gaps
        at = np.sort(at)
        if level < DENSE:  # those whose longer factor still ends within the document and may occur again
            at = at[at + level < end[at]]
            at = at[cls[at + 1] >= 0]
            key = cls[at] * (int(cls.max()) + 1) + cls[at + 1]
    if len(at):
        own = cls[at]
        r = Refinement(at, own, DENSE)
        size, first = np.bincount(own), np.unique(own, return_index=True)[1]
        parent = old[at[first]]
        order = np.lexsort((-size, parent))
        largest = order[np.append(True, np.diff(parent[order]) > 0)]
        small = [r.members(c) for c in np.setdiff1d(np.arange(len(size)), largest).tolist()]
        died = np.flatnonzero((at + DENSE >= end[at]) | (cls[at + 1] < 0)).tolist()
        while small or died:
            small, died = r.refine(small, died)
        if r.squares:
            more = np.array(r.squares)
            starts.append(more[:, 1])
            periods.append(more[:, 0])
    return np.concatenate(starts), np.concatenate(periods)


def runs_of(code: np.ndarray, end: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of the runs of least words or more, by start, then period."""
    start, period = squares(code, end)
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    first = np.append(True, (np.diff(start) != 1) | (np.diff(period) != 0))[: len(start)]
    last = np.append(first[1:], True)[: len(start)]
    period = period[first]
    length = start[last] - start[first] + 2 * period
    start = start[first]
    long = np.flatnonzero(length >= least)
    long = long[np.lexsort((period[long], start[long]))]
    return start[long], length[long], period[long]


def _block(texts: list[bytes], least: int) -> tuple[list[np.ndarray], list[bytes]]:
    """For each text its runs (start, length and period by row) and the text without repeats."""
    words = [t.split() for t in texts]  # at space and U+0009 to U+000D
    n = np.array([len(w) for w in words])
    ends = np.cumsum(n)
    flat = [x for w in words for x in w]
    code = np.array(list(map(dict[bytes, int]().setdefault, flat, count())), np.int64)
    start, length, period = runs_of(code, np.repeat(ends, n), least)
    doc = np.searchsorted(ends, start, "right")
    change = np.zeros(len(code) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    keep = np.cumsum(change)[:-1] == 0
    found = np.stack([start - (ends - n)[doc], length, period], 1)
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    runs, kept = [], []
    for i, w in enumerate(words):
        runs.append(found[bounds[i] : bounds[i + 1]])
        if len(runs[-1]):
            w = [x for x, k in zip(w, keep[ends[i] - n[i] : ends[i]].tolist(), strict=True) if k]
        kept.append(b" ".join(w))
    return runs, kept


def collapse_runs(docs: DataFrame, least: int = 12, text_col: str = "text") -> DataFrame:
    """docs with runs (start, length, period, by start, then period) and collapsed, the text without repeats.

    Words are what is not space or U+0009 to U+000D, numbered from 0. A run is a stretch of words of which those a
    period apart are identical, with the smallest such period, at least twice the period and least words long, that
    can't be extended on either side. A word goes if a run contains it after that run's first period; the others are
    joined by one space. Null and empty texts: no runs, "". Rows are judged one by one, so repeated ids and rows are no
    matter. Columns of docs named runs or collapsed are replaced. A task holds BLOCK words, or one document.
    """
    s = Sealed(docs, "runs", "collapsed")
    text, names = s[text_col], s.df.columns
    schema = StructType([*s.df.schema.fields, StructField("runs", RUNS), StructField("collapsed", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(names.index(text)).cast(pa.binary()).to_pylist()]
            size = np.cumsum([len(t) for t in texts])
            starts = [0, *np.flatnonzero(np.diff(size // (6 * BLOCK)) > 0) + 1, len(texts)]
            for lo, hi in zip(starts, starts[1:]):
                runs, kept = _block(texts[lo:hi], least)
                flat = np.concatenate([np.zeros((0, 3), np.int64), *runs])
                each = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, j])) for j in range(3)], ["start", "length", "period"])
                lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, runs)]).astype(np.int32), each)
                columns = [batch.column(i).slice(lo, hi - lo) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, lists, pa.array(kept, pa.binary()).cast(pa.string())], names=[*names, "runs", "collapsed"])

    return s.opened(s.df.mapInArrow(run, schema), "runs", "collapsed")


def periodic_tail(doc_id: Column, text: Column) -> Column:
    """text, for a tenth of the ids with its words repeating from some word on: h is the id's CRC-32, a = (h / 10) % n, and word i >= a becomes word a + (i - a) % p."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def rewritten(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = let(p, lambda q: F.transform(F.sequence(F.lit(0).cast("long"), n - a - 1), lambda i: F.get(words, (a + i % q).cast("int"))))
        return F.array_join(F.concat(F.slice(words, 1, a.cast("int")), tail), " ")

    inner = F.btrim(text, F.lit(SPACES))
    return F.when((h % 10 == 0) & (inner != ""), let(F.split(inner, r"[\x20\x09-\x0D]+", -1), rewritten)).otherwise(text)


def op11(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic_tail(F.col("doc_id"), F.col("text")).alias("text"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    out = collapse_runs(docs).select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), "runs", "collapsed")
    start, length, period = -F.col("best.col2"), F.col("best.length"), -F.col("best.col3")
    told = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return out.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"), F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
