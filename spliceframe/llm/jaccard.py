"""N-gram Jaccard join by PartEnum signatures.

Texts become sets of hashed word shingles; equal sets are one node. Sets of like size form bands; two sets of one band's
reach with a Jaccard index of 0.8 differ in at most k shingles. The shingle domain is cut into parts and each part into
second-level parts; a signature is what a set holds in all but one of a part's second-level parts, and every such subset
is enumerated. With (k + 1) / 2 parts or more some part has at most one difference, so two such sets share a signature.
A set enters its own band and, if it may reach it, the next one.

An empty signature says nothing and would bring a percent of all sets together. There are more parts than that, so that
sets agree on more signatures than they nearly ever have empty ones: these are left out, and the few sets that have as
many give a second draw under each empty one's name. So no link is lost, and no step depends on luck.

Nodes that share a signature are candidates. Small groups give all their pairs. In large ones a centre is compared with
the rest, several rounds with other centres; a group is done once all its nodes are in one component, so a group of
near copies costs its size and not its square. What is left is compared whole, in blocks of bounded size. Pairs pass a
filter that loses nothing (counts of shingles by cell differ by at most the sets' difference) before texts are compared.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spliceframe.llm.common import cut, partitions, slim, stored, table

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # splitmix64
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
_SMALL, _CHUNK, _ROUNDS = 6, 2048, 2
BROADCAST_ROWS = 1_000_000
_NO_ID = 2**63 - 1  # stands for null

_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * _FACTORS[0])


@cache
def _place(j: int) -> np.ndarray:
    return _mix(_FACTORS[:1] + np.uint64(j)) | np.uint64(1)


def _word_hashes(text: bytes) -> np.ndarray:
    """A hash for each word: the sum of mixed (byte, place in the word), mixed again with the length."""
    b = np.frombuffer(text, np.uint8)
    word = ~_SPACE[b]
    edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    x = (_BYTES[b[word]] + at.astype(np.uint64) * _FACTORS[1]) * _M1
    x = (x ^ (x >> np.uint64(32))) * _M2
    x ^= x >> np.uint64(29)
    return _mix(np.add.reduceat(x, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))


def shingles(text: bytes | None, n: int = 5) -> np.ndarray:
    """The hashes of a text's distinct word n-grams; of all its words, if fewer; none without words. bytes.lower knows A-Z only."""
    h = _word_hashes((text or b"").lower())
    if not len(h):
        return h
    width = min(n, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):  # other factors for other places: order tells
        total += h[j : len(h) - width + 1 + j] * _place(j)
    return pd.unique(_mix(total))


def node_of(s: np.ndarray, again: frozenset[int] = frozenset()) -> tuple[int, int]:
    """128 bits of a set: its node, and what tells sets of one node apart. again: nodes that several sets had; they are named by both."""
    a, b = np.array([_mix(s + _FACTORS[0]).sum(), _mix(s).sum()], np.uint64).view(np.int64)
    node = int((np.array([a]) + np.array([b]) * 31)[0])
    if node in again:
        node = int(_mix(np.array([a, b]).view(np.uint64)).view(np.int64)[0])
    return node, int(b)


def _sums(x: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Sums of 64-bit words by place. Halves of words add up exactly in doubles, for up to 2**20 of them."""
    if len(x) > 1 << 20:
        out = np.zeros(n, np.uint64)
        np.add.at(out, at, x)
        return out
    low, high = (np.bincount(at, y.astype(np.float64), n).astype(np.uint64) for y in (x & np.uint64(2**32 - 1), x >> np.uint64(32)))
    return (high << np.uint64(32)) + low


@dataclass(frozen=True)
class Plan:
    """parts first-level parts of sub second-level parts each; a signature for every subset of sub - 1 of a part's sub."""

    high: int  # the band's largest size
    parts: int
    sub: int

    def agreeing(self, size: int, sim: float) -> int:
        """On how many signatures a set of a size agrees, at least, with any that is similar to it and no larger than high.

        They differ in at most k shingles. The first in a part costs all its signatures but one, the second that one.
        """
        k = math.floor((1 - sim) / (1 + sim) * (size + min(self.high, size / sim)) + 1e-9)
        return self.sub * self.parts - (self.sub - 1) * min(k, self.parts) - min(max(k - self.parts, 0), self.parts)


def plan(low: int, high: int, sim: float, tail: float = 1e-2) -> Plan:
    """The fewest parts with which a set rarely (tail, or as rarely as a third more of them make it) has as many empty
    signatures as it must agree on. Sets with few differences get 3 second-level parts, whose signatures hold more."""
    k = math.floor((1 - sim) / (1 + sim) * 2 * high + 1e-9)
    sub, best, least = 3 if k <= 16 else 2, None, -(-(k + 1) // 2)
    for parts in range(least, least + least // 3 + 3):
        p, rare = Plan(high, parts, sub), 0.0
        for size in sorted({math.ceil(low * sim - 1e-9), low, (low + high) // 2, high}):
            mean = sub * parts * (1 - (sub - 1) / (sub * parts)) ** size
            term, under = math.exp(-mean), 0.0
            for i in range(p.agreeing(size, sim)):
                under += term
                term *= mean / (i + 1)
            rare = max(rare, 1 - under)
        if best is None or rare < best[0]:
            best = (rare, p)
        if rare <= tail:
            break
    return best[1]


class Bands:
    """Sizes in bands [low, high] of a ratio, and the plans of their signatures."""

    RATIO = 1.4

    def __init__(self, similarity: float):
        self.sim = similarity
        self.lows = [max(1, math.floor(1 / (1 - similarity) - 1e-9) - 1)]  # smaller sets link with equal ones only
        self.plans: list[Plan] = []
        self._grow(1000)

    def _grow(self, most: int) -> None:
        while self.lows[-1] <= most:
            low = self.lows[-1]
            high = max(low, math.floor(low * self.RATIO + 1e-9))
            self.plans.append(plan(low, high, self.sim))
            self.lows.append(high + 1)

    def of(self, size: int) -> list[int]:
        """The bands in which a set takes part: its own, and those that a set of up to size / similarity may be in."""
        if size < self.lows[0]:
            return []
        if size / self.sim >= self.lows[-1]:
            self._grow(math.ceil(size / self.sim))
        own = int(np.searchsorted(self.lows, size, "right")) - 1
        last = int(np.searchsorted(self.lows, math.floor(size / self.sim + 1e-9), "right")) - 1
        return list(range(own, last + 1))

    def _drawn(self, s: np.ndarray, band: int, draw: int) -> tuple[np.ndarray, np.ndarray]:
        """Every signature of a band and which are empty."""
        p = self.plans[band]
        cells = p.parts * p.sub
        seed = np.uint64((band * 2 + draw + 1) * int(_FACTORS[1]) % 2**64)
        mixed = _mix(s ^ seed)
        at = ((mixed >> np.uint64(20)) % np.uint64(cells)).astype(np.int64)
        sums, held = _sums(mixed, at, cells).reshape(-1, p.sub), np.bincount(at, minlength=cells).reshape(-1, p.sub)
        sums, held = (x.sum(1, keepdims=True) - x for x in (sums, held))  # a part without one of its second-level parts
        return _mix(sums.ravel() + np.arange(1, cells + 1, dtype=np.uint64) * _FACTORS[2] + seed), held.ravel() == 0

    def signatures(self, s: np.ndarray) -> np.ndarray:
        """Two sets that may be similar share one at least.

        They agree on as many signatures as the plan says of either. A set gives those that hold a shingle; if it has as many empty
        ones as that, it also gives, for each empty one, all of a second draw under the empty one's name.
        """
        out = []
        for band in self.of(len(s)):
            drawn, empty = self._drawn(s, band, 0)
            out.append(drawn[~empty])
            if empty.sum() >= self.plans[band].agreeing(len(s), self.sim):
                again, _ = self._drawn(s, band, 1)
                out.append(_mix(again[None, :] ^ _mix(drawn[empty] + _FACTORS[4])[:, None]).ravel())
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


@cache
def bands(similarity: float) -> Bands:
    return Bands(similarity)


def sketch(s: np.ndarray) -> bytes:
    """Counts of shingles by cell, up to 3, four to a byte; a cell or more for each shingle, always a power of 2."""
    cells = 64
    while cells < len(s):
        cells *= 2
    x = np.minimum(np.bincount((_mix(s ^ _FACTORS[3]) & np.uint64(cells - 1)).astype(np.int64), minlength=cells), 3).astype(np.uint8).reshape(4, -1)
    return (x[0] | x[1] << 2 | x[2] << 4 | x[3] << 6).tobytes()


def counts_of(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of counts, all folded to the cells of the smallest: folding, like the limit 3, only brings sets closer."""
    sizes = set(map(len, sketches))
    cells = 4 * min(sizes)
    if len(sizes) == 1:
        x = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, cells // 4)
        return np.concatenate([x >> k & 3 for k in (0, 2, 4, 6)], axis=1)
    return np.concatenate([folded(counts_of([x]), cells) for x in sketches])


def folded(x: np.ndarray, cells: int) -> np.ndarray:
    """Rows of counts in fewer cells, up to 127."""
    return x if x.shape[1] == cells else x.reshape(len(x), -1, cells).sum(1, dtype=np.int32).clip(0, 127).astype(np.uint8)


def _near(sizes_a, sizes_b, distance, similarity: float):
    """Whether sets that differ in at least so many shingles may still be similar."""
    return distance * (1 + similarity) <= (1 - similarity) * (sizes_a + sizes_b) + 1e-6


def _facts(docs: DataFrame, n: int, again: frozenset[int]) -> DataFrame:
    """(id, node, size, sketch, text) of documents (id, text) with words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in (b.iloc[at : at + 500] for b in batches for at in range(0, len(b), 500)):
            sets = [shingles(t, n) for t in pdf["text"]]
            out = pd.DataFrame({"id": pdf["id"], "node": [node_of(s, again)[0] for s in sets], "size": [len(s) for s in sets], "sketch": [sketch(s) for s in sets], "text": pdf["text"]})
            yield out[out["size"] > 0]

    return docs.mapInPandas(run, "id long, node long, size long, sketch binary, text binary")


def _signed(docs: DataFrame, n: int, similarity: float, again: frozenset[int]) -> DataFrame:
    """(sig, node, size): a row for each signature of a set (size -1), (id, node, size) for each document, and with size -2 the
    rest of a set's 128 bits.

    A task drops the signatures of a set equal to one it has just signed.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, int]] = set()
        for pdf in batches:
            for at in range(0, len(pdf), 100):
                ids, sizes, own, sigs, nodes, rests = pdf["id"].to_numpy()[at : at + 100], [], [], [], [], []
                for t in pdf["text"].iloc[at : at + 100]:
                    s = shingles(t, n)
                    node, rest = node_of(s, again) if len(s) else (0, 0)
                    sizes.append(len(s))
                    own.append(node)
                    if len(s) and (node, rest) not in seen:
                        if len(seen) > 500_000:
                            seen.clear()
                        seen.add((node, rest))
                        rests.append((rest, node))
                        x = bands(similarity).signatures(s)
                        sigs.append(x)
                        nodes.append(np.full(len(x), node, np.int64))
                sig = np.concatenate([np.zeros(0, np.uint64), *sigs]).view(np.int64)
                size = np.r_[np.full(len(sig), -1), np.array(sizes), np.full(len(rests), -2)].astype(np.int32)
                rests = np.array(rests, np.int64).reshape(-1, 2)
                yield pd.DataFrame({"sig": np.r_[sig, ids, rests[:, 0]], "node": np.concatenate([np.zeros(0, np.int64), *nodes, np.array(own, np.int64), rests[:, 1]]), "size": size})

    return docs.mapInPandas(run, "sig long, node long, size int")


def _grouped(signed: DataFrame, parts: int) -> DataFrame:
    """(size, gid, chunk, a, b): documents as (size, id in a, node in b), size -2 likewise, and with size -1 pairs of small groups (gid null)
    and the nodes of large ones (b null), in chunks."""
    kinds = {"size": "int32", "chunk": "int64", "a": "int64"}

    def rows(size, gid, chunk, a, b) -> pd.DataFrame:
        n = len(a)
        full = lambda v: pd.array(np.full(n, v) if v is not None and np.ndim(v) == 0 else ([pd.NA] * n if v is None else v), "Int64")
        return pd.DataFrame({"size": size, "gid": full(gid), "chunk": chunk, "a": a, "b": full(b)}).astype(kinds)

    def groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sig, node, chunk, seen = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, set()

        def done(sig: np.ndarray, node: np.ndarray) -> Iterator[pd.DataFrame]:
            starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, int)
            sizes = np.diff(np.r_[starts, len(sig)])
            pairs = [np.zeros((0, 2), np.int64)]
            for g in range(2, _SMALL + 1):
                at = starts[sizes == g]
                of = node[at[:, None] + np.arange(g)]
                pairs += [of[:, [i, j]] for i in range(g) for j in range(i + 1, g)]
            pairs = np.concatenate(pairs)
            if len(pairs):
                pairs = pd.DataFrame(pairs).drop_duplicates().to_numpy()
                yield rows(-1, None, 0, pairs[:, 0], pairs[:, 1])
            big, ids = [], []
            for at, g in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL], strict=True):
                nodes = node[at : at + g]
                key = hash(nodes.tobytes())
                if key not in seen:  # many signatures of a cluster have the same nodes
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(key)
                    big.append(nodes)
                    ids.append(np.full(g, sig[at]))
            if big:
                yield rows(-1, np.concatenate(ids), 0, np.concatenate(big), None)

        for pdf in batches:
            doc = pdf["size"].to_numpy() != -1
            if doc.any():
                yield rows(pdf["size"].to_numpy()[doc], None, 0, pdf["sig"].to_numpy()[doc], pdf["node"].to_numpy()[doc])
            sig, node = np.r_[sig, pdf["sig"].to_numpy()[~doc]], np.r_[node, pdf["node"].to_numpy()[~doc]]
            if not len(sig):
                continue
            new = np.r_[True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])]
            sig, node = sig[new], node[new]
            last = int(np.searchsorted(sig, sig[-1]))
            if chunk and last:  # the run whose chunks have gone out ends within this batch
                first = int(np.searchsorted(sig, sig[0], "right"))
                yield rows(-1, int(sig[0]), chunk, node[:first], None)
                sig, node, last, chunk = sig[first:], node[first:], last - first, 0
            if last:
                yield from done(sig[:last], node[:last])
                sig, node = sig[last:], node[last:]
            while len(node) > 2 * _CHUNK:
                yield rows(-1, int(sig[0]), chunk, node[:_CHUNK], None)
                sig, node, chunk = sig[_CHUNK:], node[_CHUNK:], chunk + 1
        if chunk:
            yield rows(-1, int(sig[0]), chunk, node, None)
        else:
            yield from done(sig, node)

    dealt = signed.repartition(parts, "sig").sortWithinPartitions("sig", "node")
    return dealt.mapInPandas(groups, "size int, gid long, chunk long, a long, b long")


def components(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """(node, label): labels (the components so far, or None) with edges (a, b) added; a label is a node of its component.

    Rounds: a node takes the least label among its own and its neighbours', and all nodes of one label the least that any
    of them has taken, followed to the end of the chain of labels that move, until nothing changes.
    """
    both = slim(edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*").distinct())
    ends = both.select(F.col("a").alias("node"), F.col("a").alias("label"))
    now = slim(ends.distinct() if labels is None else labels.union(ends.join(labels, "node", "left_anti").distinct()))
    while True:
        near = both.join(now.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        stepped = now.join(near, "node", "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("next"))
        moved = slim(stepped.groupBy("label").agg(F.min("next").alias("to")).filter("to < label"))
        if moved.isEmpty():
            return now
        while True:  # labels that move to labels that move: halves the way to a chain's end each time
            onward = moved.select(F.col("label").alias("to"), F.col("to").alias("further"))
            if moved.join(onward, "to", "left_semi").isEmpty():
                break
            moved = slim(moved.join(onward, "to", "left").select("label", F.coalesce("further", "to").alias("to")))
        now = slim(now.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")))


def _filtered(pairs: DataFrame, facts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) that the sketches don't rule out."""
    joined = pairs.join(facts.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("sketch").alias("sketch_a")), "a").join(facts.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("sketch").alias("sketch_b")), "b")
    joined = joined.filter(F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * (similarity - 1e-9))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = np.zeros(len(pdf), bool)
            sizes = pdf[["size_a", "size_b"]].to_numpy()
            for i, (x, y) in enumerate(zip(pdf["sketch_a"], pdf["sketch_b"], strict=True)):
                x, y = counts_of([x, y]).view(np.int8)
                keep[i] = _near(*sizes[i], np.abs(x - y).sum(dtype=np.int64), similarity)
            yield pdf.loc[keep, ["a", "b"]]

    return joined.select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInPandas(run, "a long, b long")


def _verified(pairs: DataFrame, facts: DataFrame, n: int, similarity: float) -> DataFrame:
    """Pairs (a, b) whose texts have similar sets."""
    per_cent = round(similarity * 100)
    facts = _only(facts, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node")
    joined = pairs.join(facts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(facts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets: dict[int, np.ndarray] = {}
        for pdf in batches:
            keep = np.zeros(len(pdf), bool)
            for i, (a, b, x, y) in enumerate(zip(pdf["a"], pdf["b"], pdf["text_a"], pdf["text_b"], strict=True)):
                for key, text in ((a, x), (b, y)):
                    if key not in sets:
                        if len(sets) >= 64:
                            sets.clear()
                        sets[key] = shingles(text, n)
                x, y = sets.get(a) if a in sets else shingles(x, n), sets[b]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= per_cent * (len(x) + len(y) - both)
            yield pdf.loc[keep, ["a", "b"]]

    return joined.select("a", "b", "text_a", "text_b").mapInPandas(run, "a long, b long")


def _pairs_between(x: dict, y: dict | None, similarity: float) -> Iterator[pd.DataFrame]:
    """Pairs (a, b) of unlike labels that the sketches don't rule out, between two chunks or within one (y: None)."""
    z = y or x
    cells = min(x["counts"].shape[1], z["counts"].shape[1])
    cx, cz = (folded(v["counts"], cells).view(np.int8) for v in (x, z))
    for i in range(len(cx)):
        at = slice(i + 1 if y is None else 0, None)
        maybe = np.flatnonzero((x["label"][i] != z["label"][at]) & (np.minimum(x["size"][i], z["size"][at]) >= np.maximum(x["size"][i], z["size"][at]) * (similarity - 1e-9)))
        if len(maybe):
            far = np.abs(cz[at][maybe] - cx[i]).sum(1, dtype=np.int64)
            ok = maybe[_near(x["size"][i], z["size"][at][maybe], far, similarity)]
            if len(ok):
                other = z["node"][at][ok]
                yield pd.DataFrame({"a": np.minimum(x["node"][i], other), "b": np.maximum(x["node"][i], other)})


def _left_over(rest: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """All pairs (a, b) of unlike labels within groups that the sketches don't rule out. rest: (gid, chunk, node, label).

    A chunk is compared with itself where it lies; of groups of several chunks, every two chunks meet in a task.
    """
    rows = rest.join(sketches, "node").select("gid", "chunk", "node", "label", "size", "sketch")

    def side(gid: int, chunk: int, node, label, size, sketches) -> dict:
        return {"node": node, "label": label, "size": size, "counts": counts_of(list(sketches))}

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
        """The chunks in a partition sorted by (gid, chunk), one at a time."""
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            key = pdf[["gid", "chunk"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
            cols, sketches = [pdf[c].to_numpy(np.int64) for c in ("node", "label", "size")], pdf["sketch"].to_numpy()
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                yield side(*key[lo], *(c[lo:hi] for c in cols), sketches[lo:hi]) | {"gid": key[lo, 0], "chunk": key[lo, 1]}
            rest = pdf.iloc[starts[-1] :]
        if rest is not None:
            yield side(0, 0, *(rest[c].to_numpy(np.int64) for c in ("node", "label", "size")), rest["sketch"].to_numpy()) | {"gid": rest["gid"].iat[0], "chunk": rest["chunk"].iat[0]}

    def within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent: set[tuple[int, int]] = set()
        for x in chunks(batches):
            for pairs in _pairs_between(x, None, similarity):
                new = [p for p in zip(pairs["a"].tolist(), pairs["b"].tolist(), strict=True) if p not in sent]
                if new:  # a task sends a pair once, as far as it remembers
                    if len(sent) > 1_000_000:
                        sent.clear()
                    sent.update(new)
                    yield pd.DataFrame(new, columns=["a", "b"])

    dealt = rows.repartition(partitions(rest.sparkSession), "gid", "chunk").sortWithinPartitions("gid", "chunk")
    out = dealt.mapInPandas(within, "a long, b long")
    several = rest.groupBy("gid").agg(F.max("chunk").alias("last")).filter("last > 0")
    if several.isEmpty():
        return out

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in chunks(batches):
            yield pd.DataFrame({"gid": [x["gid"]], "chunk": [x["chunk"]], "rows": [pickle.dumps(x)]})

    packed = cut(dealt.join(several, "gid", "left_semi").repartition(partitions(rest.sparkSession), "gid", "chunk").sortWithinPartitions("gid", "chunk").mapInPandas(pack, "gid long, chunk long, rows binary"))
    # every two chunks of a group have a key of their own
    ends = packed.join(several, "gid")
    met = ends.filter("chunk < last").select("gid", "chunk", F.explode(F.sequence(F.col("chunk") + 1, "last")).alias("chunk_b"), "rows")
    met = met.join(ends.filter("chunk > 0").select("gid", F.col("chunk").alias("chunk_b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunk") - 1)).alias("chunk"), F.col("rows").alias("rows_b")), ["gid", "chunk", "chunk_b"])

    def between(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for x, y in zip(pdf["rows"], pdf["rows_b"], strict=True):
                yield from _pairs_between(pickle.loads(x), pickle.loads(y), similarity)

    return out.union(met.mapInPandas(between, "a long, b long"))


def _only(df: DataFrame, ids: DataFrame, *on: str) -> DataFrame:
    """df's rows whose key is among ids; ids are broadcast if there are at most BROADCAST_ROWS (16 bytes each)."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, list(on), "left_semi")


def similar(docs: DataFrame, n: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, node, size, component_id), one row for each row of docs.

    size: the number of distinct word n-grams (of fewer words: the whole as one). Two rows link if the Jaccard index of
    their sets is similarity (whole per cent) or more; component_id is the least id that a row reaches. Null and empty
    texts link with nothing. Rows with equal sets are one node, told by 128 bits. Ids may repeat; a null id is
    never a component's id unless all its ids are null.
    """
    spark = docs.sparkSession
    given = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), F.encode(F.col(text_col), "UTF-8").alias("text"))
    again: frozenset[int] = frozenset()
    while True:
        groups = cut(_grouped(_signed(given, n, similarity, again), partitions(spark) * 2))
        # unequal sets of one 64-bit node: a few at 10 billion sets; they get other names
        twice = groups.filter("size = -2").groupBy("b").agg(F.min("a").alias("least"), F.max("a").alias("most")).filter("least < most").select("b").collect()
        if not twice:
            break
        again |= {r[0] for r in twice}
    members = groups.filter("size >= 0").select(F.col("a").alias("id"), F.when(F.col("size") > 0, F.col("b")).alias("node"), F.col("size").cast("long"))
    pairs = groups.filter("size = -1 and gid is null").select("a", "b").distinct()
    # a set with few changes of its own agrees with many others on many parts: the first centres are those in most groups
    large = groups.filter("gid is not null").select("gid", "chunk", F.col("a").alias("node"), F.count("*").over(W.partitionBy("a")).alias("weight"))

    wanted = slim(groups.filter("size = -1").select(F.explode(F.array("a", "b")).alias("node")).filter("node is not null").distinct())
    chosen = slim(members.join(wanted, "node").groupBy("node").agg(F.min("id").alias("id")))
    facts = _facts(_only(given, chosen.select("id"), "id"), n, again)
    facts = stored(_only(facts, chosen, "node", "id"), "jaccard")
    sketches = facts.select("node", "size", "sketch")

    found, tested = None, None
    for turn in range(_ROUNDS + 2):
        if found is None:
            at = large.withColumn("label", F.col("node"))
        else:
            at = large.join(found, "node", "left").select("gid", "chunk", "node", "weight", F.coalesce("label", "node").alias("label"))
        if turn:
            ends = at.groupBy("gid").agg((F.min("label") < F.max("label")).alias("open")).filter("open").select("gid")
            at = slim(at.join(ends, "gid", "left_semi"))
            if at.isEmpty():
                break
            large = at.drop("label")
        if turn <= _ROUNDS:
            # the centre of a chunk against the chunk, and the centres of a group's chunks against that of its first
            key = F.struct(F.col("weight") if turn == 0 else F.lit(0), F.xxhash64("node", F.lit(turn)), "node", "label")
            at = at.withColumn("c", F.max(key).over(W.partitionBy("gid", "chunk")))
            heads = at.filter("node = c.node").select("gid", "chunk", "node", "label")
            across = heads.filter("chunk > 0").drop("chunk").join(heads.filter("chunk = 0").select("gid", F.col("node").alias("other"), F.col("label").alias("other_label")), "gid").filter("label <> other_label")
            star = at.filter("label <> c.label").select("node", F.col("c.node").alias("other")).union(across.select("node", "other"))
            star = star.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
            todo = (star if turn else star.union(pairs)).distinct()
        else:
            todo = _left_over(at, sketches, similarity).distinct()
        if tested is not None:
            todo = todo.join(tested, ["a", "b"], "left_anti")
        if turn <= _ROUNDS:
            todo = _filtered(todo, sketches, similarity)
        todo = slim(todo)
        found = components(found, slim(_verified(todo, facts, n, similarity)))
        tested = todo if tested is None else tested.union(todo)
    # a component's id is the least document id of its nodes; a node without links is its own component
    nodes = members.filter("node is not null").groupBy("node").agg(F.min("id").alias("least")).join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ids = nodes.groupBy("label").agg(F.min("least").alias("component_id"))
    base = nodes.join(ids, "label").select(F.col("node").alias("_node"), "component_id")
    out = members.join(base, F.col("node") == F.col("_node"), "left")
    real = lambda c: F.when(c != _NO_ID, c)
    return out.select(real(F.col("id")).alias("id"), "node", "size", real(F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))).alias("component_id"))


def op8(spark, sf_dir: str) -> DataFrame:
    out = similar(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), "component_id")
