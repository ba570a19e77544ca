"""Periodic runs, exact top-k and cross-tokenizer alignment against brute force, and on odd inputs."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spliceframe.llm import inner_top, periodic_runs, token_align
from spliceframe.llm.registry import QUERIES

DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, runs string, n_a long, links int, in0 int"
ODD = [(1, None, None, None, None, None), (2, "", "r", 1, 1, 1), (None, "one two three", "r", 1, 1, 1), (3, "word " * 30_000, "r", 1, 1, 1), (4, "a b\x0ba b", "r", 1, 1, 1)] + [(5, "same row", "r", 1, 1, 1)] * 2 + [(6, "\n\n \t", "r", 1, 1, 1), (7, "é" * 200_000, "r", 1, 1, 1)]


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


# ---- 11


def runs(w, least):
    """By trying every period."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    smaller = lambda a, e, q: any(all(w[t] == w[t + r] for t in range(a, e - r)) for r in range(1, q))
    return sorted(((a, e - a, q) for (a, e), q in found.items() if not smaller(a, e, q)), key=lambda x: (x[0], x[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def drawn(rng):
    unit = [rng.choice("abcdef") for _ in range(rng.randint(1, 20))]
    a, b = "a", "ab"
    for _ in range(rng.randint(1, 6)):
        a, b = b, b + a
    n = rng.randint(0, 60)
    return rng.choice([[rng.choice("ab") for _ in range(n)], [rng.choice("abc") for _ in range(n)], list(b), unit * rng.randint(1, 6) + unit[: rng.randint(0, len(unit))], ["a"] * n, ["x", "y", *unit, "z", *unit, *unit]])


@pytest.mark.parametrize("least", [2, 12])
def test_runs_of_small_blocks(least):
    rng = random.Random(least)
    for _ in range(300):
        docs = [drawn(rng) for _ in range(rng.randint(1, 4))]
        found, kept = periodic_runs._block([" ".join(d).encode() for d in docs], least)
        for d, f, k in zip(docs, found, kept, strict=True):
            assert [tuple(map(int, x)) for x in f] == runs(d, least)
            assert k.decode() == collapsed(d, runs(d, least))


def test_runs_take_time_in_proportion():
    def seconds(n):
        start = time.process_time()
        for w in ([str(i % (n // 3)) for i in range(n)], ["a"] * n):
            periodic_runs._block([" ".join(w).encode()], 12)
        return time.process_time() - start

    assert seconds(80_000) < 16 * max(seconds(10_000), 0.05)  # n log n: 9 to 10 times


def test_op11_equals_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, DIR).collect()}
    docs = spark.read.parquet(f"{DIR}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        w, h = words(r.text), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        if len(w) > 1000:
            continue
        found = runs(w, 12)
        best = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
        g = got[r.doc_id]
        assert (g.n_runs, g.start, g.length, g.period) == (len(found), *best)
        assert g.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert g.runs_sha256 == hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in found).encode()).hexdigest()
        assert g.collapsed_sha256 == hashlib.sha256(collapsed(w, found).encode()).hexdigest()


def test_runs_odd_inputs(spark):
    df = periodic_runs.collapse_runs(spark.createDataFrame(ODD, DOCS))
    assert df.columns == ["doc_id", "text", "n_a", "links", "in0", "runs", "collapsed"]
    got = collections.defaultdict(list)
    for r in df.collect():
        got[r.doc_id].append(([tuple(x) for x in r.runs], r.collapsed))
    assert got[1] == got[2] == got[6] == [([], "")] and got[None] == [([], "one two three")]
    assert got[3] == [([(0, 30_000, 1)], "word")] and got[5] == [([], "same row")] * 2 and got[4] == [([], "a b a b")]
    assert periodic_runs.collapse_runs(spark.createDataFrame([], DOCS)).count() == 0


# ---- 12


def largest(rows, k):
    usable = [(i, r[0], [math.floor(float(c) * 64) for c in r[1]]) for i, r in enumerate(rows) if None not in (r[0], r[1]) and all(c is not None and math.isfinite(c) for c in r[1])]
    out = []
    for i, a, x in usable:
        if a % 20 == 0:
            score = lambda y: max(-(2**63), min(2**63 - 1, sum(p * q for p, q in zip(x, y))))  # noqa: B023, E731
            best = sorted((-score(y), b, j) for j, b, y in usable if j != i and len(y) == len(x))[:k]
            out += [(a, n + 1, b, -s) for n, (s, b, _) in enumerate(best)]
    return sorted(out)


def searched(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(map(tuple, inner_top.largest(df, F.col("vec_id") % 20 == 0, **more).collect()))


def test_inner_top_odd_inputs(spark):
    rows = [(20, None), (40, [None, 1.0]), (60, [float("nan"), 1.0]), (None, [1.0, 2.0]), (80, [0.0, 0.0]), (120, []), (121, []), (140, [1.0]), (141, [3.0]), (180, [-5.5, float("inf")]), (3, [0.1, -0.01])]
    rows += [(100, [1.0, 2.0])] * 2 + [(101, [1.0, 2.0]), (200, [1e10, 1e9]), (201, [-1e10, 3.0]), (160, [1e200, 1.0]), (161, [1e300, -1.0])]
    assert searched(spark, rows, k=5, size=4) == largest(rows, 5)
    assert searched(spark, rows[:-2], k=5, size=4) == largest(rows[:-2], 5)
    assert searched(spark, []) == []


def test_inner_top_clusters_and_copies(spark, monkeypatch):
    """Thin annuli and many chunks, so that bounds do prune; many copies of one vector; lengths that differ."""
    monkeypatch.setattr(inner_top, "ANNULUS", 32)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20, 6)).repeat(80, 0) * rng.uniform(0.2, 2, size=(1600, 1)) + rng.normal(size=(1600, 6)) * 0.05
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(1600), x, strict=True)] + [(5000 + i, [0.5] * 6) for i in range(300)]
    assert searched(spark, rows, size=100) == largest(rows, 20)


def test_annuli_are_left_out():
    """A query close to one cluster doesn't visit chunks of the others."""
    rng = np.random.default_rng(3)
    x = np.floor(np.concatenate([c + rng.normal(size=(500, 8)) * 0.5 for c in rng.normal(size=(8, 8)) * 60]))
    space = inner_top.Space(x, float((x * x).sum(1).max()), 8, 1)
    near, dist = space.keyed(x)
    q = x[:1]
    norm = np.sqrt((q * q).sum(1))
    kth = np.sort(x[1:] @ q[0])[-20:-19]
    lo = np.abs(space.from_pivots(q, norm)[0][near] - dist)
    met = lo <= space.reach(norm, kth)[0]
    assert met[np.argsort(x @ q[0])[-21:]].all() and met.mean() < 0.5


def test_op12_equals_brute_force(spark):
    e = spark.read.parquet(f"{DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert sorted(map(tuple, QUERIES["op12_inner_top"](spark, DIR).collect())) == largest([(r.vec_id, list(r.embedding)) for r in e], 20)


# ---- 13


@pytest.fixture(scope="module")
def both():
    return token_align.Tokenizers(f"{token_align.FOLDER}/byte_bpe_50k.json", f"{token_align.FOLDER}/piece_bpe_32k.model")


def aligned(t, text):
    """Whole texts, byte by byte."""
    nothing = (0, 0, 0, 0, "", {})
    if not text:
        return nothing
    a, b = t.a.encode(f" {text}", add_special_tokens=False).ids, t.b.encode(text)
    if b"".join(t.a_bytes[i] for i in a) != f" {text}".encode() or b"".join(t.b_bytes[i] for i in b) != f" {text}".encode():
        return nothing
    ends = [np.cumsum([len(kept[i]) for i in ids]).tolist() for ids, kept in ((a, t.a_bytes), (b, t.b_bytes))]
    told, links, n, at = [], collections.Counter(), 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        own = [[i for i, e in zip(ids, es, strict=True) if at < e <= cut] for ids, es in ((a, ends[0]), (b, ends[1]))]
        told.append("|".join(",".join(map(str, x)) for x in own))
        links.update((x, y) for x in own[0] for y in own[1])
        n += len(own[0]) * len(own[1])
        at = cut
    return len(a), len(b), len(told), n, ";".join(told), dict(links)


def test_overlaps_by_bisection():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 30))
        a, b = (np.append(np.flatnonzero(rng.random(n - 1) < 0.4) + 1, n) for _ in range(2))
        starts = lambda e: np.append(0, e[:-1])
        first, behind = token_align.overlaps(a, b)
        for s, e, f, l in zip(starts(a), a, first, behind, strict=True):
            assert [j for j in range(len(b)) if starts(b)[j] < e and b[j] > s] == list(range(f, l))
        ga, gb = token_align.groups(a, b)
        cuts = sorted(set(a.tolist()) & set(b.tolist()))
        assert ga.tolist() == np.searchsorted(cuts, a).tolist() and gb.tolist() == np.searchsorted(cuts, b).tolist()


def test_alignment_of_segments_equals_whole_texts(both):
    odd = [None, "", "a", " ", "  ", "\n", "a  b\n c\t d", "x\n\n\ny", "tail \n", "tail ", "\nstart", "a▁b", "▁", "x ▁y", "é" * 300, "<|endoftext|> hi<|endoftext|>", "<s> </s> <unk> <0x41>", "ﬁ Å 日本語 テキスト", "don't we'll 123 4567 a b 　c", "a\r\nb;\r\n c", "​ x", "word " * 500]
    rng = random.Random(3)
    bits = ["a", "b", "th", "e", " ", "  ", "\n", "\t", "\r", "▁", "'s", "1", "é", "日", "👍", "\xa0", " ", ".", ";", "{", " {"]
    for texts in [odd, *(["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(1, 4))] for _ in range(400))]:
        stats, told, bounds, pair, times = both.align(texts)
        for i, text in enumerate(texts):
            links = {(int(p) // both.width, int(p) % both.width): int(n) for p, n in zip(pair[bounds[i] : bounds[i + 1]], times[bounds[i] : bounds[i + 1]], strict=True)}
            assert (*map(int, stats[i]), told[i].decode(), links) == aligned(both, text)


def test_alignment_forgets(both, monkeypatch):
    texts = [f"word{i} other{i % 7}" for i in range(300)]
    want = both.align(texts)
    monkeypatch.setattr(token_align, "KNOWN", 50)
    for i in range(0, 300, 20):
        stats, told, *_ = both.align(texts[i : i + 20])
        assert told == want[1][i : i + 20] and (stats == want[0][i : i + 20]).all()


@pytest.mark.parametrize("lookup", [token_align.LOOKUP, 500])
def test_op13_equals_brute_force(spark, both, monkeypatch, lookup):
    monkeypatch.setattr(token_align.link_sums, "__defaults__", (lookup,))
    got = {r.doc_id: r for r in QUERIES["op13_token_alignment"](spark, DIR).collect()}
    docs = {r.doc_id: aligned(both, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    count = collections.Counter(p for x in docs.values() for p in x[5])
    best = collections.Counter()
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    for i, x in docs.items():
        g = got[i]
        assert (g.n_a, g.n_b, g.n_groups, g.n_links) == x[:4]
        assert (g.n_best, g.count_sum) == (sum(n for p, n in x[5].items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in x[5].items()))
        assert g.groups_sha256 == (hashlib.sha256(x[4].encode()).hexdigest() if x[4] else "")


def test_alignment_odd_inputs(spark, both):
    df = token_align.aligned(spark.createDataFrame(ODD, DOCS))
    assert df.columns == ["doc_id", "text", "runs", "in0", "n_a", "n_b", "n_groups", "n_links", "groups", "links"]
    for r in df.collect():
        if len(r.text or "") < 1000:
            assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, {(x.a, x.b): x.n for x in r.links}) == aligned(both, r.text)
        else:
            assert r.n_links == sum(x.n for x in r.links) >= max(r.n_a, r.n_b)
    assert token_align.aligned(spark.createDataFrame([], DOCS)).count() == 0
