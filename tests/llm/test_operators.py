"""The training-data operators against brute force, and on odd inputs."""

import collections
import hashlib
import math
import re
import time
import uuid

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spliceframe.llm import common, decontam, html_text, jaccard, licenses, line_dedup, mixing, neighbours, pii, secrets, toxicity
from spliceframe.llm.registry import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls in every column, empty and long texts, repeated rows and ids, ties, odd white space and marks.
LINE = "A line that is longer than forty characters, surely so."
ODD = (
    [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "one two three", "en", "s", 13), (3, "word " * 30_000, "en", "s", None), (4, "a\x01b\x02c 1.2.3.4", None, "s", 3)]
    + [(5, "same row", "en", "t", 8)] * 2 + [(6, "x", "en", "t", 1), (6, "y z", "en", None, 3)] + [(10 + i, f"{LINE}\nown {i}\n  {LINE.upper()} ", "en", "t", 9) for i in range(6)]
    + [(30, "\n\n \t\x0b\n", "fr", "t", 5), (31, "é" * 50_000, "fr", "u", 1), (32, "ÀB Ünï", "de", "u", 6)]
)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    df = QUERIES[name](spark, DIR)
    r = c.execute(ORACLE_SQL[name])
    names = [x[0] for x in r.description]
    tell = lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)
    got = sorted(tuple(tell(x[c]) for c in sorted(df.columns)) for x in df.collect())
    assert got == sorted(tuple(tell(x[names.index(c)]) for c in sorted(names)) for x in r.fetchall())


# ---- helpers


def test_ascii_lower_and_words(spark):
    df = spark.createDataFrame([("AbÀÉ İX",), (None,), ("plain TEXT",)], "t string")
    assert [r[0] for r in df.select(common.ascii_lower(F.col("t"))).collect()] == ["abÀÉ İx", None, "plain text"]
    df = spark.createDataFrame([(" a\tb\x0bc\n",), ("",), (None,), (" \n ",), ("a b",)], "t string")
    assert [r[0] for r in df.select(common.n_words(F.col("t"))).collect()] == [3, 0, 0, 0, 1]


# ---- 1


def test_neighbours(spark):
    e = spark.read.parquet(f"{DIR}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in e]), np.stack([r.embedding for r in e]).astype(float)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 5 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hit = n = 0
    for i in np.flatnonzero(ids % 5 == 0):
        score = (x * x[i]).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((x[i] * x[i]).sum()))
        best = [j for j in np.lexsort((ids, -score)) if j != i][:5]
        hit += len({int(ids[j]) for j in best} & {v for v, _ in got[ids[i]]})
        n += 5
        assert all(s == pytest.approx(score[np.flatnonzero(ids == v)[0]], abs=1e-12) for v, s in got[ids[i]])
    assert hit / n >= 0.9


def test_neighbours_recall_not_exhaustive(spark):
    """20,000 vectors, of which a fifth or so is verified, against brute force."""
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(15_000, 32)), rng.normal(size=(5_000, 32)) * 0.3 + rng.normal(size=(50, 32)).repeat(100, 0)])
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    index = neighbours.SortedLines(unit[:10_000], 128, 5)
    met = [len(index.candidates(unit[i], 1000, 0.6, index.start(1000, 0.6, 0.4, 1.1), 1.1)[0]) for i in range(0, 10_000, 500)]
    assert max(met) < 4_000
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).collect():
        got[r.query_id].add(r.vec_id)
    hit = 0
    for q in range(0, 20_000, 100):
        score = unit @ unit[q]
        score[q] = -2
        hit += len(set(np.argsort(-score)[:5].tolist()) & got[q])
    assert hit >= 0.9 * 5 * 200


def test_neighbours_any_finite_vector(spark):
    rows = [(1, [1e-200, 0.0]), (2, [5e-324, 5e-324]), (3, [1e300, 1e300]), (4, [1e-200, 1e-200]), (5, [1.0, 1e-320]), (6, [-1e308, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, F.lit(True)).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, round(r.score, 12)))
    assert got[1] == [(5, 1.0), (2, 0.707106781187), (3, 0.707106781187), (4, 0.707106781187), (6, -1.0)]


def clashing(df, *names):
    """df with string columns of these names."""
    return df.select("*", *(F.concat(F.lit("k"), F.lit(i)).alias(n) for i, n in enumerate(names)))


def test_neighbours_clash(spark):
    df = clashing(spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>"), "id", "v", "q", "dim", "b", "qb", "score", "rank", "in0")
    assert [tuple(r) for r in neighbours.nearest(df, F.col("vec_id") == 1).select("query_id", "vec_id").collect()] == [(1, 2)]


def test_neighbours_odd(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, []), (None, [1.0, 1.0]), (9, [0.0, 1.0, 0.0]), (10, [float("inf"), 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in neighbours.nearest(df, F.col("vec_id").isin(1, 4, 5, 9)).orderBy("query_id", "rank").collect()]
    assert got == [(1, 1, 2, 1.0), (1, 2, 3, 1.0)]
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


# ---- 2


def test_html_blocks():
    assert [b.text for b in html_text.blocks_of('<p title="a>b">x</p><p title="y>z</p><q')] == ["x", "z", "<q"] and html_text.blocks_of("<script>if (a<b && c > '") == []
    page = '<!-- c --><HTML><head><title>t</title><style>p{}</style></head><body class=x><script>a="</p>"</script><p>a &amp; b<br>c  d<p>e <b>f</b>g</div><ul><li>h<li>i</ul>&eacute;'
    assert [b.text for b in html_text.blocks_of(page)] == ["a & b c d", "e fg", "h", "i", "é"]
    assert html_text.blocks_of(None) == [] and html_text.blocks_of("<") [0].text == "<"


@pytest.mark.parametrize("text", ["<a " * 330_000, "<div>x" * 160_000, "<div>" * 100_000 + "</b></x>" * 60_000, '<a ">" ' * 140_000, "<!" * 500_000, "<script>" * 120_000, "</script" * 120_000, "&#x" * 300_000], ids=str)
def test_html_blocks_of_a_megabyte(text):
    start = time.perf_counter()
    blocks = html_text.blocks_of(text)
    html_text.vectors(blocks)
    assert time.perf_counter() - start < 20 and all(len(b.text) <= len(text) for b in blocks)


def test_html_clash(spark):
    small = html_text.labeller(200, 8, 2)
    df = spark.createDataFrame([(1, "<p>a</p>", "k", 2)], "page_id long, html string, in0 string, n_chars int")
    out = html_text.extract(df, model=small)
    assert out.columns == ["page_id", "in0", "text", "n_chars"] and out.first().in0 == "k"


def test_html_every_class_counts():
    names = html_text._names("div", 'class="a b c d e f g h i j k sponsored"')
    assert ".sponsored" in names and len(names) == 13


def test_html_odd(spark):
    small = html_text.labeller(300, 12, 4)
    df = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<nav></nav>", "x"), (4, "u", "<p>" * 5000 + "deep", "x")], "page_id long, url string, html string, text string")
    out = {(r.page_id, r.url): r for r in html_text.extract(df, model=small).collect()}
    assert out[1, "u"].text == "" and out[2, None].text == "" and out[None, "u"].n_chars == 0 and len(out) == 4
    assert html_text.extract(df.limit(0), model=small).count() == 0


def test_html_accuracy(spark):
    rows = html_text.extract(spark.read.parquet(f"{DIR}/pages.parquet")).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(f"{DIR}/pages.parquet").collect()}
    right = sum(r.text == "\n".join(b.text for b in html_text.blocks_of(html[r.page_id]) if "article" in b.path) for r in rows)
    assert right >= 0.95 * len(rows) and all(r.n_chars == len(r.text) for r in rows)


def test_labeller_slopes():
    """Backpropagation against differences."""
    rng = np.random.default_rng(0)
    net = html_text.Labeller.new(5, 3, 1)
    net.w.update({k: v.astype(float) for k, v in net.w.items()})
    pages = [rng.normal(size=(n, 5)) for n in (4, 2)]
    ys = [rng.integers(0, 2, n).astype(float) for n in (4, 2)]

    def loss() -> float:
        return sum(float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()) for y, p in zip(ys, net.label(pages), strict=True)) / 6

    h, mask, flip = net._both(pages)
    y = np.zeros(mask.shape[:2])
    for j, v in enumerate(ys):
        y[: len(v), j] = v
    slope = (html_text._sigmoid(h @ net.w["out"] + net.w["bias"]) - y) * mask[:, :, 0] / mask.sum()
    dh = slope[:, :, None] * net.w["out"]
    grads = net.ahead.backward(dh[:, :, :3]) | net.back.backward(dh[:, :, 3:][flip, np.arange(2)[None, :]])
    for key in ("ax", "ah", "ab", "bx", "bh", "bb"):
        at = tuple(0 for _ in net.w[key].shape)
        old = net.w[key][at]
        net.w[key][at] = old + 1e-3
        up = loss()
        net.w[key][at] = old - 1e-3
        down = loss()
        net.w[key][at] = old
        assert grads[key][at] == pytest.approx((up - down) / 2e-3, abs=2e-3)


# ---- 3


def brute_contamination(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for t in docs:
        w, hit, found = words(t), set(), set()
        for i, item in items:
            v = words(item)
            n = min(13, len(v))
            for a in range(len(v) - n + 1) if v else []:
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[a : a + n]:
                        hit.update(range(p, p + n))
                        found.add(str(i))
        out.append((len(w), len(hit), ",".join(sorted(found))))
    return out


@settings(max_examples=6, deadline=None)
@given(st.data())
def test_contamination_random(spark, data):
    vocabulary = st.sampled_from(["a", "B", "cé", "d"])
    items = data.draw(st.lists(st.lists(vocabulary, min_size=0, max_size=30), min_size=1, max_size=4))
    docs = [data.draw(st.lists(vocabulary, max_size=20)) + data.draw(st.sampled_from(items)) + data.draw(st.lists(vocabulary, max_size=20)) for _ in range(3)]
    d = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(docs)], "doc_id long, text string")
    b = spark.createDataFrame([(i, "-".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = [(r.n_words, r.n_hit, ",".join(r["items"])) for r in decontam.contamination(d, b).orderBy("doc_id").collect()]
    assert got == brute_contamination([" ".join(x) for x in docs], list(enumerate("-".join(x) for x in items)))


def test_contamination_odd(spark, odd, none):
    b = spark.createDataFrame([(1, None), (2, ""), (3, "x"), (None, "y z"), (4, "word " * 20), (4, "word " * 20)], "item_id long, text string")
    out = decontam.contamination(odd.withColumn("n_hit", F.lit("clash")), b)
    rows = {(r.doc_id, r.text and r.text[:5]): r for r in out.collect()}
    assert out.count() == len(ODD) and rows[1, None].n_words == 0 and not rows[2, ""].contaminated
    assert rows[6, "x"].n_hit == 1 and rows[6, "y z"]["items"] == [""] and rows[3, "word "].n_hit == 30_000
    assert decontam.contamination(none, b).count() == 0
    assert decontam.contamination(odd, b.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_contamination_clash(spark):
    df = clashing(spark.createDataFrame([(1, "x " * 20), (1, "y")], "doc_id long, text string"), "id", "h", "i", "g", "items", "places", "words", "in0", "_dc_doc", "N_HIT")
    b = spark.createDataFrame([(3, "x " * 13)], "item_id long, text string")
    out = decontam.contamination(df, b)
    made = ["n_words", "n_hit", "n_items", "items", "hits", "contaminated"]
    assert out.columns == [c for c in df.columns if c.lower() not in made] + made
    assert sorted((r.n_words, r.n_hit, r["items"], [tuple(x) for x in r.hits]) for r in out.collect()) == [(1, 0, [], []), (20, 20, ["3"], [(0, 20)])]


def test_contamination_by_many_items(spark):
    """A passage that all items share, repeated in a document, against brute force."""
    passage = " ".join(f"p{i}" for i in range(15))
    items = [(i, f"{passage} own{i} " + " ".join(f"q{i}w{k}" for k in range(14))) for i in range(40)] + [(99, "p1 p2"), (98, passage)]
    docs = [f"a b {passage} c {passage} d " * 3, items[7][1], "p1 p2 p3", "p2 p1", ""]
    got = decontam.contamination(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, ",".join(r["items"])) for r in got] == brute_contamination(docs, items)


# ---- 5


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{d}/labels.parquet")
    model = toxicity.fit(docs, labels)
    test = docs.join(labels.filter(toxicity.held_out(F.col("doc_id"))), "doc_id")
    rows = [(r.toxic, r.score >= toxicity.CUT) for r in toxicity.score(test, model).collect()]
    caught, false = sum(y and p for y, p in rows), sum(p and not y for y, p in rows)
    assert caught >= 0.93 * sum(y for y, _ in rows) and false <= 0.02 * len(rows)


def test_toxicity_odd(spark, odd, none):
    s = toxicity.Settings(epochs=3, rows=20)
    texts = ["fine words here"] * 10 + ["idiot moron here"] * 10
    model = toxicity.train(texts, np.array([0] * 10 + [1] * 10), s)
    assert model.score("idiott", {}) > model.score("finer", {})
    out = toxicity.score(odd.withColumn("score", F.lit("clash")), model)
    assert out.count() == len(ODD) and all(0 <= r.score <= 1 for r in out.collect())
    assert toxicity.score(none, model).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(odd, toxicity.fit(odd, labels, s)).count() == len(ODD)


def test_toxicity_repeated_ids(spark):
    """Clean rows of repeated ids, in whatever number, leave toxic texts their places."""
    s = toxicity.Settings(epochs=3, rows=20)
    free = [r.id for r in spark.range(200).filter(~toxicity.held_out(F.col("id"))).collect()]
    clean, toxic = free[:20], free[20:40]
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in free[:40]], "doc_id long, toxic int")
    bad = [(i, f"idiot moron here {i}") for i in toxic]
    for good in (
        [(clean[0], f"fine words here {k}") for k in range(60)] + [(i, "fine words here") for i in clean[1:]],  # one hot id
        [(i, "fine words here") for i in clean] * 2,
        [(i, f"fine words here {k}") for i in clean for k in (1, 2)],
    ):
        model = toxicity.fit(spark.createDataFrame(good + bad, "doc_id long, text string"), labels, s)
        assert model.weights.any() and model.score("idiot moron here", {}) > model.score("fine words here", {})


# ---- 6


def test_mixing(spark):
    rng = np.random.default_rng(0)
    rows = [(i, ["a", "b", "c", None, "e"][int(rng.integers(5))], int(rng.integers(0, 300))) for i in range(600)] + [(1000, "solo", 7), (1001, "zero", 0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    out = mixing.mix_sources(df, block_words=64).collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r.source].append(r)
        assert 0 <= r.taken <= 2 * r["size"]
        assert (r.mix_at is not None) == (r.taken > 0)
    total = sum(s for *_, s in rows)
    assert sum(x[0].target for x in by.values()) == pytest.approx(1.5 * total)
    for rs in by.values():
        assert sum(r.taken for r in rs) == int(rs[0].target + 1e-9) and rs[0].target <= 2 * rs[0].source_size + 1e-6
    again = {(r.doc_id): r.taken for r in mixing.mix_sources(df.orderBy(F.desc("doc_id")), block_words=64).collect()}
    assert again == {r.doc_id: r.taken for r in out}


def test_mixing_odd(spark, odd, none):
    df = odd.select("doc_id", "source", F.lit("clash").alias("taken"), common.n_words(F.col("text")).alias("size"))
    assert mixing.mix_sources(df).count() == len(ODD)
    assert mixing.mix_sources(none.select("doc_id", "source", F.lit(0).cast("long").alias("size"))).count() == 0
    assert mixing.mix_sources(df.withColumn("size", F.lit(None).cast("long"))).agg(F.sum("taken")).first()[0] == 0


def test_mixing_prefixes_hold_the_shares(spark):
    """The schedule keeps to the target shares in every prefix of the mix, not only at its end."""
    rng = np.random.default_rng(1)
    rows = [(i, "abcd"[int(rng.integers(4))], int(rng.integers(1, 200))) for i in range(4000)]
    docs = spark.createDataFrame(rows, "id long, src string, size long")
    sources = mixing.source_targets(docs.select("src", "size"))
    n = 5000
    dealt = mixing._schedule(sources.withColumn("quota", F.lit(n).cast("long")), n).filter(F.col("pos") < n).orderBy("pos").collect()
    share = {r.src: r.target for r in sources.collect()}
    total = sum(share.values())
    assert [r.pos for r in dealt] == list(range(n))
    for end in (10, 100, 999, n):
        for src, t in share.items():
            assert abs(sum(r.src == src for r in dealt[:end]) - end * t / total) <= 4 + math.log2(end)
    out = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, size long"), block_words=64).collect()
    early = [r for r in out if r.mix_at is not None and r.mix_at < 500]
    words = collections.Counter()
    for r in early:
        words[r.source] += r["size"]
    for src, t in share.items():
        assert words[src] / words.total() == pytest.approx(t / total, abs=0.05)


def test_mixing_clash_and_repeated_rows(spark):
    df = clashing(spark.createDataFrame([(1, "a", 10)] * 3 + [(2, None, 30), (None, "a", None)], "doc_id long, source string, size long"), "id", "src", "s", "b", "at", "one", "copies", "words", "in0", "_mx_size", "MIX_AT")
    out = mixing.mix_sources(df, block_words=4).collect()
    assert len(out) == 5 and {r["size"] for r in out} == {0, 10, 30} and all(0 <= r.taken <= 2 * r["size"] for r in out)
    assert len({(r.doc_id, r.taken) for r in out}) == 3
    assert {(r.id, r.copies, r.in0) for r in out} == {("k0", "k6", "k8")}


# ---- 7 and 9

PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d: str) -> bool:
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def pii_holds(kind: str, m: str) -> bool:
    d = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: max(map(int, m.split("."))) <= 255, "card": lambda: 16 <= len(d) <= 19 and luhn(d), "phone": lambda: 8 <= len(d) <= 15}[kind]()


TEXTS = ["a@b.c_d@e.f.g x..y@z.w-", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 1.2.3", "4539 1488 0343 6467 and 4539-1488-0343-6467-1 0", "+1 (456) 555-2186 +12 + 1 +123456789012345678", "DE89 3704 0044 0532 0130 00", "é@x.y é a@x.y", "a" * 3000 + "@", "+" + "1" * 500, None, "", "\x01a@b.cc\x02"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="a@b.1 2-+(4)é_\x01", max_size=60), min_size=1, max_size=6))
def test_pii_random(spark, texts):
    texts = texts + TEXTS
    out = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "i int, text string")).orderBy("i").collect()
    for r, t in zip(out, texts, strict=True):
        want = [(k, m.start(), m.end()) for k, p in PII.items() for m in re.finditer(p, t or "") if pii_holds(k, m.group())]
        assert [(s.kind, s.start, s.end) for s in r.pii if s.kind in PII] == want
    assert any(s.kind == "iban" and s.match.startswith("DE89") for r in out for s in r.pii)


def test_pii_scores(spark):
    texts = ["call the iban office: my ssn 123-45-6789 and 987-65-4321", "nothing 123-45-6789", "contact a@b.cc, a@b.dd", "strip 1.2.3.4; ip 1.2.3.5"]
    out = [[(s.kind, s.match, s.score) for s in r.pii] for r in pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "i int, text string")).orderBy("i").collect()]
    assert out == [[("ssn", "123-45-6789", 0.6)], [], [("email", "a@b.cc", 1.0), ("email", "a@b.dd", 0.8)], [("ip", "1.2.3.4", 0.5), ("ip", "1.2.3.5", 0.7)]]


def test_spans_of_a_megabyte(spark):
    texts = ["a@b.cc 1.2.3.4 " * 50_000, "eyJ" * 300_000, "a." * 300_000, "1" * 1_000_000, "+1" + "(" * 1_000_000, "a@" * 300_000, "1-" * 300_000, "token=abcdefgh1 " * 60_000, "password " * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    start = time.perf_counter()
    got = {r.i: r.n for r in pii.find_pii(df).select("i", F.size("pii").alias("n")).collect()}
    found = {r.i: r.n for r in secrets.find_secrets(df, ledger_of(spark)).select("i", F.size("secrets").alias("n")).collect()}
    assert time.perf_counter() - start < 60 and got[0] == 100_000 and found[7] == 60_000


def test_pii_odd(odd, none):
    assert pii.find_pii(odd.withColumn("pii", F.lit(1))).count() == len(ODD) and pii.find_pii(none).count() == 0


SECRETS = {"assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), "access": re.compile(r"AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}


def secret_spans(t):
    ok = {"assign": lambda m: len(m.group(2)) >= 8, "access": lambda m: len(m.group()) >= 16, "hex": lambda m: len(m.group()) >= 32}
    out = [(m.start(), i, k, m.end()) for i, (k, p) in enumerate(SECRETS.items()) for m in p.finditer(t or "") if ok[k](m)]
    return [(k, s, e) for s, _, k, e in sorted(out)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["token", "=", " ", "Secret", "'", "abcdefgh", "AKIA", "0123456789abcdef" * 2, "é", "APIKEY:", "api_key"]), max_size=12), min_size=1, max_size=5))
def test_secrets_random(spark, parts):
    texts = ["".join(p) for p in parts] + ["token=secret=abcdefgh1", "passwd: x token: 12345678", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in secrets.find_secrets(df, ledger_of(spark)).collect():
        assert [(s.kind, s.start, s.end) for s in r.secrets if s.kind in SECRETS] == secret_spans(texts[r.i])


def ledger_of(spark):
    return secrets.Ledger(spark, f"{common.shared_folder(spark)}/ledger-{uuid.uuid4().hex}")


def test_copies_of_a_blob_end_where_they_are_read(spark):
    """In the plan with a ledger every text passes a partial aggregate before any exchange."""
    df = spark.range(2000).select("id", F.when(F.col("id") < 1500, "token=abcdefgh1").otherwise(F.concat(F.lit("token=zzzzzzzz"), F.col("id"))).alias("text"))
    ledger = ledger_of(spark)
    plan = secrets.scan(df, ledger.read())._jdf.queryExecution().sparkPlan().toString()
    assert secrets.scan(df, ledger.read()).count() == 501 * len(secrets.RULES)
    joins = [line for line in plan.split("\n") if "Join" in line]
    assert len(joins) == 1 and plan.index("Join") < plan.index("first(text")


def test_ledger_scans_unseen_pairs_only(spark):
    one = spark.createDataFrame([(1, "token=abcdefgh1"), (2, "token=abcdefgh1"), (3, "clean")], "i int, text string")
    rules, ledger = secrets.RULES[:1], ledger_of(spark)
    found = secrets.find_secrets(one, ledger, rules)
    assert ledger.read().count() == 2 and found.filter(F.size("secrets") > 0).count() == 2
    more = one.union(spark.createDataFrame([(4, "secret=zzzzzzzz"), (5, "clean")], "i int, text string"))
    fresh = secrets.scan(more, ledger.read(), secrets.RULES[:2])
    assert {(r.blob == hashlib.sha256(b"secret=zzzzzzzz").hexdigest(), r.rule) for r in fresh.collect()} == {(True, "assign@1"), (True, "access@1"), (False, "access@1")}
    ledger = secrets.Ledger(spark, ledger.path)  # opened again, it knows what was scanned
    found = secrets.find_secrets(more, ledger, secrets.RULES[:2])
    assert found.filter(F.size("secrets") > 0).count() == 3 and ledger.read().count() == 6
    assert secrets.scan(more, ledger.read(), secrets.RULES[:2]).count() == 0


def test_secrets_odd(spark, odd, none):
    assert secrets.find_secrets(odd.withColumn("secrets", F.lit(1)).withColumn("blob", F.lit(1)), ledger_of(spark)).count() == len(ODD)
    assert secrets.find_secrets(none, ledger_of(spark)).count() == 0


def test_spans_clash(spark):
    names = ["b", "rule", "spans", "todo", "m0", "in0", "_se_blob", "_pii_email", "match"]
    df = clashing(spark.createDataFrame([(1, "token=abcdefgh1 a@b.cc")], "i int, text string"), *names)
    out = secrets.find_secrets(df, ledger_of(spark))
    assert out.columns == ["i", *names, "blob", "secrets"] and out.first().m0 == "k4" and len(out.first().secrets) == 1
    out = pii.find_pii(df)
    assert out.columns == ["i", "text", *names, "pii"] and out.first().m0 == "k4" and len(out.first().pii) == 1


# ---- 8


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                if a != b:
                    keep, gone = (a, b) if rows[a][0] <= rows[b][0] else (b, a)
                    parent[gone] = keep
    return sorted((rows[i][0], len(sets[i]), rows[find(i)][0]) for i in range(len(rows)))


def test_jaccard_families(spark):
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for length, copies, edits in ((9, 6, 1), (12, 8, 1), (30, 10, 2), (60, 40, 3), (300, 15, 12), (5, 5, 1), (6, 9, 1), (3, 3, 0)):
        base = [f"w{x}" for x in rng.integers(0, 5000, length)]
        for _ in range(copies):
            words = list(base)
            for _ in range(int(rng.integers(0, edits + 1))):
                at = int(rng.integers(len(words)))
                words[at : at + int(rng.integers(0, 2))] = [f"e{rng.integers(9999)}"] if rng.random() < 0.6 else []
            rows.append((i, " ".join(words)))
            i += 1
    shared = " ".join(f"p{k}" for k in range(40))  # a passage that many share
    rows += [(i + k, shared + " " + " ".join(f"q{x}" for x in rng.integers(0, 9999, 60))) for k in range(60)]
    got = sorted((r.id, r["size"], r.component_id) for r in jaccard.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_components(rows)


@pytest.mark.parametrize("small, chunk", [(2, 3), (6, 2048)])
def test_jaccard_group_sizes(spark, monkeypatch, small, chunk):
    """Groups over several chunks lose nothing."""
    rows = [(i, " ".join(f"w{j}" for j in range(40)) + f" x{i % 5} y{i}") for i in range(30)] + [(100 + i, " ".join(f"w{j}" for j in range(20)) + " " + " ".join(f"v{i}{j}" for j in range(20))) for i in range(12)]
    monkeypatch.setattr(jaccard, "_SMALL", small)
    monkeypatch.setattr(jaccard, "_CHUNK", chunk)
    got = sorted((r.id, r["size"], r.component_id) for r in jaccard.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_components(rows)


def test_signatures_lose_no_link():
    """Every two sets at the limit of 0.8 share a signature, small and large, whatever they hold."""
    rng, bands = np.random.default_rng(0), jaccard.bands(0.8)
    tried = 0
    for _ in range(8000):
        n = int(rng.integers(4, 60)) if rng.random() < 0.7 else int(rng.integers(60, 500))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        common = n - int(rng.integers(0, n // 5 + 2))
        b = np.r_[a[:common], rng.integers(0, 2**63, int(rng.integers(0, n // 4 + 2))).astype(np.uint64)]
        if 100 * common >= 80 * (n + len(b) - common) and len(b) + n > 2 * common:
            tried += 1
            assert len(np.intersect1d(bands.signatures(a), bands.signatures(b)))
    assert tried > 2000


def test_signatures_of_few_parts():
    """Where empty signatures are the rule, as with a plan of no spare parts, the second draw stands in."""
    bands, rng, second = jaccard.Bands(0.8), np.random.default_rng(1), 0
    bands.plans = [jaccard.Plan(p.high, -(-(math.floor(0.2 / 1.8 * 2 * p.high + 1e-9) + 1) // 2), 2) for p in bands.plans]
    for _ in range(2000):
        n = int(rng.integers(10, 80))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.r_[a[: n - n // 10], rng.integers(0, 2**63, n // 10).astype(np.uint64)]
        second += any(bands._drawn(a, band, 0)[1].sum() >= bands.plans[band].agreeing(n, 0.8) for band in bands.of(n))
        assert len(np.intersect1d(bands.signatures(a), bands.signatures(b)))
    assert second > 3


def test_jaccard_nodes_of_one_name(spark, monkeypatch):
    """Sets whose first 64 bits are equal are told apart by the others."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(8))) for i in range(6)] + [(10 + i, " ".join(f"w{i}x{j}" for j in range(8))) for i in range(6)]
    real = jaccard.node_of

    def node_of(s, again=frozenset()):
        node, rest = real(s)
        return (real(s, frozenset([node]))[0] if 7 in again else 7), rest

    monkeypatch.setattr(jaccard, "node_of", node_of)
    given = spark.createDataFrame(rows, "id long, text string").select("id", F.encode("text", "UTF-8").alias("text"))
    run = jaccard._signed(given.coalesce(1), 5, 0.8, frozenset()).collect()
    assert len({r.sig for r in run if r.size == -2}) == 6


def test_chain_of_components(spark):
    n = 400
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    assert {tuple(r) for r in jaccard.components(None, edges).collect()} == {(i, 0) for i in range(n + 1)}


def test_jaccard_clash(spark):
    df = clashing(spark.createDataFrame([(1, "a b c"), (2, "a b c")], "doc_id long, text string"), "id", "node", "size", "sig", "label", "in0")
    assert sorted((r.id, r.component_id) for r in jaccard.similar(df).collect()) == [(1, 1), (2, 1)]


def test_jaccard_odd(odd, none):
    rows = jaccard.similar(odd).collect()
    assert len(rows) == len(ODD) and jaccard.similar(none).count() == 0
    by = {r.id: r for r in rows}
    assert by[1]["size"] == 0 and by[1].component_id == 1 and by[2].component_id == 2 and by[None].component_id is None and by[5].component_id == 5


# ---- 10


def test_line_dedup_by_hand(spark, odd, none):
    out = {r.doc_id: r for r in line_dedup.dedup_lines(odd.withColumn("n_lines", F.lit(1))).collect()}
    assert out[10].text == "own 0" and out[10].n_dropped == 2 and out[15].n_dropped == 0 and out[15].n_lines == 3
    assert out[1].text == "" and out[1].n_lines == 1 and out[30].n_lines == 4
    assert line_dedup.dedup_lines(none).count() == 0


def test_line_dedup_hot_shards(spark):
    rows = [(i, f"{LINE}\n{LINE} {i % 7}\n{i} {LINE}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a = sorted(map(tuple, line_dedup.dedup_lines(df).collect()))
    assert a == sorted(map(tuple, line_dedup.dedup_lines(df, shard_keys=40, probe_rows=10).collect()))
    assert sum(r[3] for r in a) == 299 + 293


def test_line_dedup_clash(spark):
    df = clashing(spark.createDataFrame([(i, f"{LINE}\nown {i}") for i in range(5)], "doc_id long, text string"), "doc", "drops", "lines", "long", "gone", "in0", "_ld_doc", "N_LINES")
    out = line_dedup.dedup_lines(df).collect()
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out) == [(i, f"own {i}", 2, 1) for i in range(4)] + [(4, f"{LINE}\nown 4", 2, 0)]
    assert {(r.doc, r.lines, r.in0) for r in out} == {("k0", "k2", "k5")}


def test_line_dedup_of_many_lines(spark):
    text = "\n".join(f"line number {i} that is more than forty characters long" for i in range(50_000))
    start = time.perf_counter()
    out = line_dedup.dedup_lines(spark.createDataFrame([(i, text) for i in range(6)], "doc_id long, text string"))
    assert out.agg(F.sum("n_dropped")).first()[0] == 250_000 and time.perf_counter() - start < 40


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400))
def test_perfect_hash_is_minimal(keys):
    k = np.array(sorted(keys), np.uint64)
    slots = line_dedup.PerfectHash.build(k).slots(k)
    assert sorted(slots) == list(range(len(k)))


# ---- 4


def test_licenses(spark, odd, none):
    mit = dict((t[:11], t) for _, t in licenses.KNOWN)["MIT License"]
    rows = [(1, "Copyright (c) 2020 A. B.\n" + mit.upper()), (2, "text\n  RELEASED under the MIT-Licence!\nmore"), (3, "Released under the MIT License, or so."), (4, None), (5, mit.replace("MIT License\n", "MIT License\n\n(c) 1999 X\n")), (6, "Released under the MIT License."), (6, "other")]
    out = sorted((r.doc_id, ",".join(r.licenses), ",".join(r.whole)) for r in licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert out == [(1, "MIT", "MIT"), (2, "MIT", ""), (3, "", ""), (4, "", ""), (5, "MIT", "MIT"), (6, "", ""), (6, "MIT", "MIT")]
    assert licenses.find_licenses(odd.withColumn("whole", F.lit(1))).count() == len(ODD) and licenses.find_licenses(none).count() == 0


def test_licenses_clash_and_long_text(spark):
    names = ["_li_text", "_li_key", "_li_whole", "_li_k", "in0", "key", "d", "own_key", "license", "n", "lines", "c"]
    mit = dict((t[:11], t) for _, t in licenses.KNOWN)["MIT License"]
    df = clashing(spark.createDataFrame([(1, mit), (2, "word " * 250_000 + "\n" + mit + "\n" + "other\n" * 20_000)], "i int, text string"), *names)
    out = licenses.find_licenses(df)
    assert out.columns == ["i", *names, "digest", "licenses", "whole"]
    got = {r.i: r for r in out.collect()}
    assert (got[1].licenses, got[1].whole) == (["MIT"], ["MIT"]) and (got[2].licenses, got[2].whole) == (["MIT"], [])
    assert all(got[1][c] == v for c, v in df.filter("i = 1").first().asDict().items() if c in names)


def test_license_catalogue(spark):
    """Full texts, titles or none, copyright without a year, wrapped at any width inside longer documents."""
    import textwrap

    rows, want = [], []
    for i, t in licenses.catalogue():
        for width in (37, 60, 79):
            lines = [x for line in t.split("\n") for x in ([line] if re.match(r"\W*copyright\W+(c\)|yyyy)", line, re.I) else textwrap.wrap(line, width, break_long_words=False, break_on_hyphens=False) or [""])]
            for text in ("\n".join(["Copyright (c) Jane Doe", "All rights reserved.", "", *lines]), "\n".join(["Some program", "the readme", "", "Copyright: 2020 X", "", *("# " + x for x in lines), "", "more text"])):
                rows.append((len(rows), text))
                want.append(i)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in licenses.find_licenses(df).collect()}
    bad = [(want[k], rows[k][1][:150], out[k].licenses, out[k].whole) for k in out if want[k] not in out[k].licenses or (k % 2 == 0) != (want[k] in out[k].whole)]
    assert len(out) == len(rows) and not bad, (len(bad), bad[:3])
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "Unlicense", "MIT", "ISC", "0BSD"} <= set(want)
    other = spark.createDataFrame([(1, "Permission is hereby granted,\nfree of charge"), (2, "the copyright\ncopyright notice of it"), (3, None)], "doc_id long, text string")
    assert all(r.licenses == [] for r in licenses.find_licenses(other).collect())


def test_passage_of_many_items_and_documents(spark):
    """A passage that 400 items and 400 documents share makes hits by window, not by document and item."""
    shared = " ".join(f"w{i}" for i in range(15))
    items = spark.range(400).select(F.concat(F.lit("b"), F.col("id").cast("string")).alias("item_id"), F.concat(F.lit(shared + " tail"), F.col("id").cast("string")).alias("text"))
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("head "), F.lit(shared), F.lit(" end"), F.col("id").cast("string")).alias("text"))
    start = time.time()
    got = decontam.contamination(docs, items).select("n_words", "n_hit", "n_items", F.size("items").alias("k"), "items", "contaminated").distinct().collect()
    assert len(got) == 1 and got[0][:4] == (17, 15, 400, 400) and got[0].contaminated and got[0]["items"] == sorted(f"b{i}" for i in range(400))
    assert time.time() - start < 120
