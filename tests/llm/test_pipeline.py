"""Each stage of the corpus pipeline on what the one before kept, against brute force, on small documents."""

import collections
import os
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from spliceframe.llm import toxicity
from spliceframe.llm.common import shared_folder, table


WORD, WINDOW = re.compile(r"[^\x20\x09-\x0D]+"), 13


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def grams(w):
    return [tuple(w[i : i + WINDOW]) for i in range(max(1, len(w) - WINDOW + 1))] if w else []


def contaminated(text, windows):
    w, hit = words(text), set()
    for n in {len(x) for x in windows}:
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
    return len(hit) > 0 and 20 * len(hit) >= len(w)


def without_repeated_lines(texts):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    for i, t in texts.items():
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    gone = {k: max(d) for k, d in holders.items() if len(k) >= 40 and len(d) >= 5}
    return {i: "\n".join(line for line in (t or "").split("\n") if gone.get(key(line), i) == i) for i, t in texts.items()}


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    kept, windows = {}, {w for r in table(spark, sf_dir, "benchmark").collect() for w in grams(words(r.text))}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, sf_dir)
        if name != "source_mix":
            assert out.columns == docs.columns
        rows = out.collect()
        after = {r.doc_id: r for r in rows}
        kept[name] = len(after)
        assert set(after) <= set(before) and len(rows) == len(after)
        if name == "line_dedup":
            assert set(after) == set(before) and all(len(r.text) <= len(before[i].text or "") and r.n_chars == len(r.text) for i, r in after.items())
        if name == "jaccard_join":
            sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if (w := (r.text or "").lower().split()) else set() for i, r in after.items()}
            ids = sorted(sets)
            assert not any(len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b]) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b])
        if name == "line_dedup":
            assert {i: r.text for i, r in after.items()} == without_repeated_lines({i: r.text for i, r in before.items()})
        if name == "decontamination":
            assert set(after) == set(before) - {i for i, r in before.items() if contaminated(r.text, windows)}
        if name == "source_mix":
            for source in {r.source for r in before.values()}:
                own = [r for r in rows if r.source == source]
                assert not own or abs(sum(r.taken for r in own) - own[0].target) <= 1
            assert all(r.taken <= 2 * r["size"] and r["size"] == len(WORD.findall(r.text or "")) for r in rows)
            total = sum(r["size"] for r in rows)
            assert total and sum(r.taken for r in rows) > total
        docs = spark.createDataFrame(rows, out.schema)
    assert kept["toxicity"] > 0.8 * table(spark, sf_dir, "documents").count()


def test_run_equals_stages_on_repeated_and_null_rows(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, "en", "a", 9), (1, text, "en", "a", 9), (2, text + " x", "en", "a", 9), (3, None, None, None, None), (4, "", "en", "b", 0), (5, "other words entirely", "en", None, 3)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, None), (2, "one two")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    there = set(os.listdir(shared_folder(spark).removeprefix("file://")))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in out.collect()) == [1, 5]
    new = {x.rpartition("-")[0] for x in set(os.listdir(shared_folder(spark).removeprefix("file://"))) - there}
    assert not new & {name for name, _ in corpus_pipeline.STAGES[:-1]} and "source_mix" in new


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(2, "one two")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_toxic_documents_go(spark):
    docs = spark.createDataFrame([(i, "pleasant words all over " * 3 + ("moron " * 4 if i % 2 else "")) for i in range(200)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels, toxicity.Settings(epochs=10))
    scores = np.array([(r.doc_id % 2, r.score) for r in toxicity.score(docs, model).collect()])
    assert (scores[scores[:, 0] == 1, 1] >= toxicity.CUT).all() and (scores[scores[:, 0] == 0, 1] < toxicity.CUT).all()
