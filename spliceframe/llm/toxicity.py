"""Toxicity: averaged subword embeddings into a linear softmax, trained jointly in numpy.

A word is the bag of its hashed character n-grams (with < and > at its ends), and its vector their mean; a text's vector
is the mean of its words'. Vectors and softmax weights are trained together by gradient descent on labelled texts, so
an unseen misspelling or inflection is scored by the n-grams that it shares. As all that follows the means is linear, a
trained model comes down to one number for each hash bucket, and scoring reads every word of every text.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from spliceframe.llm.common import Sealed, cut, table

#: The score from which a text counts as toxic.
CUT = 0.7
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    dim: int = 6
    least: int = 3  # lengths of n-grams
    most: int = 6
    epochs: int = 14
    batch: int = 128
    rate: float = 0.1
    least_share: float = 0.0025  # n-grams in a smaller share of the training texts, or in under 3, keep the vector 0
    shrink: float = 0.1  # every step takes so much of the rate from a vector's length, down to 0
    scale: float = 600.0  # logits are this times the softmax's input: a few words of a long text have to tell
    seed: int = 11
    rows: int = 2_000  # texts of each label, at most, that training takes: those whose ids have the least hashes


@dataclass(frozen=True)
class Model:
    """weights: what a bucket adds to a word's logit. A text's is scale * mean + bias."""

    weights: np.ndarray
    bias: float
    settings: Settings

    def word(self, w: str) -> float:
        g = grams(w, self.settings)
        return float(self.weights[g].sum()) / len(g)

    def logit(self, text: str | None, known: dict[str, float]) -> float:
        counts = Counter(_WORD.findall((text or "").lower()))
        total = 0.0
        for w, n in counts.items():
            x = known.get(w)
            if x is None:
                if len(known) >= 1_000_000:
                    known.clear()
                x = known[w] = self.word(w)
            total += n * x
        return self.settings.scale * total / max(1, counts.total()) + self.bias

    def score(self, text: str | None, known: dict[str, float]) -> float:
        return 1.0 / (1.0 + math.exp(-min(max(self.logit(text, known), -60.0), 60.0)))


def grams(word: str, s: Settings) -> list[int]:
    w = f"<{word}>"
    if len(w) > 80:  # numbers and keys without breaks: their pieces are looked at in turn, all of them
        return [x for i in range(0, len(word), 64) for x in grams(word[i : i + 64], s)]
    return [zlib.crc32(w[i : i + n].encode()) % s.buckets for n in range(s.least, s.most + 1) for i in range(len(w) - n + 1)] or [zlib.crc32(w.encode()) % s.buckets]


def _pieces(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes of several stretches, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def train(texts: list[str | None], labels: np.ndarray, s: Settings = Settings()) -> Model:
    """Fits vectors and softmax to whole texts with labels 0 and 1; a seed makes reruns agree. One label only: a constant."""
    ids: dict[str, int] = {}
    words, shares, kept = [], [], []
    for i, t in enumerate(texts):
        if counts := Counter(_WORD.findall((t or "").lower())):
            kept.append(i)
            words.append(np.fromiter((ids.setdefault(w, len(ids)) for w in counts), np.int32, len(counts)))
            shares.append(np.fromiter(counts.values(), np.float32, len(counts)) / counts.total())
    y = np.asarray(labels)[kept].astype(int)
    if len({*y}) < 2:
        return Model(np.zeros(s.buckets, np.float32), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))), s)
    flat, g_len = array("i"), np.zeros(len(ids), np.int64)
    for i, w in enumerate(ids):
        bag = grams(w, s)
        g_len[i] = len(bag)
        flat.extend(bag)
    g_all, g_at = np.frombuffer(flat, np.int32), np.cumsum(g_len) - g_len
    rng = np.random.default_rng(s.seed)
    held_by = np.zeros(s.buckets, np.int32)
    for w in words:
        held_by[np.unique(g_all[_pieces(g_at[w], g_len[w])])] += 1
    held = np.flatnonzero(held_by >= max(3, s.least_share * len(y)))
    place = np.full(s.buckets, len(held))  # rare n-grams share the last place, whose vector stays 0
    place[held] = np.arange(len(held))
    g_all = place[g_all]
    vectors = np.zeros((len(held) + 1, s.dim), np.float32)  # unseen n-grams say nothing; the softmax's start breaks the tie
    soft, bias = rng.normal(0, 1, s.dim), -2.0
    seen_v, seen_s, seen_b = np.full_like(vectors, 1e-4), np.full(s.dim, 1e-4), 1e-4
    per_label = len(y) / 2 / np.bincount(y, minlength=2)
    for epoch in range(s.epochs):
        rate = s.rate * (1 - epoch / s.epochs) + 1e-4
        order = rng.permutation(len(y))
        for at in range(0, len(y), s.batch):
            mine = order[at : at + s.batch]
            lengths = np.array([len(words[i]) for i in mine])
            which, inverse = np.unique(np.concatenate([words[i] for i in mine]), return_inverse=True)
            share = np.concatenate([shares[i] for i in mine])
            doc_at, n = np.cumsum(lengths) - lengths, g_len[which]
            g = g_all[_pieces(g_at[which], n)]
            of_word = np.add.reduceat(vectors[g], np.cumsum(n) - n) / n[:, None]
            of_doc = np.add.reduceat(of_word[inverse] * share[:, None], doc_at)
            p = 1 / (1 + np.exp(-np.clip(s.scale * (of_doc @ soft) + bias, -60, 60)))
            slope = (p - y[mine]) * per_label[y[mine]] / len(mine)
            step_s = s.scale * (of_doc.T @ slope)
            back = s.scale * np.outer(slope, soft)
            back = np.repeat(back, lengths, axis=0) * share[:, None]
            back = np.stack([np.bincount(inverse, back[:, d], len(which)) for d in range(s.dim)], 1) / n[:, None]
            step_v = np.stack([np.bincount(g, np.repeat(back[:, d], n), len(vectors)) for d in range(s.dim)], 1).astype(np.float32)
            seen_v += step_v**2
            seen_s += step_s**2
            seen_b += slope.sum() ** 2
            step_v[-1] = 0
            vectors -= rate * step_v / np.sqrt(seen_v)
            length = np.sqrt((vectors**2).sum(1, keepdims=True))
            vectors *= np.maximum(0, 1 - rate * s.shrink / np.maximum(length, 1e-12))
            soft -= rate * step_s / np.sqrt(seen_s)
            bias -= rate * slope.sum() / np.sqrt(seen_b)
    weights = np.zeros(s.buckets, np.float32)
    weights[held] = vectors[:-1] @ soft
    return Model(weights, float(bias), s)


def calibrated(model: Model, logits: np.ndarray, labels: np.ndarray, share: float) -> Model:
    """The model with its bias moved so that a text at the best cut scores CUT. share: of label 1 among all.

    The best cut has the highest F1 among those that hold at most one clean text in a hundred; logits should come from
    models that have not seen the texts.
    """
    y = np.asarray(labels) == 1
    if y.all() or not y.any():
        return model
    order = np.argsort(-logits, kind="stable")
    z = logits[order]
    hit, false = np.cumsum(y[order]) / y.sum(), np.cumsum(~y[order]) / (~y).sum()
    f1 = 2 * share * hit / (share * hit + (1 - share) * false + share)
    f1[(np.diff(z, append=-np.inf) >= 0) | (false > 0.01)] = -1
    best = int(f1.argmax())
    cut = (z[best] + z[best + 1]) / 2 if f1[best] > 0 and best + 1 < len(z) else z[0] + 1e-6
    return replace(model, bias=model.bias - cut + math.log(CUT / (1 - CUT)))


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 3) -> Model:
    """Trains on labelled rows of docs outside the held-out third: s.rows texts of each label at most.

    Rows without id or label take no part. Of repeated ids every text counts once; of more texts of a label than s.rows,
    those with the least hashes of id and text. The model is the mean of models that leave out a fold each (all is
    linear, so weights and biases are averaged), calibrated on the logits that each gives its own left-out fold. Each is
    trained in a task of its own; the driver gets weights and logits, not texts.
    """
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id is not null and y in (0, 1)").filter(~held_out(F.col("id")))
    order = [F.xxhash64("id"), F.col("id")]
    ids = [r for y in (0, 1) for r in usable.filter(F.col("y") == y).distinct().orderBy(*order).limit(s.rows).collect()]
    chosen = docs.sparkSession.createDataFrame(ids, "id long, y int")  # 2 * s.rows rows at most
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").distinct()
    one, other = (found.filter(F.col("y") == y).orderBy(F.xxhash64("id", "text"), "id", "text").limit(s.rows) for y in (0, 1))  # so that no label takes the other's places
    rows = cut(one.union(other).withColumn("h", order[0]))

    def train_one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(none=pdf["text"].isna(), text=pdf["text"].fillna("")).sort_values(["y", "h", "id", "none", "text"], ignore_index=True)
        y, left_out = pdf["y"].to_numpy(), pdf["model"].iat[0]
        out = pdf.groupby("y").cumcount().to_numpy() % folds == left_out  # each label in every fold
        model = train(pdf["text"][~out].tolist(), y[~out], s)
        known: dict[str, float] = {}
        logits = np.array([model.logit(t, known) for t in pdf["text"][out]], np.float64)
        return pd.DataFrame({"model": [left_out], "weights": [model.weights.tobytes()], "bias": [model.bias], "logits": [logits.tobytes()], "y": [y[out].astype(np.int64).tobytes()]})

    each = rows.withColumn("model", F.explode(F.array(*map(F.lit, range(folds))))).repartitionByRange(folds, "model")
    got = sorted(each.groupBy("model").applyInPandas(train_one, "model int, weights binary, bias double, logits binary, y binary").collect(), key=lambda r: r["model"])
    if not got:
        return train([], np.zeros(0, int), s)
    n = dict(usable.groupBy("y").count().collect())
    mean = Model(np.mean([np.frombuffer(r["weights"], np.float32) for r in got], axis=0), float(np.mean([r["bias"] for r in got])), s)
    logits, y = (np.concatenate([np.frombuffer(r[c], t) for r in got]) for c, t in (("logits", np.float64), ("y", np.int64)))
    return calibrated(mean, logits, y, n.get(1, 0) / max(1, sum(n.values())))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


_known: tuple[int, dict[str, float]] = (0, {})


def score(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True, score_col: str = "score") -> DataFrame:
    """docs with score_col, from 0 to 1. Null and empty texts get the model's bias. A column of docs named score_col is replaced."""
    s = Sealed(docs, score_col)
    docs = s.df
    out = docs if keep_text else docs.drop(s[text_col])
    held = docs.sparkSession.sparkContext.broadcast(model)
    names, key, text = out.columns, zlib.crc32(model.weights.tobytes()), s[text_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        global _known
        if _known[0] != key:
            _known = (key, {})
        for pdf in batches:
            scores = [held.value.score(t, _known[1]) for t in pdf[text]]
            yield pdf[names].assign(score=scores)

    scored = docs.mapInPandas(run, StructType([*out.schema.fields, StructField("score", DoubleType())]))
    return s.opened(scored, F.col("score").alias(score_col), without=() if keep_text else (text_col,))


def op5(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")), keep_text=False)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
