"""Which tokens of two tokenizers cover the same bytes of a text, and how often over a corpus.

B's tokens lie side by side, so their sorted starts and ends are a static interval index: two bisections give all of them
that a token of A overlaps. A gap between tokens that no token of either side spans parts two groups; within a group every
A token is linked with every B token.

Neither tokenizer joins anything across a place where a space or line feed follows a character that isn't white space
(checked on the vocabularies), so a text is cut there and what a segment gives is kept: a task tokenizes and aligns each
distinct segment once, many at a time. Counts of linked pairs are sums over documents by Spark. The most frequent pairs,
LOOKUP at most, are broadcast to look the counts up; the others, none of which a large share of documents holds, are joined.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from spliceframe.llm.common import Sealed, cut, stored, table

FOLDER = "/opt/tokenizers"
#: Segments that a process remembers; characters that are tokenized at once, and that documents of one step hold.
KNOWN, CHUNK, STEP = 200_000, 200_000, 2_000_000
#: Pairs that are broadcast.
LOOKUP = 500_000

LINKS = ArrayType(StructType([StructField("a", IntegerType()), StructField("b", IntegerType()), StructField("n", LongType())]))  # two int keys join as one long
_SPACE = "▁"


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each A token the first B token that it overlaps and the first one behind. Ends are in ascending order, starts are the ends before."""
    b_start = np.append(0, b_end[:-1])
    return np.searchsorted(b_end, np.append(0, a_end[:-1]), "right"), np.searchsorted(b_start, a_end, "left")


def groups(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and of each B token, from 0."""
    first, behind = overlaps(a_end, b_end)
    a = np.cumsum(np.append(0, behind[:-1] <= first[1:]))
    return a, a[np.searchsorted(behind, np.arange(len(b_end)), "right")]


def _byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write bytes as signs: printable ones of Latin-1 as themselves, the others in turn from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(0x100) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """A: a byte-level BPE file; B: a piece model with byte fallback."""

    def __init__(self, a_file: str, b_file: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        sign = _byte_of_sign()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(sign[c] for c in token) if all(c in sign for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        with open(a_file, encoding="utf-8") as f:
            file = json.load(f)
        before = file.get("pre_tokenizer") or {}
        cuts = file.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        cuts = cuts and not any(_SPACE in p.lstrip(_SPACE) or "\n" in p for p in pieces)
        #: A segment begins with a space or line feed behind a character that is neither white space nor taken for a space.
        self.segment = re.compile(rf"[ \n][^ \n]*(?:(?<=[\s{_SPACE}])[ \n][^ \n]*)*" if cuts else "(?s:.+)")
        self.alone = re.compile(rf"[\s{_SPACE}]\Z|{_SPACE}" if cuts else "")
        self.anchor = "a" if cuts else ""  # what a segment stands behind, so that B adds its space there
        self.ahead = len(self.b.encode(self.anchor))
        self.a_len, self.b_len = (np.array([len(x) for x in y]) for y in (self.a_bytes, self.b_bytes))
        self.width = len(self.b_bytes)
        numbers = [str(i).encode() for i in range(max(len(self.a_bytes), self.width))]
        #: Each id with the mark behind it inside its group and at the end of its side of the group, and the length of that.
        self.a_told, self.b_told = ((*(np.array([x + mark for x in numbers[:size]], object) for mark in (b",", end)), np.array([len(x) + 1 for x in numbers[:size]])) for size, end in ((len(self.a_bytes), b"|"), (self.width, b";")))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.told: list[bytes] = []
        self.stats = np.zeros((0, 5), np.int64)  # whether its bytes are kept, A tokens, B tokens, groups, links
        self.bounds, self.pair, self.times = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of both, if their bytes are the text's. text begins with a space or line feed."""
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(self.anchor + text if self.anchor else text.removeprefix(" "))[self.ahead :]
        whole = text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def learn(self, new: list[str]) -> None:
        """Tokenizes and aligns segments that aren't known."""
        together, size, alone = [[]], 0, []
        for x in new:
            if self.alone.search(x):
                alone.append(x)
                continue
            if size > CHUNK:
                together, size = [*together, []], 0
            together[-1].append(x)
            size += len(x)
        for part in [*together, *([x] for x in alone)]:
            if part:
                ids = self.encode("".join(part))
                if ids is not None:
                    self.add(part, *ids)
                elif len(part) > 1:
                    for x in part:
                        ids = self.encode(x)
                        self.add([x], *(ids or (np.zeros(0, np.int64),) * 2))
                else:
                    self.add(part, *(np.zeros(0, np.int64),) * 2)

    def add(self, part: list[str], a: np.ndarray, b: np.ndarray) -> None:
        """Keeps what the tokens of these segments, one after another, give; without tokens they have none."""
        n = len(part)
        for x in part:
            self.known[x] = len(self.known)
        if not len(a):
            self.stats = np.concatenate([self.stats, np.zeros((n, 5), np.int64)])
            self.bounds = np.append(self.bounds, np.repeat(self.bounds[-1], n))
            self.told += [b""] * n
            return
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        seg_end = np.cumsum([len(x.encode()) for x in part])
        a_group, b_group = groups(a_end, b_end)
        first = np.append(0, np.flatnonzero(np.diff(a_group)) + 1)
        a_seg, b_seg = np.searchsorted(seg_end, a_end), np.searchsorted(seg_end, b_end)
        seg, n_a, n_b = a_seg[first], np.bincount(a_group), np.bincount(b_group)
        links = np.bincount(seg, n_a * n_b, n).astype(np.int64)
        self.stats = np.concatenate([self.stats, np.stack([np.ones(n, np.int64), np.bincount(a_seg, minlength=n), np.bincount(b_seg, minlength=n), np.bincount(seg, minlength=n), links], 1)])

        # "a1,a2|b1;a3|b2,b3" for each segment
        last_a, last_b = np.append(np.diff(a_group) > 0, True), np.append(np.diff(b_group) > 0, True)
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + np.append(0, np.cumsum(n_b))[a_group]] = np.where(last_a, self.a_told[1][a], self.a_told[0][a])
        out[np.arange(len(b)) + np.cumsum(n_a)[b_group]] = np.where(last_b, self.b_told[1][b], self.b_told[0][b])
        whole = b"".join(out.tolist())
        ends = np.cumsum(np.bincount(a_seg, self.a_told[2][a], n) + np.bincount(b_seg, self.b_told[2][b], n)).astype(np.int64).tolist()
        self.told += [whole[i : j - 1] for i, j in zip([0, *ends], ends)]

        # pairs of a segment with the number of their links: kinds of A times kinds of B tokens in each group
        (ka, ca), (kb, cb) = (np.unique(g * w + x, return_counts=True) for g, w, x in ((a_group, len(self.a_bytes), a), (b_group, self.width, b)))
        ga, gb = ka // len(self.a_bytes), kb // self.width
        kinds = np.bincount(gb)
        left = np.repeat(np.arange(len(ka)), kinds[ga])
        right = np.arange(len(left)) - np.repeat(np.cumsum(kinds[ga]) - kinds[ga], kinds[ga]) + (np.cumsum(kinds) - kinds)[ga[left]]
        key, times = merged(seg[ga[left]] * (len(self.a_bytes) * self.width) + ka[left] % len(self.a_bytes) * self.width + kb[right] % self.width, ca[left] * cb[right])
        at, key = np.divmod(key, len(self.a_bytes) * self.width)
        self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(np.bincount(at, minlength=n)))
        self.pair, self.times = np.append(self.pair, key), np.append(self.times, times)

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """By text: A tokens, B tokens, groups, links and the groups as text; bounds of its pairs, the pairs, and their links."""
        found = [self.segment.findall(f" {t}") if t else [] for t in texts]
        flat = [x for f in found for x in f]
        new = set(flat).difference(self.known)
        if len(self.known) + len(new) > KNOWN:
            self.forget()
            new = set(flat)
        self.learn(sorted(new))
        ids = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        n = len(texts)
        doc = np.repeat(np.arange(n), [len(f) for f in found])
        ok = np.bincount(doc, self.stats[ids, 0] == 0, n) == 0
        stats = np.stack([np.bincount(doc, self.stats[ids, c], n) for c in range(1, 5)], 1).astype(np.int64) * ok[:, None]
        told, end = [], 0
        for f, fine in zip(found, ok.tolist(), strict=True):
            told.append(b";".join(map(self.told.__getitem__, ids[end : end + len(f)].tolist())) if fine else b"")
            end += len(f)
        both, often = np.unique((doc * len(self.told) + ids)[ok[doc]], return_counts=True)
        doc, ids = np.divmod(both, len(self.told))
        length = self.bounds[ids + 1] - self.bounds[ids]
        at = np.arange(length.sum()) + np.repeat(self.bounds[ids] - np.cumsum(length) + length, length)
        size = len(self.a_bytes) * self.width
        key, times = merged(np.repeat(doc, length) * size + self.pair[at], np.repeat(often, length) * self.times[at])
        doc, pair = np.divmod(key, size)
        return stats, told, np.searchsorted(doc, np.arange(n + 1)), pair, times


def merged(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of n by key, in ascending order."""
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return key[first], np.add.reduceat(n, first) if len(first) else n


_loaded: dict[tuple[str, str], Tokenizers] = {}


def aligned(docs: DataFrame, a_file: str = f"{FOLDER}/byte_bpe_50k.json", b_file: str = f"{FOLDER}/piece_bpe_32k.model", text_col: str = "text") -> DataFrame:
    """docs with n_a, n_b (tokens), n_groups, n_links, groups ("a1,a2|b1;a3|b2,b3": ids in order) and links (a, b, n: the distinct
    pairs of ids that are linked, and how many links of them there are).

    A takes a space and the text, B the text (it adds the space); special tokens' strings are plain text. Texts that are
    null, empty, or not what the tokens' bytes join to have no tokens: zeros, groups "", no links. Columns of these names
    are replaced. The files have to be where the tasks run.
    """
    made = ["n_a", "n_b", "n_groups", "n_links", "groups", "links"]
    s = Sealed(docs, *made)
    text, names = s[text_col], s.df.columns
    schema = StructType([*s.df.schema.fields, *(StructField(m, LongType()) for m in made[:4]), StructField("groups", StringType()), StructField("links", LINKS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _loaded.setdefault((a_file, b_file), None) or Tokenizers(a_file, b_file)
        _loaded[a_file, b_file] = both
        for batch in batches:
            texts = batch.column(names.index(text)).to_pylist()
            size = np.cumsum([len(t or "") for t in texts])
            starts = [0, *np.flatnonzero(np.diff(size // STEP) > 0) + 1, len(texts)]
            for lo, hi in zip(starts, starts[1:]):
                stats, told, bounds, pair, times = both.align(texts[lo:hi])
                links = pa.StructArray.from_arrays([pa.array(x) for x in ((pair // both.width).astype(np.int32), (pair % both.width).astype(np.int32), times)], ["a", "b", "n"])
                columns = [batch.column(i).slice(lo, hi - lo) for i in range(len(names))]
                columns += [pa.array(np.ascontiguousarray(stats[:, c])) for c in range(4)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(told, pa.binary()).cast(pa.string()), pa.ListArray.from_arrays(bounds.astype(np.int32), links)], names=[*names, *made])

    out = s.df.mapInArrow(run, schema)
    return s.opened(out, *made)


def pair_counts(linked: DataFrame) -> DataFrame:
    """(a, b, docs, best) from rows of links: how many rows hold the pair linked, and whether no pair of this a is held by more."""
    counts = cut(linked.select(F.inline("links")).groupBy("a", "b").agg(F.count("*").alias("docs")))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))  # a row for each entry of A's vocabulary at most
    return counts.join(F.broadcast(most), "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))


def link_sums(linked: DataFrame, row_col: str, lookup: int = LOOKUP) -> DataFrame:
    """(row_col, n_best, count_sum) from rows of row_col and links: the links whose pair is its a's most frequent one (ties
    included), and the counts of all links' pairs added up. Rows without links are left out."""
    counts = cut(pair_counts(linked))
    top = F.broadcast(counts.orderBy(F.col("docs").desc(), "a", "b").limit(lookup))
    each = linked.select(row_col, F.inline("links"))
    found = each.join(top, ["a", "b"])
    if counts.count() > lookup:
        rare = each.join(top, ["a", "b"], "left_anti").join(counts.join(top, ["a", "b"], "left_anti"), ["a", "b"])
        found = found.unionByName(rare)
    return found.groupBy(row_col).agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("docs")).alias("count_sum"))


def op13(spark, sf_dir: str) -> DataFrame:
    docs = aligned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "links"), "aligned")
    sums = link_sums(rows.select("row", "links"), "row")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.drop("links").join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
