"""Toxicity by a classifier chain.

Categories are predicted one after another; each linear model sees the text's
features and the probabilities of the categories before it.  In training those
are out-of-fold predictions, so a later model meets earlier probabilities as
they will be on unseen text.

The labels have one human category, ``toxic``.  The chain puts two before it
that follow from it by rule, over the marker words that training
finds: ``repeated``, a toxic text with at least as many marker words as the
median toxic text, and ``dense``, one with at least its share of them.
A text counts as toxic from a final probability of ``THRESHOLD`` on.

Features are words and word beginnings of five to seven letters, lower-cased,
hashed into ``BUCKETS``; those that toxic texts hold significantly more often
(G-test) are kept, at most ``FEATURES``.  A feature enters as presence and as
root of its share of the words, so that chance hits in a long clean text weigh little.

Training takes at most ``ROWS`` labelled ids, the lowest id hashes first, each
with one text (the least by hash), and fits on the driver.  Prediction covers all rows.

Defined cases: a null text or one without words has probabilities 0.0 and is
not toxic; so is every text if the sample lacks either class; null ids stay
null; a label other than 0 or 1, or on a null id, is ignored, of several labels of an id
the largest counts; repeated rows get equal results; an empty table gives an
empty result.  Only the named columns are read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.flat import map_texts, mix, ragged
from martflow.llm.lang_crf import Words, letter_tables
from martflow.llm.staging import fits_broadcast

CHAIN = ("repeated", "dense", "toxic")
THRESHOLD = 0.5
#: Bounds of training: labelled rows, features; buckets of the feature hash.
ROWS = 8000
FEATURES = 1024
BUCKETS = 1 << 20
#: Least G statistic of a feature, folds, steps of a fit, its rate and decay.
SIGNIFICANT = 24.0
FOLDS = 4
STEPS = 300
RATE = 0.1
DECAY = 1e-4
PREFIXES = (5, 6, 7)


class Chain(NamedTuple):
    """Kept buckets in order, and for each category its weights: presence, share, chain and bias."""

    buckets: np.ndarray
    weights: list


def text_features(texts: list, tables) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) of every feature of every text, sorted, and the words of each text."""
    words = Words(texts, tables)
    n = words.ends - words.starts
    number, key = [np.arange(len(n))], [words.hash]
    for k in PREFIXES:
        long = np.flatnonzero(n > k)
        number.append(long)
        key.append(mix(words.block.hashes(words.starts[long], words.starts[long] + k) + np.uint64(k)))
    number, key = np.concatenate(number), np.concatenate(key)
    order = np.argsort(number, kind="stable")
    bucket, many = (key[order] >> np.uint64(44)).astype(np.int64), np.bincount(number, minlength=len(n))
    first = np.cumsum(many) - many
    total = np.bincount(words.text, minlength=len(texts))
    # distinct (text, word) pairs first, then their few features
    pair, times = np.unique(words.text * np.int64(len(n) + 1) + words.number, return_counts=True)
    text, word = pair // (len(n) + 1), pair % (len(n) + 1)
    own = bucket[ragged(first[word], many[word])]
    text, times = np.repeat(text, many[word]), np.repeat(times, many[word])
    both, back = np.unique(text * np.int64(BUCKETS) + own, return_inverse=True)
    count = np.bincount(back, weights=times, minlength=len(both)).astype(np.int64)
    return both // BUCKETS, both % BUCKETS, count, total


def training_rows(docs: DataFrame, labels: DataFrame, doc: str, text: str, label: str) -> list:
    """At most ``ROWS`` rows (toxic, words, buckets, counts), one of each id, by id hash."""
    y = labels.filter(F.col(doc).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(doc).alias("y_id")).agg(F.max(label).alias("y"))
    share = min(1.0, 1.2 * (ROWS + 50) / max(y.count(), 1))
    y = y.withColumn("h", F.pmod(F.xxhash64("y_id"), F.lit(2 ** 32))).filter(F.col("h") < F.lit(int(share * 2 ** 32)))
    y = F.broadcast(y) if fits_broadcast(y, 48) else y
    rows = docs.select(F.col(doc).alias("d"), F.col(text).cast("string").alias("t")).join(y, F.col("d") == F.col("y_id")).select("d", "t", "y", "h")
    # copies of an id are one row before any feature is made
    rows = rows.groupBy("d", "y", "h").agg(F.min(F.struct(F.col("t").isNull(), F.xxhash64("t"), "t"))["t"].alias("t"))
    fields = [T.StructField("n", T.LongType()), T.StructField("buckets", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))]

    def make():
        tables = letter_tables()

        def work(texts):
            t, bucket, count, total = text_features(texts, tables)
            at = np.searchsorted(t, np.arange(len(texts) + 1))
            lists = lambda x: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, pa.int32()))
            return [pa.array(total, pa.int64()), lists(bucket), lists(count)]

        return work

    got = map_texts(rows, make, fields, "t", ["d", "y", "h"]).orderBy("h", "d").limit(ROWS).toArrow()
    order = np.lexsort((got["d"].to_numpy(), got["h"].to_numpy()))
    columns = got.select(["y", "n", "buckets", "counts"]).take(pa.array(order)).combine_chunks()
    y, n = columns["y"].to_numpy(), columns["n"].to_numpy()
    b, c = columns["buckets"].combine_chunks(), columns["counts"].combine_chunks()
    if isinstance(b, pa.ChunkedArray):
        b, c = pa.concat_arrays(b.chunks), pa.concat_arrays(c.chunks)
    many = np.diff(b.offsets.to_numpy())
    return [y.astype(np.int64), n, np.repeat(np.arange(len(y)), many), b.flatten().to_numpy().astype(np.int64), c.flatten().to_numpy()]


def _significant(y: np.ndarray, row: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Buckets that toxic rows hold significantly more often, in order."""
    yes, no = np.bincount(bucket[y[row] == 1], minlength=BUCKETS), np.bincount(bucket[y[row] == 0], minlength=BUCKETS)
    pos, neg = int((y == 1).sum()), int((y == 0).sum())
    part = lambda x, e: np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(e, 1e-9)), 0.0)
    share = (yes + no) / (pos + neg)
    g = 2 * (part(yes, share * pos) + part(no, share * neg) + part(pos - yes, (1 - share) * pos) + part(neg - no, (1 - share) * neg))
    g[yes * neg <= no * pos] = 0
    best = np.argsort(-g, kind="stable")[:FEATURES]
    return np.sort(best[g[best] >= SIGNIFICANT])


class _Rows:
    """Sparse rows: for each (row, feature) its presence and the root of its share, and the rows' totals over all features."""

    def __init__(self, size: int, words: np.ndarray, row: np.ndarray, feature: np.ndarray, count: np.ndarray, features: int):
        self.size, self.row, self.features = size, row, features
        share = 5 * np.sqrt(count / np.maximum(words[row], 1))
        self.at = np.concatenate((feature, features + feature))
        self.value = np.concatenate((np.ones(len(row)), share))
        self.two = np.concatenate((row, row))
        hits = np.bincount(row, weights=count, minlength=size)
        self.hits, self.share = hits, hits / np.maximum(words, 1)
        self.dense = np.stack((np.log1p(hits), 5 * np.sqrt(self.share), np.ones(size)), 1)

    def score(self, w: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Linear score: sparse part, totals and bias, then the earlier categories."""
        k = 2 * self.features
        out = np.bincount(self.two, weights=self.value * w[self.at], minlength=self.size)
        return out + self.dense @ w[k:k + 3] + (before @ w[k + 3:] if before.shape[1] else 0)

    def slope(self, miss: np.ndarray, before: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.at, weights=self.value * miss[self.two], minlength=2 * self.features)
        return np.concatenate((sparse, self.dense.T @ miss, before.T @ miss))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit(rows: _Rows, y: np.ndarray, before: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Logistic regression over the rows ``use``, by Adam on the full batch."""
    w = np.zeros(2 * rows.features + 3 + before.shape[1])
    m, v, n = np.zeros_like(w), np.zeros_like(w), max(use.sum(), 1)
    for t in range(1, STEPS + 1):
        miss = np.where(use, _sigmoid(rows.score(w, before)) - y, 0.0) / n
        g = rows.slope(miss, before) + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def fit(y: np.ndarray, words: np.ndarray, row: np.ndarray, bucket: np.ndarray, count: np.ndarray) -> Chain | None:
    """The chain fitted to labelled rows; None if either class is missing or nothing tells them apart."""
    if not (y == 1).any() or not (y == 0).any():
        return None
    kept = _significant(y, row, bucket)
    if not len(kept):
        return None
    place = np.searchsorted(kept, bucket)
    there = (place < len(kept)) & (kept[np.minimum(place, len(kept) - 1)] == bucket)
    rows = _Rows(len(y), words, row[there], place[there], count[there], len(kept))
    marked = (y == 1) & (rows.hits > 0)
    middle = lambda x: np.median(x[marked]) if marked.any() else np.inf
    target = {"repeated": marked & (rows.hits >= middle(rows.hits)), "dense": marked & (rows.share >= middle(rows.share)), "toxic": y == 1}
    fold = np.arange(len(y)) % FOLDS
    before, weights = np.zeros((len(y), 0)), []
    for name in CHAIN:
        goal, out = target[name].astype(float), np.zeros(len(y))
        for k in range(FOLDS if name != CHAIN[-1] else 0):
            w = _fit(rows, goal, before, fold != k)
            out[fold == k] = _sigmoid(rows.score(w, before))[fold == k]
        weights.append(_fit(rows, goal, before, np.ones(len(y), bool)))
        before = np.concatenate((before, out[:, None]), 1)
    return Chain(kept, weights)


def probabilities(chain: Chain, texts: list, tables) -> np.ndarray:
    """A column of probabilities for each category of the chain."""
    t, bucket, count, words = text_features(texts, tables)
    place = np.searchsorted(chain.buckets, bucket)
    there = (place < len(chain.buckets)) & (chain.buckets[np.minimum(place, len(chain.buckets) - 1)] == bucket)
    rows = _Rows(len(texts), words, t[there], place[there], count[there], len(chain.buckets))
    before = np.zeros((len(texts), 0))
    for w in chain.weights:
        before = np.concatenate((before, np.where(words > 0, _sigmoid(rows.score(w, before)), 0.0)[:, None]), 1)
    return before


def train(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic") -> Chain | None:
    return fit(*training_rows(docs, labels, doc, text, label))


def toxicity(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """doc_id, toxic and the probability of each category for every row of ``docs``."""
    chain = train(docs, labels, doc, text, label)
    fields = [T.StructField("toxic", T.BooleanType())] + [T.StructField(f"p_{c}", T.DoubleType()) for c in CHAIN]

    def make():
        tables = letter_tables()

        def work(texts):
            p = probabilities(chain, texts, tables) if chain else np.zeros((len(texts), len(CHAIN)))
            return [pa.array(p[:, -1] >= THRESHOLD)] + [pa.array(p[:, i]) for i in range(len(CHAIN))]

        return work

    return map_texts(docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("t")), make, fields, "t", ["doc_id"])
