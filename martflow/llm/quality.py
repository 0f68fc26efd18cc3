"""Quality rules: hashed n-gram log-likelihood ratio of trusted against raw text.

Tokens are runs of letters and digits and runs of other marks; their single
and paired hashes fall into ``BUCKETS`` counters.  One pass over all texts
counts the raw multinomial and, over the rows marked trusted, the target
multinomial.  A second pass gives each text the mean over its n-grams of
``log p_target - log p_raw``.  A text passes if that mean reaches the
threshold, a number given by the caller or learned once from all marked rows
(:func:`learn_threshold`).  No draw is involved: equal texts get equal results.

Defined cases: a null or empty text has no words and no n-grams, scores 0.0
and fails the base rules; without trusted rows every ratio is 0.0 and the
learned threshold is minus infinity, so the base rules alone decide; rows
that repeat are counted and judged one by one; null ids stay null; an empty
table gives an empty result.  Only the named columns are read, so further
columns of any name do no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.flat import Block, blocks, map_texts, mix
from martflow.llm.staging import fits_broadcast, ship_package, staged

BUCKETS = 1 << 16
SMOOTHING = 1.0
#: Share of the trusted rows that a learned threshold has to keep.
KEEP_TRUSTED = 0.995
#: Base rules: least words, and most repeated words in a hundred.
LEAST_WORDS = 20
MOST_REPEATED = 30
WINDOW = 8
#: Scores are compared in steps of this size, here and in the threshold.
STEP = 0.001

_SYMBOLS = np.frombuffer("#*$%&|<>".encode("utf-32-le"), np.uint32)


def _classes() -> np.ndarray:
    """0 space, 1 letter or digit, 2 other, for the first 65,536 code points."""
    out = np.full(1 << 16, 2, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        out[i] = 0 if c.isspace() else 1 if c.isalnum() else 2
    return out


def ngram_buckets(block: Block, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every single token and every pair of neighbours."""
    kind = classes[np.minimum(block.cp, 0xFFFF)]
    kind[block.cp > 0xFFFF] = 1
    edge = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(kind)]))
    starts, ends = edge[:-1], edge[1:]
    real = kind[starts] != 0
    starts, ends = starts[real], ends[real]
    h, own = block.hashes(starts, ends), block.owner(starts)
    pair = own[1:] == own[:-1]
    two = mix(h[:-1] * np.uint64(3) + h[1:])[pair]
    return (np.concatenate((h, two)) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate((own, own[1:][pair]))


def base_rules(block: Block) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    n = block.texts
    ws, we = block.words()
    own = block.owner(ws)
    count = np.bincount(own, minlength=n)
    chars = np.bincount(own, weights=we - ws, minlength=n).astype(np.int64)
    marks = np.flatnonzero(np.isin(block.cp, _SYMBOLS))
    symbols = np.bincount(block.owner(marks), minlength=n)

    ls, le = block.lines()
    worded = np.searchsorted(ws, le) > np.searchsorted(ws, ls)
    ls, le = ls[worded], le[worded]
    lown = block.owner(ls)
    key = mix(block.hashes(ls, le) + mix(lown.astype(np.uint64)))
    _, first = np.unique(key, return_index=True)
    again = np.bincount(lown, minlength=n) - np.bincount(lown[first], minlength=n)

    repeated = np.zeros(n, np.int64)
    if len(ws) >= WINDOW:
        whole = own[WINDOW - 1:] == own[:len(own) - WINDOW + 1]
        at = np.flatnonzero(whole)
        h = block.hashes(ws, we)
        acc = np.zeros(len(at), np.uint64)
        for i in range(WINDOW):
            acc = mix(acc + h[at + i])
        acc = mix(acc + mix(own[at].astype(np.uint64)))
        _, back, times = np.unique(acc, return_inverse=True, return_counts=True)
        hit = at[times[back] > 1]
        step = np.zeros(len(ws) + 1, np.int64)
        step[hit] += 1
        step[hit + WINDOW] -= 1
        covered = np.cumsum(step[:-1]) > 0
        repeated = np.bincount(own[covered], minlength=n)
    return {"n_words": count, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": again, "n_repeat_words": repeated}


def count_ngrams(docs: DataFrame, text: str, trusted: str) -> DataFrame:
    """(bucket, raw, target): n-gram counts over all rows and over the rows whose ``trusted`` is true."""
    source = docs.select(F.col(text).cast("string").alias("t"), F.coalesce(F.col(trusted), F.lit(False)).alias("x"))

    def run(batches):
        classes, raw, target = _classes(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            marked = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b, texts in blocks(batch.column(0)):
                bucket, own = ngram_buckets(Block(texts), classes)
                raw += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[marked[a:b].astype(bool)[own]], minlength=BUCKETS)
        at = np.flatnonzero(raw)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])

    ship_package(docs.sparkSession)
    return (source.mapInArrow(run, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """log p_target - log p_raw of every bucket; ``counts`` has at most ``BUCKETS`` rows."""
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    got = counts.toPandas()
    raw[got["bucket"]], target[got["bucket"]] = got["raw"], got["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    share = lambda c: np.log(c + SMOOTHING) - np.log(c.sum() + SMOOTHING * BUCKETS)
    return share(target) - share(raw)


def score_texts(docs: DataFrame, ratios: np.ndarray, text: str, keep: list[str]) -> DataFrame:
    """``keep``, the base counts and the length-normalised score of every row."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = [T.StructField(x, T.LongType()) for x in names] + [T.StructField("score", T.DoubleType())]

    def make():
        classes = _classes()

        def work(texts):
            block = Block(texts)
            base = base_rules(block)
            bucket, own = ngram_buckets(block, classes)
            n = np.bincount(own, minlength=len(texts))
            total = np.bincount(own, weights=ratios[bucket], minlength=len(texts))
            mean = np.round(total / np.maximum(n, 1) / STEP) * STEP
            return [pa.array(base[x].astype(np.int64)) for x in names] + [pa.array(mean)]

        return work

    return map_texts(docs, make, fields, text, keep)


def learn_threshold(scored: DataFrame, label: str) -> float:
    """Where trusted (1) and rejected (0) rows part best, among the thresholds that keep ``KEEP_TRUSTED`` of the trusted rows.

    Uses the score histogram of all labelled rows, in bins of ``STEP``.
    """
    rows = (scored.filter(F.col(label).isin(0, 1)).groupBy(F.round(F.col("score") / STEP).cast("long").alias("bin"))
            .agg(F.sum((F.col(label) == 1).cast("long")).alias("good"), F.sum((F.col(label) == 0).cast("long")).alias("bad"))
            .orderBy("bin").collect())
    good, bad = sum(r["good"] for r in rows), sum(r["bad"] for r in rows)
    best, at, lost, caught = 0.0, float("-inf"), 0, 0
    for low, high in zip(rows, rows[1:]):
        lost, caught = lost + low["good"], caught + low["bad"]
        if good and bad and lost <= (1 - KEEP_TRUSTED) * good and (gain := caught / bad - lost / good) > best:
            best, at = gain, (low["bin"] + high["bin"]) / 2 * STEP
    return at


def with_labels(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", label: str = "quality") -> DataFrame:
    """(id, text, label) of every row of ``docs``; null where ``labels`` has none.  Of several labels of an id the smallest counts."""
    y = labels.filter(F.col(doc).isNotNull()).groupBy(F.col(doc).alias("y_id")).agg(F.min(label).alias("label"))
    y = F.broadcast(y) if fits_broadcast(y, 32) else y
    return docs.select(F.col(doc).alias("doc_id"), "text").join(y, F.col("doc_id") == F.col("y_id"), "left").drop("y_id")


def quality(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """doc_id, the five base counts, score, base_failed and kept of every row of ``docs`` (doc_id, text).

    Trusted rows are those with ``labels.quality`` 1.
    """
    rows = with_labels(docs, labels)
    ratios = log_ratios(count_ngrams(rows.withColumn("trusted", F.col("label") == 1), "text", "trusted"))
    scored = staged(score_texts(rows, ratios, "text", ["doc_id", "label"]), "quality")
    at = learn_threshold(scored, "label") if threshold is None else threshold
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (scored.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(at))).drop("label"))
