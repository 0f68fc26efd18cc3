"""Language identification by a linear-chain conditional random field.

The field labels every word of a line, so text that switches between languages
gets a label for each word; a document's language is the one with the largest
mean probability over its words.  A word's score for a language is the sum of
learned weights of its features: prefixes and suffixes up to four
letters, letter n-grams up to three, and its place in a lexicon of words
frequent in the training sample.  Transition weights are learned with them.
Forward-backward runs over all lines of a block at once, a step for each place
in the line, and gives exact marginals.

Training takes a bounded sample: at most ``DOCS_PER_LANG`` windows of
``WINDOW`` words and ``WINDOW_CHARS`` characters for each language, one of each id, picked by a hash of the id.
The field is fitted in one task, not on the driver, to sequences cut from these windows; half of
them join pieces of several windows, so that transitions see switches.

Words are runs of letters, lower-cased.  Defined cases: a null text, or one
without a letter, is ``und`` with score 0.0; so is every text if there is
nothing to learn from; rows with a null id are not learned from and not held
out; equal probabilities go to the first language by code point; repeated rows
get equal results; an empty table gives an empty result.  Only the named
columns are read, lang only in training.
"""

from __future__ import annotations

import pickle
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.flat import Block, map_texts, ragged, runs
from martflow.llm.staging import ship_package

#: Bounds of the training sample (windows a language, words and characters of a window) and of the lexicon.
DOCS_PER_LANG = 1500
WINDOW = 64
WINDOW_CHARS = 4096
LEXICON = 8192
#: Words whose features are worked out at a time, windows whose words are.
WORDS, WINDOWS = 1 << 13, 512
#: Feature buckets, passes over the sequences, sequences in a step, words in a sequence.
BUCKETS = 1 << 16
EPOCHS = 4
BATCH = 512
SEQUENCE = 32
RATE = 0.2
DECAY = 1e-6
UNKNOWN = "und"


class Field(NamedTuple):
    """A fitted field: languages, weights by feature bucket, lexicon hashes and weights, transition and start weights."""

    langs: list
    weights: np.ndarray
    words: np.ndarray
    lexicon: np.ndarray
    moves: np.ndarray
    first: np.ndarray


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """Whether a code point is a letter, and its lower-case form, for the first 65,536."""
    letter, lower = np.zeros(1 << 16, bool), np.arange(1 << 16, dtype=np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        letter[i] = c.isalpha()
        if len(c.lower()) == 1:
            lower[i] = ord(c.lower())
    return letter, lower


class Words:
    """The words of a block, each as the number of a distinct word, and the lines they form."""

    def __init__(self, texts: list, tables):
        letter, lower = tables
        block = self.block = Block(texts)
        low = np.minimum(block.cp, 0xFFFF)
        inside = letter[low]
        astral = np.flatnonzero(block.cp > 0xFFFF)
        if len(astral):
            points, back = np.unique(block.cp[astral], return_inverse=True)
            inside[astral] = np.array([chr(p).isalpha() for p in points])[back]
        block.rehash(np.where(block.cp > 0xFFFF, block.cp, lower[low]))
        starts, ends = runs(inside)
        self.text = block.owner(starts)
        self.hash, at, self.number = np.unique(block.hashes(starts, ends), return_index=True, return_inverse=True)
        self.starts, self.ends = starts[at], ends[at]
        line = np.cumsum(block.cp == 10)[starts] if len(starts) else starts
        edge = np.concatenate(([0], np.flatnonzero(line[1:] != line[:-1]) + 1)) if len(line) else np.zeros(0, np.int64)
        self.line_starts = edge
        self.line_lengths = np.diff(np.concatenate((edge, [len(line)])))

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Feature buckets of the distinct words, laid end to end, and how many each has; worked out for some words at a time."""
        parts = [self._features(slice(low, low + WORDS)) for low in range(0, len(self.starts), WORDS)] or [self._features(slice(0, 0))]
        return np.concatenate([b for b, _ in parts]), np.concatenate([n for _, n in parts])

    def _features(self, which: slice) -> tuple[np.ndarray, np.ndarray]:
        s, e = self.starts[which], self.ends[which]
        n, spans = e - s, []
        for k in (1, 2, 3):
            many = np.maximum(n - k + 1, 0)
            at = ragged(s, many)
            spans.append((np.repeat(np.arange(len(s)), many), at, at + k, k))
        for k in (1, 2, 3, 4):
            long = np.flatnonzero(n >= k)
            spans.append((long, s[long], s[long] + k, 4 + k))
            spans.append((long, e[long] - k, e[long], 8 + k))
        word = np.concatenate([x[0] for x in spans])
        salt = np.concatenate([np.full(len(x[0]), x[3], np.uint64) for x in spans])
        h = self.block.hashes(np.concatenate([x[1] for x in spans]), np.concatenate([x[2] for x in spans]))
        bucket = ((h ^ (salt * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(40)) & np.uint64(BUCKETS - 1)
        order = np.argsort(word, kind="stable")
        return bucket[order].astype(np.int64), np.bincount(word, minlength=len(s))


def _sums(rows: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sum of each run of ``count`` rows."""
    total = np.zeros((len(rows) + 1, rows.shape[1]))
    np.cumsum(rows, axis=0, out=total[1:])
    ends = np.cumsum(count)
    return total[ends] - total[ends - count]


def marginals(score: np.ndarray, starts: np.ndarray, lengths: np.ndarray, moves: np.ndarray, first: np.ndarray, pairs: bool = False):
    """Probability of each label at each place, by forward-backward over all sequences at once.

    With ``pairs`` also the expected number of each transition and of each first label.
    """
    emit = np.exp(score - score.max(1, keepdims=True))
    step, begin = np.exp(moves), np.exp(first)
    order = np.argsort(-lengths, kind="stable")
    s, n = starts[order], lengths[order]
    most = int(n[0]) if len(n) else 0
    active = np.searchsorted(-n, -np.arange(most), "left")
    ahead, back = np.empty_like(emit), np.ones_like(emit)
    a = emit[s] * begin
    ahead[s] = a = a / a.sum(1, keepdims=True)
    for t in range(1, most):
        at = s[:active[t]] + t
        a = (a[:active[t]] @ step) * emit[at]
        a /= a.sum(1, keepdims=True)
        ahead[at] = a
    for t in range(most - 2, -1, -1):
        at = s[:active[t + 1]] + t
        b = (emit[at + 1] * back[at + 1]) @ step.T
        back[at] = b / b.sum(1, keepdims=True)
    both = ahead * back
    both /= both.sum(1, keepdims=True)
    if not pairs:
        return both
    inner = np.ones(len(score), bool)
    inner[starts + lengths - 1] = False
    at = np.flatnonzero(inner)
    joint = ahead[at][:, :, None] * step * (emit[at + 1] * back[at + 1])[:, None, :]
    joint /= joint.sum((1, 2), keepdims=True)
    return both, joint.sum(0), both[starts].sum(0)


def _sampled_words(texts: list):
    """Each word's text and number, the distinct words' hashes, feature buckets and how many each has, and the lines' starts and lengths.

    As from :class:`Words` of all texts, but for ``WINDOWS`` texts at a time, so that no array holds all characters.
    """
    tables, owner, words, starts, lengths, buckets, counts, hashes, before = letter_tables(), [], [], [], [], [], [], [], 0
    for low in range(0, len(texts), WINDOWS):
        some = Words(texts[low:low + WINDOWS], tables)
        bucket, many = some.features()
        owner.append(some.text + low)
        words.append(some.hash[some.number])
        starts.append(some.line_starts + before)
        lengths.append(some.line_lengths)
        new = ~np.isin(some.hash, np.concatenate(hashes)) if hashes else np.ones(len(some.hash), bool)
        hashes.append(some.hash[new])
        buckets.append(bucket[np.repeat(new, many)])
        counts.append(many[new])
        before += len(some.number)
    word, many, bucket = np.concatenate(hashes), np.concatenate(counts), np.concatenate(buckets)
    order, begin = np.argsort(word), np.cumsum(many) - many
    bucket = bucket[ragged(begin[order], many[order])]
    word, many = word[order], many[order]
    return (np.concatenate(owner), word, np.searchsorted(word, np.concatenate(words)), bucket, many, np.concatenate(starts), np.concatenate(lengths))


def fit(sample: list[tuple[str, str]]) -> Field:
    """The field fitted to (language, window of text) pairs; the same pairs in the same order give the same field."""
    langs = sorted({lang for lang, _ in sample})
    size, draw = len(langs), np.random.default_rng(7)
    owner, word, number, bucket, many, at, n = _sampled_words([text.replace("\n", " ") for _, text in sample])
    label = np.array([langs.index(lang) for lang, _ in sample], np.int64)[owner]
    count = np.bincount(number, minlength=len(word))
    known = np.sort(np.argsort(-count, kind="stable")[:LEXICON])
    known = known[count[known] >= 3]
    place = np.full(len(word), -1)
    place[known] = np.arange(len(known))
    where = np.cumsum(many) - many

    # sequences of word places: whole cuts of a window, then as many that join two to four cuts
    seqs = [np.arange(a + i, min(a + i + SEQUENCE, a + k)) for a, k in zip(at, n) for i in range(0, k, SEQUENCE)]
    whole = len(seqs)
    for _ in range(whole):
        parts = []
        for _ in range(int(draw.integers(2, 5))):
            cut = seqs[int(draw.integers(whole))]
            k = int(draw.integers(2, 12))
            i = int(draw.integers(max(len(cut) - k, 0) + 1))
            parts.append(cut[i:i + k])
        seqs.append(np.concatenate(parts))

    weights, lexicon = np.zeros((BUCKETS, size)), np.zeros((len(known) + 1, size))
    moves, first = np.zeros((size, size)), np.zeros(size)
    grown = [np.full_like(x, 1e-2) for x in (weights, lexicon, moves, first)]
    for _ in range(EPOCHS):
        order = draw.permutation(len(seqs))
        for low in range(0, len(order), BATCH):
            batch = [seqs[i] for i in order[low:low + BATCH]]
            k = np.array([len(x) for x in batch])
            token = np.concatenate(batch)
            used, back = np.unique(number[token], return_inverse=True)
            own = bucket[ragged(where[used], many[used])]
            score = (_sums(weights[own], many[used]) + lexicon[place[used]])[back]
            starts = np.cumsum(k) - k
            p, joint, begin = marginals(score, starts, k, moves, first, pairs=True)
            y = label[token]
            miss = -p
            miss[np.arange(len(y)), y] += 1
            inner = np.ones(len(y), bool)
            inner[starts + k - 1] = False
            i = np.flatnonzero(inner)
            seen = np.zeros((size, size))
            np.add.at(seen, (y[i], y[i + 1]), 1)
            by_word = np.stack([np.bincount(back, weights=miss[:, j], minlength=len(used)) for j in range(size)], 1)
            spread = np.repeat(by_word, many[used], axis=0)
            up = [np.stack([np.bincount(own, weights=spread[:, j], minlength=BUCKETS) for j in range(size)], 1) / len(batch),
                  np.zeros_like(lexicon), (seen - joint) / len(batch), (np.bincount(y[starts], minlength=size) - begin) / len(batch)]
            there = place[used] >= 0
            up[1][place[used][there]] = by_word[there] / len(batch)
            for x, g, s in zip((weights, lexicon, moves, first), up, grown):
                g -= DECAY * x
                s += g * g
                x += RATE * g / np.sqrt(s)
            lexicon[-1] = 0  # the place of words outside the lexicon
    order = np.argsort(word[known])
    lexicon = np.vstack([lexicon[:-1][order], lexicon[-1:]])
    return Field(langs, weights.astype(np.float32), word[known][order], lexicon, moves, first)


def label_words(field: Field, texts: list, tables) -> tuple[Words, np.ndarray]:
    """The words of the texts and each one's probability of each language."""
    words = Words(texts, tables)
    if not len(words.number):
        return words, np.zeros((0, len(field.langs)))
    bucket, many = words.features()
    score = _sums(field.weights[bucket], many)
    at = np.minimum(np.searchsorted(field.words, words.hash), max(len(field.words) - 1, 0))
    known = field.words[at] == words.hash if len(field.words) else np.zeros(len(words.hash), bool)
    score += field.lexicon[np.where(known, at, -1)]
    return words, marginals(score[words.number], words.line_starts, words.line_lengths, field.moves, field.first)


def held_out(doc: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc.cast("string")) % 3 == 1, F.lit(False))


def _picked(docs: DataFrame, doc: str, text: str, lang: str) -> DataFrame | None:
    """(l, h, d, t): language, id hash, id and window of the training sample, or None if there is nothing to learn from."""
    rows = docs.select(F.col(doc).alias("d"), F.col(lang).cast("string").alias("l"), F.col(text).cast("string").alias("t"))
    rows = rows.filter(F.col("d").isNotNull() & F.col("l").isNotNull() & F.col("t").isNotNull() & ~held_out(F.col("d")))
    share = {r["l"]: min(1.0, 1.2 * (DOCS_PER_LANG + 50) / r["n"]) for r in rows.groupBy("l").agg(F.greatest(F.approx_count_distinct("d", 0.02), F.lit(1)).alias("n")).collect()}
    if not share:
        return None
    most = F.element_at(F.create_map(*[x for l, p in share.items() for x in (F.lit(l), F.lit(int(p * 2 ** 32)))]), F.col("l"))
    h = F.pmod(F.xxhash64("d"), F.lit(2 ** 32))
    words = F.split(F.trim("t"), r"[\x20\x09-\x0D]+")
    picked = rows.withColumn("h", h).filter(F.col("h") < most).withColumn("w", words)
    start = F.pmod(F.xxhash64("h"), F.greatest(F.size("w") - F.lit(WINDOW - 1), F.lit(1))) + 1
    window = F.substring(F.array_join(F.slice("w", start.cast("int"), WINDOW), " "), 1, WINDOW_CHARS)
    picked = picked.select("l", "h", "d", window.alias("t")).groupBy("l", "h", "d").agg(F.min("t").alias("t"))
    place = F.row_number().over(Window.partitionBy("l").orderBy("h", F.col("d").cast("string")))
    return picked.withColumn("place", place).filter(F.col("place") <= DOCS_PER_LANG).drop("place")


def _in_order(rows: list) -> list[tuple[str, str]]:
    return [(r["l"], r["t"]) for r in sorted(rows, key=lambda r: (r["l"], r["h"], str(r["d"]))) if any(map(str.isalpha, r["t"]))]


def training_sample(docs: DataFrame, doc: str, text: str, lang: str) -> list[tuple[str, str]]:
    """(language, window): at most ``DOCS_PER_LANG`` windows of each language, one of each id, the lowest id hashes first."""
    picked = _picked(docs, doc, text, lang)
    return _in_order(picked.collect()) if picked is not None else []


def train(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang") -> Field | None:
    """The field fitted to :func:`training_sample`, in the one task that the bounded sample goes to; the driver gets the field alone."""
    picked = _picked(docs, doc, text, lang)
    if picked is None:
        return None
    ship_package(docs.sparkSession)

    def run(batches):
        sample = _in_order([row for batch in batches for row in batch.to_pylist()])
        if sample:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(sample))], pa.binary())], ["field"])

    found = picked.coalesce(1).mapInArrow(run, "field binary").collect()
    return pickle.loads(found[0]["field"]) if found else None


def predict(docs: DataFrame, field: Field | None, text: str, keep: list[str], prefix: str = "") -> DataFrame:
    """``keep`` and lang_pred, score and sure (after ``prefix``) of every row.

    ``score`` is the best language's share of the text, ``sure`` the mean over the words of each one's largest probability.
    """
    fields = [T.StructField(f"{prefix}lang_pred", T.StringType()), T.StructField(f"{prefix}score", T.DoubleType()), T.StructField(f"{prefix}sure", T.DoubleType())]

    def make():
        tables = letter_tables()

        def work(texts):
            if field is None:
                return [pa.array([UNKNOWN] * len(texts)), pa.array(np.zeros(len(texts))), pa.array(np.zeros(len(texts)))]
            words, p = label_words(field, texts, tables)
            n = np.bincount(words.text, minlength=len(texts))
            total = np.stack([np.bincount(words.text, weights=p[:, j], minlength=len(texts)) for j in range(len(field.langs))], 1)
            mean = total / np.maximum(n, 1)[:, None]
            best = mean.argmax(1)
            sure = np.bincount(words.text, minlength=len(texts), weights=p.max(1)) / np.maximum(n, 1)
            return [pa.array([field.langs[b] if k else UNKNOWN for b, k in zip(best, n)], pa.string()),
                    pa.array(np.clip(mean[np.arange(len(best)), best], 0, 1)), pa.array(np.clip(sure, 0, 1))]

        return work

    return map_texts(docs, make, fields, text, keep)


def identify(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``."""
    out = predict(docs, train(docs, doc, text, lang), text, [doc])
    return out.select(F.col(doc).alias("doc_id"), held_out(F.col(doc)).alias("held_out"), "lang_pred", "score")
