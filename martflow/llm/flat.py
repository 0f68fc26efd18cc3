"""Many texts as one array of code points, for numpy.

A batch of texts is laid out as one ``uint32`` array, texts parted by one
line feed.  Words, lines and n-grams are index ranges into it, and a range's
64-bit hash comes from prefix sums of a polynomial, so no Python code runs
per word.  Batches are cut so that a block holds about ``BLOCK_CHARS`` code
points; a longer text is a block of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from martflow.llm.staging import ship_package

BLOCK_CHARS = 1 << 20
_RADIX = 0x9E6C63D0876A9A47 | 1
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift-multiply rounds), in wrapping arithmetic."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse modulo 2**64, at least ``n`` of each."""
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, 2 * BLOCK_CHARS)
        back = pow(_RADIX, -1, 1 << 64)
        out = []
        for base in (_RADIX, back):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        _powers, _inverse = out
    return _powers, _inverse


class Block:
    """Texts of one block: code points, and where each text begins and ends."""

    def __init__(self, texts: list[str | None]):
        texts = [t or "" for t in texts]
        n = np.fromiter(map(len, texts), np.int64, len(texts))
        self.cp = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        self.begin = np.zeros(len(texts), np.int64)
        np.cumsum(n[:-1] + 1, out=self.begin[1:])
        self.end = self.begin + n
        self.texts = len(texts)
        self._prefix = None

    def rehash(self, cp: np.ndarray) -> None:
        """Take hashes over ``cp`` (say, a lower-cased copy) from now on."""
        self.cp, self._prefix = cp, None

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each range of code points."""
        if self._prefix is None:
            power, _ = _tables(len(self.cp))
            term = mix(self.cp.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
            term *= power[:len(term)]
            self._prefix = np.zeros(len(term) + 1, np.uint64)
            np.cumsum(term, out=self._prefix[1:])
        _, back = _tables(len(self.cp))
        h = self._prefix[ends] - self._prefix[starts]
        h *= back[starts]
        return mix(h + (ends - starts).astype(np.uint64))

    def owner(self, starts: np.ndarray) -> np.ndarray:
        """The text that holds each position."""
        return np.searchsorted(self.begin, starts, "right") - 1

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of characters other than U+0020 and U+0009 to U+000D."""
        cp = self.cp
        return runs(~((cp == 32) | ((cp >= 9) & (cp <= 13))))

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the line-feed-parted lines; every text has at least one."""
        ends = np.flatnonzero(self.cp == 10)
        starts = np.zeros(len(ends), np.int64)
        starts[1:] = ends[:-1] + 1
        return starts, ends


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    if len(inside) and inside[-1]:
        edge = np.concatenate((edge, [len(inside)]))
    return edge[0::2], edge[1::2]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(s, s + n)`` over the pairs."""
    total = int(lengths.sum())
    out = np.arange(total, dtype=np.int64)
    before = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=before[1:])
    return out + np.repeat(starts - before, lengths)


def blocks(column: pa.Array) -> Iterator[tuple[int, int, list]]:
    """(from, to, texts) of consecutive rows with about ``BLOCK_CHARS`` bytes each."""
    if not len(column):
        return
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    group = np.cumsum(size) // BLOCK_CHARS
    cut = np.concatenate(([0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(size)]))
    for a, b in zip(cut[:-1], cut[1:]):
        yield int(a), int(b), column.slice(int(a), int(b - a)).to_pylist()


def map_texts(df: DataFrame, make: Callable[[], Callable[[list], list[pa.Array]]], fields: list[T.StructField],
              text: str, keep: list[str], extra: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` and, after them, ``fields`` worked out from ``text`` block by block.

    ``make()`` runs once per task and gives a function from a block's texts
    (and the lists of the ``extra`` columns) to the arrays of ``fields``.
    """
    extra = extra or []
    ship_package(df.sparkSession)
    source = df.select(*[df[f"`{c}`"].alias(f"k{i}") for i, c in enumerate(keep)],
                       df[f"`{text}`"].cast("string").alias("t"),
                       *[df[f"`{c}`"].alias(f"x{i}") for i, c in enumerate(extra)])
    kept = [T.StructField(c, df.schema[c].dataType, True) for c in keep]
    n = len(keep)

    def run(batches):
        work = make()
        for batch in batches:
            column = batch.column(n)
            for a, b, texts in blocks(column):
                out = work(texts, *[batch.column(n + 1 + i).slice(a, b - a).to_pylist() for i in range(len(extra))])
                arrays = [batch.column(i).slice(a, b - a) for i in range(n)] + out
                yield pa.RecordBatch.from_arrays(arrays, [f.name for f in kept + fields])

    return source.mapInArrow(run, T.StructType(kept + fields))
