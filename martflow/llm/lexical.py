"""Ranked lexical search: an inverted index in segments, searched by block-max MaxScore.

1. Terms are runs of ASCII letters, digits and all characters above U+007F, with A-Z lower-cased.
2. :func:`index` reads the documents once.  A task turns the texts that it streams into segments of up to
   ``SEGMENT_DOCS`` documents or ``SEGMENT_TERMS`` postings, one row for each (segment, term): the postings in blocks of ``BLOCK``, as bytes
   (gaps of document numbers and counts, seven bits a byte), and what bounds a block's scores, open to be read: its last document, the largest
   count and the least ratio of length to count.  No document and no term crosses a shuffle whole.
3. Lengths and document frequencies are sums over the rows of all segments (:func:`statistics`).
4. :func:`search` takes the lists of the terms asked for, and a task goes through its segments (:class:`Search`):
   the block bounds give a global bound for each list, and an item's lists are taken by falling bound.
   Lists are essential, and add candidates, as long as their bounds and those after them sum to the least score
   that counts (the heap's 50th so far, or the 50th partial sum).  A candidate then stays while its sum and the maxima of the blocks that it
   falls into, in all lists to come, reach that score; only blocks that hold a live candidate are decompressed.
5. A task keeps one heap for each item across its segments; the heaps of all tasks are merged by a window.

Scores are 64-bit integers and exact; bounds are rounded up, and equal scores are never pruned, so the result is that of scoring everything.

Defined cases: a null or empty text has no terms and counts for nothing; an item without terms, or without a document that shares one, has no rows; rows of one
item id are one item with all their terms; each document row is ranked by itself, also with an equal id; a null id is
last among equal scores, items of null id are one item; empty tables give no rows.  A long text is one document of
its segment and never cut.  Only the named columns are read.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.flat import ragged
from martflow.llm.staging import ship_package, staged

TOP = 50
BLOCK = 64
SEGMENT_DOCS = 1 << 14
SEGMENT_TERMS = 1 << 20
#: Bytes of item ids and terms that one pass sends to the tasks; more items take more passes.
ITEM_BYTES = 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of UTF-8 that belong to terms, A-Z lower-cased; all others become spaces.
BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

INDEX = T.StructType([
    T.StructField("segment", T.LongType()), T.StructField("term", T.BinaryType()), T.StructField("df", T.LongType()),
    T.StructField("last", T.ArrayType(T.IntegerType())), T.StructField("most", T.ArrayType(T.LongType())),
    T.StructField("ratio", T.ArrayType(T.DoubleType())), T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("postings", T.BinaryType()),
    T.StructField("docs", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType()))])


def terms(text: bytes | None) -> list[bytes]:
    """All terms of a text in UTF-8, with repeats."""
    return (text or b"").translate(BYTES).split()


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits, the last byte of each marked by its eighth; and how many bytes each takes."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    rest = values >> np.uint64(7)
    while rest.any():
        size += rest > 0
        rest >>= np.uint64(7)
    place = ragged(np.zeros(len(values), np.int64), size)
    out = ((np.repeat(values, size) >> (np.uint64(7) * place.astype(np.uint64))) & np.uint64(127)).astype(np.uint8)
    out[np.cumsum(size) - 1] |= 128
    return out, size


def unpacked(data: np.ndarray) -> np.ndarray:
    """The numbers that :func:`packed` made into ``data``."""
    ends = np.flatnonzero(data >= 128)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    place = ragged(np.zeros(len(ends), np.int64), ends - starts + 1).astype(np.uint64)
    return np.add.reduceat((data & 127).astype(np.uint64) << (np.uint64(7) * place), starts).astype(np.int64) if len(ends) else np.zeros(0, np.int64)


class Segment:
    """Documents on their way into an index."""

    def __init__(self):
        self.ids, self.lengths, self.names = [], [], {}
        self.of, self.times, self.distinct = array("q"), array("q"), array("q")

    def add(self, doc: int | None, text: bytes | None) -> None:
        found = terms(text)
        if found:
            count = Counter(found)
            names = self.names
            self.of.extend(array("q", [names.setdefault(t, len(names)) for t in count]))
            self.times.extend(array("q", count.values()))
            self.distinct.append(len(count))
            self.ids.append(doc)
            self.lengths.append(len(found))

    def full(self) -> bool:
        return len(self.ids) >= SEGMENT_DOCS or len(self.of) >= SEGMENT_TERMS

    def rows(self, segment: int) -> Iterator[pa.RecordBatch]:
        """The rows of INDEX: one with the documents (term null), then one for each term."""
        schema = pa.schema([(f.name, {"long": pa.int64(), "binary": pa.binary()}.get(f.dataType.simpleString().replace("bigint", "long"),
                             pa.list_({"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}[f.dataType.elementType.simpleString()])
                             if isinstance(f.dataType, T.ArrayType) else None)) for f in INDEX])
        if not self.ids:
            return
        yield pa.RecordBatch.from_pylist([{"segment": segment, "docs": self.ids, "lengths": self.lengths}], schema)
        of, times = np.array(self.of), np.array(self.times)
        doc = np.repeat(np.arange(len(self.ids)), np.array(self.distinct))
        order = np.argsort(of, kind="stable")  # by term, then document
        of, times, doc = of[order], times[order], doc[order]
        df = np.bincount(of, minlength=len(self.names))
        first = np.cumsum(df) - df
        place = np.arange(len(of)) - first[of]
        begin = np.flatnonzero(place % BLOCK == 0)  # of the blocks
        gap = np.diff(doc, prepend=0)
        gap[begin] = doc[begin]
        data, size = packed(np.stack([gap, times], 1).ravel())
        used = np.cumsum(size)[1::2]  # bytes up to and with each posting
        end = np.append(begin[1:], len(of))
        per_term = np.bincount(of[begin], minlength=len(df))  # blocks
        stop, last = used[end - 1], doc[end - 1]
        most, ratio = np.maximum.reduceat(times, begin), np.minimum.reduceat(np.array(self.lengths)[doc] / times, begin)
        cut = np.concatenate(([0], np.cumsum(per_term)))
        byte = np.concatenate(([0], used[first + df - 1]))
        at = stop - np.repeat(byte[:-1], per_term)  # block ends within the term's bytes
        listed = lambda x, kind: pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x, kind))
        bytes_ = pa.Array.from_buffers(pa.binary(), len(df), [None, pa.py_buffer(byte.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
        batch = pa.RecordBatch.from_arrays([
            pa.array(np.full(len(df), segment)), pa.array(list(self.names), pa.binary()), pa.array(df, pa.int64()), listed(last, pa.int32()),
            listed(most, pa.int64()), listed(ratio, pa.float64()), listed(at, pa.int32()), bytes_,
            pa.nulls(len(df), pa.list_(pa.int64())), pa.nulls(len(df), pa.list_(pa.int64()))], schema=schema)
        for low in range(0, len(df), 4096):
            yield batch.slice(low, 4096)


def index(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of ``docs`` as a staged table of :data:`INDEX` rows."""
    ship_package(docs.sparkSession)
    source = docs.select(docs[f"`{doc}`"].cast("long").alias("doc"), docs[f"`{text}`"].cast("string").cast("binary").alias("t"))

    def run(batches):
        from pyspark import TaskContext

        number, open_ = TaskContext.get().partitionId() << 32, Segment()
        for batch in batches:
            for doc_id, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                open_.add(doc_id, t.as_py())
                if open_.full():
                    yield from open_.rows(number)
                    number, open_ = number + 1, Segment()
        yield from open_.rows(number)

    return staged(source.mapInArrow(run, INDEX), "index")


def statistics(indexed: DataFrame) -> tuple[int, int]:
    """(documents with a term, terms with repeats) of the whole index."""
    got = indexed.filter("term IS NULL").agg(
        F.sum(F.size("docs")).alias("n"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("l")).first()
    return got["n"] or 0, got["l"] or 0


def asked_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term): the distinct terms of each item."""
    low = F.translate(items[f"`{text}`"].cast("string"), UPPER, LOWER)
    found = F.regexp_extract_all(low, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))
    return items.select(items[f"`{item}`"].alias("item"), F.explode(found.cast("array<binary>")).alias("term")).distinct()


class Search:
    """The items of a pass, searched segment by segment; their heaps stay between segments."""

    def __init__(self, items: list[list[tuple[bytes, int]]], n: int, length: int, top: int):
        self.items, self.n, self.length, self.top = items, n, length, top
        self.heaps = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in items]  # scores, ids, whether the id is null

    def norm(self, lengths: np.ndarray) -> np.ndarray:
        """Each document's m."""
        if len(lengths) and int(lengths.max()) * 50 * self.n >= 1 << 63:
            return np.array([50 + 50 * int(x) * self.n // self.length for x in lengths], np.int64)
        return 50 + 50 * lengths * self.n // self.length

    def bounds(self, most: np.ndarray, ratio: np.ndarray) -> np.ndarray:
        """What no posting of a block exceeds, before its weight: m is more than 49 + 50 * n * N / L, so m / tf is at least this."""
        least = 49 / most + 50 * self.n / self.length * ratio * (1 - 1e-12)
        return (1e9 / (1000 + 20 * least)).astype(np.int64) + 2

    def segment(self, ids: np.ndarray, none: np.ndarray, lengths: np.ndarray, lists: dict) -> None:
        """Search one segment.  ``lists``: term -> (last, most, ratio, at, bytes)."""
        m = self.norm(lengths)
        bounds = {t: self.bounds(x[1], x[2]) for t, x in lists.items()}
        whole: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}

        def blocks(term: bytes, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Documents and unweighted scores of the chosen blocks of a list; lists decompressed whole are kept for other items."""
            if term in whole:
                return whole[term]
            last, _, _, at, data = lists[term]
            begin = np.concatenate(([0], at[:-1]))
            some = len(chosen) < len(at)
            sizes = (at - begin)[chosen]
            flat = unpacked(data[ragged(begin[chosen], sizes)] if some else data)
            gap, times = flat[0::2], flat[1::2]
            # a block begins with a whole document number: take off what the blocks before it sum to
            held = np.add.reduceat((data[ragged(begin[chosen], sizes)] if some else data) >= 128, np.cumsum(sizes) - sizes) // 2
            start = np.cumsum(held) - held
            total = np.cumsum(gap)
            doc = total - np.repeat(total[start] - gap[start], held)
            got = doc, 1_000_000_000 * times // (1000 * times + 20 * m[doc])
            if not some:
                whole[term] = got
            return got

        total = np.zeros(len(ids), np.int64)
        for k, asked in enumerate(self.items):
            mine = sorted(((w * int(bounds[t].max()), w, t) for t, w in asked if t in lists and w > 0), reverse=True)
            if not mine:
                continue
            rest = np.cumsum([b for b, _, _ in mine][::-1])[::-1]  # of each list and all after it
            scores, _, _ = self.heaps[k]
            least = int(scores[-1]) if len(scores) == self.top else 1
            total[:] = 0
            i = 0
            while i < len(mine) and rest[i] >= least:  # essential
                _, w, t = mine[i]
                doc, s = blocks(t, np.arange(len(lists[t][3])))
                total[doc] += w * s
                i += 1
                # a new least score costs a pass over the sums: before every long list, and after some short ones
                if len(ids) > self.top and i < len(mine) and (i % 4 == 0 or 16 * BLOCK * len(lists[mine[i][2]][0]) > len(ids)):
                    least = max(least, int(np.partition(total, -self.top)[-self.top]))
            live = np.flatnonzero(total)
            if i < len(mine) and len(live):
                # the maxima of the blocks that each candidate falls into, summed from the last list to the next one
                limit = np.zeros((len(mine) - i + 1, len(live)), np.int64)
                for j in range(len(mine) - 1, i - 1, -1):
                    _, w, t = mine[j]
                    at = np.searchsorted(lists[t][0], live)
                    limit[j - i] = limit[j - i + 1] + np.append(w * bounds[t], 0)[at]
                for j in range(i, len(mine)):
                    stays = total[live] + limit[j - i] >= least
                    live, limit = live[stays], limit[:, stays]
                    if not len(live):
                        break
                    _, w, t = mine[j]
                    chosen = np.unique(np.searchsorted(lists[t][0], live))
                    chosen = chosen[chosen < len(lists[t][0])]
                    if len(chosen):
                        doc, s = blocks(t, chosen)
                        total[doc] += w * s  # other documents of these blocks are out of the race
                    if len(live) > self.top:
                        least = max(least, int(np.partition(total[live], -self.top)[-self.top]))
            live = live[total[live] >= least]
            self.push(k, total[live], ids[live], none[live])

    def push(self, k: int, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        scores, ids, none = (np.concatenate(x) for x in zip(self.heaps[k], (scores, ids, none)))
        best = np.lexsort((ids, none, -scores))[:self.top]
        self.heaps[k] = scores[best], ids[best], none[best]


def _searched(items: list[list[tuple[bytes, int]]], n: int, length: int, top: int):
    """For mapInArrow over index rows sorted by segment: (i, doc_id, score) of the best documents of each item in this task."""

    def run(batches):
        search, now, lists, docs = Search(items, n, length, top), None, {}, None
        arr = lambda x: x.values.to_numpy()

        def done():
            if docs is not None:
                ids, lengths = docs
                search.segment(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), lengths.to_numpy(), lists)

        for batch in batches:
            segment, term = batch.column("segment").to_pylist(), batch.column("term").to_pylist()
            for r in range(batch.num_rows):
                if segment[r] != now:
                    done()
                    now, lists, docs = segment[r], {}, None
                x = lambda c: batch.column(c)[r]  # noqa: E731, B023
                if term[r] is None:
                    docs = x("docs").values, x("lengths").values
                else:
                    lists[term[r]] = (*(arr(x(c)).copy() for c in ("last", "most", "ratio", "at")), np.frombuffer(x("postings").as_py(), np.uint8))
        done()
        for k, (scores, ids, none) in enumerate(search.heaps):
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), k)), pa.array(ids, mask=none), pa.array(scores)], ["i", "doc_id", "score"])

    return run


def search(indexed: DataFrame, asked: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` best documents of each item of ``asked`` (item, term)."""
    spark = indexed.sparkSession
    ship_package(spark)
    n, length = statistics(indexed)
    wanted = asked.select("term").distinct()
    df = indexed.join(wanted, "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n) + 2) / (2 * F.col("df") + 1)))
    weighed = asked.join(df, "term").select("item", "term", weight.cast("long").alias("w"))
    weighed = staged(weighed.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("term", "w"))).alias("terms")), "items")
    size = weighed.agg(F.sum(F.aggregate("terms", F.lit(64).cast("long"), lambda a, t: a + F.octet_length(t["term"]) + 16)).alias("b")).first()["b"] or 0
    passes = -(-size // item_bytes)
    out = None
    for p in range(passes):
        some = weighed.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == p) if passes > 1 else weighed
        got = some.collect()  # of bounded size
        if not got:
            continue
        names = {t["term"] for r in got for t in r["terms"]}
        lists = indexed.join(F.broadcast(spark.createDataFrame([(bytes(t),) for t in names], "term binary")), "term", "left_semi")
        rows = indexed.filter("term IS NULL").unionByName(lists).repartition("segment").sortWithinPartitions("segment")
        items = [[(bytes(t["term"]), t["w"]) for t in r["terms"]] for r in got]
        best = rows.mapInArrow(_searched(items, n, length, top), "i long, doc_id long, score long")
        ids = spark.createDataFrame([(k, r["item"]) for k, r in enumerate(got)], T.StructType([T.StructField("i", T.LongType()), T.StructField("item_id", asked.schema["item"].dataType)]))
        found = best.join(F.broadcast(ids), "i").drop("i")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = weighed.select(F.col("item").alias("item_id"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).filter("false")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` best documents of each item, over a new index of ``docs``."""
    return search(index(docs), asked_terms(items), top)


#: The same by scoring every document that shares a term.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS t
  FROM documents
), docs AS (SELECT r, doc_id, len(t) AS n, t FROM d WHERE len(t) > 0),
total AS (SELECT count(*) AS n, sum(n)::BIGINT AS l FROM docs),
postings AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(t) AS term FROM docs) GROUP BY r, term),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(total.n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, total GROUP BY term),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark
), scores AS (
  SELECT i.item_id, p.r, any_value(p.doc_id) AS doc_id,
         sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (50 + (50 * p.n * total.n) // total.l))))::BIGINT AS score
  FROM items i JOIN postings p USING (term) JOIN weights w USING (term), total GROUP BY i.item_id, p.r
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""
