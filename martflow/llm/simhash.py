"""SimHash near-duplicates by pigeonring filtering of 64-bit fingerprints.

1. A text's fingerprint has a bit set if over half of its shingle hashes (XXH64, seed 42) have it set.  Rows of equal
   fingerprint are one row below, so copies never meet.
2. The 64 bits lie on a ring of ``SEGMENTS`` segments.  If two fingerprints differ in at most ``LIMIT`` bits, then from some segment
   on every chain of l consecutive segments differs in at most l * LIMIT / SEGMENTS bits (the pigeonring principle): in
   0, 1, 2, 3 and 4 bits for chains of one to five.  So a pair agrees in a whole segment and, but for one bit, in the
   next.  A fingerprint is listed under each such pair of segments with one bit of the second masked
   out, 64 entries, and two that may link meet in a list.
3. Lists of one go.  The pairs of a list pass the longer chains, each of which prunes, and then the full check.
   A list gives each member's link to the least member that it reaches there, not all its pairs.
4. Lists of over ``LIST`` members are not paired: their members are listed under every 64-bit value within half of ``LIMIT``
   bits (2,081).  Two fingerprints link exactly if they meet in such a list, all members of it are linked, and it holds no more than 2,081, so
   a dense group costs rows in proportion to its members.  No link is lost on either way, for any ``LIST``.
5. Links are contracted to components, and a component has the least id of its rows.

Defined cases: a null text, or one without words, has fingerprint zero, which links like any other; a text of fewer words than a
shingle is one shingle; repeated rows, also of equal ids, are all returned; a null id takes part in linking, and component_id is
the least other id (null if there is none); an empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.flat import ragged
from martflow.llm.near_dup import components
from martflow.llm.staging import ship_package, staged

LIMIT = 4
SEGMENTS = 5
#: Members up to which a list is paired; pairs and shingles that are compared at a time.
LIST = 512
PAIRS = 1 << 20
SHINGLES = 1 << 16
SEED = 42


def fingerprint(text: bytes | None, words: int) -> int:
    """The fingerprint of one text in UTF-8, as an unsigned number."""
    # bytes.lower() and bytes.split() know ASCII alone: A-Z, and U+0009 to U+000D and U+0020
    joined = b" ".join((text or b"").lower().split())
    if not joined:
        return 0
    space = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = [0, *(space + 1).tolist()], [*space.tolist(), len(joined)]
    if len(ends) >= words:
        starts, ends = starts[:len(starts) - words + 1], ends[words - 1:]
    else:
        starts, ends = [0], [len(joined)]
    of, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for low in range(0, len(starts), SHINGLES):
        h = np.array([of(joined[a:b], SEED) for a, b in zip(starts[low:low + SHINGLES], ends[low:low + SHINGLES])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc: str, text: str, words: int) -> DataFrame:
    """(doc, fp) of every row; ``fp`` is the fingerprint as a signed number."""
    ship_package(docs.sparkSession)
    source = docs.select(docs[f"`{doc}`"].alias("doc"), docs[f"`{text}`"].cast("string").cast("binary").alias("t"))

    def run(batches):
        for batch in batches:
            fp = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc", "fp"])

    return source.mapInArrow(run, T.StructType([T.StructField("doc", source.schema["doc"].dataType), T.StructField("fp", T.LongType())]))


def ring(segments: int = SEGMENTS) -> list[int]:
    """The bit masks of the ring's segments, the longer ones first."""
    out, low = [], 0
    for i in range(segments):
        wide = 64 // segments + (i < 64 % segments)
        out.append(((1 << wide) - 1) << low)
        low += wide
    return out


def chains(limit: int = LIMIT, segments: int = SEGMENTS) -> list[list[tuple[int, int]]]:
    """From each segment on, the chains of one segment to all: their bits, and how many of them may differ."""
    own, out = ring(segments), []
    for i in range(segments):
        bits, one = 0, []
        for n in range(segments):
            bits |= own[(i + n) % segments]
            one.append((bits, (n + 1) * limit // segments))
        out.append(one)
    return out


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def list_masks() -> list[tuple[int, int]]:
    """(start of the chain, mask of its first two segments but for one bit of the second)."""
    own = ring()
    pairs = [(i, own[i], own[(i + 1) % SEGMENTS]) for i in range(SEGMENTS)]
    return [(i, one | (two & ~(1 << b))) for i, one, two in pairs for b in range(64) if two >> b & 1]


def _entries(prints: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    """(m, v, fp): the lists that each fingerprint is in."""
    each = F.posexplode(F.array(*[F.lit(signed(m)) for _, m in masks])).alias("m", "mask")
    return prints.select("fp", each).select("m", F.col("fp").bitwiseAND(F.col("mask")).alias("v"), "fp")


def linked(masks: list[tuple[int, int]]):
    """For mapInArrow over (m, members): (a, b) of each member b of a list and the least member a that it reaches."""
    budgets = chains()
    bit = [np.uint64(budgets[i][1][0] & ~m) for i, m in masks]  # the masked bit
    first = [k == 0 or masks[k - 1][0] != masks[k][0] for k in range(len(masks))]

    def within(lists: list[np.ndarray], m: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links between members of lists under one mask."""
        flat = np.concatenate(lists)
        n = np.array([len(x) for x in lists])
        end = np.repeat(np.cumsum(n), n)
        at = np.arange(len(flat))
        later = end - at - 1
        cut = np.flatnonzero(np.diff(np.cumsum(later) // PAIRS, prepend=0, append=-1))
        steps = np.unique(np.concatenate(([0], cut, [len(flat)])))
        for low, high in zip(steps[:-1], steps[1:]):
            a, b = np.repeat(at[low:high], later[low:high]), ragged(at[low:high] + 1, later[low:high])
            apart = flat[a] ^ flat[b]
            # a pair that agrees in the masked bit too is in all lists of this chain: the first mask's list takes it
            live = np.ones(len(apart), bool) if first[m] else (apart & bit[m]) != 0
            for bits, most in budgets[masks[m][0]][1:]:
                live[live] = np.bitwise_count(apart[live] & np.uint64(bits)) <= most
            yield a[live], b[live]

    def run(batches):
        for batch in batches:
            masks_, members = batch.column(0).to_numpy(), batch.column(1)
            flat = members.flatten().to_numpy().view(np.uint64)
            size = np.diff(members.offsets.to_numpy())
            begin = np.cumsum(size) - size
            lo, hi = [], []
            for m in np.unique(masks_):
                mine = np.flatnonzero(masks_ == m)
                lists = [np.sort(flat[begin[i]:begin[i] + size[i]]) for i in mine]
                values = np.concatenate(lists)
                a, b = (np.concatenate(x) for x in zip(*within(lists, int(m))))
                root = np.arange(len(values))
                while len(a):  # the least member that each reaches
                    least = root.copy()
                    np.minimum.at(least, a, root[b])
                    np.minimum.at(least, b, root[a])
                    least = least[least]
                    if (least == root).all():
                        break
                    root = least
                moved = np.flatnonzero(root != np.arange(len(values)))
                lo.append(values[root[moved]])
                hi.append(values[moved])
            if lo:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (lo, hi)], ["a", "b"])

    return run


def links(prints: DataFrame, most: int = LIST) -> DataFrame:
    """(a, b): links that join all distinct fingerprints ``fp`` which a chain of links of up to ``LIMIT`` bits joins."""
    ship_package(prints.sparkSession)
    masks = list_masks()
    sizes = _entries(prints, masks).groupBy("m", "v").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    # by key at every size: a broadcast of the shared lists would grow with the input
    shared = staged(_entries(prints, masks).join(staged(sizes, "sizes").hint("merge"), ["m", "v"]), "shared")
    short = shared.filter(F.col("held") <= most).groupBy("m", "v").agg(F.collect_list("fp").alias("members")).select("m", "members")
    near = short.mapInArrow(linked(masks), "a long, b long")
    dense = shared.filter(F.col("held") > most).select("fp").distinct()
    flips = [0, *(1 << i for i in range(64)), *(1 << i | 1 << j for i in range(64) for j in range(i))]
    around = dense.select("fp", F.explode(F.expr(f"array({', '.join(f'{signed(x) + 1}L - 1L' for x in flips)})")).alias("x")).select(F.col("fp").bitwiseXOR(F.col("x")).alias("z"), "fp")
    balls = around.groupBy("z").agg(F.array_sort(F.collect_list("fp")).alias("all")).filter("size(all) > 1")
    met = balls.select(F.col("all")[0].alias("a"), F.explode(F.slice("all", 2, len(flips))).alias("b"))
    return near.unionByName(met)


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", words: int = 4, most: int = LIST) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``."""
    rows = staged(fingerprints(docs, doc, text, words), "prints")
    prints = staged(rows.groupBy("fp").agg(F.min("doc").alias("first")), "distinct")
    found = components(links(prints.select("fp"), most))
    named = prints.join(found.withColumnRenamed("sig", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("prints"))
    joined = named.join(least.filter("prints > 1"), "label", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    return rows.join(joined, "fp").select(F.col("doc").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
