"""MinHash near-duplicates from bottom-k sketches of one hash function.

1. Each text becomes the set of hashes of its word shingles.  Texts with equal
   sets form a class, named by a 128-bit digest of the set; everything below
   works on classes, so copies never meet in pairs.
2. A class keeps its ``k`` smallest hashes.  Two sets of the wanted similarity
   share at least ``least`` kept values (:func:`least_shared`) but for a chance of at most 1e-9 at the limit of
   similarity, and exactly if the sets are no larger than ``k``.  So only the
   ``kept - least + 1`` rarest kept values of a class need inverted lists: two
   such sets meet in one of them.
3. Lists of up to ``SHORT`` members generate their pairs.  A longer list goes to the group of one of its members, the one of
   most lists, so that the lists of a common text are one group.  A group's sets are written as differences from a reference, the
   shingles that most of some members hold (:func:`references`); two sets differ in what their differences differ in, whatever the reference is.
   Members without a common difference are similar only if both are close to the reference, and then both are similar to the closest member:
   one comparison each finds these (:func:`measured`).  Others meet in lists of their rarest differences
   (:func:`difference_lists`), where the group's common text is gone.  So a group of m copies or of m pages of one
   template yields about m pair rows, not m * m / 2.  Difference lists that stay long are compared in blocks, which return links alone.
4. A pair's overlap within the k smallest values of the united sketches
   estimates its similarity; pairs under ``least`` go, on every way (:func:`estimated`).  Intersection and union
   of the full sets, or of the differences, verify the rest.  The ways depend on the lists alone, not on the size of the input.
5. Verified links are contracted to components by repeated minimum labels.

Defined cases: a null text, or one without words, has an empty set and links
with nothing; with fewer words than a shingle the whole sequence is the one
shingle; repeated rows, also with equal ids, are copies of one class; a null
id takes part in linking, its row has component_id of its component's smallest
non-null id (null if there is none) and is kept only if that is null too; an
empty table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.flat import Block, map_texts, mix
from martflow.llm.staging import BROADCAST_BYTES, fits_broadcast, staged
from martflow.operators.joins import has_at_most

#: Values that a sketch keeps, and the chance that a pair at the limit shares fewer of the united sketch's k values than it has to.
SKETCH = 48
CHANCE = 1e-9
#: Members of a group that make its reference.
SAMPLE = 9
#: Members up to which a list is paired by a join; members of a block; shingles compared at a time.
SHORT = 8
BLOCK = 1024
COLUMNS = 4096


def least_shared(percent: int, k: int) -> int:
    """How many of k values a pair has to share: as many as one at the limit has but for ``CHANCE`` (binomial)."""
    p, least, under = percent / 100, 0, 0.0
    while least < k and (under := under + math.comb(k, least) * p ** least * (1 - p) ** (k - least)) <= CHANCE:
        least += 1
    return max(least, 1)


def shingle_sets(texts: list, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z lower-cased."""
    block = Block(texts)
    cp = block.cp.copy()
    cp[(cp >= 65) & (cp <= 90)] += 32
    block.rehash(cp)
    ws, we = block.words()
    n = np.bincount(block.owner(ws), minlength=block.texts)
    ends = np.cumsum(n)
    h = block.hashes(ws, we)
    acc = mix(h)
    for i in range(1, words):
        acc[:len(h) - i] = mix(acc[:len(h) - i] + h[i:])
    out = []
    for a, b in zip(ends - n, ends):
        if b - a >= words:
            out.append(np.unique(acc[a:b - words + 1]))
        elif b > a:
            x = mix(h[a:a + 1])
            for i in range(a + 1, b):
                x = mix(x + h[i:i + 1])
            out.append(mix(x + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, keep: list[str], text: str, words: int, k: int) -> DataFrame:
    """(*keep, sig, n_shingles, sketch): class digest (null for an empty set), set size, k smallest hashes."""
    fields = [T.StructField("sig", T.BinaryType()), T.StructField("n_shingles", T.LongType()),
              T.StructField("sketch", T.ArrayType(T.LongType()))]

    def make():
        def work(texts):
            sets = shingle_sets(texts, words)
            return [pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s[:k].view(np.int64) for s in sets], pa.list_(pa.int64()))]

        return work

    return map_texts(docs, make, fields, text, keep)


def full_sets(docs: DataFrame, text: str, words: int) -> DataFrame:
    """(sig, grams): the whole set of each row's class."""
    fields = [T.StructField("sig", T.BinaryType()), T.StructField("grams", T.ArrayType(T.LongType()))]

    def make():
        def work(texts):
            sets = shingle_sets(texts, words)
            return [pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]

        return work

    return map_texts(docs, make, fields, text, [])


def inverted_lists(classes: DataFrame, k: int, least: int, similarity: float) -> DataFrame:
    """(v, sig): the rarest kept values of each class, those that a second class keeps too."""
    entries = classes.select("sig", F.size("sketch").alias("kept"), F.explode("sketch").alias("v"))
    shared = entries.groupBy("v").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    hot = entries.join(shared, "v")
    # Values that no other class keeps are the rarest; they take a place in the prefix but need no list.
    need = F.when(F.col("kept") < k, F.least(F.ceil(F.lit(similarity) * F.col("kept") - F.lit(1e-9)), F.lit(min(k // 2, least))))
    prefix = (F.col("kept") - F.coalesce(need, F.lit(least)) + 1).cast("int")
    return (hot.groupBy("sig", "kept").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("own"))
            .withColumn("take", prefix - (F.col("kept") - F.size("own")))
            .filter("take > 0").select("sig", F.explode(F.slice("own", F.lit(1), F.col("take"))).alias("e"))
            .select("e.v", "sig"))


def estimated(pairs: DataFrame, classes: DataFrame, k: int, least: int, percent: int) -> DataFrame:
    """The pairs (a, b) that may be similar enough by their sizes and by the k smallest values of their united sketches."""
    side = lambda x: classes.select(F.col("sig").alias(x), F.col("sketch").alias(f"{x}s"), F.col("n_shingles").alias(f"{x}n"))
    return (pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
            .filter(100 * F.least("an", "bn") >= percent * F.greatest("an", "bn"))
            .withColumn("united", F.slice(F.array_sort(F.array_union("as", "bs")), 1, k))
            .withColumn("both", F.size(F.array_intersect(F.col("united"), F.array_intersect("as", "bs"))))
            .filter((F.col("both") >= least) | (F.size("united") < k)).select("a", "b"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    grams = lambda x: sets.select(F.col("sig").alias(x), F.col("grams").alias(f"{x}g"))
    # by key at every size: a broadcast of the pairs, or of the sets, would grow with the input
    return (pairs.join(grams("a").hint("merge"), "a").join(grams("b").hint("merge"), "b")
            .withColumn("both", F.size(F.array_intersect("ag", "bg")))
            .filter(100 * F.col("both") >= percent * (F.size("ag") + F.size("bg") - F.col("both"))).select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """(sig, label) of every class with a link: the label is one of its component's classes."""
    edges, labels = staged(links.distinct(), "links"), None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("up")), "parents")
        jump = up.select(F.col("a").alias("up"), F.col("up").alias("top"))
        up = staged(up.join(jump, "up", "left").select("a", F.coalesce("top", "up").alias("up")), "parents")
        moved = lambda df, x: df.join(up.select(F.col("a").alias(x), "up"), x, "left").withColumn(x, F.coalesce("up", x)).drop("up")
        labels = up.select(F.col("a").alias("sig"), F.col("up").alias("label")) if labels is None else moved(labels, "label")
        labels = staged(labels, "labels")
        edges = staged(moved(moved(edges, "a"), "b").filter("a <> b").select("a", "b").distinct(), "links")
    return labels if labels is not None else links.select(F.col("a").alias("sig"), F.col("b").alias("label"))


def _unlinked(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Lists with members of two components or more, with (label, held) for members in the list."""
    named = lists.join(labels, "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    sizes = (named.groupBy("v", "label").agg(F.count(F.lit(1)).alias("m"))
             .groupBy("v").agg(F.count(F.lit(1)).alias("parts"), F.sum("m").alias("held")).filter("parts > 1").select("v", "held"))
    return staged(named.join(staged(sizes, "open"), "v"), "lists")


def references(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(b, grams): for each group b the shingles that most of ``SAMPLE`` of its members (a, b) hold."""
    some = Window.partitionBy("b").orderBy(F.xxhash64("a"), "a")
    some = members.withColumn("nth", F.row_number().over(some)).filter(F.col("nth") <= SAMPLE)
    held = some.join(sets.select(F.col("sig").alias("a"), "grams").hint("merge"), "a").select("b", F.explode("grams").alias("e"))
    of = some.groupBy("b").agg(F.count(F.lit(1)).alias("of"))
    most = held.groupBy("b", "e").agg(F.count(F.lit(1)).alias("times")).join(of, "b").filter(2 * F.col("times") > F.col("of"))
    # no more than twice the shingles of a member
    return of.select("b").join(most.groupBy("b").agg(F.collect_list("e").alias("ref")), "b", "left") \
        .select("b", F.coalesce("ref", F.array().cast("array<bigint>")).alias("ref"))


def measured(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, z, near, n, apart): of each member a of a group b its size, its differences from the group's reference, the
    member z that is closest to it, and whether a and z are similar enough.

    With t = (100 - percent) / (100 + percent), x and y are similar if their differences X and Y differ in at most t * (|x| + |y|)
    shingles.  Without a common one that is (|X| - t * |x|) + (|Y| - t * |y|) <= 0; then the member of least |Z| - t * |z| is similar to both.
    """
    refs = staged(references(members, sets), "references")
    each = members.join(sets.select(F.col("sig").alias("a"), "grams").hint("merge"), "a").join(refs.hint("merge"), "b")
    each = each.select("a", "b", F.size("grams").alias("n"), F.concat(F.array_except("grams", "ref"), F.array_except("ref", "grams")).alias("apart"))
    each = staged(each, "apart")
    far = (100 + percent) * F.size("apart").cast("long") - (100 - percent) * F.col("n")
    closest = each.groupBy("b").agg(F.min_by(F.struct(F.col("a").alias("z"), F.col("n").alias("zn"), F.col("apart").alias("zapart")), F.struct(far, "a")).alias("c"))
    closest = closest.select("b", "c.*")
    both = each.join(staged(closest, "closest").hint("merge"), "b")
    off = F.size("apart") + F.size("zapart") - 2 * F.size(F.array_intersect("apart", "zapart"))
    total = F.col("n") + F.col("zn")
    return both.select("a", "b", "z", (100 * (total - off) >= percent * (total + off)).alias("near"), "n", "apart")


def difference_lists(group: DataFrame, percent: int) -> DataFrame:
    """(v, sig, b): inverted lists over the differences of a group's members from its reference.

    With X and Y the differences of similar x and y, they differ in at most (100 - percent) / percent of x's size.
    So Y holds all of X but so many, or, if X is that small, at least one of X unless they have none in common:
    x and y meet in one of the rarest so many and one of X.  What most members have in common is gone.
    """
    entries = group.select("a", "b", "n", F.size("apart").alias("all"), F.explode("apart").alias("e"))
    shared = entries.groupBy("b", "e").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    own = entries.join(shared, ["b", "e"]).groupBy("a", "b", "n", "all").agg(F.array_sort(F.collect_list(F.struct("df", "e"))).alias("own"))
    spare = F.floor((100 - percent) * F.col("n") / percent) + 1
    own = own.withColumn("take", (F.least(spare, "all") - (F.col("all") - F.size("own"))).cast("int")).filter("take > 0")
    return (own.select("a", "b", F.explode(F.slice("own", F.lit(1), F.col("take"))).alias("e"))
            .select(F.xxhash64("b", "e.e").alias("v"), F.col("a").alias("sig"), "b"))


def _block_links(percent: int):
    """Links between two blocks of a list's members (or within one), enough of them to join what they join."""

    def overlaps(left: list, right: list) -> np.ndarray:
        flat = np.concatenate(left + right)
        _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
        often = np.flatnonzero(times > 1)
        place = np.full(len(times), -1)
        place[often] = np.arange(len(often))
        row, code = row[place[code] >= 0], place[code][place[code] >= 0]
        order = np.argsort(code, kind="stable")
        row, code = row[order], code[order]
        out = np.zeros((len(left), len(right)), np.float32)
        for low in range(0, len(often), COLUMNS):
            a, b = np.searchsorted(code, (low, low + COLUMNS))
            held = np.zeros((len(left) + len(right), min(COLUMNS, len(often) - low)), np.float32)
            held[row[a:b], code[a:b] - low] = 1
            out += held[:len(left)] @ held[len(left):].T
        return out

    def links(group: pd.DataFrame) -> pd.DataFrame:
        one = group[group["block"] == group["i"]]
        two = one if group["i"].iat[0] == group["j"].iat[0] else group[group["block"] == group["j"]]
        pairs: list[tuple[bytes, bytes]] = []
        if len(one) and len(two):
            size = lambda g: (g["n"].to_numpy(), np.array([len(x) for x in g["apart"]]))
            (n1, d1), (n2, d2) = size(one), size(two)
            total = n1[:, None] + n2[None, :]
            apart = d1[:, None] + d2[None, :] - 2 * overlaps(list(one["apart"]), list(two["apart"])).astype(np.int64)
            near = 100 * (total - apart) >= percent * (total + apart)
            names = {x: i for i, x in enumerate(dict.fromkeys([*one["label"], *two["label"]]))}
            l1, l2 = (np.array([names[x] for x in g["label"]]) for g in (one, two))
            near &= l1[:, None] != l2[None, :]
            root = list(range(len(names)))

            def top(x):
                while root[x] != x:
                    root[x] = x = root[root[x]]
                return x

            s1, s2 = list(one["sig"]), list(two["sig"])
            for x, y in np.argwhere(near):
                p, q = top(l1[x]), top(l2[y])
                if p != q:
                    root[p] = q
                    pairs.append((s1[x], s2[y]))
        return pd.DataFrame({"a": [p for p, _ in pairs], "b": [q for _, q in pairs]}, columns=["a", "b"], dtype=object)

    return links


def difference_links(lists: DataFrame, group: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) between members of different components that share a difference list.

    Short lists pair their members by a join; long ones are cut into blocks, and blocks of a
    list meet in tasks that return links alone.
    """
    full = group.select(F.col("a").alias("sig"), "b", "n", "apart")
    rows = lists.join(full, ["sig", "b"]).select("v", "sig", "label", "held", "n", "apart")
    short = rows.filter(F.col("held") <= SHORT)
    side = lambda x: short.select(F.col("v"), *[F.col(c).alias(f"{x}_{c}") for c in ("sig", "label", "n", "apart")])
    pairs = side("a").join(side("b"), "v").filter((F.col("a_sig") < F.col("b_sig")) & (F.col("a_label") != F.col("b_label")))
    total = F.col("a_n") + F.col("b_n")
    apart = F.size("a_apart") + F.size("b_apart") - 2 * F.size(F.array_intersect("a_apart", "b_apart"))
    found = pairs.filter(100 * (total - apart) >= percent * (total + apart)).select(F.col("a_sig").alias("a"), F.col("b_sig").alias("b"))

    blocks = F.ceil(F.col("held") / BLOCK).cast("int")
    long = rows.filter(F.col("held") > SHORT).withColumn("block", F.pmod(F.xxhash64("sig"), blocks).cast("int"))
    long = long.withColumn("k", F.explode(F.sequence(F.lit(0), blocks - 1)))
    long = long.select("v", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"), "block", "sig", "label", "n", "apart")
    far = long.groupBy("v", "i", "j").applyInPandas(_block_links(percent), "a binary, b binary")
    return found.union(far)


def class_links(docs: DataFrame, doc: str, text: str, classes: DataFrame, words: int, percent: int, k: int, least: int) -> DataFrame | None:
    """(sig, label) of the linked classes, or None if no two classes are linked."""
    lists = inverted_lists(classes, k, least, percent / 100)
    lists = staged(lists.join(lists.groupBy("v").agg(F.count(F.lit(1)).alias("held")).filter("held > 1"), "v"), "entries")
    if lists.isEmpty():
        return None
    listed = staged(lists.select("sig").distinct(), "listed")
    some = classes.join(listed, "sig")
    wanted = some.select(F.col("doc").alias("w")).distinct()
    wanted = staged(wanted, "wanted")
    # ids alone, and only if they are measured to be few bytes: else both sides are dealt by id
    wanted = F.broadcast(wanted) if has_at_most(wanted, BROADCAST_BYTES // 16, BROADCAST_BYTES) else wanted
    there = docs.join(wanted, F.col(doc).eqNullSafe(F.col("w")), "left_semi")
    sets = staged(full_sets(there, text, words).join(listed, "sig", "left_semi").dropDuplicates(["sig"]), "sets")
    passing = lambda pairs: estimated(pairs, some, k, least, percent)
    short = lists.filter(F.col("held") <= SHORT).select("v", "sig")
    pairs = short.join(short.select("v", F.col("sig").alias("b")), "v").filter(F.col("sig") < F.col("b")).select(F.col("sig").alias("a"), "b").distinct()
    links = staged(verified(passing(pairs), sets, percent), "found")
    long = lists.filter(F.col("held") > SHORT).select("v", "sig")
    if not long.isEmpty():
        # the member of most lists is likely in all lists of a common text
        central = long.groupBy("sig").agg(F.count(F.lit(1)).alias("lists"))
        one = long.join(central, "sig").groupBy("v").agg(F.max(F.struct("lists", "sig"))["sig"].alias("b"))
        members = staged(long.join(one, "v").select(F.col("sig").alias("a"), "b").distinct(), "members")
        group = staged(measured(members, sets, percent), "measured")
        star = passing(group.filter("near AND a <> z").select("a", F.col("z").alias("b")).distinct())
        links = staged(links.union(star), "found")
        again = _unlinked(staged(difference_lists(group, percent), "entries"), components(links))
        if not again.isEmpty():
            links = links.union(staged(passing(difference_links(again, group, percent).distinct()), "found"))
    return None if links.isEmpty() else components(links)


def judged(docs: DataFrame, doc: str, text: str, words: int, percent: int, k: int, least: int | None) -> DataFrame:
    """(doc, tag, n_shingles, component, component_id) of every row.

    ``tag`` is a hash of the text, ``component`` one of the class digests of the row's component (null for an empty set).
    """
    least = least_shared(percent, k) if least is None else least
    tagged = docs.select(F.col(doc).alias("doc"), F.col(text).cast("string").alias("text"), F.xxhash64(F.col(text)).alias("tag"))
    rows = staged(sketches(tagged, ["doc", "tag"], "text", words, k), "sketches")
    classes = staged(rows.filter("sig IS NOT NULL").groupBy("sig").agg(
        F.min("doc").alias("doc"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "classes")
    labels = class_links(tagged, "doc", "text", classes, words, percent, k, least)
    named = classes.select("sig", "doc")
    if labels is None:
        named = named.select("sig", F.col("sig").alias("component"), F.col("doc").alias("component_id"))
    else:
        at = named.join(labels, "sig")
        moved = at.join(at.groupBy("label").agg(F.min("doc").alias("first")), "label").select("sig", "label", "first")
        named = named.join(moved, "sig", "left").select(
            "sig", F.coalesce("label", "sig").alias("component"),
            F.when(F.col("label").isNull(), F.col("doc")).otherwise(F.col("first")).alias("component_id"))
    return (rows.drop("sketch").join(named, "sig", "left")
            .withColumn("component_id", F.when(F.col("sig").isNull(), F.col("doc")).otherwise(F.col("component_id")))
            .select("doc", "tag", "n_shingles", "component", "component_id"))


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80,
                    k: int = SKETCH, least: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Links rows whose sets of ``words``-word shingles have ``100 * intersection >= percent * union``.
    """
    return judged(docs, doc, text, words, percent, k, least).select(
        F.col("doc").alias("doc_id"), "n_shingles", "component_id", F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, doc: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80,
                k: int = SKETCH, least: int | None = None) -> DataFrame:
    """``docs`` with one row of each component: of the smallest id (null last), then of the least text hash.  Rows without words all stay."""
    rows = staged(judged(docs, doc, text, words, percent, k, least).select("doc", "tag", "component"), "judged")
    rows = rows.filter("component IS NOT NULL").withColumn("own", F.struct(F.col("doc").isNull().alias("none"), "doc", "tag"))
    firsts = rows.groupBy("component").agg(F.min("own").alias("first"))
    rows = rows.join(firsts, "component").select("doc", "tag", F.col("own").eqNullSafe(F.col("first")).alias("stays"))
    # (id, text) pairs that go, and those that stay but occur more than once: usually none or few
    marks = rows.groupBy("doc", "tag").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("n")).filter("NOT stays OR n > 1")
    marks = staged(marks.select(F.col("doc").alias("_d"), F.col("tag").alias("_t"), "stays"), "marks")
    marks = F.broadcast(marks) if fits_broadcast(marks, 48) else marks
    columns = docs.columns
    wrapped = docs.select(F.struct(*[docs[f"`{c}`"] for c in columns]).alias("row"), F.col(doc).alias("d"), F.xxhash64(F.col(text)).alias("t"))
    wrapped = wrapped.join(marks, F.col("d").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t")), "left")
    once = wrapped.filter("stays").dropDuplicates(["d", "t"])
    return wrapped.filter("stays IS NULL").select("row.*").unionByName(once.select("row.*"))
