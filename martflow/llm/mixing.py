"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words: its weight's share of the wanted
total, at most ``cap`` times what it has, the excess going to the others by
weight.  Every document of a source then expects ``target / source size``
copies.  The expected copies are summed up along the source's documents, one
random offset is added, and a document is emitted once for each whole number
that its step crosses.  Documents lie in order of size (by its leading binary digits, within that by a digest of id and text),
so a source's words miss its target by less than its longest document has.  Of a few evenly spread turns of the offset the one is
used whose words come nearest the target: a source with a few very long documents stays near it too.

The running sum is not one window over a source, which may hold a third of
all rows: equal rows are counted first, and stand in the order one after another; distinct rows fall into
cells (source, size band, two hexadecimal digits of the digest), a window over the few cell counts of a source gives each cell's
place, a window inside the cell the row's.  Sources are ordered by windows over all of them, a row for each: they may be some millions.

Defined cases: a null or empty text has size 0 and may be emitted like any
other; a null source is a source of its own, ordered last; rows that repeat are sampled one by one, of any number; sources without
words have target 0; an empty table gives an empty result.  Input columns are
carried in one struct, so their names cannot clash with the operator's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martflow.llm.staging import fits_broadcast, staged

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating; wanted words for each word there is; most copies of a source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = "mix-1"
#: Offsets that are tried for a source.
DRAWS = 32
#: Most numbers of one sequence that spreads a row into its repeats.
STEP = 1 << 16

_CELL = ["skey", "octave", "lead", "digit"]


def _unit(text: Column) -> Column:
    """A number in [0, 1) from a digest."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


def with_cells(docs: DataFrame, doc: str, text: str, source: str) -> DataFrame:
    """``row`` (all input columns), size, source key and cell of every document."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                       F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.coalesce(F.concat(F.lit("a"), F.col(source).cast("string")), F.lit("b")).alias("skey"),
                       F.col(doc).alias("doc"), F.md5(F.concat(F.coalesce(F.col(doc).cast("string"), F.lit("")), F.lit(":"),
                                                      F.coalesce(F.col(text).cast("string"), F.lit("")))).alias("digest"))
    return rows.withColumns({"tag": F.xxhash64("row"), "octave": F.length(F.bin("size")), "lead": F.substring(F.bin("size"), 1, 3),
                             "digit": F.substring("digest", 1, 2)})


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(skey, source_size, target) from rows of (skey, size); a row for each source.

    Sources stop at their cap in order of cap for each weight.  With the first
    i of them stopped, the rest share what is left at a level for each weight;
    the right i is the first whose level stops no further source.
    """
    s = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy("skey")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", weight).withColumn("most", F.lit(cap) * F.col("source_size"))
    order = W.orderBy(F.col("most") / F.col("weight"), "skey")
    s = s.withColumns({
        "at": F.row_number().over(order),
        "stopped": F.coalesce(F.sum("most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
        "open": F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)),
        "total": F.sum("source_size").over(W.partitionBy())})
    s = s.withColumn("level", (F.lit(share) * F.col("total") - F.col("stopped")) / F.col("open"))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct("at", "level"))
    s = s.withColumn("level", F.min(fits).over(W.partitionBy())["level"])
    return s.select("skey", "source_size", F.coalesce(F.least(F.col("level") * F.col("weight"), "most"), "most").alias("target"))


def _copies(offset: Column, begin: Column, end: Column) -> Column:
    """Whole numbers that the running sum of expected copies crosses from one rank to another."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (F.floor(offset + end.cast("double") * rate) - F.floor(offset + begin.cast("double") * rate)).cast("long")


def offsets(placed: DataFrame, seed: str) -> DataFrame:
    """(skey, offset): of ``DRAWS`` evenly spread turns of a source's random offset, the one whose words come nearest its target.

    ``placed`` has equal rows as one, ``n`` of them behind the first ``begin`` of their source.
    """
    turns = [(F.col("unit") + F.lit(j / DRAWS)) - F.floor(F.col("unit") + F.lit(j / DRAWS)) for j in range(DRAWS)]
    rows = placed.withColumn("unit", _unit(F.concat(F.lit(seed), "skey")))
    words = [F.sum(_copies(t, F.col("begin"), F.col("begin") + F.col("n")) * F.col("size")) for t in turns]
    sums = rows.groupBy("skey", "unit", "target").agg(*[w.alias(f"w{j}") for j, w in enumerate(words)])
    tries = F.array(*[F.struct(F.abs(F.col(f"w{j}") - F.col("target")).alias("miss"), F.lit(j).alias("j"), t.alias("offset")) for j, t in enumerate(turns)])
    return sums.select("skey", F.array_min(tries)["offset"].alias("offset"))


def sampled(docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
            share: float = SHARE, cap: float = CAP, seed: str = SEED, carry: bool = True) -> DataFrame:
    """size, source_size, target and copies of every document, with its columns in ``row`` (its id alone without ``carry``)."""
    same = [*_CELL, "size", "doc", "digest", "tag"]
    rows = with_cells(docs, doc, text, source)
    kinds = staged(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n")), "kinds")
    cells = kinds.groupBy(*_CELL).agg(F.sum("n").alias("held"))
    along = W.partitionBy("skey").orderBy("octave", "lead", "digit").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("held").over(along), F.lit(0)))
    targets = source_targets(kinds.select("skey", (F.col("size") * F.col("n")).alias("size")), weights, share, cap)
    cells = staged(cells.join(targets, "skey").select(*_CELL, "before", "source_size", "target"), "cells")
    inside = W.partitionBy(*_CELL).orderBy("size", "doc", "digest", "tag").rowsBetween(W.unboundedPreceding, -1)
    placed = kinds.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(cells, _CELL)
    placed = staged(placed.select(*same, "n", "source_size", "target", (F.col("before") + F.col("inside")).alias("begin")), "placed")
    turn = staged(offsets(placed, seed), "offsets")
    turn = F.broadcast(turn) if fits_broadcast(turn, 256) else turn
    placed = placed.join(turn, "skey")
    if carry:
        texts = rows.dropDuplicates(same).select(*same, "row")
        null_safe = [texts[c].eqNullSafe(placed[c]) for c in same]
        on = null_safe[0]
        for c in null_safe[1:]:
            on &= c
        placed = texts.join(placed, on).select("row", texts["size"], "n", "source_size", "target", "begin", "offset")
    else:
        placed = placed.select(F.struct(F.col("doc").alias(doc)).alias("row"), "size", "n", "source_size", "target", "begin", "offset")
    some = placed.withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(STEP).cast("long"))))
    each = some.withColumn("at", F.explode(F.sequence(F.col("low") + 1, F.least(F.col("n"), F.col("low") + STEP))))
    each = each.withColumn("rank", F.col("begin") + F.col("at"))
    return each.withColumn("copies", _copies(F.col("offset"), F.col("rank") - 1, F.col("rank"))).select("row", "size", "source_size", "target", "copies")


def emitted(mixed: DataFrame) -> DataFrame:
    """The input rows, each as often as it is taken."""
    return mixed.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         coalesce('a' || source, 'b') AS skey, md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS digest, substr(digest, 1, 2) AS digit
  FROM documents),
s AS (
  SELECT skey, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY skey) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight
  FROM d GROUP BY skey),
o AS (
  SELECT *, 2.0::DOUBLE * source_size AS most, row_number() OVER w AS pos,
         coalesce(sum(2.0::DOUBLE * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open, sum(source_size) OVER () AS total
  FROM s WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, skey)),
l AS (SELECT *, (1.5::DOUBLE * total - stopped) / open AS level FROM o),
t AS (
  SELECT skey, source_size, least(weight * (SELECT arg_min(level, pos) FROM l WHERE level * weight <= most), most) AS target,
         ('0x' || substr(md5('mix-1' || skey), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS unit
  FROM l),
r AS (
  SELECT *, (row_number() OVER (PARTITION BY skey ORDER BY length(bin(size)), substr(bin(size), 1, 3), digit, size, doc_id, digest))::DOUBLE AS k,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM d JOIN t USING (skey)),
u AS (SELECT skey, j, (unit + j / 32.0::DOUBLE) - floor(unit + j / 32.0::DOUBLE) AS turn FROM t, range(32) AS n(j)),
w AS (
  SELECT skey, j, turn, abs(sum(size * (floor(turn + k * rate) - floor(turn + (k - 1) * rate))::BIGINT)::DOUBLE - any_value(target)) AS miss
  FROM r JOIN u USING (skey) GROUP BY skey, j, turn),
f AS (SELECT skey, arg_min(turn, (miss, j)) AS turn FROM w GROUP BY skey)
SELECT doc_id, size, source_size, target, size * (floor(turn + k * rate) - floor(turn + (k - 1) * rate))::BIGINT AS taken
FROM r JOIN f USING (skey)
"""
