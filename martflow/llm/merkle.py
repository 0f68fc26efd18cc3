"""Merkle manifest of a dataset: a content-addressed tree over its rows, and a proof for every row.

1. A row's leaf is the SHA-256 of its fields, each written as byte count, colon and value (``-`` if null).
2. Rows get their rank within their group (here: language) from one range sort of the leaves (:func:`ranked`): the
   place within a part of the sort, after the group's rows in the parts before.  No group is in one task.
3. :func:`grown` hashes every ``FANOUT`` consecutive nodes of a group into their parent until one is left, and
   stores a record (digest -> children) of each parent, by height.  The groups' last nodes are the leaves of one more tree.
4. :func:`descended` answers all rows' requests from the root down: a request looks its digest up in the records
   of its height, takes the child that the next digit of its rank names, and puts the record's other children on
   its path.  Requests that agree in their digits so far are one row, so a record near the root is read
   once, not once a document.  Rows join their run of ``FANOUT`` last; the path is then reversed, leaf first.
5. A row's proof is checked by folding (:func:`folded`): its leaf takes its place among its siblings, and so on to the root.

Digests are equal where contents are equal: equal records are stored once, and requests for them share the record.

Defined cases: a null field is ``-``, a null id too, which comes first in its group and is never tampered with; a null group comes
before all others; an empty text is ``0:``; rows of equal id are ordered by leaf; wholly equal rows are all there, each
at its own place; a group of one row has its leaf as subroot and a table of one row as root, without siblings (the
proof is the hash of nothing); an empty table gives no rows.  Only the named columns are read; others do not clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.staging import staged

FANOUT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string,right:string>>"


@dataclass
class Tree:
    """``nodes``: (g, rank, n, digest, *carried) of the leaves; ``records``: by height, (digest, children) from height 1 up;
    ``tops``: (g, n, height, digest), the last node of each group."""

    nodes: DataFrame
    records: list[DataFrame]
    tops: DataFrame


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 (hex) of fields, written so that no two lists of values read alike."""
    text = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text]), 256)


def lowered(text: Column) -> Column:
    """``text`` with A-Z lower-cased, other letters untouched."""
    return F.translate(text, UPPER, LOWER)


def ranked(rows: DataFrame, group: str | None, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0) in their group, by ``order``, nulls first, ``n``, the group's size, and ``g``, the group's own rank.

    One range sort deals the rows evenly; the row's own number splits equal rows too.
    """
    keys = [*([group] if group else []), *order, "_row"]
    rows = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
    # the number holds the part in its upper 31 bits and the place in the part in its lower 33
    rows = staged(rows.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), "sorted")
    by = rows[group] if group else F.lit(0)
    pieces = rows.groupBy(by.alias("_key"), F.col("_part").alias("_in")).agg(F.count(F.lit(1)).alias("_held"), F.min("_at").alias("_first"))
    one = Window.partitionBy("_key")  # a row for each part that holds the group, not for each of its rows
    before = F.coalesce(F.sum("_held").over(one.orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.select("_key", "_in", (before - F.col("_first")).alias("_shift"), F.sum("_held").over(one).alias("n"))
    if group:
        pieces = staged(pieces, "pieces")
        numbers = ranked(pieces.select(F.col("_key").alias("k")).distinct(), None, ["k"]).select(F.col("k").alias("_k"), F.col("rank").alias("g"))
        pieces = pieces.join(numbers, F.col("_key").eqNullSafe(F.col("_k"))).drop("_k")
    else:
        pieces = pieces.withColumn("g", F.lit(0).cast("long"))
    same = (F.col("_part") == F.col("_in")) & by.eqNullSafe(F.col("_key"))
    return rows.join(pieces, same).withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_in", "_key", "_shift")


def grown(nodes: DataFrame) -> Tree:
    """The tree over ``nodes`` (g, rank, n, digest), whose ranks run from 0 to n - 1 in each group g."""
    nodes = level = staged(nodes, "nodes")
    most = nodes.agg(F.max("n")).first()[0] or 0
    records, tops = [], []
    while most > 1:
        tops.append(level.filter("n = 1").select("g", "n", F.lit(len(records)).alias("height"), "digest"))
        runs = level.filter("n > 1").groupBy("g", F.floor(F.col("rank") / FANOUT).alias("rank"))
        runs = runs.agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("c"), F.ceil(F.first("n") / FANOUT).alias("n"))
        runs = runs.withColumn("children", F.col("c.digest")).drop("c")
        level = staged(runs.withColumn("digest", F.sha2(F.concat_ws("", "children"), 256)), "level")
        records.append(level.select("digest", "children").dropDuplicates(["digest"]))
        most = -(-most // FANOUT)
    tops.append(level.filter("n = 1").select("g", "n", F.lit(len(records)).alias("height"), "digest"))
    every = tops[0]
    for t in tops[1:]:
        every = every.unionByName(t)
    return Tree(nodes, records, staged(every, "tops"))


def _step(children: str, digit: Column) -> Column:
    """The path segment of the child at ``digit``: the children on its left, and those on its right."""
    return F.struct(F.concat_ws("", F.slice(children, F.lit(1), digit)).alias("left"),
                    F.concat_ws("", F.slice(children, digit + 2, F.lit(FANOUT))).alias("right"))


def descended(tree: Tree, above: DataFrame) -> DataFrame:
    """(g, rank, n, digest, *carried, subroot, path) of every leaf: its group's last node, and its siblings from the leaf up.

    ``above`` has (g, path): what each group's last node has above it, from the root down.
    """
    starts = tree.tops.join(above, "g").select("g", "height", F.lit(0).cast("long").alias("lead"), "digest", F.col("digest").alias("subroot"), "path")
    starts = staged(starts, "starts")
    asked = starts.filter("false").drop("height")
    for height in range(len(tree.records), 0, -1):
        here = starts.filter(F.col("height") == height).drop("height").unionByName(asked)
        asked = here.join(tree.records[height - 1], "digest").drop("digest")
        if height > 1:
            asked = asked.select("g", "lead", "subroot", "path", "children", F.posexplode("children").alias("digit", "digest"))
            asked = asked.select("g", (F.col("lead") * FANOUT + F.col("digit")).alias("lead"), "digest", "subroot",
                                 F.concat("path", F.array(_step("children", F.col("digit")))).alias("path"))
        asked = staged(asked, "asked")
    last = starts.filter("height = 0").select("g", "lead", "subroot", "path", F.lit(None).cast("array<string>").alias("children"))
    if tree.records:
        last = last.unionByName(asked)
    rows = tree.nodes.withColumn("lead", F.floor(F.col("rank") / FANOUT)).join(last, ["g", "lead"])
    digit = (F.col("rank") % FANOUT).cast("int")
    path = F.when(F.col("children").isNull(), F.col("path")).otherwise(F.concat("path", F.array(_step("children", digit))))
    return rows.withColumn("path", F.reverse(path)).drop("lead", "children")


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 over all siblings, level by level from the leaf up, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256)


def manifest(leaves: DataFrame, group: str, order: str) -> DataFrame:
    """``leaves``, which have a column ``leaf``, each row with its group's ``subroot``, the ``root`` and its ``path`` of siblings."""
    tree = grown(ranked(leaves, group, [order, "leaf"]).withColumn("digest", F.col("leaf")))
    crown = grown(ranked(tree.tops.select(F.col("g").alias("own"), "digest"), None, ["own"]))
    top = crown.tops.first()
    above = descended(crown, crown.tops.select("g", F.array().cast(PATH).alias("path"))).select(F.col("own").alias("g"), F.reverse("path").alias("path"))
    return descended(tree, above).drop("digest").withColumn("root", F.lit(top["digest"] if top else None).cast("string"))


def audit(docs: DataFrame, tampered: Column, doc: str = "doc_id", source: str = "source", group: str = "lang", size: str = "n_chars",
          text: str = "text") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs``.

    ``tampered`` says of which rows the copy under audit has its text lower-cased; it is a condition on ``docs``.
    """
    fields = lambda t: [docs[f"`{c}`"] for c in (doc, source, group, size)] + [t]
    whole = docs[f"`{text}`"]
    leaves = docs.select(docs[f"`{doc}`"].alias("doc"), docs[f"`{group}`"].alias("group"), leaf_digest(fields(whole)).alias("leaf"),
                         F.when(tampered, leaf_digest(fields(lowered(whole)))).alias("seen"))
    proved = manifest(leaves, "group", "doc").withColumn("folded_root", folded(F.coalesce("seen", "leaf"), F.col("path")))
    return proved.select(F.col("doc").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def third_by_crc(doc: Column) -> Column:
    """Whether 3 divides the CRC-32 of the id in decimal; not for a null id."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 3 == 0, F.lit(False))


#: The same by levels in DuckDB; its CRC-32 goes bit by bit over the id's digits.
ORACLE = """
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         text, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
             lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 3 = 0 AS hit
  FROM documents
), ranks AS (
  SELECT *, CASE WHEN hit THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
            ELSE leaf END AS seen,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g
  FROM leaves
), nodes AS (
  SELECT g, 0 AS h, rank, leaf AS digest, count(*) OVER (PARTITION BY g) AS n FROM ranks
  UNION ALL
  SELECT g, any_value(h) + 1, rank // 8, sha256(string_agg(digest, '' ORDER BY rank)), (any_value(n) + 7) // 8
  FROM nodes WHERE n > 1 GROUP BY g, rank // 8
), subroots AS (SELECT g, h, digest FROM nodes WHERE n = 1
), crown AS (
  SELECT 0 AS h, g AS rank, digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT any_value(h) + 1, rank // 8, sha256(string_agg(digest, '' ORDER BY rank)), (any_value(n) + 7) // 8
  FROM crown WHERE n > 1 GROUP BY rank // 8
), every AS (
  SELECT g, h, rank, digest, n FROM nodes
  UNION ALL
  SELECT s.g, s.h + c.h, c.rank, c.digest, c.n FROM crown c CROSS JOIN subroots s WHERE c.n > 1
), steps AS (
  SELECT r.g, r.rank, x.h,
         coalesce(string_agg(x.digest, '' ORDER BY x.rank) FILTER (x.rank < place), '') AS before,
         coalesce(string_agg(x.digest, '' ORDER BY x.rank) FILTER (x.rank > place), '') AS after
  FROM (SELECT g, rank, h.h, CASE WHEN h.h < s.h THEN rank // (8 ** h.h)::BIGINT ELSE g // (8 ** (h.h - s.h))::BIGINT END AS place
        FROM ranks JOIN subroots s USING (g) CROSS JOIN (SELECT DISTINCT h FROM every) h) r
  JOIN every x ON x.g = r.g AND x.h = r.h AND x.n > 1 AND x.rank // 8 = place // 8
  GROUP BY r.g, r.rank, x.h
), proofs AS (
  SELECT g, rank, count(*) AS height, sha256(string_agg(before || after, '' ORDER BY h)) AS proof_sha256 FROM steps GROUP BY g, rank
), fold AS (
  SELECT g, rank, 0 AS h, seen AS digest FROM ranks
  UNION ALL
  SELECT f.g, f.rank, f.h + 1, sha256(s.before || f.digest || s.after) FROM fold f JOIN steps s ON s.g = f.g AND s.rank = f.rank AND s.h = f.h
)
SELECT r.doc_id, r.leaf, s.digest AS subroot, c.digest AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
       f.digest AS folded_root, f.digest = c.digest AS verified
FROM ranks r JOIN subroots s USING (g) LEFT JOIN proofs p ON p.g = r.g AND p.rank = r.rank
JOIN fold f ON f.g = r.g AND f.rank = r.rank AND f.h = coalesce(p.height, 0)
CROSS JOIN (SELECT digest FROM crown WHERE n = 1) c
"""
