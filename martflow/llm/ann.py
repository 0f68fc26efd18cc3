"""Nearest neighbours through stable projections and a kd-tree.

Vectors are projected to ``M`` dimensions by Gaussian weights: the squared
projected length of a difference is its squared length times a chi-square
variable of ``M`` degrees.  A kd-tree over the projections, its splits medians
of a bounded sample, parts all rows into leaves.

A query first looks into its own leaf, nearest projections first.  Each verified vector may lower
its k-th distance ``d``; it stops when the next projection lies so far off that
a vector within ``d`` would be projected nearer with probability ``SURE``:
``projected > d * sqrt(chi-square quantile)``, with room for the rounding of the projections.  Then it
goes on by rounds over the other leaves in order of their boxes' projected distance, the nearest few first (``ROUNDS``): in each it visits those
whose boxes meet the ball of that radius, which has shrunk with all rounds before, and searches each in the same way.

Leaves hold any number of rows (a vector may repeat without end), so each is
cut into blocks by a hash of the id; queries are taken in blocks too.  Of the exact copies of a vector in a block only those of the
``k + 1`` smallest ids are looked at, as no other can be a result.  The tree
and the boxes, at most ``MOST_LEAVES`` leaves, are all that is sent to every task.

Defined cases: rows with a null id or with a vector that is null, zero, holds a null or
a non-finite component or has another length than most vectors take no part;
rows of one id are one candidate at the nearest of their vectors, and one query,
the least vector; equal distances go to the smaller id; with fewer than k candidates all
are returned; an empty table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.staging import ship_package, staged

M = 8
SURE = 0.85
#: Leaves, by distance, up to which a round goes; the last one goes on to all.
ROUNDS = (9, 65, 513)
#: Rows that a leaf and a block should hold; bounds of the sample and of the leaves; queries of a block.
LEAF_ROWS = 2048
BLOCK_ROWS = 8192
SAMPLE = 65536
MOST_LEAVES = 4096
QUERY_BLOCK = 16384
#: Projections verified between two looks at the stopping test.
STEP = 256
SEED = 11


class Tree(NamedTuple):
    """A complete kd-tree: dimension and value of each inner node, box of each leaf."""

    depth: int
    dims: np.ndarray
    values: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.dims[node]] > self.values[node])
        return node - (2 ** self.depth - 1)

    def distance(self, point: np.ndarray) -> np.ndarray:
        """Projected distance of a point to each leaf's box."""
        return np.sqrt((np.maximum(0, np.maximum(self.low - point, point - self.high)) ** 2).sum(1))


def build_tree(points: np.ndarray, depth: int) -> Tree:
    """Splits at the median of the dimension that spreads widest; boxes from the splits."""
    inner = 2 ** depth - 1
    dims, values = np.zeros(inner, np.int64), np.zeros(inner)
    held = [points] + [None] * (2 * inner)
    boxes = [(np.full(M, -np.inf), np.full(M, np.inf))] + [None] * (2 * inner)
    for node in range(inner):
        own, (a, b) = held[node], boxes[node]
        if len(own):
            dims[node] = int(own.std(0).argmax())
            values[node] = float(np.median(own[:, dims[node]]))
        right = own[:, dims[node]] > values[node]
        held[2 * node + 1], held[2 * node + 2], held[node] = own[~right], own[right], None
        cut = np.eye(M, dtype=bool)[dims[node]]
        boxes[2 * node + 1] = a, np.where(cut, np.minimum(b, values[node]), b)
        boxes[2 * node + 2] = np.where(cut, np.maximum(a, values[node]), a), b
    low, high = (np.stack([box[i] for box in boxes[inner:]]) for i in (0, 1))
    return Tree(depth, dims, values, low, high)


def chi_square_quantile(p: float, degrees: int) -> float:
    """Quantile for an even number of degrees, by bisection of the closed distribution function."""
    half = degrees // 2
    below = lambda x: 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(half))
    a, b = 0.0, 1000.0
    for _ in range(200):
        a, b = ((a + b) / 2, b) if below((a + b) / 2) < p else (a, (a + b) / 2)
    return a


def projection(size: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, M))


def usable(rows: DataFrame, vec: str, embedding: str) -> tuple[DataFrame, int]:
    """(vec_id, v) of the rows that take part, and the length of their vectors."""
    v = F.col(embedding).cast("array<double>")
    rows = rows.select(F.col(vec).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").head(1)
    size = sizes[0]["n"] if sizes else 0
    return rows.filter(F.size("v") == size), size


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 1))


def index_rows(rows: DataFrame, size: int) -> tuple[Tree, DataFrame, dict, int]:
    """The tree, the staged rows (leaf, vec_id, v), the blocks of each leaf, and the number of rows."""
    ship_package(rows.sparkSession)
    n = rows.count()
    weights = projection(size)
    share = min(1.0, SAMPLE / max(n, 1))

    def project(batches):
        for batch in batches:
            v = _matrix(batch.column("v").to_pandas())
            points = v @ weights if len(v) else np.zeros((0, M))
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(list(points), pa.list_(pa.float64()))], ["h", "p"])

    # by the hash of the whole row, so that rows that repeat count once; projected before they come to the driver
    sample = rows.withColumn("h", F.xxhash64("vec_id", "v")).filter(F.pmod("h", F.lit(2 ** 32)) < F.lit(int(share * 2 ** 32)))
    sample = sample.select("h", "v").mapInArrow(project, "h long, p array<double>").groupBy("h").agg(F.min("p").alias("p"))
    sample = sample.toPandas().sort_values("h").head(SAMPLE)
    points = _matrix(sample["p"]) if len(sample) else np.zeros((0, M))
    depth = min(max(0, math.ceil(math.log2(max(n, 1) / LEAF_ROWS))), int(math.log2(MOST_LEAVES)), int(math.log2(max(len(points) // 16, 1))))
    tree = build_tree(points, depth)

    def place(batches):
        for batch in batches:
            v = _matrix(batch.column("v").to_pandas())
            yield pa.RecordBatch.from_arrays([pa.array(tree.leaf(v @ weights) if len(v) else [], pa.int64()), batch.column("vec_id"), batch.column("v")], ["leaf", "vec_id", "v"])

    placed = staged(rows.mapInArrow(place, "leaf long, vec_id long, v array<double>"), "leaves")
    counts = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}
    return tree, placed, {k: max(1, math.ceil(c / BLOCK_ROWS)) for k, c in counts.items()}, n


def _limit(q: np.ndarray, d: float, weights: np.ndarray, reach: float) -> float:
    """Projected distance up to which a vector within ``d`` of ``q`` counts: ``d * reach`` and the rounding of both projections."""
    room = 4 * np.finfo(float).eps * len(q) * np.linalg.norm(weights)
    return d * reach + room * (2 * np.linalg.norm(q) + d)


def _first_copies(ids: np.ndarray, v: np.ndarray, most: int) -> np.ndarray:
    """Places, in order, of the rows of the ``most`` smallest ids of each distinct vector, a row for each id."""
    flat = np.ascontiguousarray(v).view(np.dtype((np.void, v.dtype.itemsize * v.shape[1]))).ravel()
    group = np.unique(flat, return_inverse=True)[1]
    order = np.lexsort((ids, group))
    g, i = group[order], ids[order]
    order = order[np.concatenate(([True], (g[1:] != g[:-1]) | (i[1:] != i[:-1])))]
    g = group[order]
    return np.sort(order[np.arange(len(g)) - np.searchsorted(g, g) < most])


def _search(data: pd.DataFrame, asked: pd.DataFrame, weights: np.ndarray, k: int, reach: float) -> list[tuple]:
    """(query, distance, id) of the k best of a block for each query, nearest projections first."""
    if not len(data) or not len(asked):
        return []
    ids, v = data["vec_id"].to_numpy(), _matrix(data["v"])
    first = _first_copies(ids, v, k + 1)  # one of them may be the query itself
    ids, v = ids[first], v[first]
    points, out = v @ weights, []
    for query, q, bound in zip(asked["query_id"], asked["q"], asked["bound"]):
        q = np.asarray(q, float)
        off = np.sqrt(((points - q @ weights) ** 2).sum(1))
        near = np.flatnonzero((off <= _limit(q, bound, weights, reach)) & (ids != query))
        near = near[np.argsort(off[near], kind="stable")]
        best_d, best_i, d = np.zeros(0), np.zeros(0, np.int64), bound
        for low in range(0, len(near), STEP):
            if off[near[low]] > _limit(q, d, weights, reach):
                break
            part = near[low:low + STEP]
            dist = np.concatenate((best_d, np.sqrt(((v[part] - q) ** 2).sum(1))))
            name = np.concatenate((best_i, ids[part]))
            order = np.lexsort((name, dist))
            _, first = np.unique(name[order], return_index=True)
            order = order[np.sort(first)][:k]
            best_d, best_i = dist[order], name[order]
            if len(order) == k:
                d = min(d, best_d[-1])
        out += [(query, x, i) for x, i in zip(best_d, best_i)]
    return out


def _visit(queries: DataFrame, placed: DataFrame, blocks: dict, weights: np.ndarray, k: int, reach: float) -> DataFrame:
    """(query_id, score, vec_id) found by queries (leaf, part, query_id, q, bound) in their leaves."""
    most = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair]), F.col("leaf")), F.lit(1))
    wanted = queries.select(F.col("leaf").alias("in_leaf"), F.col("part").alias("in_part")).distinct()
    data = placed.join(wanted, F.col("leaf") == F.col("in_leaf"))
    data = data.select("in_leaf", "in_part", F.pmod(F.xxhash64("vec_id"), most).cast("int").alias("in_block"), "vec_id", "v")
    asked = queries.withColumn("block", F.explode(F.sequence(F.lit(0), (most - 1).cast("int"))))

    def look(data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_search(data, asked, weights, k, reach), columns=["query_id", "score", "vec_id"]).astype({"query_id": "int64", "score": "float64", "vec_id": "int64"})

    return data.groupBy("in_leaf", "in_part", "in_block").cogroup(asked.groupBy("leaf", "part", "block")).applyInPandas(look, "query_id long, score double, vec_id long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """(query_id, best): the k nearest (score, vec_id) of each query, each id once."""
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return once.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("best"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, vec: str = "vec_id", embedding: str = "embedding", sure: float = SURE) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest rows of ``vectors`` to each row of ``queries``, nearest first.

    Distances are Euclidean, in double precision on the original vectors.  A row of the query's own id is no candidate.
    """
    rows, size = usable(vectors, vec, embedding)
    tree, placed, blocks, n = index_rows(rows, size)
    weights, reach = projection(size), math.sqrt(chi_square_quantile(sure, M))
    asked, _ = usable(queries, vec, embedding)
    asked = asked.filter(F.size("v") == size).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
    asked = staged(asked, "queries")
    parts = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    leaves = np.array(sorted(blocks), np.int64)

    def route(batches, low, high):
        """The leaves from the ``low``-th to before the ``high``-th by distance, for each query those within reach; the first is its own."""
        home = low == 0
        for batch in batches:
            ids, q = batch.column("query_id").to_numpy(), _matrix(batch.column("q").to_pandas())
            bound = np.full(len(ids), np.inf) if home else batch.column("bound").to_numpy()
            own = tree.leaf(q @ weights) if len(ids) else np.zeros(0, np.int64)
            row, leaf = [], []
            for i in range(len(ids)):
                if home:
                    hit = own[i:i + 1]
                else:
                    off = tree.distance(q[i] @ weights)[leaves]
                    order = np.lexsort((leaves, off, leaves != own[i]))[low:high]
                    hit = leaves[order[off[order] <= _limit(q[i], bound[i], weights, reach)]]
                row.append(np.full(len(hit), i))
                leaf.append(hit)
            row = np.concatenate(row) if row else np.zeros(0, np.int64)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(leaf) if leaf else [], pa.int64()), pa.array(ids[row] // 100 % parts, pa.int32()),
                 pa.array(ids[row], pa.int64()), batch.column("q").take(at), pa.array(bound[row], pa.float64())],
                ["leaf", "part", "query_id", "q", "bound"])

    where = "leaf long, part int, query_id long, q array<double>, bound double"
    if n:
        found = staged(_visit(asked.mapInArrow(lambda b: route(b, 0, 1), where), placed, blocks, weights, k, reach), "found")
        low = 1
        for high in (*ROUNDS, MOST_LEAVES):
            if low >= len(leaves):
                break
            best = staged(_best(found, k), "best")
            bound = best.select("query_id", F.when(F.size("best") == k, F.element_at("best", -1)["score"]).alias("bound"))
            rest = asked.join(bound, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
            rest = rest.select("query_id", "q", "bound").mapInArrow(lambda b, low=low, high=high: route(b, low, high), where)
            best = best.select("query_id", F.explode("best").alias("b")).select("query_id", "b.score", "b.vec_id")
            found = staged(best.unionByName(_visit(rest, placed, blocks, weights, k, reach)), "found")
            low = high
    else:
        found = vectors.sparkSession.createDataFrame([], "query_id long, score double, vec_id long")
    return (_best(found, k).select("query_id", F.posexplode("best").alias("at", "b"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score")))
