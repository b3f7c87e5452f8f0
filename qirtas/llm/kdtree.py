"""Exact search of the largest inner products by KD-trees, one a shard.

Vectors are turned into whole numbers and dealt into shards of ``SHARD`` rows. A bounded sample, cut at medians, says which
vectors lie together, so that a shard's box is tight. In a shard, rows are split at the median of the widest dimension until
``LEAF`` rows are left or all are equal; each node keeps the tight box of its rows. No vector in a box has a larger inner
product with a query than the box's bound, the sum over dimensions of the larger of the products with its two sides. The
traversal takes the node of largest bound first and ends where the bound falls below the k-th score known: that of the rows
met so far, in this and in earlier shards of the task, or, before any, that of the sample. Rows of equal vectors in one leaf
are kept to the k + 1 smallest ids, as no query can have more of them in its result.

Queries are taken in blocks of ``QUERY_BLOCK``, each sent to all shards; shards whose whole box is below a query's k-th
score are not opened for it, and only rows that reach the score leave a task.

Products are exact: in double precision where sums stay below 2**53, else in 64-bit integers. Defined results: vectors that
are null, empty, of another length than most, or that hold a null or a non-finite number take no part, and neither do
those with a component whose square times the number of dimensions would leave 64 bits; zero vectors do; ties go to the smaller vec_id; fewer
than k candidates give all; all rows with the query's id count as its own; a repeated query id is searched once, by its
smallest vector; repeated rows are candidates each; a null vec_id takes no part; other columns, whatever their names, are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import partitions, write_table

SCALE, SHARD, LEAF, QUERY_BLOCK, SAMPLE, CELL_SAMPLE, SCAN = 1024, 8192, 64, 16384, 4096, 32, 512
NONE = np.iinfo(np.int64).min
TREE = "ids binary, points binary, boxes binary, nodes binary"


def whole_numbers(column: Column) -> Column:
    return F.transform(column, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))


def finite(column: str) -> Column:
    v = F.col(column)
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def split_order(points: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Rows cut at the median of the widest dimension; None if all are equal."""
    part = points[rows]
    low, high = part.min(axis=0), part.max(axis=0)
    d = int(np.argmax(high - low))
    if high[d] == low[d]:
        return None
    half = len(rows) // 2
    order = np.argpartition(part[:, d], half)
    return rows[order[:half]], rows[order[half:]]


def build_tree(ids: np.ndarray, points: np.ndarray, k: int, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and points in the order of the leaves, boxes (nodes x low and high x dimensions), and nodes: first row, rows, and
    the children (0 for a leaf)."""
    boxes, nodes, kept, n = [], [], [], 0
    todo = [(np.arange(len(ids)), -1, 0)]
    while todo:
        rows, parent, side = todo.pop()
        part = points[rows]
        boxes.append((part.min(axis=0), part.max(axis=0)))
        nodes.append([n, 0, 0, 0])
        if parent >= 0:
            nodes[parent][2 + side] = len(nodes) - 1
        halves = split_order(points, rows) if len(rows) > leaf else None
        if halves is None:
            if (boxes[-1][0] == boxes[-1][1]).all():
                rows = rows[np.argsort(ids[rows], kind="stable")[: k + 1]]
            nodes[-1][1] = len(rows)
            kept.append(rows)
            n += len(rows)
        else:
            todo += [(halves[1], len(nodes) - 1, 1), (halves[0], len(nodes) - 1, 0)]
    order = np.concatenate(kept)
    return ids[order], points[order], np.array(boxes), np.array(nodes, np.int32)


def best_first(bounds: np.ndarray, nodes: np.ndarray, least: int, open_leaf) -> int:
    """Visit leaves by falling bound while it reaches ``least``, which ``open_leaf`` returns anew. The number of leaves."""
    heap, visited = [(-bounds[0], 0)], 0
    while heap:
        bound, at = heapq.heappop(heap)
        if -bound < least:
            break
        first, rows, left, right = nodes[at]
        if left:
            for child in (left, right):
                if bounds[child] >= least:
                    heapq.heappush(heap, (-bounds[child], child))
        else:
            least = open_leaf(first, first + rows)
            visited += 1
    return visited


def box_bounds(queries: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """Queries x boxes: the largest inner product that any point of the box could have."""
    return np.maximum(queries, 0) @ boxes[:, 1].T + np.minimum(queries, 0) @ boxes[:, 0].T


class Found:
    """The k best of each query so far, and the score that others must reach."""

    def __init__(self, ids: np.ndarray, least: np.ndarray, k: int):
        self.ids, self.least, self.k = ids, least.copy(), k
        self.score, self.who = np.full((len(ids), k), NONE), np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, j: int, scores: np.ndarray, who: np.ndarray) -> int:
        own = (scores >= self.least[j]) & (who != self.ids[j])
        if own.any():
            score, name = np.concatenate([self.score[j], scores[own].astype(np.int64)]), np.concatenate([self.who[j], who[own]])
            order = np.lexsort((name, ~score))[: self.k]
            self.score[j], self.who[j] = score[order], name[order]
            self.least[j] = max(self.least[j], self.score[j, -1])
        return self.least[j]

    def rows(self) -> pa.RecordBatch:
        q, c = np.nonzero(self.who != np.iinfo(np.int64).max)
        return pa.RecordBatch.from_arrays([pa.array(self.ids[q]), pa.array(self.who[q, c]), pa.array(self.score[q, c])], ["query_id", "vec_id", "score"])


def search_tree(found: Found, queries: np.ndarray, tree: tuple[np.ndarray, ...]) -> int:
    """Take a shard's rows into ``found``; the number of leaves opened."""
    ids, points, boxes, nodes = tree
    opened = 0
    for a in range(0, len(queries), SCAN):
        part = np.arange(a, min(a + SCAN, len(queries)))
        part = part[box_bounds(queries[part], boxes[:1])[:, 0] >= found.least[part]]
        if not len(part):
            continue
        bounds = box_bounds(queries[part], boxes)
        for i, j in enumerate(part.tolist()):
            q = queries[j]
            opened += best_first(bounds[i], nodes, found.least[j], lambda x, y, j=j, q=q: found.add(j, points[x:y] @ q, ids[x:y]))
    return opened


def _sample(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n)


def cell_cuts(points: np.ndarray, most: int) -> list[tuple[int, int, int, int]]:
    """Median cuts of the sample: (dimension, value, node below it, node from it on); a negative node is a cell."""
    cuts: list[list[int]] = []
    cells = 0
    todo = [(np.arange(len(points)), 0, 0)]
    while todo:
        rows, parent, side = todo.pop(0)
        part = points[rows]
        d = int(np.argmax(part.max(axis=0) - part.min(axis=0))) if len(rows) else 0
        value = int(np.sort(part[:, d])[len(rows) // 2]) if len(rows) else 0
        below = part[:, d] < value if len(rows) else np.zeros(0, bool)
        if len(rows) < 2 * CELL_SAMPLE or len(todo) + cells + 2 > most or not below.any():
            cells += 1
            node = -cells
        else:
            cuts.append([d, value, 0, 0])
            node = len(cuts) - 1
            todo += [(rows[below], node, 2), (rows[~below], node, 3)]
        if side:
            cuts[parent][side] = node
    return [tuple(c) for c in cuts]


def cells_of(points: np.ndarray, cuts: list[tuple[int, int, int, int]]) -> np.ndarray:
    out = np.zeros(len(points), np.int64)
    todo = [(np.arange(len(points)), 0)] if cuts else []
    while todo:
        rows, node = todo.pop()
        d, value, low, high = cuts[node]
        below = points[rows, d] < value
        for own, to in ((rows[below], low), (rows[~below], high)):
            if to < 0:
                out[own] = -to
            elif len(own):
                todo.append((own, to))
    return out


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard: int = SHARD, block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k largest inner products of whole numbers, itself left out."""
    spark = vectors.sparkSession
    whole = lambda df, name: df.select(F.col("vec_id").alias(name), F.col("embedding").cast("array<double>").alias("v")).filter(F.col(name).isNotNull() & finite("v"))
    rows, wanted = whole(vectors, "vec_id"), whole(queries, "query_id")
    most = F.array_max(F.transform("v", lambda x: F.abs(F.floor(float(SCALE) * x).cast("double"))))
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("rows"), F.max(most).alias("most")).orderBy(F.desc("rows"), "dim").limit(1).collect()
    if not sizes:
        return nothing
    dim, total = sizes[0]["dim"], sizes[0]["rows"]
    limit = min(2**31 - 1, int((2**63 / dim) ** 0.5) - 1)
    fits = (F.size("v") == dim) & (most <= limit)
    kind = np.float64 if dim * min(sizes[0]["most"], limit) ** 2 < 2**53 else np.int64
    rows = rows.filter(fits).withColumn("v", whole_numbers(F.col("v")))
    wanted = wanted.filter(fits).groupBy("query_id").agg(F.min(whole_numbers(F.col("v"))).alias("v"))
    seeds = _sample(rows, SAMPLE).toArrow()
    seed_ids, seed_points = seeds.column(0).to_numpy(), _matrix(seeds.column(1), dim)
    cuts = spark.sparkContext.broadcast(cell_cuts(seed_points, max(1, -(-total // shard))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column(1), dim)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells_of(points, cuts.value))], ["vec_id", "v", "cell"])

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for batch in batches:
            for a in range(0, batch.num_rows, shard):
                ids, points = batch.column(0).slice(a, shard).to_numpy(), _matrix(batch.column(1).slice(a, shard), dim)
                held.append((ids, points))
                n += len(ids)
                if n >= shard:
                    yield _tree_row(held, k)
                    held, n = [], 0
        if held:
            yield _tree_row(held, k)

    each = max(1, min(-(-total // shard), 8 * partitions(spark)))
    salted = rows.mapInArrow(place, "vec_id long, v array<long>, cell long").withColumn("salt", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(1 << 20)))
    dealt = salted.repartitionByRange(each, "cell", "salt").sortWithinPartitions("cell", "salt").select("vec_id", "v")
    trees = write_table(dealt.mapInArrow(plant, TREE), "kd-trees")

    blocks = max(1, -(-wanted.count() // block))
    wanted = write_table(wanted.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))), "kd-queries")
    parts = []
    for i in range(blocks):
        own = wanted.filter(F.col("block") == i).select("query_id", "v").toArrow()
        if not own.num_rows:
            continue
        ids, points = own.column(0).to_numpy(), _matrix(own.column(1), dim)
        sent = spark.sparkContext.broadcast((ids, points, first_scores(ids, points.astype(kind), seed_ids, seed_points.astype(kind), k)))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, points, least = sent.value
            found, points = Found(ids, least, k), points.astype(kind)
            for batch in batches:
                for at in range(batch.num_rows):
                    search_tree(found, points, _tree_of(batch, at, dim, kind))
            yield found.rows()

        first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        part = trees.mapInArrow(search, "query_id long, vec_id long, score long").withColumn("rank", F.row_number().over(first))
        part = part.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        parts.append(write_table(part, "kd-block") if blocks > 1 else part)
        if blocks > 1:
            sent.destroy()
    out = parts[0] if parts else nothing
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def first_scores(ids: np.ndarray, queries: np.ndarray, seed_ids: np.ndarray, seeds: np.ndarray, k: int) -> np.ndarray:
    """The k-th score of each query among the sample: what a row must reach at least."""
    out = np.full(len(ids), NONE)
    for a in range(0, len(ids), SCAN):
        scores = (queries[a : a + SCAN] @ seeds.T).astype(np.int64)
        scores[ids[a : a + SCAN, None] == seed_ids[None]] = NONE
        if scores.shape[1] >= k:
            out[a : a + SCAN] = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    return out


def _tree_row(held: list[tuple[np.ndarray, np.ndarray]], k: int) -> pa.RecordBatch:
    ids, points, boxes, nodes = build_tree(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), k)
    cells = [ids.astype("<i8"), points.astype("<i4"), boxes.astype("<i4"), nodes.astype("<i4")]
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in cells], ["ids", "points", "boxes", "nodes"])


def _tree_of(batch: pa.RecordBatch, at: int, dim: int, kind: type) -> tuple[np.ndarray, ...]:
    raw = [np.frombuffer(batch.column(i)[at].as_buffer(), t) for i, t in enumerate(("<i8", "<i4", "<i4", "<i4"))]
    return raw[0], raw[1].reshape(-1, dim).astype(kind), raw[2].reshape(-1, 2, dim).astype(kind), raw[3].reshape(-1, 4)
