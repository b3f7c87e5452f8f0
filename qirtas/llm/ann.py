"""Approximate nearest neighbours by randomly rotated one-bit codes.

Vectors less their mean are turned by a random rotation; a code keeps one bit a dimension and two
scalars: the vector's length and the inner product of its direction with the code. From a query's inner
product with the bits these give an unbiased estimate of the distance, and a bound on its error. A vector
is compared in full only if its lower bound does not exceed the k-th smallest distance known so far.

Codes are made once and kept as a table beside their vectors. The queries are taken in blocks of a fixed number, each
against all rows: a block is sent to the tasks, every task scans its rows' codes, keeps k of each query, and k rows a
query and task are merged. Vectors are compared in batches, so a batch of which no code can be near is left at that.

Defined results: vectors that are null, zero, of another length than most, or that hold a null or a
non-finite number take no part; ties go to the smaller vec_id; fewer than k candidates give all of them;
repeated rows are candidates of their own; a repeated query id is searched once, by its smallest vector; other
columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import write_table
from .text import binary

QUERY_BLOCK = 4096
EPSILON = 4.0  # widths of the error bound: a true neighbour is lost with a chance of about 1 in 10,000
SCAN_ROWS, SCAN_QUERIES = 4096, 256
_BYTES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32) * 2 - 1


def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def one_bit_codes(x: np.ndarray, center: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bits, lengths, and inner products of each direction with its own code."""
    v = (x - center) @ turn
    length = np.linalg.norm(v, axis=1)
    own = np.abs(v).sum(axis=1) / (np.sqrt(v.shape[1]) * np.where(length > 0, length, 1))
    return np.packbits(v > 0, axis=1), length, np.where(length > 0, own, 1)


def distance_bounds(bits: np.ndarray, length: np.ndarray, own: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Lower bounds of the squared distances, vectors x queries; ``query`` is centred and turned."""
    dim = query.shape[1]
    signs = _BYTES[bits].reshape(len(bits), -1)[:, :dim]
    size = np.linalg.norm(query, axis=1)
    dots = signs @ query.T.astype(np.float32) / np.float32(np.sqrt(dim))
    estimate = dots / own[:, None].astype(np.float32)
    error = EPSILON * np.sqrt((1 - own**2).clip(0) / (own**2 * max(dim - 1, 1)))[:, None] * size[None, :]
    near = (estimate + error) * length[:, None]
    low = length[:, None] ** 2 + size[None, :] ** 2 - 2 * near
    return low - 1e-4 * (length[:, None] ** 2 + size[None, :] ** 2)  # single precision


def usable(column: str = "embedding") -> F.Column:
    v = F.col(column)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, seed: int = 11) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest rows by Euclidean distance, itself left out."""
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).filter(usable("v") & F.col("vec_id").isNotNull())
    wanted = queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("v")).filter(usable("v") & F.col("query_id").isNotNull())
    wanted = wanted.groupBy("query_id").agg(F.min("v").alias("v"))
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    schema = "query_id long, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = sizes[0]["dim"]
    rows, wanted = rows.filter(F.size("v") == dim), wanted.filter(F.size("v") == dim)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dim), 0
        for batch in batches:
            m = _matrix(batch.column(1), dim)
            total, n = total + m.sum(axis=0), n + len(m)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()])], ["n", "total"])

    sums = rows.mapInArrow(add_up, "n long, total array<double>").select("n", F.posexplode("total").alias("i", "x"))
    mean = sums.groupBy("i").agg((F.sum("x") / F.sum("n")).alias("m")).collect()
    center, turn = np.zeros(dim), rotation(dim, seed)
    for r in mean:
        center[r["i"]] = r["m"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, m = batch.column(0), _matrix(batch.column(1), dim)
            for a in range(0, len(m), SCAN_ROWS):
                bits, length, own = one_bit_codes(m[a : a + SCAN_ROWS], center, turn)
                n = len(bits)
                yield pa.RecordBatch.from_arrays([ids.slice(a, n), batch.column(1).slice(a, n), binary(bits.reshape(-1), np.full(n, bits.shape[1])), pa.array(length), pa.array(own)], ["vec_id", "v", "bits", "length", "own"])

    coded = write_table(rows.mapInArrow(encode, "vec_id long, v array<double>, bits binary, length double, own double"), "ann-codes")
    blocks = max(1, -(-wanted.count() // QUERY_BLOCK))
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    found = None
    for i in range(blocks):
        block = wanted.filter(F.col("block") == i).select("query_id", "v").toArrow() if blocks > 1 else wanted.select("query_id", "v").toArrow()
        if not block.num_rows:
            continue
        q_ids = block.column(0).to_numpy()
        q_raw = _matrix(block.column(1).combine_chunks(), dim)
        sent = spark.sparkContext.broadcast((q_ids, q_raw, (q_raw - center) @ turn))

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, raw, turned = sent.value
            best = np.full((len(ids), k), np.inf)
            who = np.full((len(ids), k), np.iinfo(np.int64).max)
            for batch in batches:
                v_ids, m = batch.column(0).to_numpy(), _matrix(batch.column(1), dim)
                codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(len(m), -1)
                lengths, owns = batch.column(3).to_numpy(), batch.column(4).to_numpy()
                for a in range(0, len(m), SCAN_ROWS):
                    x, own_ids = m[a : a + SCAN_ROWS], v_ids[a : a + SCAN_ROWS]
                    bits, length, own = codes[a : a + SCAN_ROWS], lengths[a : a + SCAN_ROWS], owns[a : a + SCAN_ROWS]
                    for b in range(0, len(ids), SCAN_QUERIES):
                        part = slice(b, b + SCAN_QUERIES)
                        low = distance_bounds(bits, length, own, turned[part])
                        if np.isinf(best[part, -1]).any():  # nothing known yet: start from the nearest by bound
                            first = np.argpartition(low, min(2 * k, len(x) - 1), axis=0)[: 2 * k].T
                            pairs = [(j, first[j]) for j in range(first.shape[0])]
                        else:
                            pairs = []
                        for j, at in pairs:
                            _merge(best, who, b + j, raw, ids, x, own_ids, at, k)
                            low[at, j] = np.inf
                        rest = low <= (best[part, -1] ** 2)[None, :]
                        for j in np.flatnonzero(rest.any(axis=0)):
                            _merge(best, who, b + j, raw, ids, x, own_ids, np.flatnonzero(rest[:, j]), k)
            q, c = np.nonzero(np.isfinite(best))
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(who[q, c]), pa.array(best[q, c])], ["query_id", "vec_id", "score"])

        part = coded.mapInArrow(scan, schema)
        first = Window.partitionBy("query_id").orderBy("score", "vec_id")
        part = part.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
        part = write_table(part.select("query_id", "rank", "vec_id", "score"), "ann-block") if blocks > 1 else part.select("query_id", "rank", "vec_id", "score")
        found = part if found is None else found.unionByName(part)
        if blocks > 1:
            sent.destroy()
    return found if found is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def _merge(best, who, j, raw, ids, x, own_ids, at, k) -> None:
    """Take rows ``at`` of x into query j's list, by exact distance and then id."""
    at = at[own_ids[at] != ids[j]]
    if not len(at):
        return
    d = np.sqrt(((x[at] - raw[j]) ** 2).sum(axis=1))
    dist, name = np.concatenate([best[j], d]), np.concatenate([who[j], own_ids[at]])
    order = np.lexsort((name, dist))[:k]
    best[j], who[j] = dist[order], name[order]
