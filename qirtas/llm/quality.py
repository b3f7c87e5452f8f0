"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Features of a text: its distinct words (ASCII letters lower-cased, hashed), each with weight one over the
root of their number; shares and means of its characters, words and lines, each as one of ``BINS`` steps;
and metadata columns on a logarithmic scale. The machine scores all pairwise interactions at low rank in
linear time: half the sum over factors of (the square of the sum less the sum of squares).

It is fitted by logistic loss on at most ``PER_CLASS`` labelled rows of each class, those of the smallest
hashed doc_id, and of these on no more than ``LEARN_BYTES`` of features a class; the features, not the texts, reach the
driver. Rows are scored in Arrow batches.

Defined results: a null or empty text has no words and the statistics of an empty text; labels other
than 0 and 1 are left out, and so is a doc_id with both; without a label of both classes every score is the share of
label 1 (0.5 without any label); repeated rows are scored each, and of the rows of a labelled doc_id the one of the smallest text is learnt from. Other
columns, whatever their names, are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ngrams import LETTERS, lowered, rows_of
from .shared import drop_table, smallest, write_table
from .text import flat, slices, word_bounds, word_hashes

PER_CLASS, BITS, BINS, RANK, ROUNDS = 4096, 16, 16, 8, 12
LEARN_BYTES = 64 << 20
STATISTICS = ("letters", "capitals", "digits", "marks", "odd", "spaces", "high", "word length", "distinct words", "line length", "distinct lines", "words", "marked words")


def _share(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return np.diff(total[offsets]) / np.maximum(np.diff(offsets), 1)


def statistics(data: np.ndarray, off: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Rows x STATISTICS, each from 0 to 1."""
    n, words = np.diff(off), np.diff(first)
    capital, digit = (data >= 65) & (data <= 90), (data >= 48) & (data <= 57)
    high, space = data >= 128, (data == 32) | ((data >= 9) & (data <= 13))
    mark = ~(LETTERS[data] | digit | high | space)
    plain = mark & np.isin(data, np.frombuffer(b".,;:!?'\"()-", np.uint8))
    line = data == 10
    row = rows_of(off)
    breaks = np.flatnonzero(line | np.isin(np.arange(len(data)), off[1:-1] - 1)) + 1
    cuts = np.unique(np.concatenate([off[:-1], breaks, off[-1:]]))
    cuts = cuts[cuts <= len(data)]
    lines = np.bincount(row[cuts[:-1]], minlength=len(n)) if len(data) else np.zeros(len(n))
    if len(data):
        value = np.add.reduceat(data.astype(np.uint64) * (np.arange(len(data), dtype=np.uint64) - np.repeat(cuts[:-1], np.diff(cuts)).astype(np.uint64) + np.uint64(7)) ** np.uint64(3), cuts[:-1])
        own = np.unique(np.stack([row[cuts[:-1]].astype(np.uint64), value]), axis=1)[0]
        kinds = np.bincount(own.astype(np.int64), minlength=len(n))
    else:
        kinds = np.zeros(len(n))
    tail = mark[np.maximum(ends - 1, 0)] & ~plain[np.maximum(ends - 1, 0)] if len(ends) else np.zeros(0, bool)
    safe = np.maximum(words, 1)
    size = np.concatenate([[0], np.cumsum(ends - starts)])
    marked = np.concatenate([[0], np.cumsum(tail)])
    return np.stack(
        [
            _share(LETTERS[data] | high, off), _share(capital, off) * 2, _share(digit, off) * 4, _share(plain, off) * 4, _share(mark & ~plain, off) * 4,
            _share(space, off) * 3, _share(high, off) * 4, np.diff(size[first]) / safe / 16, distinct / safe,
            np.log1p(n / np.maximum(lines, 1)) / 8, kinds / np.maximum(lines, 1), np.log1p(words) / 12, np.diff(marked[first]) / safe,
        ],
        axis=1,
    ).clip(0, 1)


def features(texts: pa.Array, extra: list[pa.Array]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of rows: first row, rows, and (row, feature, value) of every feature."""
    data, offsets = flat(texts)
    meta = [np.nan_to_num(x.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float), nan=-1.0) for x in extra]
    space, words_at = BINS + 1, 1 << BITS
    for a, b in slices(offsets):
        part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, first = word_bounds(part, off)
        code = (word_hashes(lowered(part), starts, ends) >> np.uint64(64 - BITS)).astype(np.int64)
        key = np.unique((np.repeat(np.arange(b - a), np.diff(first)) << BITS) | code)
        row, word = key >> BITS, key & (words_at - 1)
        distinct = np.bincount(row, minlength=b - a)
        stats = statistics(part, off, starts, ends, first, distinct)
        step = (stats * BINS).astype(np.int64) + np.arange(stats.shape[1]) * space + words_at
        cells = [step]
        for i, m in enumerate(meta):
            own = np.where(m[a:b] < 0, BINS, np.minimum(np.log1p(np.maximum(m[a:b], 0)), BINS - 1)).astype(np.int64)
            cells.append((own + (len(STATISTICS) + i) * space + words_at)[:, None])
        cell = np.concatenate(cells, axis=1)
        rows = np.concatenate([row, np.repeat(np.arange(b - a), cell.shape[1])])
        value = np.concatenate([1 / np.sqrt(distinct[row]), np.full(cell.size, 0.5)])
        order = np.argsort(rows, kind="stable")
        yield a, b - a, rows[order], np.concatenate([word, cell.reshape(-1)])[order], value[order].astype(np.float32)


def machine(rows: int, row: np.ndarray, feature: np.ndarray, value: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """Scores before the logistic function; ``weights``: features x (linear weight and factors)."""
    if not rows:
        return np.zeros(0)
    cut = np.searchsorted(row, np.arange(rows))
    x = weights[feature] * value[:, None]
    total = np.add.reduceat(x, cut, axis=0)
    squares = np.add.reduceat((x[:, 1:] ** 2).sum(axis=1), cut)
    return bias + total[:, 0] + 0.5 * ((total[:, 1:] ** 2).sum(axis=1) - squares)


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], size: int, seed: int = 3) -> tuple[np.ndarray, float]:
    """Adaptive gradient steps on the logistic loss, in small batches."""
    rng = np.random.default_rng(seed)
    weights = np.concatenate([np.zeros((size, 1)), rng.normal(0, 0.05, (size, RANK))], axis=1).astype(np.float32)
    past, bias, rate = np.full_like(weights, 1e-3), 0.0, 0.1
    y = np.array([s[2] for s in samples], np.float32)
    for _ in range(ROUNDS):
        order = rng.permutation(len(samples))
        for i in range(0, len(order), 64):
            at = order[i : i + 64]
            n = [len(samples[j][0]) for j in at]
            row = np.repeat(np.arange(len(at)), n)
            feature = np.concatenate([samples[j][0] for j in at])
            value = np.concatenate([samples[j][1] for j in at])
            z = machine(len(at), row, feature, value, weights, bias)
            error = (1 / (1 + np.exp(-z)) - y[at]).astype(np.float32)
            x = weights[feature, 1:] * value[:, None]
            total = np.add.reduceat(x, np.searchsorted(row, np.arange(len(at))), axis=0)
            grad = np.concatenate([value[:, None], value[:, None] * (total[row] - x)], axis=1) * error[row][:, None]
            order_f = np.argsort(feature, kind="stable")
            own, cut = np.unique(feature[order_f], return_index=True)
            step = np.add.reduceat(grad[order_f], cut, axis=0) / np.float32(len(at)) + np.float32(1e-5) * weights[own]
            past[own] += step**2
            weights[own] -= rate * step / np.sqrt(past[own])
            bias -= rate * float(error.mean())
    return weights, bias


def score_quality(docs: DataFrame, labels: DataFrame, learn, per_class: int = PER_CLASS, learn_bytes: int = LEARN_BYTES, metadata: tuple[str, ...] = ("n_chars",)) -> DataFrame:
    """``doc_id, score`` of every document; ``learn`` says by doc_id which labels may be learnt from."""
    spark = docs.sparkSession
    metadata = [c for c in metadata if c in docs.columns]
    size = (1 << BITS) + (len(STATISTICS) + len(metadata)) * (BINS + 1)
    rows = docs.select("doc_id", "text", *metadata)
    ranked = labels.select("doc_id", F.col("quality").cast("int").alias("label")).filter(F.col("label").isin(0, 1) & learn(F.col("doc_id")))
    sure = ranked.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").select("doc_id", "label")
    chosen = smallest(sure, "label", "doc_id", per_class)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, n, row, feature, value in features(batch.column(2), batch.columns[3:]):
                cut = np.searchsorted(row, np.arange(n + 1))
                each = range(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), batch.column(1).slice(a, n).cast(pa.int64()), pa.array([feature[cut[i] : cut[i + 1]].astype("<i4").tobytes() for i in each]), pa.array([value[cut[i] : cut[i + 1]].tobytes() for i in each])],
                    ["doc_id", "label", "f", "v"],
                )

    train = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("text", *metadata)).alias("row")).select("doc_id", "label", "row.*")
    described = write_table(train.mapInArrow(describe, "doc_id long, label long, f binary, v binary"), "quality-learnt")
    so_far = F.sum(F.length("f") + F.length("v")).over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id"))
    within = described.select("doc_id", so_far.alias("bytes")).filter(F.col("bytes") <= learn_bytes).select("doc_id")
    got = described.join(F.broadcast(within), "doc_id").toLocalIterator()
    samples = sorted(((bytes(r["f"]), bytes(r["v"]), r["label"]) for r in got))
    drop_table(described)
    samples = [(np.frombuffer(f, "<i4"), np.frombuffer(v, np.float32), y) for f, v, y in samples]
    share = np.mean([s[2] for s in samples]) if samples else 0.5
    model = fit(samples, size) if samples and 0 < share < 1 else None
    sent = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, n, row, feature, value in features(batch.column(1), batch.columns[2:]):
                z = machine(n, row, feature, value, *sent.value) if sent.value else np.zeros(n)
                p = 1 / (1 + np.exp(-z.clip(-30, 30))) if sent.value else np.full(n, float(share))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, n), pa.array(p.astype(float))], ["doc_id", "score"])

    return rows.mapInArrow(score, "doc_id long, score double")
