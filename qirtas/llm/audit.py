"""Audit of filters that are applied one after another, in every order.

A document's failures are five bits. For each of the 32 combinations and the 120 orders a table, made beforehand, says at
which step a document is removed. Tasks look their rows up in it and add up, by ``np.bincount``, what each part, order and
step removes, with and without labels; Spark adds up the tasks' arrays. All measures are sums, so nothing but these arrays
is shuffled after the documents' bits.

Filters (a document fails): A under 200 words; B under half of its words distinct; C over 3 % capitals A-Z; D one of the
marks ``#$%&*|``; E its text is that of a smaller doc_id. Words are ``[^\\x20\\x09-\\x0D]+``. A text is measured in one
pass; its digest (SHA-256) stands for it where texts are compared.

Defined results: a null text is empty; empty texts equal each other; a null doc_id is no smaller than any and has no
smaller one; rows of equal doc_id are documents of their own, equal to each other without failing E; a label counts if any
of the doc_id's rows has it; a null lang is the part of the empty string; other columns, whatever their names, are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import FEW, HOT_KEYS, write_table
from .text import no_nulls

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
WORDS_LEAST, DISTINCT_PERCENT, CAPITALS_PERCENT = 200, 50, 3
MARKS, CAPITALS, LATER = b"#$%&*|", bytes(range(65, 91)), bytes(range(0x80, 0xC0))
PIECE, PARTS = 4 << 20, 64
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_WHICH = np.array([[FILTERS.index(c) for c in order] for order in ORDERS])  # orders x steps: the filter


def first_failures() -> np.ndarray:
    """Combinations x orders: the step (from 0) at which a document is removed, or the number of filters if it stays."""
    fails = (np.arange(1 << len(FILTERS))[:, None, None] >> _WHICH[None]) & 1
    return np.where(fails.any(axis=2), fails.argmax(axis=2), len(FILTERS))


FIRST = first_failures()


def words_of(raw: bytes) -> tuple[int, int]:
    """Number of words and of distinct words; a long text is cut into pieces at white space, so only its distinct words are
    held at once."""
    if len(raw) <= PIECE:
        words = raw.split()
        return len(words), len(set(words))
    n, kinds, a = 0, set(), 0
    while a < len(raw):
        b = a + PIECE
        while b < len(raw) and not raw[b : b + 1].isspace():
            b += 1
        words = raw[a:b].split()
        n, a = n + len(words), b
        kinds.update(words)
    return n, len(kinds)


def failures(raw: bytes) -> int:
    """Bits of A to D."""
    n, distinct = words_of(raw)
    out = (n < WORDS_LEAST) | (100 * distinct < DISTINCT_PERCENT * n) << 1
    points = len(raw.translate(None, LATER))
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return out | (100 * capitals > CAPITALS_PERCENT * points) << 2 | any(m in raw for m in MARKS) << 3


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, part, mask, digest`` of rows of doc_id, part and text."""
    for batch in batches:
        texts = no_nulls(batch.column(2)).cast(pa.large_binary())
        mask, digest = [], []
        for t in texts:
            raw = t.as_py()
            mask.append(failures(raw))
            digest.append(hashlib.sha256(raw).digest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(mask, pa.int32()), pa.array(digest, pa.binary())], ["doc_id", "part", "mask", "digest"])


def failing_all(rows: DataFrame) -> DataFrame:
    """``rows`` with bit E set in ``mask``. Only texts that occur more than once are joined; those of very many rows go to
    every task, the others are shuffled without their texts."""
    named = rows.filter("doc_id is not null")
    groups = named.groupBy("digest").agg(F.count("*").alias("rows"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    groups = write_table(groups.filter("last > first").select("digest", "rows", "first"), "audit-copies")
    most = max(FEW, (groups.agg(F.sum("rows")).first()[0] or 0) // HOT_KEYS)
    hot, cold = F.broadcast(groups.filter(F.col("rows") > most).drop("rows")), groups.filter(F.col("rows") <= most).drop("rows")
    fails = F.when(F.col("doc_id") > F.col("first"), F.col("mask").bitwiseOR(1 << FILTERS.index("E"))).otherwise(F.col("mask")).alias("mask")
    columns = ("doc_id", "part")
    in_hot = named.join(hot, "digest").select(*columns, fails)
    others = named.join(F.broadcast(groups.filter(F.col("rows") > most).select("digest")), "digest", "left_anti").join(cold, "digest", "left").select(*columns, fails)
    return in_hot.unionByName(others).unionByName(rows.filter("doc_id is null").select(*columns, "mask"))


def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of rows of part, mask, good and toxic: a row for each part, order and step."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        parts = batch.column(0).dictionary_encode()
        names, part = parts.dictionary.to_pylist(), parts.indices.to_numpy()
        mask = batch.column(1).to_numpy()
        label = np.stack([np.ones(len(mask)), batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(zero_copy_only=False)]).astype(float)
        for i, name in enumerate(names):
            own = part == i
            if name not in held:
                if len(held) >= PARTS:
                    yield from _sums(held)
                    held.clear()
                held[name] = np.zeros((4, len(ORDERS), len(FILTERS) + 1), np.int64)
            _add(held[name], mask[own], label[:, own])
    yield from _sums(held)


def _add(total: np.ndarray, mask: np.ndarray, label: np.ndarray) -> None:
    """``total``: by label (all, good, toxic), order and step (the last: never removed), and the rows by combination."""
    steps, orders = len(FILTERS) + 1, len(ORDERS)
    for a in range(0, len(mask), 4096):
        m = mask[a : a + 4096]
        at = (FIRST[m] + np.arange(orders) * steps).reshape(-1)
        for j in range(3):
            total[j] += np.bincount(at, np.repeat(label[j, a : a + 4096], orders), orders * steps).astype(np.int64).reshape(orders, steps)
    total[3].reshape(-1)[: len(FIRST)] += np.bincount(mask, minlength=len(FIRST))


def _sums(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    n = len(FILTERS)
    masks = np.arange(1 << n)
    for name, (removed, good, toxic, combined) in held.items():
        rows = combined.reshape(-1)[: 1 << n]
        failing = np.array([rows[(masks >> f) & 1 == 1].sum() for f in range(n)])
        alone = np.array([rows[1 << f] for f in range(n)])
        here = removed[:, :n]
        shapley = np.array([here[_WHICH == f].sum() for f in range(n)])
        kept = rows.sum() - np.cumsum(here, axis=1)
        values = (kept, here, failing[_WHICH] - here, alone[_WHICH], good[:, :n], toxic[:, :n], shapley[_WHICH])
        size = len(ORDERS) * n
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * size, pa.string()), pa.array(np.repeat(ORDERS, n).tolist(), pa.string()), pa.array(np.tile(np.arange(1, n + 1), len(ORDERS)).astype(np.int32)), *[pa.array(v.reshape(-1).astype(np.int64)) for v in values]],
            ["part", "filter_order", "step", *MEASURES],
        )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and the measures: kept after the step, removed there, failing its filter but removed
    earlier, failing its filter alone, good and toxic ones removed there, removed by the filter over all orders."""
    part = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")
    rows = docs.select("doc_id", part, "text").mapInArrow(measure, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, part string, mask int, digest binary")
    rows = failing_all(write_table(rows, "audit-rows"))
    marked = labels.groupBy(F.col("doc_id").alias("key")).agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    marked = marked.filter("key is not null and (good or toxic)")
    no = F.lit(False)
    known = rows.filter("doc_id is not null").join(marked, F.col("doc_id") == F.col("key"), "left").select("part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    nameless = rows.filter("doc_id is null").select("part", "mask", no.alias("good"), no.alias("toxic"))
    sums = ", ".join(f"{m} long" for m in MEASURES)
    partial = known.unionByName(nameless).mapInArrow(look_up, f"part string, filter_order string, step int, {sums}")
    return partial.groupBy("part", "filter_order", "step").agg(*[F.sum(m).alias(m) for m in MEASURES])
