"""Document fingerprints by winnowing.

All k-grams of a text's code points get a rolling hash; of every window of w consecutive hashes the
smallest is kept, the rightmost on ties, with its position. Two texts that share a passage of at least
w + k - 1 code points share a fingerprint, and the position says where. A fingerprint is written as ten
hex digits a kept hash: its 32-bit value and its distance from the one kept before (at most w).

Defined results: a text of fewer than w hashes is one window; one of fewer than k code points is one
gram; an empty or null text has an empty fingerprint. Two empty fingerprints are alike (1), an empty and
another are not (0). Documents follow each other by doc_id, null first; repeated doc_ids by text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import partitions
from .text import U, mix, moved, sliding_min, sums

GRAM, WINDOW = 12, 40
_BASE = 0xB5026F5AA96619E9
_GROUP = 1 << 18  # code points hashed together


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")


def select(texts: list[np.ndarray], k: int = GRAM, w: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text the kept 32-bit hashes and their positions."""
    out, a = [], 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size + len(texts[b]) <= _GROUP):
            size += len(texts[b])
            b += 1
        out += _select(texts[a:b], k, w)
        a = b
    return out


def _select(texts: list[np.ndarray], k: int, w: int) -> list[tuple[np.ndarray, np.ndarray]]:
    n = np.array([len(t) for t in texts])
    cp = np.concatenate(texts).astype(U) + U(1) if n.sum() else np.zeros(0, U)
    total = sums(cp, _BASE)
    first = np.cumsum(n) - n
    h = (mix(moved(total[k:] - total[:-k], np.arange(len(total) - k), _BASE)) >> U(32)).astype(np.uint32) if len(cp) >= k else np.zeros(0, np.uint32)
    _, at = sliding_min(h, w)
    out = []
    for f, size in zip(first.tolist(), n.tolist(), strict=True):
        grams = size - k + 1
        if size == 0:
            out.append((np.zeros(0, np.uint32), np.zeros(0, np.int64)))
        elif grams <= 0:
            whole = mix(moved(total[f + size : f + size + 1] - total[f : f + 1], np.array([f]), _BASE) + U(size)) >> U(32)
            out.append((whole.astype(np.uint32), np.zeros(1, np.int64)))
        elif grams < w:
            own = h[f : f + grams]
            p = grams - 1 - int(np.argmin(own[::-1]))
            out.append((own[p : p + 1], np.array([p])))
        else:
            p = at[f : f + grams - w + 1]
            p = p[np.flatnonzero(np.diff(p, prepend=-1))]
            out.append((h[p], (p - f).astype(np.int64)))
    return out


def written(hashes: np.ndarray, places: np.ndarray) -> str:
    row = np.zeros((len(hashes), 5), np.uint8)
    row[:, :4] = hashes.astype(">u4").view(np.uint8).reshape(-1, 4)
    row[:, 4] = np.diff(places, prepend=0)
    return row.tobytes().hex()


def read_back(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    row = np.frombuffer(bytes.fromhex(fingerprint), np.uint8).reshape(-1, 5)
    return row[:, :4].copy().view(">u4").reshape(-1).astype(np.uint32), np.cumsum(row[:, 4].astype(np.int64))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of the kept hashes (distinct, sorted)."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited_text(cp: np.ndarray, following: np.ndarray) -> np.ndarray:
    n = len(cp) // 4
    return np.concatenate([cp[: len(cp) - n], following[:n]])


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(ids: list, texts: list[np.ndarray]) -> pa.RecordBatch:
    """Rows of all texts but the last, which only follows."""
    edited = [edited_text(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
    own, other = select(texts), select(edited)
    sets, others = [np.unique(h) for h, _ in own], [np.unique(h) for h, _ in other]
    columns = [
        pa.array(ids[:-1], pa.int64()),
        pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(e.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).hexdigest() for e in edited], pa.string()),
        pa.array([written(*x) for x in own[:-1]], pa.string()),
        pa.array([written(*x) for x in other], pa.string()),
        pa.array([likeness(a, b) for a, b in zip(sets[:-1], others, strict=True)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(sets[:-1], sets[1:], strict=True)], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, SCHEMA.replace(",", "").split()[::2])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text (the last quarter replaced by the start of the next
    document's, by ascending doc_id, the first after the last), and their likeness.

    Documents are dealt to ranges of doc_id, sorted within each; the first row of each range also goes
    to the range before it. So only the bounds of the ranges reach the driver."""
    spark = docs.sparkSession
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = partitions(spark)
    bounds = sorted(set(base.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100_000)).first()[0] or []))
    bucket = F.when(F.col("doc_id").isNull(), 0).otherwise(F.expr(f"{len(bounds)} - size(filter(array({','.join(f'{int(b)}L' for b in bounds)}), b -> b >= doc_id))") if bounds else F.lit(0)).cast("int")
    dealt = base.select("doc_id", bucket.alias("range"))
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")
    heads = sorted(((r["range"], r["head"]["doc_id"]) for r in dealt.groupBy("range").agg(F.min(order).alias("head")).collect()), key=lambda x: x[0])
    before = [(b, head, heads[i - 1][0]) for i, (b, head) in enumerate(heads)]  # the first range follows the last
    known = F.broadcast(spark.createDataFrame(before, "range int, head long, before int"))
    rows = base.withColumn("range", bucket).join(known, "range")
    own = F.struct("range", F.lit(0).alias("tail"))
    copies = F.when(F.col("doc_id").eqNullSafe(F.col("head")), F.array(own, F.struct(F.col("before").alias("range"), F.lit(1).alias("tail")))).otherwise(F.array(own))
    rows = rows.select("doc_id", "text", F.explode(copies).alias("to")).select("doc_id", "text", F.col("to.range").alias("range"), F.col("to.tail").alias("tail"))
    order_cols = ["range", "tail", F.col("doc_id").asc_nulls_first(), "text"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, now, closed = [], [], 0, None, False
        for batch in batches:
            for doc, text, rng, tail in zip(*(batch.column(i) for i in range(4)), strict=True):
                rng, tail = rng.as_py(), tail.as_py()
                if rng != now:
                    ids, texts, size, now, closed = [], [], 0, rng, False
                if closed:  # of equal heads only the first follows
                    continue
                ids.append(doc.as_py())
                texts.append(code_points(text.as_py()))
                size += len(texts[-1])
                if tail:
                    closed = True
                if tail or size > 1 << 20:
                    if len(ids) > 1:
                        yield _rows(ids, texts)
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])

    return rows.repartitionByRange(n, "range").sortWithinPartitions(*order_cols).mapInArrow(walk, SCHEMA)
