"""Language identification by a string kernel.

The kernel compares the sets of byte n-grams (n from 2 to 4, lower case) that occur in two texts: the
number in common over the geometric mean of their numbers, a blended spectrum of presence. ``LANDMARKS``
labelled texts stand for all others (Nystroem): a text is described by its kernel values with them,
whitened by the landmarks' own kernel matrix, and one ridge regression a language is fitted on at most
``PER_LANG`` labelled rows of each language, those of the smallest hash. As both steps are linear in the
kernel values, landmarks and weights are multiplied once; a batch of texts is then one matrix product.

Sets are kept over all 2**16 hashed n-grams, so no n-gram is left out, however rare its language. Only the
labelled rows' sets reach the driver, as bits.

Defined results: a null text or one without a letter is ``und`` with score 0; so is every text when
nothing could be learnt. Repeated rows are predicted each; rows of equal doc_id and text count once among the labelled
ones. Other columns, whatever their names, are not read; those of ``keep`` are passed on. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ngrams import LETTERS, gram_codes, lowered, rows_of
from .shared import smallest
from .text import flat, give_back, slices

PER_LANG, LANDMARKS, SIZES, RIDGE = 1024, 256, (2, 3, 4), 1e-3
HASHED, CUT = 1 << 16, 1 << 10
UNKNOWN = "und"


def marks(data: np.ndarray, off: np.ndarray, slot: np.ndarray, width: int) -> np.ndarray:
    """Rows x slots: does an n-gram of the slot occur?"""
    out = np.zeros((len(off) - 1, width), bool)
    low, row, end = lowered(data), rows_of(off), np.repeat(off[1:], np.diff(off))
    for n in SIZES:
        code = gram_codes(low, n)
        own = slot[((code * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(16)).astype(np.int32)]
        inside = np.arange(len(code)) + n <= end[: len(code)]
        out[row[: len(code)][inside], own[inside]] = True
    return out


def has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(LETTERS[data])])
    out = np.diff(total[off]) > 0
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in data[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def cut_up(texts: pa.Array, rows: int = 64) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = flat(texts)
    for a, b in slices(offsets):
        for x in range(a, b, rows):
            y = min(b, x + rows)
            yield x, y, data[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x]


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many n-grams each two sets, given as bits, have in common; a few rows and columns are unpacked at a time."""
    out = np.zeros((len(a), len(b)))
    for c in range(0, a.shape[1], CUT):
        right = np.unpackbits(b[:, c : c + CUT], axis=1).astype(np.float32).T
        for r in range(0, len(a), 256):
            out[r : r + 256] += np.unpackbits(a[r : r + 256, c : c + CUT], axis=1).astype(np.float32) @ right
    return out


def roots(sets: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(np.bitwise_count(sets).sum(axis=1, dtype=np.int64), 1))


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return common(a, b) / roots(a)[:, None] / roots(b)[None, :]


def fit(packed: np.ndarray, langs: list[str], landmarks: int, seed: int = 5) -> tuple[np.ndarray, list[str]] | None:
    """The product of landmarks and weights (hashed n-grams x languages), languages.
    ``packed``: the labelled rows' sets, a bit an n-gram."""
    names = sorted(set(langs))
    if not names:
        return None
    y = np.array([[1.0 if lang == name else -1.0 for name in names] for lang in langs])
    rng = np.random.default_rng(seed)
    own = [rng.permutation(np.flatnonzero(y[:, j] > 0)) for j in range(len(names))]
    chosen = np.array([i for turn in range(landmarks) for o in own if turn < len(o) for i in [o[turn]]][:landmarks])
    z = packed[chosen]
    found, vectors = np.linalg.eigh(kernel(z, z))
    keep = found > 1e-6
    white = vectors[:, keep] / np.sqrt(found[keep])
    phi = kernel(packed, z) @ white
    weight = len(langs) / (len(names) * np.maximum((y > 0).sum(axis=0), 1))
    each = np.array([weight[names.index(lang)] for lang in langs])[:, None]
    w = np.linalg.solve(phi.T @ (phi * each) + RIDGE * len(langs) * np.eye(phi.shape[1]), phi.T @ (y * each))
    scaled = ((white @ w) / roots(z)[:, None]).astype(np.float32)
    product = [np.unpackbits(z[:, c : c + CUT], axis=1).astype(np.float32).T @ scaled for c in range(0, z.shape[1], CUT)]
    return np.concatenate(product), names


def values(sets: np.ndarray, product: np.ndarray) -> np.ndarray:
    """Rows x languages: the sum of the product over a row's n-grams by the root of their number."""
    size, out = sets.sum(axis=1), np.zeros((len(sets), product.shape[1]))
    at = np.flatnonzero(sets) % sets.shape[1]
    some = size > 0
    if some.any():
        out[some] = np.add.reduceat(product[at], (np.cumsum(size) - size)[some], axis=0)
    return out / np.sqrt(np.maximum(size, 1))[:, None]


def predict_language(docs: DataFrame, learn, per_lang: int = PER_LANG, landmarks: int = LANDMARKS, keep: list[str] | None = None) -> DataFrame:
    """``doc_id, lang_pred, score``, and the columns of ``keep`` as a struct ``row``; ``learn`` says by doc_id which languages may
    be learnt."""
    spark = docs.sparkSession
    key = F.xxhash64("doc_id", "text")
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & learn(F.col("doc_id"))).select("lang", key.alias("key"))
    chosen = smallest(known, "lang", "key", per_lang)

    every = np.arange(HASHED, dtype=np.int32)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y, data, off in cut_up(batch.column(1)):
                bits = np.packbits(marks(data, off, every, HASHED), axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(x, y - x), pa.array([b.tobytes() for b in bits])], ["lang", "bits"])

    labelled = docs.select("lang", "text", key.alias("key"), "doc_id").filter(learn(F.col("doc_id"))).join(F.broadcast(chosen), ["lang", "key"])
    labelled = labelled.groupBy("lang", "key").agg(F.min("text").alias("text"))
    got = sorted((r["lang"], bytes(r["bits"])) for r in labelled.select("lang", "text").mapInArrow(describe, "lang string, bits binary").toLocalIterator())
    packed, langs = np.frombuffer(b"".join(b for _, b in got), np.uint8).reshape(len(got), HASHED // 8), [lang for lang, _ in got]
    del got
    sent = spark.sparkContext.broadcast(fit(packed, langs, landmarks))
    del packed
    give_back()
    keep = keep or []
    others = [c for c in keep if c not in ("doc_id", "text")]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for x, y, data, off in cut_up(batch.column(1)):
                letter = has_letter(data, off)
                if sent.value is None:
                    langs += [UNKNOWN] * (y - x)
                    scores.append(np.zeros(y - x))
                    continue
                product, names = sent.value
                f = values(marks(data, off, every, HASHED), product)
                p = np.exp(4 * (f - f.max(axis=1, keepdims=True)))
                p /= p.sum(axis=1, keepdims=True)
                best = p.argmax(axis=1)
                langs += [names[i] if ok else UNKNOWN for i, ok in zip(best, letter, strict=True)]
                scores.append(np.where(letter, p.max(axis=1), 0.0))
            score = np.concatenate(scores).astype(float) if scores else np.zeros(0)
            rest = [*batch.columns[2:], *([batch.column(1)] if "text" in keep else [])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(score), *rest], schema.names)

    kinds = {"doc_id": docs.schema["doc_id"].dataType, "lang_pred": T.StringType(), "score": T.DoubleType()} | {f"_{i}": docs.schema[c].dataType for i, c in enumerate(others)}
    schema = T.StructType([T.StructField(n, t) for n, t in (kinds | ({"_text": T.StringType()} if "text" in keep else {})).items()])
    out = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)]).mapInArrow(predict, schema)
    if not keep:
        return out
    place = {"doc_id": "doc_id", "text": "_text"} | {c: f"_{i}" for i, c in enumerate(others)}
    return out.select("doc_id", "lang_pred", "score", F.struct(*[F.col(place[c]).alias(c) for c in keep]).alias("row"))
