"""Arrow-based functions for what Spark has no expression for: Unicode normal forms and character classes,
difflib matching, token edit distance, token overlap."""

from __future__ import annotations

import difflib
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def _rtl_share(text: str | None) -> float:
    if not text or text.isascii():
        return 0.0
    _, left, right = np.bincount(_strong()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)], minlength=3).tolist()
    return right / (right + left) if right + left else 0.0


@cache
def _strong() -> np.ndarray:
    """By code point: 1 for left-to-right, 2 for right-to-left letters and Arabic digits, else 0."""
    kinds = {"L": 1, "R": 2, "AL": 2, "AN": 2}
    return np.array([kinds.get(unicodedata.bidirectional(chr(i)), 0) for i in range(0x110000)], np.uint8)


@F.pandas_udf(T.DoubleType())
def rtl_ratio(text: pd.Series) -> pd.Series:
    """Share of right-to-left among the characters with a strong direction (Arabic digits count)."""
    return text.map(_rtl_share).astype(float)


@F.pandas_udf(T.StructType().add("disagreements", T.IntegerType()).add("total_words", T.IntegerType()).add("confidence", T.DoubleType()))
def word_agreement(left: pd.Series, right: pd.Series) -> pd.DataFrame:
    """Number of differing spans of two word lists as difflib matches them, and the confidence that leaves."""
    rows = []
    for a, b in zip(left.fillna(""), right.fillna(""), strict=True):
        x, y = a.split(), b.split()
        n = max(len(x), len(y))
        d = 0 if x == y else sum(op[0] != "equal" for op in difflib.SequenceMatcher(None, x, y).get_opcodes())
        rows.append((d, n, max(0.0, 1.0 - d / max(n, 1)) if d else 1.0))
    return pd.DataFrame(rows, columns=["disagreements", "total_words", "confidence"])


@F.pandas_udf(T.DoubleType())
def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """difflib ratio over characters."""
    return pd.Series([difflib.SequenceMatcher(None, a or "", b or "").ratio() for a, b in zip(left, right, strict=True)], dtype=float)


def edit_distance(x: list, y: list) -> int:
    """Unit-cost edit distance of two sequences, a row of the table at a time."""
    if not x or not y:
        return len(x) or len(y)
    names = {v: i for i, v in enumerate(dict.fromkeys([*x, *y]))}
    b, steps = np.array([names[v] for v in y]), np.arange(len(y) + 1)
    row = steps.copy()
    for i, v in enumerate(x, 1):
        best = np.minimum(row[:-1] + (b != names[v]), row[1:] + 1)
        row = np.concatenate([[i], best])
        row = np.minimum.accumulate(row - steps) + steps
    return int(row[-1])


@F.pandas_udf(T.DoubleType())
def word_error_rate(truth: pd.Series, found: pd.Series) -> pd.Series:
    """Token edit distance over the truth's tokens; without any, 0 if nothing was found and else 1."""
    out = []
    for a, b in zip(truth.fillna(""), found.fillna(""), strict=True):
        x, y = a.split(), b.split()
        out.append(edit_distance(x, y) / len(x) if x else float(bool(y)))
    return pd.Series(out, dtype=float)


OVERLAP_ROWS = 64  # documents whose tokens are Python objects at one time


def token_overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows of a key, names and tokens (joined by spaces): for every two names of a row, in order, the share of the one's
    tokens that the other has, both ways. A few rows at a time, as a batch of long texts is large already."""

    def overlap(words: list, there: set) -> float:
        return sum(map(there.__contains__, words)) / len(words) if words and there else 0.0

    for batch in batches:
        for at in range(0, batch.num_rows, OVERLAP_ROWS):
            part, rows, out = batch.slice(at, OVERLAP_ROWS), [], []
            for row, (own, texts) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)):
                words = [t.split() for t in texts]
                sets = [set(w) for w in words]
                named = [i for i, n in enumerate(own) if n is not None]
                found = [(own[i], own[j], overlap(words[i], sets[j]), overlap(words[j], sets[i])) for i in named for j in named if own[i] < own[j]]
                out += found
                rows += [row] * len(found)
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["key", "config", "other", "left_in_right", "right_in_left"])
