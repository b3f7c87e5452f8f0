"""Numeric operators on grey pages: rows with width, height and one byte a pixel, row by row. Arrow batches of pages; the
arrays of one page are in memory at a time."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INK, PAPER = 235, 245  # fixed values: darker than the first is ink, than the second not white
BOX = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("x1", "y1", "x2", "y2")]))
RANGES = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("start", "end")]))


def image(width: int, height: int, grey: bytes | None) -> np.ndarray:
    return np.frombuffer(grey or b"", np.uint8)[: width * height].reshape(height, width) if width and height else np.zeros((0, 0), np.uint8)


def islands(mask: np.ndarray, max_gap: int, min_length: int) -> list[tuple[int, int]]:
    """Runs of true values over gaps of up to ``max_gap``; the last runs on to the end unless a longer gap follows it."""
    at = np.flatnonzero(mask)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) - 1 > max_gap)
    begin, end = at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])] + 1
    if len(mask) - end[-1] <= max_gap:
        end[-1] = len(mask)
    return [(int(a), int(b)) for a, b in zip(begin, end, strict=True) if b - a >= min_length]


def widened(x1: int, y1: int, x2: int, y2: int, width: int, height: int) -> tuple[int, int, int, int]:
    dx, dy = max(12, width // 120), max(10, height // 180)
    return max(0, x1 - dx), max(0, y1 - dy), min(width, x2 + dx), min(height, y2 + dy)


def ink_blocks(grey: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Bands of rows with ink, and their columns where there are several; nothing for a page of one block."""
    ink = grey < INK
    height, width = ink.shape
    if not ink.any():
        return []
    rows = islands(ink.sum(axis=1) > max(8, int(width * 0.01)), max(12, height // 120), max(24, height // 80))
    boxes = []
    for top, bottom in rows:
        columns = islands(ink[top:bottom].sum(axis=0) > max(6, int(max(bottom - top, 1) * 0.03)), max(24, width // 80), max(48, width // 12))
        boxes += [widened(a, top, b, bottom, width, height) for a, b in (columns if len(columns) >= 2 else [(0, width)])]
    return boxes if len(boxes) > 1 else []


def ink_lines(grey: np.ndarray) -> list[tuple[int, int]]:
    """Rows of text within a block."""
    ink = grey < INK
    height, width = ink.shape
    if not ink.any():
        return []
    return islands(ink.sum(axis=1) > max(6, int(width * 0.008)), max(4, height // 180), max(8, height // 300))


def chunk_rows(grey: np.ndarray, target: int = 1600, overlap: int = 180, search: int = 220) -> list[tuple[int, int]]:
    """A tall page in overlapping chunks, each cut at the row of least ink near its due height; none for a page of one."""
    height = len(grey)
    if height <= target + overlap:
        return []
    ink, least = (grey < INK).sum(axis=1), max(target // 2, 900)
    out, start = [], 0
    while True:
        due = min(height, start + target)
        end, low, high = due, max(start + least, due - search), min(height - 1, due + search)
        if due < height and high > low:
            end = max(low + int(np.argmin(ink[low : high + 1])), start + least)
        out.append((start, end))
        if end >= height:
            break
        following = max(0, end - overlap)
        start = following if following > start else min(height, start + least)
        if start >= height:
            break
    return out if len(out) > 1 else []


def not_white(grey: np.ndarray) -> float:
    return float((grey < PAPER).mean()) if grey.size else 0.0


def _over(kind: T.DataType, work: Callable, pack: Callable):
    @F.pandas_udf(kind)
    def run(width: pd.Series, height: pd.Series, grey: pd.Series) -> pd.Series:
        return pd.Series([pack(work(image(int(w or 0), int(h or 0), g))) for w, h, g in zip(width, height, grey, strict=True)], dtype=float if kind == T.DoubleType() else object)

    return run


_boxes = lambda own: [dict(zip(("x1", "y1", "x2", "y2"), b, strict=True)) for b in own]
_ranges = lambda own: [{"start": a, "end": b} for a, b in own]
block_boxes = _over(BOX, lambda g: ink_blocks(g) if g.size else [], _boxes)
line_ranges = _over(RANGES, lambda g: ink_lines(g) if g.size else [], _ranges)
chunk_ranges = _over(RANGES, chunk_rows, _ranges)
not_white_share = _over(T.DoubleType(), not_white, float)


@F.pandas_udf(T.DoubleType())
def mean_square_error(a: pd.Series, b: pd.Series) -> pd.Series:
    """Of two pages of one size; null where the sizes differ."""
    pair = lambda x, y: None if x is None or y is None or len(x) != len(y) else float(np.mean((np.frombuffer(x, np.uint8).astype(np.float32) - np.frombuffer(y, np.uint8).astype(np.float32)) ** 2))
    return pd.Series([pair(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


def regions(pages: DataFrame, key: str) -> DataFrame:
    """Every page's blocks (``label``, ``confidence`` and box), or the full page where there are none."""
    boxes = block_boxes("width", "height", "grey")
    own = pages.select(key, "width", "height", boxes.alias("b"))
    whole = F.array(F.struct(F.lit(0).alias("x1"), F.lit(0).alias("y1"), F.col("width").cast("int").alias("x2"), F.col("height").cast("int").alias("y2")))
    none = F.size("b") == 0
    rows = own.select(key, none.alias("none"), F.posexplode(F.when(none, whole).otherwise(F.col("b"))).alias("region", "b"))
    return rows.select(key, "region", F.when(F.col("none"), "full_page").otherwise("heuristic_block").alias("label"), F.when(F.col("none"), 1.0).otherwise(0.6).alias("confidence"), "b.x1", "b.y1", "b.x2", "b.y2")


def worth_chunking(width: Column, height: Column, n_tokens: Column, n_lines: Column, trigger: Column) -> Column:
    """Whether an under-read crop is read again in chunks: large ones only."""
    area = width * height
    wanted = trigger.isin("sparse_large_crop", "under_read_large_crop") | ((trigger == "empty") & (height >= 2200)) | ((trigger == "low_quality") & (area >= 5_000_000) & (n_tokens < 120)) | ((area >= 8_000_000) & (n_lines < 8))
    return ~((height < 1800) & (area < 5_000_000)) & F.coalesce(wanted, F.lit(False))
