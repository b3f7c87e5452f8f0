"""Grey pages made ready for reading: histograms and Otsu's threshold, local thresholds by sums over rectangles, equal and
limited contrast, median, sharpening, skew by row profiles.

Histograms leave a task as at most 256 rows a page and the threshold is found by running sums over them, so a page's pixels
never leave the task that read them. The other operators take pages one at a time in Arrow batches.

Defined results: null or empty pages have no histogram and stay empty; a page of one value has that value as threshold and
is not stretched; at a page's border its outermost pixels go on; ties go to the smaller threshold and the smaller turn."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pixels import image

# Limits and tiles of local contrast, window and offset of local thresholds, weights of sharpening, turns tried.
CLIP, TILES = 3.0, 8
WINDOW, OFFSET = 35, 11
SHARP, SHARP_SIGMA = 1.5, 1.0
MOST_TURN, LEAST_TURN, STEP = 15.0, 0.5, 0.25


def histograms(pages: DataFrame, key: str, grey: str = "grey") -> DataFrame:
    """``key, value, n``: how many pixels of each value a page has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_buffer()
                n = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256, np.int64)
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[i].as_py()] * len(at), batch.column(0).type), pa.array(at.astype(np.int32)), pa.array(n[at])], [key, "value", "n"])

    return pages.select(key, F.col(grey).cast("binary").alias("grey")).mapInArrow(count, f"`{key}` {pages.schema[key].dataType.simpleString()}, value int, n long")


def otsu_thresholds(counts: DataFrame, key: str) -> DataFrame:
    """``key, threshold, dark, pixels``: the value up to which pixels are dark, so that dark and light ones differ most between
    and least within. ``counts`` (value, n) has a row a page and value."""
    upto = Window.partitionBy(key).orderBy("value")
    whole = Window.partitionBy(key)
    mass = F.col("value") * F.col("n")
    sums = counts.select(key, "value", F.sum("n").over(upto).alias("n0"), F.sum(mass).over(upto).alias("s0"), F.sum("n").over(whole).alias("n"), F.sum(mass).over(whole).alias("s"))
    apart = F.col("s0") / F.col("n0") - (F.col("s") - F.col("s0")) / F.nullif(F.col("n") - F.col("n0"), F.lit(0))
    between = F.col("n0").cast("double") * (F.col("n") - F.col("n0")).cast("double") * (apart * apart)
    best = F.min_by(F.struct("value", "n0", "n"), F.struct(-F.coalesce(between, F.lit(-1.0)), "value"))
    return sums.groupBy(key).agg(best.alias("b")).select(key, F.col("b.value").alias("threshold"), F.col("b.n0").alias("dark"), F.col("b.n").alias("pixels"))


def otsu(grey: np.ndarray) -> int:
    n = np.bincount(grey.reshape(-1), minlength=256).astype(float)
    n0, s0 = np.cumsum(n), np.cumsum(n * np.arange(256))
    rest = n0[-1] - n0
    with np.errstate(divide="ignore", invalid="ignore"):
        between = n0 * rest * (s0 / n0 - (s0[-1] - s0) / rest) ** 2
    between[(n0 == 0) | (rest == 0)] = -1.0
    return int(np.argmax(between)) if between.max() >= 0 else int(grey.reshape(-1)[0])


def integral(grey: np.ndarray) -> np.ndarray:
    """Sums of all rectangles that begin at the corner."""
    out = np.zeros((grey.shape[0] + 1, grey.shape[1] + 1), np.int64)
    out[1:, 1:] = grey.cumsum(axis=0, dtype=np.int64).cumsum(axis=1)
    return out


def window_means(grey: np.ndarray, size: int) -> np.ndarray:
    """Means of the squares around each pixel, by four places of the integral image whatever their size."""
    total = integral(np.pad(grey, size // 2, mode="edge"))
    return (total[size:, size:] - total[:-size, size:] - total[size:, :-size] + total[:-size, :-size]) / (size * size)


def smoothed(grey: np.ndarray, sigma: float, radius: int | None = None) -> np.ndarray:
    """By a Gaussian, rows and then columns."""
    r = radius if radius is not None else max(1, round(4 * sigma))
    weights = np.exp(-(np.arange(-r, r + 1) ** 2) / (2 * sigma * sigma))
    weights /= weights.sum()
    out = np.pad(grey.astype(float), r, mode="edge")
    out = sum(w * out[:, i : i + grey.shape[1]] for i, w in enumerate(weights))
    return sum(w * out[i : i + grey.shape[0]] for i, w in enumerate(weights))


def local_threshold(grey: np.ndarray, size: int = WINDOW, offset: float = OFFSET, weighted: bool = False) -> np.ndarray:
    """White where a pixel is lighter than its surroundings less ``offset``, else black."""
    mean = smoothed(grey, 0.3 * ((size - 1) * 0.5 - 1) + 0.8, size // 2) if weighted else window_means(grey, size)
    return np.where(grey > np.rint(mean) - offset, 255, 0).astype(np.uint8)


def stretched(grey: np.ndarray, cutoff: float = 1.0) -> np.ndarray:
    """The values but ``cutoff`` per cent at either end, stretched to all."""
    n = np.bincount(grey.reshape(-1), minlength=256)
    cut = int(grey.size * cutoff // 100)
    low, high = int(np.argmax(np.cumsum(n) > cut)), 255 - int(np.argmax(np.cumsum(n[::-1]) > cut))
    if high <= low:
        return grey
    scale = 255.0 / (high - low)
    return np.clip(np.floor(np.arange(256) * scale - low * scale), 0, 255).astype(np.uint8)[grey]


def equalised(grey: np.ndarray) -> np.ndarray:
    """Every value as often as every other, as far as that goes."""
    n = np.bincount(grey.reshape(-1), minlength=256)
    first = int(np.argmax(n > 0))
    if n[first] == grey.size:
        return grey
    table = np.rint((np.cumsum(n) - n[first]) * (255.0 / (grey.size - n[first])))
    return np.clip(table, 0, 255).astype(np.uint8)[grey]


def limited_contrast(grey: np.ndarray, clip: float = CLIP, tiles: int = TILES) -> np.ndarray:
    """Equalised tile by tile, no value counting more than ``clip`` times its share; between the tiles' middles their tables are
    mixed by distance."""
    height, width = grey.shape
    h, w = -(-height // tiles), -(-width // tiles)
    padded = np.pad(grey, ((0, h * tiles - height), (0, w * tiles - width)), mode="edge")
    tables = np.empty((tiles, tiles, 256))
    most = max(int(clip * h * w / 256), 1)
    for a in range(tiles):
        for b in range(tiles):
            n = np.bincount(padded[a * h : (a + 1) * h, b * w : (b + 1) * w].reshape(-1), minlength=256)
            over = int((n - most).clip(0).sum())
            n = np.minimum(n, most) + over // 256
            left = over % 256
            if left:
                n[:: max(256 // left, 1)][:left] += 1
            tables[a, b] = np.clip(np.rint(np.cumsum(n) * (255.0 / (h * w))), 0, 255)
    y, x = (np.arange(height) + 0.5) / h - 0.5, (np.arange(width) + 0.5) / w - 0.5
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    at = lambda i, j: tables[np.clip(i, 0, tiles - 1)[:, None], np.clip(j, 0, tiles - 1)[None, :], grey]
    top, bottom = at(y0, x0) * (1 - fx) + at(y0, x0 + 1) * fx, at(y0 + 1, x0) * (1 - fx) + at(y0 + 1, x0 + 1) * fx
    return np.clip(np.rint(top * (1 - fy) + bottom * fy), 0, 255).astype(np.uint8)


def median3(grey: np.ndarray) -> np.ndarray:
    p = np.pad(grey, 1, mode="edge")
    return np.median(np.stack([p[i : i + grey.shape[0], j : j + grey.shape[1]] for i in range(3) for j in range(3)]), axis=0).astype(np.uint8)


def sharpened(grey: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(SHARP * grey + (1 - SHARP) * smoothed(grey, SHARP_SIGMA)), 0, 255).astype(np.uint8)


def profile_spread(dark: np.ndarray, turn: float) -> float:
    """How unevenly the rows of a page, sheared by ``turn`` degrees, are filled."""
    y, x = np.nonzero(dark)
    row = np.rint(y - (x - dark.shape[1] // 2) * np.tan(np.radians(turn))).astype(int)
    n = np.bincount(row - row.min()).astype(float)
    return float((n**2).sum())


def skew(grey: np.ndarray) -> float:
    """Degrees by which lines of text fall to the right: the turn that fills rows most unevenly, coarse steps first."""
    dark = grey <= otsu(grey)
    if not dark.any() or dark.all():
        return 0.0
    best = lambda turns: min(turns, key=lambda t: (-profile_spread(dark, t), abs(t), t))
    coarse = best(np.arange(-MOST_TURN, MOST_TURN + 1, 1.0).tolist())
    return float(best(np.arange(coarse - 1, coarse + 1 + STEP, STEP).tolist()))


def straightened(grey: np.ndarray) -> np.ndarray:
    """Turned back about its middle, between pixels by distance; a turn of less than half a degree stays."""
    turn = skew(grey)
    if abs(turn) < LEAST_TURN:
        return grey
    height, width = grey.shape
    c, s = np.cos(np.radians(turn)), np.sin(np.radians(turn))
    y, x = np.mgrid[:height, :width].astype(float)
    y, x = y - height // 2, x - width // 2
    sx, sy = np.clip(c * x - s * y + width // 2, 0, width - 1), np.clip(s * x + c * y + height // 2, 0, height - 1)
    x0, y0 = np.minimum(sx.astype(int), max(width - 2, 0)), np.minimum(sy.astype(int), max(height - 2, 0))
    x1, y1, fx, fy = np.minimum(x0 + 1, width - 1), np.minimum(y0 + 1, height - 1), sx - x0, sy - y0
    g = grey.astype(float)
    out = (g[y0, x0] * (1 - fx) + g[y0, x1] * fx) * (1 - fy) + (g[y1, x0] * (1 - fx) + g[y1, x1] * fx) * fy
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def prepared(grey: np.ndarray) -> np.ndarray:
    """Local contrast, less noise, straight lines."""
    return straightened(median3(limited_contrast(grey)))


VARIANTS: dict[str, Callable[[np.ndarray], np.ndarray]] = {
    "raw": lambda g: g, "clahe": lambda g: limited_contrast(g, 2.0), "sharp": sharpened, "binary": lambda g: np.where(g > otsu(g), 255, 0).astype(np.uint8),
    "adaptive": lambda g: local_threshold(g, weighted=True), "local": local_threshold, "contrast": stretched, "equal": equalised, "prepared": prepared,
}


def page_variants(pages: DataFrame, key: str, names: list[str]) -> DataFrame:
    """``key, variant, width, height, grey``: each page (width, height, grey) in each of the named variants."""
    if wrong := sorted(set(names) - set(VARIANTS)):
        raise ValueError(f"unknown variants {wrong}; there are {sorted(VARIANTS)}")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                w, h = batch.column(1)[i].as_py() or 0, batch.column(2)[i].as_py() or 0
                raw = batch.column(3)[i].as_py() or b""
                page = image(w, h, raw) if len(raw) >= w * h else np.zeros((0, 0), np.uint8)
                done = [(VARIANTS[n](page) if page.size else page).tobytes() for n in names]
                cells = [pa.array([batch.column(0)[i].as_py()] * len(names), batch.column(0).type), pa.array(names, pa.string()), pa.array([page.shape[1]] * len(names), pa.int32()), pa.array([page.shape[0]] * len(names), pa.int32()), pa.array(done, pa.binary())]
                yield pa.RecordBatch.from_arrays(cells, [key, "variant", "width", "height", "grey"])

    rows = pages.select(key, F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"), F.col("grey").cast("binary").alias("grey"))
    return rows.mapInArrow(make, f"`{key}` {pages.schema[key].dataType.simpleString()}, variant string, width int, height int, grey binary")
