"""Pages as thumbnails, and the source page that each differs least from, found by bounds before full comparisons.

The mean square error of two thumbnails is at least that of their block means, weighted by the blocks' sizes, at any scale.
Whole means give an equi-join: pages further apart than the root of the largest error that counts never meet. Those that
do meet in groups of at most ``BLOCK`` targets and ``BLOCK`` sources, so no task holds more; there block means rule out most
pairs, and the rest are compared in full, nearest bound first, until the bound exceeds the best error found.

Defined results: null or empty thumbnails, and those of another size, have no partner; ties go to the smaller name; repeated
rows of a target count as one; ``compared`` says how many full comparisons a target took of the ``pairs`` that met."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .contrast import equalised

# Size and margin of a thumbnail, what is darker than paper, the error from which pages are not alike.
WIDTH, HEIGHT, MARGIN, PAPER, MOST = 256, 330, 0.03, 245, 1000.0
BLOCK, SCALES = 256, (2, 8)


def resized(grey: np.ndarray, width: int, height: int) -> np.ndarray:
    """Each new pixel the mean of the area that it covers."""
    out = grey.astype(float)
    for axis, n in ((0, height), (1, width)):
        old = out.shape[axis]
        sums = np.concatenate([np.zeros_like(np.take(out, [0], axis)), np.cumsum(out, axis=axis)], axis=axis)
        edge = np.arange(n + 1) * (old / n)
        low = np.minimum(edge.astype(int), old - 1)
        part = np.expand_dims(edge - low, 1 - axis)
        at = np.take(sums, low, axis) + part * np.take(out, low, axis)
        out = np.diff(at, axis=axis) * (n / old)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def normalised(grey: np.ndarray, width: int = WIDTH, height: int = HEIGHT) -> np.ndarray:
    """The part with ink and a margin, in the size of thumbnails, with equal contrast."""
    ink = grey <= PAPER
    if ink.any():
        rows, columns = np.flatnonzero(ink.any(axis=1)), np.flatnonzero(ink.any(axis=0))
        pad = int(max(columns[-1] - columns[0] + 1, rows[-1] - rows[0] + 1) * MARGIN)
        grey = grey[max(0, rows[0] - pad) : rows[-1] + 1 + pad, max(0, columns[0] - pad) : columns[-1] + 1 + pad]
    return equalised(resized(grey, width, height))


def block_means(pages: np.ndarray, scale: int) -> np.ndarray:
    """Pages x blocks (``scale`` a side), scaled so that squared distances are lower bounds of mean square errors."""
    n, height, width = pages.shape
    rows, columns = (np.unique(np.arange(scale) * k // scale) for k in (height, width))
    sums = np.add.reduceat(np.add.reduceat(pages.astype(float), rows, axis=1), columns, axis=2)
    sizes = np.diff(np.append(rows, height))[:, None] * np.diff(np.append(columns, width))[None, :]
    return (sums / np.sqrt(sizes * float(height * width))).reshape(n, -1)


def lower_bounds(a: np.ndarray, b: np.ndarray, scale: int) -> np.ndarray:
    x, y = block_means(a, scale), block_means(b, scale)
    return ((x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1)[None] - 2 * x @ y.T).clip(0)


def nearest_in(targets: np.ndarray, sources: np.ndarray, most: float) -> list[tuple[float | None, int, int]]:
    """For each target the least error below ``most``, the first source with it, and the full comparisons made."""
    least = np.maximum.reduce([lower_bounds(targets, sources, s) for s in SCALES])
    out = []
    for i, t in enumerate(targets.astype(float)):
        best, who, compared = most, -1, 0
        for j in np.argsort(least[i], kind="stable").tolist():
            if least[i, j] > best * (1 + 1e-9) + 1e-9:
                break
            error, compared = float(((sources[j] - t) ** 2).sum() / t.size), compared + 1
            if error < best or error == best and who > j:
                best, who = error, j
        out.append((best if who >= 0 else None, who, compared))
    return out


def nearest_pages(targets: DataFrame, sources: DataFrame, target: str, source: str, most: float = MOST, width: int | None = None, block: int = BLOCK) -> DataFrame:
    """``target, source, mse, compared, pairs``; source and error are null where the least error is not below ``most``. Thumbnails
    (``grey``) have ``width`` bytes a row (one row if null)."""
    size = sources.filter("length(grey) > 0").groupBy(F.length("grey").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    size = size[0]["n"] if size else 0
    wide = width or max(size, 1)
    step = float(np.sqrt(most))

    def with_means(batches):
        for batch in batches:
            raw = [g.as_buffer() for g in batch.column(1)]
            mean = [float(np.frombuffer(g, np.uint8).mean()) for g in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.floor(np.array(mean) / step).astype(np.int32))], ["name", "grey", "cell"])

    def placed(df: DataFrame, name: str, salt: str) -> tuple[DataFrame, DataFrame]:
        rows = df.select(F.col(name).cast("string").alias("name"), F.col("grey").cast("binary").alias("grey")).filter(F.length("grey") == size).groupBy("name", "grey").agg(F.count("*").alias("rows")).select("name", "grey")
        rows = rows.mapInArrow(with_means, "name string, grey binary, cell int")
        n = rows.groupBy("cell").agg(F.ceil(F.count("*") / block).alias("blocks"))  # there are no more than 256 / step cells
        return rows.join(F.broadcast(n), "cell").withColumn(salt, F.pmod(F.xxhash64("name"), F.col("blocks"))), n

    left, left_n = placed(targets, target, "x")
    right, right_n = placed(sources, source, "y")
    near = left.withColumn("cell_of", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)))
    near = near.drop("blocks").join(F.broadcast(right_n.select(F.col("cell").alias("cell_of"), F.col("blocks").alias("others"))), "cell_of")
    near = near.select("name", "grey", F.col("cell").alias("own"), "cell_of", "x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).alias("y"))
    around = F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)
    far = right.select("name", "grey", F.col("cell").alias("cell_of"), "y", F.explode(around).alias("own"))
    far = far.join(F.broadcast(left_n.select(F.col("cell").alias("own"), F.col("blocks").alias("others"))), "own")
    far = far.select("name", "grey", "own", "cell_of", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).alias("x"), "y")
    keys = ["own", "cell_of", "x", "y"]

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        names = {"target": [], "source": [], "mse": [], "compared": [], "pairs": []}
        if a.num_rows and b.num_rows:
            b = b.sort_by("name")
            pages = lambda t: np.frombuffer(b"".join(t.column("grey").to_pylist()), np.uint8).reshape(t.num_rows, -1, wide)
            others = b.column("name").to_pylist()
            for name, (error, j, compared) in zip(a.column("name").to_pylist(), nearest_in(pages(a), pages(b), most), strict=True):
                for k, v in zip(names, (name, others[j] if error is not None else None, error, compared, b.num_rows), strict=True):
                    names[k].append(v)
        kinds = (pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64())
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(names.items(), kinds, strict=True)})

    found = near.select(*keys, "name", "grey").groupBy(*keys).cogroup(far.select(*keys, "name", "grey").groupBy(*keys)).applyInArrow(compare, "target string, source string, mse double, compared long, pairs long")
    best = F.min(F.when(F.col("mse").isNotNull(), F.struct("mse", "source")))
    rows = found.groupBy(F.col("target").alias("_target")).agg(best.alias("b"), F.sum("compared").alias("compared"), F.sum("pairs").alias("pairs"))
    every = targets.select(F.col(target).alias("target")).distinct()
    zero = F.lit(0).cast("long")
    return every.join(rows, F.col("target").cast("string") == F.col("_target"), "left").select("target", F.col("b.source").alias("source"), F.col("b.mse").alias("mse"), F.coalesce("compared", zero).alias("compared"), F.coalesce("pairs", zero).alias("pairs"))
