"""Geometry of pages: segments, boxes, reading order, columns."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def segments(cells: DataFrame, key: str, index: str, on: Column, max_gap: int, min_length: int) -> DataFrame:
    """Islands of true cells that bridge gaps of up to ``max_gap``: start and end (exclusive). An island that no
    longer gap closes runs to the end of the cells."""
    total = cells.groupBy(key).agg((F.max(index) + 1).alias("total"))
    w = Window.partitionBy(key).orderBy(index)
    rows = cells.filter(on).select(key, F.col(index).alias("i")).withColumn("gap", F.col("i") - F.lag("i").over(Window.partitionBy(key).orderBy("i")) - 1)
    w = Window.partitionBy(key).orderBy("i")
    rows = rows.withColumn("island", F.sum(F.when(F.col("gap") > max_gap, 1).otherwise(0)).over(w))
    found = rows.groupBy(key, "island").agg(F.min("i").alias("start"), (F.max("i") + 1).alias("end")).join(total, key)
    end = F.when(F.col("total") - F.col("end") <= max_gap, F.col("total")).otherwise(F.col("end"))
    return found.select(key, "start", end.alias("end")).filter(F.col("end") - F.col("start") >= min_length)


def kept_regions(regions: DataFrame, key: str, width: str, height: str) -> DataFrame:
    """Regions without tiny heuristic ones; all of them where that leaves none, or there is only one."""
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    tiny = (F.col("label") == "heuristic_block") & (w * h < F.col(width) * F.col(height) * 0.008) & ((w < F.col(width) * 0.35) | (h < F.col(height) * 0.04))
    own = Window.partitionBy(key)
    rows = regions.withColumn("_tiny", tiny).withColumn("_n", F.count("*").over(own)).withColumn("_kept", F.sum((~F.col("_tiny")).cast("int")).over(own))
    return rows.filter("not _tiny or _n <= 1 or _kept = 0").drop("_tiny", "_n", "_kept")


def expanded(x1, y1, x2, y2, width, height) -> Column:
    dx, dy = F.greatest(F.lit(12), F.floor(width / 120)), F.greatest(F.lit(10), F.floor(height / 180))
    return F.struct(F.greatest(F.lit(0), x1 - dx).cast("int").alias("x1"), F.greatest(F.lit(0), y1 - dy).cast("int").alias("y1"), F.least(width, x2 + dx).cast("int").alias("x2"), F.least(height, y2 + dy).cast("int").alias("y2"))


def line_boxes(lines: DataFrame) -> DataFrame:
    """Equal slices of a block's box for its lines, one pixel high at least: columns line_index, n_lines, x1, y1, x2, y2."""
    step = F.greatest(F.col("y2") - F.col("y1"), F.lit(1)) / F.col("n_lines")
    edge = lambda i: F.floor(F.col("y1") + i * step).cast("int")
    top = edge(F.col("line_index"))
    return lines.withColumn("line_y1", top).withColumn("line_y2", F.greatest(edge(F.col("line_index") + 1), top + 1))


def upscaled(width: Column, height: Column, most: int = 3072) -> Column:
    longest = F.greatest(width, height)
    scale = F.least(F.lit(2.0), most / F.greatest(longest, F.lit(1)))
    keep = (longest >= most) | (scale <= 1.05)
    grow = lambda x: F.when(keep, x).otherwise(F.greatest(F.lit(1), F.floor(x * scale))).cast("int")
    return F.struct(grow(width).alias("width"), grow(height).alias("height"))


def half(width: Column, height: Column, side: Column, overlap: int = 30) -> Column:
    mid = F.floor(width / 2)
    left = F.when(side == "right", F.greatest(F.lit(0), mid - overlap)).otherwise(0)
    right = F.when(side == "right", width).otherwise(F.least(width, mid + overlap))
    return F.struct(left.cast("int").alias("x1"), F.lit(0).alias("y1"), right.cast("int").alias("x2"), height.cast("int").alias("y2"))


def right_to_left(regions: DataFrame, key: str) -> DataFrame:
    """``reading_order``: columns from right to left, top to bottom (by centre) in each. Regions are dealt to columns from
    right to left: to the first column whose mean centre is nearer than a fifth of the page width, else to a new one; ties
    keep the order of the rows' own ``region`` column where there is one. One page's regions at a time."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in regions.schema.fields) + ", reading_order int"

    def order(page: pd.DataFrame) -> pd.DataFrame:
        if "region" in page.columns:
            page = page.sort_values("region", kind="stable")
        near = 0.2 * page["x2"].max()
        across, down = (page["x1"] + page["x2"]) / 2, (page["y1"] + page["y2"]) / 2
        columns: list[list[int]] = []
        for i in across.sort_values(ascending=False, kind="stable").index:
            home = next((c for c in columns if abs(across[i] - sum(across[j] for j in c) / len(c)) < near), None)
            if home is None or len(page) <= 1:
                columns.append([i])
            else:
                home.append(i)
        columns.sort(key=lambda c: -sum(across[j] for j in c) / len(c))
        out = page.loc[[i for c in columns for i in sorted(c, key=lambda j: down[j])]].copy()
        out["reading_order"] = range(len(out))
        return out

    return regions.groupBy(key).applyInPandas(order, schema)


def fitted(start_end: list[tuple[int, int]], count: int, height: int) -> list[tuple[int, int]]:
    """Segments merged over the smallest gaps, or the tallest halved, until there are ``count``; none if that fails."""
    own = list(start_end)
    if count <= 0 or not own:
        return []
    while len(own) > count:
        i = min(range(len(own) - 1), key=lambda j: own[j + 1][0] - own[j][1])
        own[i : i + 2] = [(own[i][0], own[i + 1][1])]
    least = max(12, height // 160)
    while len(own) < count:
        i = max(range(len(own)), key=lambda j: own[j][1] - own[j][0])
        a, b = own[i]
        if b - a < least:
            return []
        own[i : i + 1] = [(a, (a + b) // 2), ((a + b) // 2, b)]
    return own


def fitted_segments(pages: DataFrame) -> DataFrame:
    """``pages``: key, segments array<struct<start, end>>, n_lines, height; adds ``fitted``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields) + ", fitted array<struct<start:int,end:int>>"

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["fitted"] = [
                [{"start": a, "end": b} for a, b in fitted([(int(s["start"]), int(s["end"])) for s in own], int(n), int(h))]
                for own, n, h in zip(batch["segments"], batch["n_lines"], batch["height"], strict=True)
            ]
            yield batch

    return pages.mapInPandas(fit, schema)


def column_valley(spans: DataFrame, key: str, x: str, units: str, width: str, bin_width: float = 20.0, least: int = 50, side: float = 0.15, enough: float = 0.3) -> DataFrame:
    """Where a page has two columns, the boundary between them: of the splits in its middle three fifths with ``side`` of
    the characters on either side, the one that leaves both sides most alike and has the fewest characters in the bins
    around it. ``units`` counts a span's characters; pages with fewer than ``least`` or no good split are left out."""
    last = F.floor(F.col(width) / bin_width).cast("long")
    rows = spans.filter(F.col(width) > 0).select(key, last.alias("last"), F.least(F.floor(F.col(x) / bin_width).cast("long"), last).alias("bin"), F.col(units).cast("long").alias("n"))
    bins = rows.groupBy(key, "last", "bin").agg(F.sum("n").alias("n"))
    pages = bins.groupBy(key, "last").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("by")).filter(F.col("total") >= least)
    at = lambda b: F.coalesce(F.try_element_at("by", b), F.lit(0).cast("long"))
    start, stop = F.floor((F.col("last") + 1) * 0.2).cast("long"), F.floor((F.col("last") + 1) * 0.8).cast("long")
    split = pages.filter(stop > start).withColumn("split", F.explode(F.sequence(start, stop - 1)))
    left = F.aggregate(F.map_entries("by"), F.lit(0).cast("long"), lambda s, e: s + F.when(e["key"] < F.col("split"), e["value"]).otherwise(0))
    split = split.withColumn("left", left).withColumn("right", F.col("total") - F.col("left"))
    around = F.when(F.col("split") > 0, at(F.col("split") - 1)).otherwise(0) + at(F.col("split")) + F.when(F.col("split") < F.col("last"), at(F.col("split") + 1)).otherwise(0)
    score = F.least("left", "right") / F.greatest("left", "right") * (1.0 - around / F.col("total") * 5)
    good = split.filter((F.col("left") >= F.col("total") * side) & (F.col("right") >= F.col("total") * side)).withColumn("score", score)
    best = good.groupBy(key).agg(F.max(F.struct("score", (-F.col("split")).alias("s"))).alias("b")).filter((F.col("b.score") > 0) & (F.col("b.score") >= enough))
    return best.select(key, (F.col("b.s") * -bin_width).alias("boundary"), F.round("b.score", 6).alias("score"))


def upper_median(rows: DataFrame, keys: list[str], value: str, default: float) -> DataFrame:
    """The middle of the positive values, the upper of two: from counts of each value, so that a key of very many rows is
    no list."""
    counted = rows.groupBy(*keys, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
    own = Window.partitionBy(*keys)
    good = counted.filter("v > 0").withColumn("upto", F.sum("n").over(own.orderBy("v"))).withColumn("total", F.sum("n").over(own))
    middle = good.filter(F.col("upto") > F.floor(F.col("total") / 2)).groupBy(*keys).agg(F.min("v").alias("m"))
    every = counted.select(*keys).distinct()
    on = [every[k].eqNullSafe(middle[k]) for k in keys]
    return every.join(middle, on, "left").select(*[every[k] for k in keys], F.coalesce("m", F.lit(default)).alias("upper_median"))
