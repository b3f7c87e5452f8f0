"""Readings that are kept: what was read is not read again."""

from __future__ import annotations

import os
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import functions as F

from qirtas.sources import readings

cloudpickle.register_pickle_by_value(sys.modules[__name__])
PAGES = "name string, sha256 string, page int, side string, image binary"
CONFIGS = "engine string, variant string, psm int"


class Counting:
    """Leaves a file for every page that it reads; the image's bytes are the text."""

    def __init__(self, folder, variant):
        self.folder, self.variant = folder, variant

    def recognise(self, image):
        open(f"{self.folder}/{uuid.uuid4().hex}", "w").close()
        text = image.decode()
        if "broken" in text and not os.path.exists(f"{self.folder}.mended"):
            raise OSError("broken")
        return (text.upper() if self.variant == "upper" else text), 0.5, None


def setting(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()
    rows = [("b.pdf", "h1", 1, "left", b"one left"), ("b.pdf", "h1", 1, "right", b"one right"), ("b.pdf", "h1", 2, None, b"two"), ("a.pdf", "h1", 1, "left", b"one left"), ("c.pdf", "h2", 1, None, b"broken"), ("d.pdf", None, 1, None, b"x")]
    folder = str(seen)
    make = lambda engine, variant, psm: Counting(folder, variant)
    return spark.createDataFrame(rows, PAGES), str(tmp_path / "cache"), make, lambda: len(os.listdir(folder)), folder


def test_a_second_run_reads_nothing(spark, tmp_path):
    pages, path, make, count, folder = setting(spark, tmp_path)
    configs = spark.createDataFrame([("t", "plain", 6), ("t", "plain", 6)], CONFIGS)
    assert readings.read_missing(spark, path, pages, configs, make) == 1 and count() == 4
    got = {(r.sha256, r.page, r.side): (r.text, r.success, r.error, r.run) for r in readings.readings(spark, path).collect()}
    assert got == {("h1", 1, "left"): ("one left", True, None, 1), ("h1", 1, "right"): ("one right", True, None, 1), ("h1", 2, None): ("two", True, None, 1), ("h2", 1, None): ("", False, "broken", 1)}
    readings.read_missing(spark, path, pages.filter("sha256 = 'h1'"), configs, make)
    assert count() == 4  # what failed is tried again, nothing else
    open(f"{folder}.mended", "w").close()
    readings.read_missing(spark, path, pages, configs, make)
    assert count() == 5 and readings.readings(spark, path).filter("not success").count() == 0
    more = configs.union(spark.createDataFrame([("t", "upper", None)], CONFIGS))
    readings.read_missing(spark, path, pages, more, make)
    assert count() == 9 and readings.readings(spark, path).count() == 8
    before = readings.stored(spark, path).agg(F.max("run")).first()[0]
    assert readings.read_missing(spark, path, pages, more, make, force=True) == before + 1 and count() == 17
    assert {r.run for r in readings.readings(spark, path).collect()} == {before + 1} and readings.readings(spark, path).count() == 8


def test_pages_and_sides_keep_their_order(spark, tmp_path):
    pages, path, make, _, folder = setting(spark, tmp_path)
    open(f"{folder}.mended", "w").close()
    readings.read_missing(spark, path, pages, spark.createDataFrame([("t", "plain", 6), ("t", "upper", None)], CONFIGS), make)
    best = readings.best_texts(readings.readings(spark, path), F.when(F.col("variant") == "upper", 2.0).otherwise(F.length("text") % 2))
    files = pages.select("name", "sha256").distinct()
    got = {r.name: r.texts for r in readings.in_order(files, best).collect()}
    assert got == {"a.pdf": ["ONE RIGHT", "ONE LEFT", "TWO"], "b.pdf": ["ONE RIGHT", "ONE LEFT", "TWO"], "c.pdf": ["BROKEN"]}


def test_a_run_that_failed_is_made_again(spark, tmp_path):
    pages, path, make, count, _ = setting(spark, tmp_path)
    configs = spark.createDataFrame([("t", "plain", 6)], CONFIGS)
    readings.read_missing(spark, path, pages.filter("page = 1"), configs, make)
    first = readings.stored(spark, path).count()
    found = readings.read_pages(readings.work_list(pages, configs, readings.readings(spark, path)), make).withColumns({"run": F.lit(1), "bucket": F.substring("sha256", 1, 2)})
    assert first == 3 and found.count() == 2
    assert readings.work_list(pages.limit(0), configs, readings.readings(spark, path)).collect() == [] and readings.work_list(pages, configs.limit(0), readings.readings(spark, path)).collect() == []
    assert readings.readings(spark, str(tmp_path / "nothing")).collect() == []
