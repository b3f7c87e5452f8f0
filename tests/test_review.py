"""Reviews at once and as pages come in: equal rows, attempts in the state, restarts."""

from __future__ import annotations

import json
import sys
import time

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from qirtas.operators import casefile
from qirtas.streaming import review

cloudpickle.register_pickle_by_value(sys.modules[__name__])
SCHEMA = "doc string, page int, page_total int, text string"


class Plain:
    def review(self, raw_text, attempt):
        return json.dumps({"cleaned_text": raw_text.replace("\n", " "), "uncertainties": []})


class Flaky(Plain):
    """Fails twice where the text says so, always where it is bad."""

    def review(self, raw_text, attempt):
        if "bad" in raw_text or "twice" in raw_text and attempt < 3:
            raise OSError(f"attempt {attempt}")
        return super().review(raw_text, attempt)


class Odd:
    def review(self, raw_text, attempt):
        return {"a": "no object", "b": '```json\n{"cleaned_text": "  ", "uncertainties": ["x", "x", " y "]}\n```', "c": '{"cleaned_text": "ok"}'}[raw_text[-1]]


def pages_of(names, n=3):
    return [(d, p, n, f"text {p} of {d}") for d in names for p in range(1, n + 1)]


def rows(df):
    return sorted((r.doc, r.cleaned_text, tuple(r.uncertainties), r.attempts, r.status) for r in df.collect())


def put(spark, folder, name, data):
    pd.DataFrame(data, columns=["doc", "page", "page_total", "text"]).astype({"page": "int32", "page_total": "int32"}).to_parquet(f"{folder}/{name}.parquet")


def stream(spark, folder, make=Plain, **options):
    pages = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))
    return review.review_stream(pages, ["doc"], make, **options)


def test_packing_is_that_of_the_table(spark):
    sizes = [5, 2000, 985, 986, 3001, 10, 10, 10, 1500, 1500]
    pages = spark.createDataFrame([("d", i + 1, 10, "x" * n) for i, n in enumerate(sizes)], SCHEMA)
    want = [(r.page_start, r.page_end, r.raw_text) for r in casefile.review_segments(pages, ["doc"], "page", "text").orderBy("segment").collect()]
    bodies = [(r.page, r.b) for r in pages.select("page", casefile.headed_page(F.col("page"), F.col("text")).alias("b")).orderBy("page").collect()]
    assert review.packed(bodies, review.MAX_CHARS, review.MAX_PAGES) == want and review.packed([], 10, 2) == []


def test_replies_of_every_kind(spark):
    pages = spark.createDataFrame([("a", 1, 1, "a"), ("b", 1, 2, "q"), ("b", 2, 2, "b"), ("c", 1, 1, "c"), ("c", 1, 1, "c"), ("n", 1, 1, None)], SCHEMA)
    got = {r[0]: r[1:] for r in rows(review.review_pages(pages.filter("doc <> 'n'"), ["doc"], Odd))}
    assert got["a"] == ("### Page 1\n\na", (f"Page 1: {review.EMPTY_REPLY}",), 1, "reviewed") and got["c"] == ("ok", (), 1, "reviewed")
    assert got["b"] == ("### Page 1\n\nq\n\n### Page 2\n\nb", ("Pages 1-2: x", "Pages 1-2: y", f"Pages 1-2: {review.EMPTY_REPLY}"), 1, "reviewed")
    assert rows(review.review_pages(pages.filter("doc = 'n'"), ["doc"], Plain)) == [("n", "### Page 1", (), 1, "reviewed")]
    assert review.review_pages(pages.limit(0), ["doc"], Plain).collect() == []


def test_attempts_and_failures(spark):
    pages = spark.createDataFrame([("a", 1, 1, "twice"), ("b", 1, 1, "bad"), ("c", 1, 1, "good")], SCHEMA)
    got = {r[0]: r[1:] for r in rows(review.review_pages(pages, ["doc"], Flaky))}
    assert got["a"][2:] == (3, "reviewed") and got["b"] == ("### Page 1\n\nbad", (), 3, "failed") and got["c"][2:] == (1, "reviewed")
    done = review.review_pages(pages, ["doc"], Flaky).filter("status = 'reviewed'")
    assert [r.doc for r in casefile.pending(pages, done, ["doc"]).collect()] == ["b"]


def test_stream_gives_the_rows_of_the_batch(spark, tmp_path):
    """Pages out of order, twice, late and never; one file a batch."""
    folder = tmp_path / "in"
    folder.mkdir()
    data = pages_of("abc") + [("late", 1, 2, "one"), ("long", 1, 1, "twice")]
    put(spark, folder, "1", data[::2])
    put(spark, folder, "2", data[1::2] + data[:2])
    put(spark, folder, "3", [("a", 1, 3, "another text of a"), ("b", 9, 3, "beyond")])
    query = review.write_reviews(stream(spark, folder, Flaky), ["doc"], f"{tmp_path}/out", f"{tmp_path}/check")
    query.awaitTermination(120)
    want = review.review_pages(spark.createDataFrame([d for d in data if d[0] != "late"], SCHEMA), ["doc"], Flaky)
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(want) and len(rows(want)) == 4


def test_a_restart_repeats_and_loses_nothing(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    data = pages_of("abcdefgh", 2)
    for i in range(4):
        put(spark, folder, str(i), data[i::4])
    broken = {"n": 0}

    def start(fail):
        def keep(batch, number):
            review.reviewed(batch, ["doc"]).write.mode("overwrite").parquet(f"{tmp_path}/out/batch={number}")
            broken["n"] += 1
            if fail and broken["n"] == 2:
                raise RuntimeError("the driver is lost after it wrote, before the batch is committed")

        return stream(spark, folder).writeStream.foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()

    with pytest.raises(Exception, match="driver is lost"):
        start(True).awaitTermination(120)
    start(False).awaitTermination(120)
    got = rows(spark.read.parquet(f"{tmp_path}/out"))
    assert got == rows(review.review_pages(spark.createDataFrame(data, SCHEMA), ["doc"], Plain)) and len(got) == 8
    put(spark, folder, "9", [("a", 1, 2, "once more"), ("z", 1, 1, "new")])
    start(False).awaitTermination(120)
    assert sorted(r[0] for r in rows(spark.read.parquet(f"{tmp_path}/out"))) == [*"abcdefgh", "z"]


def test_attempts_are_kept_between_batches(spark, tmp_path):
    """One attempt a batch: the state counts them, and the waiting document's turn comes by time."""
    folder = tmp_path / "in"
    folder.mkdir()
    put(spark, folder, "1", [("a", 1, 1, "twice"), ("b", 1, 1, "bad"), ("c", 1, 1, "good")])
    query = review.write_reviews(stream(spark, folder, Flaky, at_once=1, wait_ms=100), ["doc"], f"{tmp_path}/out", f"{tmp_path}/check", once=False)
    try:
        for _ in range(60):
            time.sleep(1)
            got = rows(spark.read.schema("doc string, cleaned_text string, uncertainties array<string>, attempts int, status string").parquet(f"{tmp_path}/out/*")) if (tmp_path / "out").exists() else []
            if len(got) == 3 or not query.isActive:
                break
    finally:
        query.stop()
    assert [(r[0], r[3], r[4]) for r in got] == [("a", 3, "reviewed"), ("b", 3, "failed"), ("c", 1, "reviewed")]


def test_request(spark):
    row = spark.createDataFrame([(None, "memo", 1, 2, "s", ["r1", "r2"], "raw")], "l string, k string, a int, b int, s string, w array<string>, t string")
    got = row.select(review.request_text("Clean it.", *[F.col(c) for c in "lkabswt"])).first()[0]
    assert got == "Clean it.\n\nDocument label: Unknown\nDocument type: memo\nPages: 1-2\nSummary hint: s\nKnown OCR risks: r1; r2\n\nRaw OCR text follows:\nraw"
