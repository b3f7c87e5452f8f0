"""Operators on small tables of our own."""

from __future__ import annotations

import random
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from qirtas.operators import casefile, choose, evaluate, inventory, layout, lines, render
from qirtas.sources import pages as source
from qirtas.streaming import landing

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class FakeEngine:
    """Takes the image's bytes as its text."""

    def __init__(self, engine_id: str = "fake", confidence: float = 0.5):
        self.engine_id, self.confidence = engine_id, confidence

    def available(self) -> bool:
        return True

    def recognise(self, image: bytes) -> tuple[str, float | None, str | None]:
        return (image or b"").decode("utf-8", "replace"), self.confidence, None


def test_best_candidate_takes_the_first_on_ties(spark):
    rows = spark.createDataFrame([(1, 0, " ", 9.0), (1, 1, "a", 5.0), (1, 2, "b", 5.0), (2, 0, "", 1.0), (2, 1, None, 2.0)], "p int, ord int, text string, score double")
    assert sorted((r.p, r.ord) for r in choose.best(rows, ["p"]).collect()) == [(1, 1), (2, 1)]


def test_merge_rules(spark):
    cases = [("same words here", "same words here", "verify"), ("left side", "", "primary_only"), ("", "right side", "secondary_only"), ("", None, "neither"), ("(no text visible)", "real words", "secondary_only"), ("some plain words", "some plain words and quite a few more of the same kind", "secondary_quality")]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a string, b string")
    got = {r.i: r for r in choose.merge_pairs(rows, "a", "b").collect()}
    assert [got[i].rule for i in range(5)] == [c[2] for c in cases[:5]]
    assert got[5].rule in ("secondary_quality", "primary_shorter") and got[0].confidence == 1.0 and got[3].confidence == 0.0


def test_chunks_are_stitched(spark):
    rows = spark.createDataFrame([(1, 0, "1\n2\n3"), (1, 1, "3\n4"), (1, 2, ""), (1, 3, "4\n5")], "d int, o int, text string")
    assert choose.stitched_chunks(rows, ["d"], "o", "text").first()["text"] == "1\n2\n3\n4\n5"


def test_rescue_trigger(spark):
    rows = spark.createDataFrame([("", 1), ("a b c d", 1), ("word " * 10, 2_000_000), ("word " * 30, 7_000_000), ("word " * 50, 1)], "t string, a long")
    assert [r[0] for r in rows.select(choose.rescue_trigger(F.col("t"), F.col("a"))).collect()] == ["empty", "low_quality", "under_read_large_crop", "sparse_large_crop", None]


def model_cover(entries, total):
    out, free = [], 1
    good = sorted(tuple(sorted(e)) for e in entries if e[0] >= 1 and e[1] >= 1)
    for a, b in good:
        a, b = min(total, a), min(total, b)
        if b < free:
            continue
        a = max(a, free)
        if a > free:
            out.append((free, a - 1))
        out.append((a, b))
        free = b + 1
    if free <= total or not out:
        out.append((free, total))
    return out


def test_coverage_on_random_ranges(spark):
    rng = random.Random(7)
    bundles = {k: (rng.randrange(1, 12), [(rng.randrange(0, 14), rng.randrange(0, 14)) for _ in range(rng.randrange(0, 6))]) for k in range(150)}
    entries = spark.createDataFrame([(k, str(a), str(b), f"e{i}") for k, (_, own) in bundles.items() for i, (a, b) in enumerate(own)], "k int, page_start string, page_end string, label string")
    sizes = spark.createDataFrame([(k, n) for k, (n, _) in bundles.items()], "k int, page_total int")
    got: dict = {}
    for r in casefile.coverage(entries, sizes, "k").collect():
        got.setdefault(r.k, []).append((r.page_start, r.page_end))
    for k, (n, own) in bundles.items():
        assert sorted(got[k]) == model_cover(own, n), (k, n, own)


def test_people_keep_their_order(spark):
    rows = spark.createDataFrame([(1, 2, "A", "x"), (1, 1, "A", "y"), (1, 3, "A", "y"), (1, 3, "B", None), (1, 3, "", "z")], "k int, o int, name string, role string")
    assert {r["name"]: r["roles"] for r in casefile.people_roles(rows, "k", "o", "name", "role").collect()} == {"A": ["y", "x"], "B": []}


def test_islands(spark):
    mask = [1, 1, 0, 1, 0, 0, 1, 0]
    rows = spark.createDataFrame([(1, i, bool(x)) for i, x in enumerate(mask)], "k int, i int, on boolean")
    assert sorted((r.start, r.end) for r in layout.segments(rows, "k", "i", F.col("on"), 1, 1).collect()) == [(0, 4), (6, 8)]


def test_reading_order_is_right_to_left(spark):
    rows = spark.createDataFrame([(1, "l1", 20, 10, 380, 50), (1, "r1", 420, 10, 780, 50), (1, "l2", 20, 60, 380, 90), (1, "r2", 420, 60, 780, 90)], "p int, n string, x1 int, y1 int, x2 int, y2 int")
    assert [r["n"] for r in layout.right_to_left(rows, "p").orderBy("reading_order").collect()] == ["r1", "r2", "l1", "l2"]


def test_segments_fit_a_count():
    assert layout.fitted([(0, 10), (12, 20), (40, 60)], 2, 100) == [(0, 20), (40, 60)]
    assert layout.fitted([(0, 100)], 2, 100) == [(0, 50), (50, 100)]
    assert layout.fitted([(0, 5)], 2, 100) == [] and layout.fitted([], 2, 100) == []


def test_artifacts(spark):
    r = spark.createDataFrame([("(No visible text to extract)\nby CamScanner\nkept\nempty image, no text visible",)], "t string").select(lines.without_artifacts(F.col("t")).alias("w")).first()["w"]
    assert r["text"] == "kept" and r["labels"] == ["no_visible_text_to_extract", "camscanner", "empty_image_no_text_visible"]


def test_duplicates(spark):
    rows = spark.createDataFrame([("b", "x"), ("A", "x"), ("c", "y")], "n string, t string")
    assert {r.n: r.duplicate_of for r in inventory.with_duplicates(rows, "n", "t").collect()} == {"b": "A", "A": None, "c": None}


def test_error_rates(spark):
    found = spark.createDataFrame([("a", "hello there"), ("b", "x"), ("c", "")], "k string, t string")
    truth = spark.createDataFrame([("a", "hello world"), ("c", "")], "k string, u string")
    got = {r.k: (r.cer, r.wer) for r in evaluate.evaluated(found, truth, "k", "t", "u").collect()}
    assert got["b"] == (None, None) and got["c"] == (0.0, 0.0) and got["a"][1] == 0.5


def test_rendered_pages(spark):
    rows = spark.createDataFrame([(1, 1, "b"), (1, 0, " a ")], "d int, p int, t string")
    assert render.document_text(rows, "d", "p", "t").first()["rendered"] == "=== Page 1 ===\na\n\n=== Page 2 ===\nb"


def test_engines_fail_as_rows(spark):
    class Broken(FakeEngine):
        def recognise(self, image):
            if image == b"bad":
                raise ValueError("no")
            return super().recognise(image)

    rows = spark.createDataFrame([(1, bytearray(b"ok")), (2, bytearray(b"bad"))], "i int, image binary")
    got = {r.i: (r.text, r.success) for r in source.recognised(rows, "image", lambda: Broken()).collect()}
    assert got == {1: ("ok", True), 2: ("", False)}
    assert source.routed("auto", {"a": FakeEngine("a")}, ("b", "a")) == ("a", None)


def test_document_json_round_trip(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"source_pdf": "x.pdf", "pages": [{"page": 0, "blocks": [{"type": "t", "reading_order": 1, "lines": [{"spans": [{"text": "a"}, {"text": "b"}]}, {"spans": []}]}]}]}')
    docs = source.documents_json(spark, str(tmp_path))
    assert docs.first()["dpi"] == 400 and source.block_rows(docs).first()["text"] == "ab"
    (tmp_path / "d.json").write_text('{"source_pdf": "x.pdf", "metadata": {"a": 1, "b": {"c": [2]}}, "pages": [{"page": 0, "metadata": {"k": "v"}, "blocks": []}]}')
    got = source.documents_json(spark, str(tmp_path)).first()
    assert got.metadata["a"] == "1" and got.metadata["b"] == '{"c":[2]}' and got.pages[0].metadata == {"k": "v"}


def test_page_cache_keeps_quality(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"source_pdf": "x.pdf", "page": 3, "native_status": "warn", "quality": {"chars": 5}, "candidates": [{"engine": "e", "score": 1.5, "quality": {"status": "pass"}}], "chosen": {"text": "t"}}')
    got = source.page_cache(spark, str(tmp_path)).first()
    assert got.native_status == "warn" and got.quality == {"chars": "5"} and got.candidates[0].quality == {"status": "pass"} and got.chosen.text == "t"


def test_engines_by_name():
    engines = {"a": FakeEngine("a")}
    assert source.available(engines, ("b", "a")) == ["a"] and source.engine_named(engines, "a").engine_id == "a"
    for bad in (lambda: source.engine_named(engines, "z"), lambda: source.routed("z", engines, ("a",)), lambda: source.routed("auto", {}, ("a",))):
        try:
            bad()
        except ValueError:
            continue
        raise AssertionError


def test_stream_of_pages(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"page": 1, "text": "some words"}\n')
    seen = []
    stream = landing.scored(landing.landed(spark, str(tmp_path / "in"), "page int, text string"))
    query = landing.each_batch(stream, str(tmp_path / "c"), lambda df, n: seen.extend(r.score for r in df.collect()))
    query.awaitTermination(60)
    assert len(seen) == 1 and seen[0] > 0


def test_lists_of_pages(spark):
    specs = spark.createDataFrame([(s,) for s in ("1-3,7", "2,2,1", "0", "5-2", "4", "x")], "spec string")
    got = {r.spec: r.p for r in specs.select("spec", source.page_numbers(F.col("spec")).alias("p")).collect()}
    assert got == {"1-3,7": [0, 1, 2, 6], "2,2,1": [0, 1], "0": None, "5-2": None, "4": [3], "x": None}
