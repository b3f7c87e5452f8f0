"""Glyph parsers and numeric page operators on small cases worked out by hand."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from qirtas.functions.text import corrected
from qirtas.operators import glyphs, layout, pixels, thumbnails

CMAP = """beginbfchar
<0003> <0020>
<0010> <06440627>
endbfchar
beginbfrange
<0020> <0022> <0641>
<0030> <0031> [<0627> <06280629>]
endbfrange"""


def test_font_maps(spark):
    m = glyphs.font_map(CMAP)
    assert m[3] == " " and m[0x10] == "لا" and [m[0x20 + i] for i in range(3)] == [chr(0x641 + i) for i in range(3)] and m[0x30] == "ا" and m[0x31] == "بة"
    row = spark.createDataFrame([(CMAP, "0010002000FF0003001")], "t string, h string").withColumn("m", glyphs.font_maps("t"))
    got = row.select(glyphs.glyph_units(F.col("h"), F.col("m")), glyphs.has_ligatures(F.array("m")), glyphs.is_arabic_font(F.array("m")), glyphs.is_arabic_font(F.array("m"), 3)).first()
    assert list(got) == [["لا", chr(0x641), " "], True, False, True]
    assert glyphs.font_map(None) == {}


def test_text_matrix_and_names(spark):
    row = spark.range(1).select(
        glyphs.text_matrix(F.lit("3 0 4 1 100.5 -20")), glyphs.text_matrix(F.lit("1 0 0")), glyphs.best_code_point(F.array(F.lit(65), F.lit(0xFEFB), F.lit(0x0644))), glyphs.best_code_point(F.array(F.lit(65))),
        glyphs.best_code_point(F.array().cast("array<int>")), glyphs.name_characters(F.lit("uniFE8D0644.alt")), glyphs.name_characters(F.lit("u01F600")), glyphs.name_characters(F.lit("space"), {"space": " "}), glyphs.name_characters(F.lit("uni12")),
    ).first()
    assert (row[0].x, row[0].y, row[0].scale) == (100.5, -20.0, 5.0) and row[1] is None
    assert list(row)[2:] == [chr(0x0644), "A", "", "ﺍل", "\U0001f600", " ", ""]
    assert spark.createDataFrame([(["ab", "من"],)], "u array<string>").select(glyphs.is_right_to_left(F.col("u"))).first()[0] is False
    assert spark.createDataFrame([(["a", "من"],)], "u array<string>").select(glyphs.is_right_to_left(F.col("u"))).first()[0] is True


def test_reversed_entries(spark):
    row = spark.createDataFrame([([{1: "abcd", 2: "xyyx", 3: "pqrs", 4: "srqp", 5: "ab", 6: "lmnop"}], "dcba ponml srqp")], "m array<map<int,string>>, t string")
    got = row.select(glyphs.reversed_entries(F.col("m")).alias("r"), "t").select("r", corrected(F.col("t"), F.col("r")).alias("t")).first()
    assert [(r.wrong, r.right) for r in got.r] == [("ponml", "lmnop"), ("dcba", "abcd")] and got.t == "abcd lmnop srqp"


def test_spans_become_lines_and_pages(spark):
    rows = [(1, 10.0, 100.0, "left", False), (1, 50.0, 101.5, "right", False), (1, 10.0, 88.0, "ب", True), (1, 50.0, 88.0, "أ", True), (1, 10.0, 76.0, "c ", False), (1, 30.0, 76.0, "d", False), (1, 1.0, 40.0, "e", False), (1, 1.0, 30.0, " ", False)]
    lines = glyphs.line_table(spark.createDataFrame(rows, "p int, x double, y double, text string, rtl boolean"), ["p"])
    assert [r.text for r in lines.orderBy("line").collect()] == ["right", "left", "أ ب", "c d", "e", ""] or [r.text for r in lines.orderBy("line").collect()] == ["left right", "أ ب", "c d", "e", ""]
    assert glyphs.page_text(lines, ["p"]).first()["text"].endswith("أ ب\nc d\n\ne")


def test_visual_lines(spark):
    span = lambda x, units, order=0, size=10.0: {"x": x, "order": order, "size": size, "units": units}
    assert glyphs.visual_units([span(30.0, ["c"]), span(0.0, ["a"]), span(5.0, ["b"])]) == ["a", "b", " ", "c"]
    assert glyphs.logical_text([span(0.0, ["1", "2"]), span(20.0, ["(", "ب", "ا"])]) == "اب) 12"
    rows = spark.createDataFrame([([(0.0, 0, 10.0, ["1", "2"]), (20.0, 1, 10.0, ["ا"])],), (None,)], "s array<struct<x:double,order:int,size:double,units:array<string>>>")
    assert [r[0] for r in rows.select(glyphs.logical_lines("s")).collect()] == ["ا 12", None]


def test_detached_dots(spark):
    rows = spark.createDataFrame([([("word ", 0.0, 30.0), (" .", 5.0, 6.0), (" next", 31.0, 60.0)],), ([("a", 0.0, 5.0), ("b", 50.0, 55.0)],)], "s array<struct<text:string,x0:double,x1:double>>")
    assert [r[0] for r in rows.select(glyphs.merged_lines("s")).collect()] == ["word.next", "ab"]


def test_glyph_text_may_stand_in(spark):
    rows = spark.createDataFrame([("كلمات عربية هنا", "كلمات عربية هنا"), ("only latin words", "كلمات عربية هنا"), ("ك ل م", "كلمات عربية")], "a string, b string")
    assert [r[0] for r in rows.select(glyphs.glyph_text_is_better(F.col("a"), F.col("b"))).collect()] == [True, False, False]


def page(width, height, *boxes):
    out = np.full((height, width), 255, np.uint8)
    for x1, y1, x2, y2 in boxes:
        out[y1:y2, x1:x2] = 0
    return out


def test_islands_are_those_of_the_table(spark):
    rng = np.random.default_rng(3)
    for gap, least in ((0, 1), (1, 2), (3, 4)):
        mask = rng.random(60) < 0.4
        rows = spark.createDataFrame([(1, i, bool(x)) for i, x in enumerate(mask)], "k int, i int, on boolean")
        assert pixels.islands(mask, gap, least) == sorted((r.start, r.end) for r in layout.segments(rows, "k", "i", F.col("on"), gap, least).collect())
    assert pixels.islands(np.zeros(5, bool), 1, 1) == []


def test_blocks_and_lines(spark):
    two = page(600, 400, (20, 50, 250, 120), (350, 50, 580, 120), (20, 200, 580, 260))
    assert pixels.ink_blocks(two) == [(8, 40, 262, 130), (338, 40, 600, 130), (0, 190, 600, 270)]
    rows = spark.createDataFrame([(1, 600, 400, bytearray(two.tobytes())), (2, 10, 10, bytearray(b"\xff" * 100)), (3, 0, 0, None)], "k int, width int, height int, grey binary")
    got = sorted((r.k, r.region, r.label, r.x2) for r in pixels.regions(rows, "k").collect())
    assert got == [(1, 0, "heuristic_block", 262), (1, 1, "heuristic_block", 600), (1, 2, "heuristic_block", 600), (2, 0, "full_page", 10), (3, 0, "full_page", 0)]
    lines = page(300, 100, (10, 10, 290, 30), (10, 50, 290, 70))
    assert pixels.ink_lines(lines) == [(10, 30), (50, 70)]
    assert rows.select(pixels.not_white_share("width", "height", "grey").alias("s")).collect()[1]["s"] == 0.0


def test_chunks_are_cut_at_the_least_ink():
    tall = page(50, 4000, (0, 0, 50, 1500), (0, 1550, 50, 4000))
    got = pixels.chunk_rows(tall)
    assert got[0] == (0, 1500) and got[1][0] == 1320 and got[-1][1] == 4000 and all(b > a for a, b in got)
    assert pixels.chunk_rows(page(50, 1700)) == []


def test_nearest_pages(spark):
    grey = lambda v: bytearray([v] * 16)
    targets = spark.createDataFrame([(1, grey(10)), (2, grey(200)), (3, None)], "t int, grey binary")
    sources = spark.createDataFrame([("b", grey(12)), ("a", grey(8)), ("c", grey(90))], "s string, grey binary")
    got = {r.target: (r.source, r.mse) for r in thumbnails.nearest_pages(targets, sources, "t", "s", block=4).collect()}
    assert got == {1: ("a", 4.0), 2: (None, None), 3: (None, None)}
    assert targets.select(pixels.mean_square_error("grey", "grey")).first()[0] == 0.0


def test_chunking_gate(spark):
    rows = spark.createDataFrame([(1000, 1000, 5, 1, "empty"), (1000, 2300, 0, 0, "empty"), (3000, 2000, 50, 20, "low_quality"), (4000, 2500, 500, 3, None), (1000, 1900, 500, 30, "sparse_large_crop"), (1000, 1900, 500, 30, None)], "w long, h long, n long, l long, t string")
    assert [r[0] for r in rows.select(pixels.worth_chunking(*map(F.col, "whnlt"))).collect()] == [False, True, True, True, True, False]
