"""Content streams against spans worked out by hand."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from qirtas.operators import streams

FONTS = {"F1": {1: "س", 2: "لا", 3: " ", 0x41: "A"}, "F0": {}}


def spans(stream, style="glyphs", fonts=FONTS):
    return [(font, size, x, y, "|".join(units)) for _, font, size, x, y, units in streams.shown_spans(stream, fonts, streams.STYLES[style])]


def test_places_follow_the_operators():
    got = spans("BT /F1 10 Tf 2 0 0 2 100 700 Tm <0001> Tj 5 -3 Td <0002 0003>Tj 1 1 TD [<0001>-20<0002>] TJ T* <0001> Tj ET")
    assert got == [("F1", 10.0, 100.0, 700.0, "س"), ("F1", 10.0, 110.0, 694.0, "لا| "), ("F1", 10.0, 112.0, 696.0, "س|لا"), ("F1", 10.0, 112.0, 696.0, "س")]
    assert spans("/F1 10 Tf 0 50 Td T* <0001> Tj", "marked") == [("F1", 10.0, 0.0, 38.0, "س")]
    assert spans("/F1 .5 Tf -1.5 +2. Td <0041>Tj") == [("F1", 0.5, -1.5, 2.0, "A")]


def test_strings_in_brackets():
    read = lambda s: "".join(spans(f"/F1 1 Tf ({s}) Tj", "marked")[0][4].split("|"))
    assert read(r"a\(b\)\\c") == "a(b)\\c" and read("nested (pair (of)) here") == "nested (pair (of)) here"
    assert read(r"\101\7x\0531") == "A\x07x+1" and read("one\\\ntwo\\\r\nthree") == "onetwothree" and read(r"\n\t\q") == "\n\tq"
    assert read("line\r\nline\rline") == "line\nline\nline" and read("caf\xe9 \\351") == "café é"
    assert spans("/F1 1 Tf (abc) Tj") == [] and spans("/F1 1 Tf [(a(b)c) 5 <0001> (d)] TJ", "marked")[0][4] == "a|(|b|)|c|س|d"


def test_fonts_without_a_map_show_marks():
    assert spans("/F9 1 Tf (Ab 12/3\xa1) Tj", "marked") == [("F9", 1.0, 0.0, 0.0, " |1|2|/|3|،")]
    assert spans("<3132 2f4> Tj", "marked") == [(None, 12.0, 0.0, 0.0, "1|2|/")] and spans("<3132> Tj") == [] and spans("/F0 2 Tf <0001> Tj") == []


@pytest.mark.parametrize("stream", ["Tj", "1 Tf", "/F1 Tf", "1 2 3 Tm <0001>", "/F1 x Tf", "[ <0001>", "(open", "(open \\", "] TJ", "<01", "<< /A 1 >> BDC", "% <0001> Tj", "/F1 1 Tf <0001> 5 Tj", "/F1 1 Tf <0001> TJ", ""])
def test_broken_streams_show_nothing(stream):
    assert spans(stream, "marked") == []


def test_what_an_operator_does_not_need_is_left():
    assert spans("9 9 /F1 7 Tf q 1 0 0 1 5 5 cm BT 8 8 8 1 0 0 1 3 4 Tm 7 <0001> Tj ET Q") == [("F1", 7.0, 3.0, 4.0, "س")]
    assert spans("/F1 7 Tf % note ) Tj\n<0001>Tj") == [("F1", 7.0, 0.0, 0.0, "س")]


def test_random_bytes_never_raise():
    rng = random.Random(3)
    for _ in range(300):
        list(streams.shown_spans("".join(rng.choice("()[]<>/\\%0 1aTfjJmdD*\n\r.-+") for _ in range(rng.randrange(80))), FONTS, streams.STYLES["marked"]))


def test_spans_of_pages(spark):
    pages = spark.createDataFrame([(1, b"/F1 9 Tf <0041> Tj 1 0 Td <0002> Tj", {"F1": {0x41: "A", 2: "لا"}}, 5), (2, None, {}, 5), (3, b"", None, 5), (4, b"<0041> Tj", None, 5)], "page long, stream binary, fonts map<string,map<int,string>>, ord int")
    got = streams.stream_spans(pages, ["page"])
    assert got.columns == ["page", "ord", "font", "size", "x", "y", "units"]
    assert [tuple(r) for r in got.orderBy("ord").collect()] == [(1, 0, "F1", 9.0, 0.0, 0.0, ["A"]), (1, 1, "F1", 9.0, 1.0, 0.0, ["لا"])]
    assert streams.stream_spans(pages.filter(F.lit(False)), ["page"]).collect() == []
