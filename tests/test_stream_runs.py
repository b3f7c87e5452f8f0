"""Runs of moves and strings give the spans that reading token by token gives; texts of one file are read by many tasks."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from qirtas.operators import streams
from qirtas.plans import streams as plans

FONTS = {"F1": {1: "س", 2: "لا", 0x41: "A"}, "F0": {}, "N": None}
PARTS = [
    "1 0 Td", "-2.5 .5 TD", "3 4Td", "1 1 Td(ab) Tj", "1 1 Td <0001 0002>Tj", "1 1 Td <00> Tj", "1 1 Td <> Tj", "1 1 Td () Tj", "1 1 Td [(a)5 .5<0041>(\\145\\53)]TJ", "1 1 Td [(\\5) 3 (3)] TJ",
    "1 1 Td [(a) b (c)] TJ", "1 1 Td [(a)] Tj", "1 1 Td (a) TJ", "1 1 Td (a(b)c) Tj", "1 1 Td (a\\)\\\\\\q\\7) Tj", "1 1 Td (a\rb\\\nc) Tj", "1 1 Td: (a) Tj", "1 1 Td (a) Tjx", "1 1 Td (12;\xa1 \xe9) Tj", "1 1 Td (<01>) Tj",
    "/F1 9 Tf", "/F0 3 Tf", "/N 2 Tf", "/F9 1 Tf", "2 0 0 2 72 720 Tm", "T*", "ET", "% c Tj\n", "(", "<", "[ (a)", ")", "\\", "\x00", "9 9 9 Td (a) Tj",
]


def test_runs_are_read_as_tokens_are(monkeypatch):
    rng = random.Random(5)
    pages = ["".join(rng.choice(PARTS) + rng.choice([" ", " ", "", "\n"]) for _ in range(rng.randrange(25))) for _ in range(2000)]
    read = lambda: [list(streams.shown_spans(p, FONTS, streams.STYLES[s])) for p in pages for s in streams.STYLES]
    found, runs = read(), sum(len(shows) > 1 for p in pages for *_, shows in streams.shown_runs(p, FONTS, streams.STYLES["marked"]))
    monkeypatch.setattr(streams, "RUN", re.compile(""))
    assert found == read() and runs > 200


def test_words_of_a_height(spark):
    stream = b"/F1 9 Tf 1 0 0 1 5 7 Tm (ab) Tj 2 0 Td [(c) 5 <0002>] TJ 1 0 Td <0009> Tj 0 -3 Td <0041> Tj 1 3 Td (d) Tj -9 0 Td (f  g) Tj 0 0 Td (e) Tj"
    pages = spark.createDataFrame([(1, stream, FONTS), (2, None, {}), (3, b"", None), (4, b"ET", FONTS), (5, b"/F1 1 Tf (x) Tj", FONTS)], "page long, stream binary, fonts map<string,map<int,string>>")
    rows = streams.stream_rows(pages.coalesce(1), ["page"], style="marked").select("page", "y", "line", streams.placed_words(F.struct("xs", "ends", "line")).alias("words"))
    found = [(r.page, r.y, [tuple(w) for w in r.words], r.line) for r in rows.collect()]
    assert found == [
        (1, 7.0, [(5.0, "ab"), (7.0, "cلا")], "ab cلا"), (1, 4.0, [(8.0, "A")], "A"), (1, 7.0, [(0.0, "e"), (0.0, "f  g"), (9.0, "d")], "e f  g d"), (5, 0.0, [(0.0, "x")], "x"),
    ]
    assert streams.stream_rows(pages.filter(F.lit(False)), ["page"]).collect() == []


def test_texts_of_one_file_are_dealt_out(spark, tmp_path):
    texts = [(i % 30, f"alpha (e{i}\\ عين " * 9) for i in range(40)] + [(50, None), (51, ""), (None, "x 😀 y"), (None, "a")]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    written = plans.written_streams(spark, str(tmp_path))
    assert written.select(F.spark_partition_id()).distinct().count() > 4
    found = plans.stream_lines(spark, str(tmp_path)).collect()
    lines = {(r.doc_id, r.y): (r.spans, r.x_first, r.x_last, r.line) for r in found}
    assert len(lines) == len(found) == 30 * 4 + 1 and lines[None, 720.0] == (3, 72.0, 212.0, "a x y")
    assert lines[20, 720.0] == (8, 72.0, 562.0, "alpha (e20\\ عين " * 2 + "alpha (e20\\") and lines[3, 720.0][:3] == (16, 72.0, 562.0)
