"""Expressions against plain models of the rules."""

from __future__ import annotations

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from qirtas.functions import fields, metrics, text, udfs


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string").select("i", expression(F.col("t")).alias("r")).orderBy("i")
    return [r["r"] for r in rows.collect()]


def test_normal_forms(spark):
    given = ["أحمد  إلى‏\n\n\n\nمَكتَب ٣٤", "ﻻ ﷲ", None, "", " \t ", "الـــعدل", "a\r\nb  \nc"]
    assert column(spark, given, text.normalise_legacy) == ["احمد الي مكتب 34", unicodedata.normalize("NFKC", "ﻻ ﷲ"), "", "", "", "العدل", "a b c"]
    assert column(spark, given, text.normalise_faithful)[0] == "أحمد إلى\n\nمَكتَب ٣٤"
    assert column(spark, given, text.normalise_llm)[6] == "a\nb\nc"


@pytest.mark.parametrize("given, expected", [("اإلدارة", "الإدارة"), ("االتحاد", "الاتحاد"), ("ابحملكمة", "بالمحكمة"), ("احلكم", "الحكم"), ("احملكوم", "المحكوم"), ("واملال", "والمال"), ("عامل", "عامل"), ("حممد", "محمد")])
def test_ligature_order(spark, given, expected):
    assert column(spark, [given], text.lam_order) == [expected]


def test_punctuation_and_letters(spark):
    assert column(spark, ["نعم ، لا؟"], text.clean_arabic) == ["نعم, لا?"]
    assert column(spark, ["مدرسة أولى"], text.plain_letters) == ["مدرسه اولي"]
    assert column(spark, ["كلملا  الملك ab"], text.right_way_round) == ["الملك الملك ab"]


def reply_model(t):
    n = " ".join(t.strip().lower().split()).strip("()[]{} .")
    if not n:
        return False
    marks = n.startswith("scanned with") or "camscanner" in n
    seen = "image" in n and "text" in n and any(w in n for w in metrics.SEEN_WORDS)
    return marks or seen or any(n.startswith(p.strip("()[]{} .")) for p in metrics.NO_TEXT_REPLIES)


def test_replies(spark):
    given = ["(No visible text to extract)", "[no text visible.]", "Scanned with X", "by CamScanner", "image text already", "text only", "", "No Visible Text Found", "لا يوجد نص مرئي في هذه الصورة."]
    assert column(spark, given, metrics.no_text_reply) == [reply_model(t) for t in given]
    assert column(spark, ["a\n(no text visible)\n\n\n\nb  \r\n"], metrics.without_replies) == ["a\n\nb"]


def test_statistics_on_random_texts(spark):
    rng = random.Random(4)
    given = ["".join(rng.choice(["a", "B1", "3", " ", "\n", "é", "ab", "12"]) for _ in range(rng.randrange(0, 30))) for _ in range(200)] + [None]
    found = column(spark, given, metrics.token_stats)
    for t, s in zip(given, found, strict=True):
        words = (t or "").split()
        n = len(words)
        one, frag = sum(len(w) == 1 for w in words), sum(len(w) <= 2 and any(c.isdigit() for c in w) for w in words)
        assert (s["token_count"], s["single_char_ratio"], s["digit_fragment_ratio"]) == (n, one / n if n else 0.0, frag / n if n else 0.0)


def test_quality_of_nothing(spark):
    assert column(spark, [None, " ", "no text visible"], metrics.quality_score) == [-1.0] * 3


def test_arabic_quality(spark):
    q = column(spark, ["", "hello", "è" * 9 + "a", "هذا نص عربي سليم تماما", "تتتتتتت القضااااا"], metrics.quality_status)
    assert [x["status"] for x in q] == ["not_arabic", "not_arabic", "fail", "pass", "fail"]
    assert q[4]["issues"] == ["repeated_arabic_run_noise"]


def test_fields(spark):
    assert column(spark, ["رقم 123/2025 بتاريخ 22/7/2025"], fields.case_numbers) == [["123/2025", "22/7/2025"]]
    assert column(spark, ["المادة 12"], fields.articles) == [["المادة"]]


@pytest.mark.parametrize("a, b, label, verdict", [
    ("القضية رقم 12/2020", "القضية رقم", "case_line", "lost_digits"), ("Ministry of Justice", "وزارة العدل الان", "header", "script_shift"), ("القضية رقم 12/2020", "القضية رقم 12/2021", "case_line", "accepted"),
    ("abc", "abc", "header", "unchanged"), ("abc def", "", "header", "empty"), ("ab", "abcdefgh", "header", "length_ratio"), ("a/b name here", "ab name here", "name_line", "missing_name_separator"),
])
def test_refinement(spark, a, b, label, verdict):
    row = spark.createDataFrame([(a, b, label)], "a string, b string, l string").select(fields.refinement_verdict(F.col("a"), F.col("b"), F.col("l")).alias("v"))
    assert row.first()["v"] == verdict


def test_edit_distance():
    rng = random.Random(1)

    def slow(x, y):
        row = list(range(len(y) + 1))
        for i, v in enumerate(x, 1):
            new = [i]
            for j, w in enumerate(y, 1):
                new.append(min(row[j - 1] + (v != w), row[j] + 1, new[-1] + 1))
            row = new
        return row[-1]

    for _ in range(300):
        x, y = ([rng.choice("abc") for _ in range(rng.randrange(7))] for _ in range(2))
        assert udfs.edit_distance(x, y) == slow(x, y)


def test_what_stays_away_from_python_is_in_its_form(spark):
    """Strings of settled characters are their own form, whatever their order."""
    pattern = re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: "\\u" + m[1].rjust(4, "0"), f"[^\\x00-\\x7f{text.SETTLED}]"))
    settled = [chr(i) for i in range(0xD800) if not pattern.match(chr(i))]
    rng = random.Random(1)
    assert len(settled) > 20_000 and "é" in settled and "م" in settled and "\u0301" not in settled and "ﻻ" not in settled and "²" not in settled
    every = "".join(settled)
    assert all(unicodedata.normalize(f, every) == every for f in ("NFC", "NFKC"))
    for _ in range(300):
        t = "".join(rng.choice(settled[:1500]) for _ in range(60))
        assert all(unicodedata.normalize(f, t) == t for f in ("NFC", "NFKC"))
    seen = spark.createDataFrame([(i, chr(i)) for i in range(1, 0xD800, 7)], "i int, c string").filter(F.col("c").rlike(text.UNSETTLED)).collect()
    assert {r.i for r in seen} == {i for i in range(1, 0xD800, 7) if pattern.match(chr(i))}
