"""Rule sets, cascades and rendered files on texts of our own, with results worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from qirtas.functions import rulesets as R
from qirtas.functions import text
from qirtas.operators import cascade, casefile, choose, inventory, layout, lines, render

ONE = "نص طويل من محضر التحقيق في القضية رقم ١٢"


def of(spark, value, expression):
    return spark.createDataFrame([(value,)], "t string").select(expression(F.col("t")).alias("r")).first()["r"]


def test_forms(spark):
    assert of(spark, "a\r\nb  c \n d‏ـ", R.case_form) == "a\nb c\nd"
    assert of(spark, "x — y – z ØÙ�\n\n\n\n\nq", R.statement_form) == "x - y - z\n\n\nq"
    assert of(spark, "کتاب ٬ 12;«ا»", R.law_form) == "كتاب، ١٢؛ ا"
    assert of(spark, "فى 3 , ب/ج", R.dispute_form) == "في ٣, ب / ج"
    assert of(spark, "قرار،مادة  رقم", R.gazette_form) == "قرار، مادة رقم"
    assert of(spark, "شركةالمحترمين ؟", R.disclosure_form) == "شركة المحترمين?"
    assert of(spark, "الكويت�  x", R.chat_form) == "الكويت x"
    assert of(spark, "a\n b \n\n\n\nc ؟", R.transcript_form) == "a\n b \n\nc ؟"
    assert of(spark, "Ministry of Interior\nنص ،ثان .\n", R.polished_transcript) == "نص،ثان."
    assert of(spark, None, R.case_form) == ""


def test_corrections_come_in_order(spark):
    assert of(spark, "abc", lambda c: R.law_form(c, [("abc", "abd"), ("bd", "x")])) == "ax"


def test_scores(spark):
    assert of(spark, "", R.case_score) == float("-inf")
    # 3 characters, one line of one word
    assert of(spark, "ابج", R.case_score) == pytest.approx(3 * 0.035 + 3 * 0.72 + 3.5 + 60)
    assert of(spark, "ab", R.statement_score) == pytest.approx(2 * 0.05 + 2 * 0.08 + 2.5 + 100)
    assert of(spark, "KD 1,250 in 2024", R.statement_score) == pytest.approx(16 * 0.05 + 4 * 0.08 + 8 * 0.18 + 2.5 + 65 + 20 + 16 + 12 / 16 * 100)
    assert of(spark, "ابج", R.appeal_score) == 3.0 and of(spark, "ab", R.hearing_score) == pytest.approx(0.3)
    assert of(spark, "ابج", R.dispute_score) == 3.0 and of(spark, "مادة", R.gazette_score) == pytest.approx(4 + 55 + 3)
    assert of(spark, "", R.chat_score) == pytest.approx(-200.0)
    assert of(spark, "", R.disclosure_score) == float("-inf")


def test_line_rules(spark):
    rows = spark.createDataFrame([("س ١ ما اسمك",), ("الرقم : 12",), ("كلام عادي من غير عنوان طويل جدا",), ("(12)",)], "t string")
    got = rows.select(R.case_structural(F.col("t")).alias("s"), R.case_noise(F.col("t")).alias("n")).collect()
    assert [r["s"] for r in got] == [True, True, False, False] and [r["n"] for r in got] == [False, False, False, True]
    assert of(spark, "مادة(٥)", R.is_article_heading) and of(spark, "مادة ه", R.is_article_heading) and not of(spark, "مادة ال", R.is_article_heading)
    assert of(spark, "2016", R.is_year) and not of(spark, "216", R.is_year)
    assert of(spark, "الكويت - شرق الدور", R.without_footer) == "" and of(spark, "نص قبل الكويت - شرق الدور", R.without_footer) == "نص قبل"
    assert of(spark, "ب" * 30 + " تلفون: " + "1" * 60, R.without_footer) == "ب" * 30


def test_pages(spark):
    raw = f"{ONE}\nسطر يكمل السطر الذي قبله.\n====\nسؤال قصير\n\n"
    assert of(spark, raw, R.case_page) == f"{ONE}\nسطر يكمل السطر الذي قبله.\n\nسؤال قصير"
    long = "كلام عادي لا ينتهي بنقطة ولا يبدأ بعنوان من العناوين"
    assert of(spark, f"{long}\nوتكملة له\n(3)\n(4)\nغيره", R.case_page) == f"{long} وتكملة له\n\nغيره"
    assert of(spark, f"{long}\nوتكملة له", R.defence_page) == f"{long} وتكملة له"
    assert of(spark, f"{long}\nوتكملة له", R.dispute_page) == f"{long} وتكملة له"
    assert of(spark, "قرار رقم\n598\nلسنة\n2016", R.gazette_page) == "قرار رقم\n\nلسنة 2016"  # a bare number is noise
    assert of(spark, "| Name |\n----\nTotal  5\n", R.dispute_page_english) == "Name\nTotal 5"
    assert of(spark, None, R.case_page) == ""


def test_a_law_is_reflowed(spark):
    raw = "مادة (٥)\nيجب على صاحب العمل أن\nيدفع الأجر.\n\nوعلى العامل أن يعمل\n١. بند أول هنا\nالباب الأول"
    own = spark.createDataFrame([(raw,)], "t string").select(R.law_text(R.law_lines(F.col("t"))).alias("r")).first()["r"]
    assert own == "مادة (٥)\n\nيجب على صاحب العمل أن يدفع الأجر\n\nوعلى العامل أن يعمل\n\n١. بند أول هنا\n\nالباب الأول"


def test_articles_are_numbered_anew(spark):
    rows = [(1, 7, 0, "مادة ( ٩ )"), (1, 8, 0, "مادة ( ٩ )"), (1, 8, 1, "نص"), (1, 9, 0, "مادة ه"), (2, 8, 0, "مادة")]
    got = lines.renumbered(spark.createDataFrame(rows, "d int, page int, line_index int, line string"), "d").collect()
    assert sorted((r.d, r.page, r.line_index, r.number or 0, r.line) for r in got) == [(1, 7, 0, 0, "مادة ( ٩ )"), (1, 8, 0, 1, "مادة (١)"), (1, 8, 1, 0, "نص"), (1, 9, 0, 2, "مادة (٢)"), (2, 8, 0, 1, "مادة (١)")]


def test_questions(spark):
    rows = spark.createDataFrame([("س 12",), ("12 ج",), (" س 3 نعم",), ("س3ب",), ("نص",)], "t string")
    assert [r[0] for r in rows.select(R.question_line(F.col("t"))).collect()] == ["س12", "ج12", "س3 نعم", "س3ب", "نص"]
    assert of(spark, "دولة\nالكويت\n[Signature: علي ]\nما?", R.minutes_lines) == "دولة الكويت\nعلي\nما؟"


def test_cutting_to_a_document(spark):
    r = of(spark, "head b text END tail STOP", lambda c: lines.cut_to_document(c, ["zz", "b"], ["STOP", "END"]))
    assert r["text"] == "b text END tail" and r["notes"] == ["trimmed_before_start_pattern:b", "trimmed_after_end_pattern:STOP"]
    r = of(spark, "b text", lambda c: lines.cut_to_document(c, ["b"], ["STOP"]))
    assert r["text"] == "b text" and r["notes"] == []


def test_garbled_words(spark):
    assert of(spark, "a   b\nc", text.right_way_round) == "a   b\nc"
    assert of(spark, "باتكلا  x", text.right_way_round) == "الكتاب x"


def test_adjudication(spark):
    a = "one two three four five six seven eight nine ten 12"
    cases = [(a, a, None), (a, a + ".", None), ("", "x", None), ("x", " ", None), ("12 abc", "34 xyz", "third"), ("12 abc", "34 xyz", None), (None, None, None)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, n string, o string, r string")
    got = {r.i: r.decision for r in choose.adjudicated(rows, "n", "o", "r").collect()}
    assert [got[i].source for i in range(7)] == ["native_confirmed_by_ocr", "native_preferred", "ocr_only", "native_only", "page_resolver", "native_preferred", "native_preferred"]
    assert got[0].confidence == 1.0 and got[4].text == "third" and got[4].confidence == 0.8 and 0.4 <= got[5].confidence <= 0.75 and not got[1].digit_agreement
    far = choose.adjudicated(spark.createDataFrame([("a b 1 2", "a b 2 1")], "n string, o string"), "n", "o").first().decision
    assert not far.digit_agreement  # the order of numbers counts


def test_exactly_one(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    assert inventory.exactly_one(rows.filter("i = 1")).collect() == [(1, "a")]
    for bad in (rows, rows.filter("i > 5")):
        with pytest.raises(Exception, match="not exactly one row"):
            inventory.exactly_one(bad).collect()


def test_limits_and_copies(spark):
    files = spark.createDataFrame([("b", "x"), ("A", "x"), ("c", "y")], "name string, sha256 string")
    assert sorted(r.name for r in inventory.limited(files, 2).collect()) == ["A", "b"]
    assert sorted(r.name for r in inventory.limited(files, 2, unique=True).collect()) == ["A", "b", "c"]
    out = spark.createDataFrame([("x", "Source PDF: A\nrest")], "sha256 string, text string")
    assert {r.name: r.text for r in inventory.propagated(files, out, "name", "text").collect()} == {"A": "Source PDF: A\nrest", "b": "Source PDF: b\nrest"}


def test_first_column_that_fits(spark):
    rows = spark.createDataFrame([(1, "a", 80, 0, 100, 10), (1, "b", 62, 0, 82, 40), (1, "c", 45, 0, 65, 4)], "p int, n string, x1 int, y1 int, x2 int, y2 int")
    assert [r["n"] for r in layout.right_to_left(rows, "p").orderBy("reading_order").collect()] == ["a", "b", "c"]


def test_column_valley(spark):
    rows = [(1, float(x), 10, 400.0) for x in (10, 30, 50, 70, 310, 330, 350, 370)] + [(2, float(x), 10, 400.0) for x in range(10, 400, 20)] + [(3, 10.0, 9, 400.0)]
    got = layout.column_valley(spark.createDataFrame(rows, "p int, x double, n int, w double"), "p", "x", "n", "w").collect()
    assert [(r.p, r.boundary, r.score) for r in got] == [(1, 100.0, 1.0)]


def test_upper_median(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 3.0), ("a", 9.0), ("a", -5.0), ("b", 0.0), (None, 2.0)], "k string, v double")
    assert {r.k: r.upper_median for r in layout.upper_median(rows, ["k"], "v", 14.0).collect()} == {"a": 3.0, "b": 14.0, None: 2.0}


def test_segments_hold_headed_pages(spark):
    rows = [(1, 1, "a" * 100), (1, 2, "b"), (1, 3, "c" * 90), (1, 4, "d")]
    got = casefile.review_segments(spark.createDataFrame(rows, "k int, page int, text string"), ["k"], "page", "text", max_chars=135, max_pages=2).orderBy("segment").collect()
    assert [(r.page_start, r.page_end) for r in got] == [(1, 2), (3, 4)]
    assert got[0].raw_text == "### Page 1\n\n" + "a" * 100 + "\n\n### Page 2\n\nb"


def test_fields_of_entries(spark):
    entries = spark.createDataFrame([(1, "2", "2", " A ", 5), (1, "2", "2", "B", 6)], "k int, page_start string, page_end string, label string, ord int")
    got = casefile.coverage(entries, spark.createDataFrame([(1, 3)], "k int, page_total int"), "k").orderBy("page_start").collect()
    assert [(r.label, r.document_type, r.page_start) for r in got] == [("Unclassified bundle segment", "unknown", 1), ("A", "unknown", 2), ("Unclassified bundle segment", "unknown", 3)]
    assert got[0].ocr_watchlist == ["Document boundary classification was uncertain for this page range."] and got[1].ocr_watchlist == [] and got[1].confidence == "low"


def test_review_replies(spark):
    rows = spark.createDataFrame([('```json\n{"cleaned_text": " a ", "uncertainties": ["x", " x "]}\n```',), ("words {\"cleaned_text\": \"b\"} more",), ("nothing",)], "t string")
    got = [r[0] for r in rows.select(casefile.parse_review(F.col("t"))).collect()]
    assert (got[0].cleaned_text, got[0].uncertainties) == ("a", ["x"]) and got[1].cleaned_text == "b" and got[2] is None
    key = spark.range(1).select(casefile.review_key(F.lit(None).cast("string"), F.lit(1), F.lit(2), F.lit("l"), F.lit("t")), casefile.review_key(F.lit(" i "), F.lit(1), F.lit(2), F.lit("l"), F.lit("t"))).first()
    assert key[0] == "1:2:l:t" and key[1] == "i"


def test_cascade_and_overrides(spark):
    rows = spark.createDataFrame([(1, 0, "a", 5.0), (1, 1, "b", 9.0), (2, 0, "a", 50.0), (2, 1, "b", 90.0), (3, 0, " ", 1.0), (3, 1, "c", 0.5)], "k int, stage int, text string, score double")
    got = cascade.chosen(rows, ["k"], {1: lambda best: best["score"] < 10}, order=["stage"])
    assert {r.k: r.text for r in got.collect()} == {1: "b", 2: "a", 3: "c"}
    pages = spark.createDataFrame([(1, "x", 1.0, "s"), (2, "y", 2.0, "s")], "k int, text string, score double, source string")
    checked = spark.createDataFrame([(2, "z")], "k int, text string")
    assert {r.k: (r.text, r.score, r.source) for r in cascade.overridden(pages, checked, ["k"]).collect()} == {1: ("x", 1.0, "s"), 2: ("z", 99999.0, R.VALIDATED)}
    asked = spark.createDataFrame([(1, "e")], "k int, engine string")
    assert cascade.engine_text(asked, spark.createDataFrame([(1, "e", "t"), (1, "f", "u")], "k int, engine string, text string"), ["k"]).first()["text"] == "t"
    with pytest.raises(Exception, match="no output of e"):
        cascade.engine_text(asked, spark.createDataFrame([(1, "f", "u")], "k int, engine string, text string"), ["k"]).collect()


def test_rendered_heads(spark):
    files = spark.createDataFrame([(1, "a.pdf", "t", "ff", 2, 1, 10, None)], "k int, name string, title string, sha256 string, page_count int, embedded_pages int, embedded_chars int, duplicate_of string")
    pages = spark.createDataFrame([(1, 2, None, "tess", "raw", 6, 0, 0, "fail", "fail"), (1, 1, " x\ny ", "native_pdf", None, None, 3, 0, "pass", "pass")], "k int, page int, text string, engine string, variant string, psm int, chars int, arabic_chars int, native_status string, status string")
    plain = render.document_with_head(pages, files, "k", "disclosure").first()["rendered"]
    assert plain.startswith("Source PDF: a.pdf\nSHA256: ff\nPages: 2\nExtraction: ") and "\n\n===== Page 1 (source=native_pdf:None/psm=None; chars=3; arabic=0) =====\nx\ny\n\n===== Page 2 " in plain
    assert plain.endswith("=====\n[NO TEXT EXTRACTED BY LOCAL OCR]\n")
    chat = render.chat_markdown(pages, files, "k").first()["rendered"]
    assert chat.startswith("# t\n\n## Document Metadata\n\n- Source PDF: `a.pdf`\n") and "- First readable lines:\n  - x\n  - y\n\n---\n\n## Page 1\n\n_Source: native_pdf:None; native_quality=pass; chosen_quality=pass; chars=3; arabic=0_\n\nx\ny\n\n## Page 2" in chat
    assert "Duplicate" not in chat and "/psm=6; " in chat
    assert render.marked_pages(pages, "k", empty="-").first()["rendered"] == "===== Page 1 =====\nx\ny\n\n===== Page 2 =====\n-\n"


def test_shown_text(spark):
    m = F.struct(F.lit(0).alias("legal_anchor_hits"), F.lit(0.5).alias("single_token_ratio"))
    flags = F.array(F.lit("low_ocr_score"), F.lit("low_arabic_text"))
    row = spark.range(1).select(
        R.case_shown(F.lit("t"), flags, m, F.lit(1.0), F.lit("x")), R.case_shown(F.lit("t"), F.array(F.lit("fragmented_tokens")), m, F.lit(500.0), F.lit("x")), R.case_shown(F.lit("t"), F.array(F.lit("-")), m, F.lit(500.0), F.lit("x")),
        R.defence_shown(F.lit(" "), flags, m), R.defence_shown(F.lit("t"), F.array(F.lit("fragmented_tokens")), m),
    ).first()
    assert list(row) == [R.NO_TRUSTED_TEXT, R.BROKEN_TEXT, "t", R.NO_TRUSTED_TEXT, R.BROKEN_TEXT]


def test_run_summary(spark):
    row = lambda p, s, e, st, c: (1, p, s, e, (c, 5, 1, 0, st))
    rows = spark.createDataFrame([row(1, "a", "native_pdf", "pass", 100), row(2, "b", "tesseract", "fail", 100), row(3, "a", "native_pdf", "pass", 10)], "k int, page int, source string, engine string, m struct<chars:int,arabic_chars:int,latin_extended_noise:int,replacement_chars:int,status:string>")
    r = inventory.run_summary(rows, ["k"]).first()
    assert (r.pages, r.total_chars, r.total_arabic_chars, r.total_noise_markers) == (3, 210, 15, 3) and r.weak_pages == [2, 3] and r.ocr_pages == [2]
    assert r.chosen_sources == {"a": 2, "b": 1} and r.chosen_statuses == {"pass": 2, "fail": 1}
