"""Texts are looked through as few times as can be: what is beyond ASCII apart, counters once, no form made just to be asked."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from qirtas.functions import metrics, rulesets, text

TEXTS = [None, "", "plain 12 text", "é ü 3", "١٢ نص ۲ ²½①", "𝟙 a ❶", "x‎y z", "  \x85\n\n a", "aaاا اااa", "ſubject KD KD kd 1,234 2016"]


def rows(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string").orderBy("i")


def test_digits_and_lines_are_those_of_unicode(spark):
    others = "²³¹⁰⁴⁵⁶⁷⁸⁹①❶"
    digits = lambda t: sum(unicodedata.category(c) == "Nd" or c in others for c in t)
    t = text.text_of("t")
    found = rows(spark).select(rulesets.digits_of(t).alias("d"), rulesets._filled(t).alias("l"), text.is_blank(t).alias("b")).collect()
    for r, own in zip(found, [x or "" for x in TEXTS], strict=True):
        assert (r.d, r.l, r.b) == (digits(own), sum(x.strip() != "" for x in own.splitlines()), own.strip() == "")


def test_characters_are_changed_as_by_translate(spark):
    for wrong, right in (("é١2", "e"), ("ü ", "u "), ("‎", "")):
        found = rows(spark).select(text.translate(F.col("t"), wrong, right).alias("a"), F.translate("t", wrong, right).alias("b")).collect()
        assert all(r.a == r.b for r in found)


def test_a_form_is_not_made_just_to_be_asked(spark):
    never = F.concat(F.col("t"), F.raise_error(F.lit("made")).cast("string"))
    out = spark.createDataFrame([("plain é",)], "t string").select(metrics.rtl_share(never, F.col("t")).alias("s"), text._with_forms(never, F.col("t"))["n"].alias("n"))
    assert out.first() == (0.0, None)


def test_digits_of_a_statement_are_counted_once():
    assert str(rulesets.statement_score(F.col("t"))).count("①-⑨") == 1


def test_lines_are_cleaned_where_there_is_something_to_clean(spark):
    lines = ["", "--x--", " a　 b|", "a  b", "x ،y", "نيابةالعاصمة", "دولةالكويت  _", "\x1f\x1fz", "é é"]
    d = spark.createDataFrame([(x,) for x in lines], "t string")
    edge = r"\s\-_ـ*|\\/<>"
    plain = F.regexp_replace(F.regexp_replace("t", f"(?U)^[{edge}]+", ""), rf"(?U)[{edge}]+\z", "")
    found = d.select("t", rulesets._trimmed(F.col("t"), edge).alias("a"), plain.alias("b"), rulesets._one_space(F.col("t")).alias("c"), F.regexp_replace("t", r"(?U)\s{2,}", " ").alias("d"), rulesets.joined_words_apart(F.col("t")).alias("e")).collect()
    assert all((r.a, r.c) == (r.b, r.d) for r in found)
    assert [r.e for r in found if r.e != r.t] == ["نيابة العاصمة", "دولة الكويت  _"]
