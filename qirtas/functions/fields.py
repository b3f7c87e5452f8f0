"""Field extraction, line classes and the guards on refined lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, squeeze, strip, text_of, tokens

# Patterns and hint words.
CASE_NUMBER = r"(?U)\b\d[\d/\-]{2,}\b"
DATE = r"(?U)\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b"
ARTICLE = r"(?U)(المادة|مادة)\s+\d+"
HEADER_HINT = "(?iu)النيابة|وزارة|العدل|المحامي العام|prosecution|attorney general|justice|deputy attorney"
CASE_HINT = "القضية|رقم|لسنة|حصر|نيابة"
DATE_HINT = "بتاريخ|الموافق|تاريخ"
NAME_HINT = "الشاكي|المشكو|المتهم|ضد|المدعي|المدعى|المجني"
SLASHED_NAME = r"(?U)(الشاكي|المشكو(?:\s+في\s+حقه)?|المتهم|المدعي|المدعى|المجني)\s*/"
CASE_KEYWORDS = ("القضية", "رقم", "لسنة", "حصر", "نيابة")
AGREED = "الموافق"


def case_numbers(c: Column) -> Column:
    return F.regexp_extract_all(text_of(c), F.lit(CASE_NUMBER), F.lit(0))


def dates(c: Column) -> Column:
    return F.regexp_extract_all(text_of(c), F.lit(DATE), F.lit(0))


def articles(c: Column) -> Column:
    """The word for an article wherever a number follows; the number itself is not part of the result."""
    return F.regexp_extract_all(text_of(c), F.lit(ARTICLE), F.lit(1))


def numbers(c: Column) -> Column:
    return F.regexp_extract_all(text_of(c), F.lit(r"(?U)[\d.,/:-]+"), F.lit(0))


def line_class(text: Column, index: Column, total: Column) -> Column:
    """Which lines deserve a second reading: header, case, date, name or title line; else null."""
    return let(strip(text_of(text)), lambda t: let(_hints(t), lambda h: _line_class(t, h, index, total)))


def _hints(t: Column) -> Column:
    return F.struct(
        F.size(tokens(t)).alias("n"), t.rlike(HEADER_HINT).alias("header"), (t.rlike(CASE_HINT) | t.rlike(CASE_NUMBER)).alias("case"), (t.rlike(DATE_HINT) | t.rlike(DATE)).alias("date")
    )


def _line_class(t: Column, h: Column, index: Column, total: Column) -> Column:
    n, header, case, date = h["n"], h["header"], h["case"], h["date"]
    top = index <= F.least(F.floor(total / 2), F.lit(10))
    none = F.lit(None).cast("string")
    return (
        F.when((t == "") | (top & header & date & (n > 4)), none)
        .when((n <= 8) & header & top, "header").when((n <= 14) & top & case, "case_line").when((n <= 10) & top & date, "date_line")
        .when((n <= 10) & t.rlike(SLASHED_NAME) & t.rlike(NAME_HINT), "name_line").when((index <= 2) & (n <= 8), "title_line").otherwise(none)
    )


def refinement_verdict(original: Column, refined: Column, label: Column) -> Column:
    """Why a refined line is taken or not: the first guard that it fails, else ``accepted``."""
    from .metrics import no_text_reply, token_overlap

    both = F.struct(squeeze(text_of(original)).alias("a"), squeeze(text_of(refined)).alias("b"))
    more = lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), token_overlap(x["a"], x["b"]).alias("overlap"), no_text_reply(refined).alias("reply"))
    return let(both, lambda x: let(more(x), lambda y: _verdict(y, text_of(refined), label)))


def _verdict(x: Column, refined: Column, label: Column) -> Column:
    a, b, overlap = x["a"], x["b"], x["overlap"]
    ratio = F.length(b) / F.greatest(F.length(a), F.lit(1))
    digit = lambda x: x.rlike(r"(?U)\d")
    differs = lambda pattern: a.rlike(pattern) != b.rlike(pattern)
    n_a, n_b = F.size(tokens(a)), F.size(tokens(b))
    is_title, keyword = label.isin("header", "title_line"), "|".join(CASE_KEYWORDS)
    lost = lambda word: a.contains(word) & ~b.contains(word)
    return (
        F.when(refined == "", "empty").when(x["reply"], "hallucinated").when(b == "", "blank_after_cleanup").when(a == b, "unchanged")
        .when((ratio < 0.45) | (ratio > 2.2), "length_ratio").when((n_a <= 5) & (n_b > n_a + 3), "too_many_new_tokens").when(digit(a) & ~digit(b), "lost_digits")
        .when((label == "case_line") & ~digit(b), "case_line_without_digits")
        .when(is_title & (differs("[A-Za-z]") | differs("[؀-ۿ]")), "script_shift").when(is_title & ~digit(a) & digit(b), "unexpected_digits")
        .when(is_title & (overlap < 0.6), "low_token_overlap").when(is_title & lost(AGREED), "missing_date_keyword")
        .when((label == "case_line") & a.rlike(keyword) & ~b.rlike(keyword), "missing_case_keywords").when((label == "case_line") & (overlap < 0.4), "low_token_overlap")
        .when((label == "date_line") & lost(AGREED), "missing_date_keyword").when((label == "date_line") & (overlap < 0.6), "low_token_overlap")
        .when((label == "name_line") & lost("/"), "missing_name_separator").when((label == "name_line") & (overlap < 0.5), "low_token_overlap")
        .otherwise("accepted")
    )
