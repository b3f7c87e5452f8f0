"""Measures, predicates and scores of texts as column expressions."""

from __future__ import annotations

import re
import string
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fields import articles, case_numbers, dates
from .text import ARABIC, EASTERN, PRESENTATION, WESTERN, beyond, full_lines, is_blank, let, squeeze, strip, strip_end, text_of, tokens, unix_lines
from .udfs import rtl_ratio

# Replies of recognition models that found no text.
NO_TEXT_REPLIES = (
    "there is no visible text in the provided image.",
    "there is no text in the provided image.",
    "there is no visible text in the image provided.",
    "no text is visible in the provided image.",
    "no text visible",
    "no visible text in the provided image.",
    "no visible text found.",
    "no visible text detected in the provided image.",
    "no visible text detected.",
    "no visible text detected",
    "no visible text to extract.",
    "no visible text to extract",
    "no visible text to extract from the provided image.",
    "no visible printed or handwritten text to extract from the provided image.",
    "no visible printed or handwritten text to extract.",
    "sorry, i can't extract any visible text from this image.",
    "sorry, i cannot extract any visible text from this image.",
    "the image appears to be blank or too faint to read.",
    "the image appears blank or too faint to read.",
    "لا يوجد نص مرئي في هذه الصورة.",
    "لا يوجد نص مرئي في الصورة المقدمة.",
    "لا يوجد نص ظاهر في هذه الصورة.",
)
SEEN_WORDS = ("visible", "extract", "extractable", "faint", "blank", "legible", "read")
SEEN_WORDS_ARABIC = ("مرئي", "واضح", "مقروء", "ظاهر")
ONE_OF = re.compile(r"(?:\(\?U\))?(?:\[(?:[^\[\]\\&]|&(?!&)|\\.)+\]|\\p\{\w+\})")  # a pattern of one character of a class
EDGE = r"^[()\[\]{} .]+|[()\[\]{} .]+$"


def any_of(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def count_of(c: Column, pattern: str) -> Column:
    """Matches of a pattern. Characters of a class are counted by what is left without their runs, as each match
    would make a string of its own."""
    if ONE_OF.fullmatch(pattern) and _beyond_ascii(pattern):
        return let(beyond(c), lambda u: F.length(u) - F.length(F.regexp_replace(u, pattern + "+", "")))
    if ONE_OF.fullmatch(pattern):
        for name, chars in (("A-Z", string.ascii_uppercase), ("a-z", string.ascii_lowercase), ("0-9", string.digits)):
            pattern = pattern.replace(name, chars)  # Java looks single characters up in one table
        return F.length(c) - F.length(F.regexp_replace(c, pattern + "+", ""))
    return F.regexp_count(c, F.lit(pattern))


def _beyond_ascii(pattern: str) -> bool:
    """Is this a class of nothing but characters beyond ASCII and ranges between such?"""
    body = pattern[1:-1]
    return pattern[0] == "[" and body.strip("-") == body and all(x > "\x7f" for x in body.replace("-", ""))


def token_stats(c: Column) -> Column:
    """Struct of the token count, the share of one-character tokens, and that of tokens of at most two
    characters with a digit."""
    return let(tokens(text_of(c)), _token_stats)


def _token_stats(words: Column) -> Column:
    n = F.size(words)
    short = F.size(F.filter(words, lambda t: F.length(t) == 1))
    digits = F.size(F.filter(words, lambda t: (F.length(t) <= 2) & t.rlike(r"(?U)\d")))
    return F.struct(n.cast("long").alias("token_count"), share(short, n).alias("single_char_ratio"), share(digits, n).alias("digit_fragment_ratio"))


def low_quality(stats: Column) -> Column:
    return (stats["token_count"] == 0) | (stats["single_char_ratio"] > 0.3) | (stats["digit_fragment_ratio"] > 0.2)


def no_text_reply(c: Column) -> Column:
    """Is the text a model's reply that there is none, or a scanner's mark?"""
    return let(F.regexp_replace(squeeze(F.lower(text_of(c))), EDGE, ""), _no_text_reply)


def _no_text_reply(t: Column) -> Column:
    starts = sorted({x.strip("()[]{} .") for x in NO_TEXT_REPLIES})
    starts = [x for x in starts if not any(x != y and x.startswith(y) for y in starts)]
    found = (
        t.startswith("scanned with") | t.contains("camscanner")
        | (t.contains("image") & t.contains("text") & any_of(t.contains(w) for w in SEEN_WORDS))
        | (t.contains("الصورة") & t.contains("نص") & any_of(t.contains(w) for w in SEEN_WORDS_ARABIC))
        | any_of(t.startswith(x) for x in starts)
    )
    return (t != "") & found


def without_replies(c: Column) -> Column:
    """Lines that are no such reply, right-stripped, at most one blank line in a row."""
    kept = F.filter(F.split(unix_lines(text_of(c)), "\n"), lambda x: ~no_text_reply(x))
    text = F.array_join(F.transform(kept, strip_end), "\n")
    return F.regexp_replace(strip(text), "\n{3,}", "\n\n")


def sanitised(c: Column) -> Column:
    return let(without_replies(c), lambda t: F.when(no_text_reply(t), F.lit("")).otherwise(t))


def quality_score(c: Column) -> Column:
    """Score of a transcription: more tokens, lines, letters and fields raise it; fragments and long runs of
    one character lower it; -1 for no text."""
    return let(strip(text_of(c)), lambda t: let(F.struct(token_stats(t).alias("stats"), F.size(full_lines(t)).alias("lines")), lambda m: _quality_score(t, m["stats"], m["lines"])))


def _quality_score(t: Column, stats: Column, n_lines: Column) -> Column:
    n, arabic = stats["token_count"], count_of(t, "[؀-ۿ]")
    letters = count_of(t, r"(?U)[A-Za-z\d]") + arabic
    fields = sum((F.size(f) > 0).cast("int") for f in (case_numbers(t), dates(t), articles(t)))
    score = (
        F.least(n, F.lit(120)) / 120 * 1.2 + F.least(n_lines, F.lit(12)) / 12 * 0.25
        + F.least(letters / F.greatest(F.length(t), F.lit(1)), F.lit(1.0)) * 0.45 + fields * 0.12 + F.when(arabic > 0, 0.2).otherwise(0.0)
        - stats["single_char_ratio"] * 1.6 - stats["digit_fragment_ratio"] * 1.3
        - F.least(count_of(t, r"(?d)(.)\1{4,}"), F.lit(3)) * 0.1 - F.when((n >= 20) & (n_lines <= 1), 0.2).otherwise(0.0)
    )
    return F.when((t == "") | no_text_reply(t), F.lit(-1.0)).otherwise(score)


def overlap_tokens(c: Column) -> Column:
    t = F.translate(F.lower(F.translate(text_of(c), EASTERN, WESTERN)), "\u0640", " ")
    return F.regexp_extract_all(t, F.lit("[0-9A-Za-z؀-ۿ]+"), F.lit(0))


def token_overlap(left: Column, right: Column) -> Column:
    """Share of the left text's tokens that the right text has."""
    return token_list_overlap(overlap_tokens(left), overlap_tokens(right))


def token_list_overlap(a: Column, b: Column) -> Column:
    shared = F.size(F.filter(a, lambda x: F.array_contains(b, x)))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(shared / F.size(a))


def contains_arabic(c: Column) -> Column:
    return beyond(text_of(c)).rlike(ARABIC)


def weird_ratio(c: Column) -> Column:
    t = text_of(c)
    return share(count_of(t, "[\u00c0-\u02af\u1d00-\u1eff]"), F.length(t))


def suspicious_ratio(c: Column) -> Column:
    """Share of Arabic characters that plain prose doesn't use; presentation forms all count."""
    t = text_of(c)
    usual = count_of(t, "[\u0621-\u064a\u060c\u061b\u061f\u066a-\u066c\u0660-\u0669]")
    every = count_of(t, "[؀-ۿݐ-ݿࢠ-ࣿﭐ-﻿]")
    return share(every - usual, every)


def nonstandard_ratio(c: Column) -> Column:
    t = F.regexp_replace(text_of(c), r"(?U)\s", "")
    usual = count_of(t, "[\u0000-\u024f\u0600-\u06ff\u0750-\u077f\u08a0-\u08ff\ufb50-\ufdff\ufe70-\ufeff\u2000-\u206f]")
    return share(F.length(t) - usual, F.length(t))


def repeated_run_ratio(c: Column) -> Column:
    t = text_of(c)
    runs = F.regexp_extract_all(beyond(t), F.lit("([؀-ۿ])\\1{2,}"), F.lit(0))
    size = F.aggregate(runs, F.lit(0), lambda n, x: n + F.length(x))
    return share(size, count_of(t, ARABIC))


def quality_status(c: Column) -> Column:
    """Struct of status (pass, warn, fail, not_arabic), issues and the measures they rest on."""
    t = text_of(c)
    return let(F.struct(t.alias("t"), rtl_share(t).alias("rtl")), lambda x: quality_status_of(x["t"], x["rtl"]))


def _right_to_left() -> str:
    """A class of all characters that are written from right to left, and of those whose plain forms may be."""
    own = [i for i in range(0x110000) if unicodedata.bidirectional(chr(i)) in ("R", "AL", "AN")]
    there, ends = set(own), []
    for i in own:
        if i - 1 not in there:
            ends.append([i, i])
        ends[-1][1] = i
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ends) + PRESENTATION[1:]


RIGHT_TO_LEFT = _right_to_left()


def rtl_share(t: Column, raw: Column | None = None) -> Column:
    """``rtl_ratio``, for which texts without right-to-left characters need not be handed over. ``raw`` is what ``t`` was
    made from, by steps that bring no such character into a text without one; then ``t`` is not made just to be asked."""
    asked = let(t, lambda x: F.when(beyond(x).rlike(RIGHT_TO_LEFT), x))
    if raw is not None:
        asked = F.when(beyond(raw).rlike(RIGHT_TO_LEFT), asked)
    return F.coalesce(rtl_ratio(asked), F.lit(0.0))


def quality_status_of(t: Column, rtl: Column) -> Column:
    """``quality_status`` of a text whose share of right-to-left letters is known."""
    seen = F.struct(is_blank(t).alias("blank"), contains_arabic(t).alias("arabic"), weird_ratio(t).alias("weird"), rtl.alias("rtl"), suspicious_ratio(t).alias("odd"), repeated_run_ratio(t).alias("runs"), count_of(t, ARABIC).alias("n"))
    return let(seen, _quality_status)


def _quality_status(s: Column) -> Column:
    blank, arabic, weird, rtl, odd, runs = (s[k] for k in ("blank", "arabic", "weird", "rtl", "odd", "runs"))
    full = arabic & ~blank
    issue = lambda name, when: F.when(when, F.lit(name))
    issues = F.array_compact(F.array(
        issue("suspicious_arabic_mapping", full & (odd >= 0.03)), issue("latin_extended_glyph_noise", ~blank & (weird >= 0.01)),
        issue("repeated_arabic_run_noise", full & (runs >= 0.03)), issue("low_rtl_ratio", full & (rtl < 0.25)),
    ))
    status = (
        F.when(blank, "not_arabic").when(~arabic, F.when(weird >= 0.10, "fail").otherwise("not_arabic"))
        .when((weird >= 0.10) | (odd >= 0.05) | (runs >= 0.05), "fail").when(F.size(issues) > 0, "warn").otherwise("pass")
    )
    measures = F.struct(
        rtl.alias("rtl_ratio"), F.when(blank | arabic, odd).otherwise(0.0).alias("suspicious_arabic_char_ratio"), weird.alias("weird_glyph_ratio"),
        F.when(full | blank, runs).otherwise(0.0).alias("repeated_arabic_run_ratio"), F.when(full, s["n"]).otherwise(0).cast("long").alias("arabic_char_count"),
    )
    return F.struct(status.alias("status"), issues.alias("issues"), measures.alias("metrics"))


def single_letter_ratio(c: Column) -> Column:
    """Share of one-letter words among those with Arabic."""
    words = F.filter(tokens(text_of(c)), lambda w: w.rlike("[؀-ۿ]"))
    return share(F.size(F.filter(words, lambda w: F.length(w) == 1)), F.size(words))


def mean_arabic_word(c: Column) -> Column:
    words = F.filter(tokens(text_of(c)), lambda w: w.rlike("[؀-ۿ]"))
    return share(F.aggregate(words, F.lit(0), lambda n, w: n + F.length(w)), F.size(words))


def native_score(c: Column) -> Column:
    """Score of a page's text candidate from its file; blank texts come last."""
    t = text_of(c)
    return let(F.struct(t.alias("t"), rtl_share(t).alias("rtl")), lambda x: _native_score(x["t"], contains_arabic(x["t"]), x["rtl"]))


def _native_score(t: Column, arabic: Column, rtl: Column) -> Column:
    score = (
        F.least(F.length(strip(t)), F.lit(2000)) / 2000.0 + F.when(arabic, 100.0).otherwise(0.0) + F.when(rtl >= 0.5, 10.0).otherwise(0.0)
        + rtl * 10.0 - weird_ratio(t) * 120.0 - repeated_run_ratio(t) * 250.0 - F.when(arabic, single_letter_ratio(t)).otherwise(1.0) * 15.0
    )
    return F.when(strip(t) == "", F.lit(float("-inf"))).otherwise(score)


def status_score(quality: Column) -> Column:
    m = quality["metrics"]
    base = F.when(quality["status"] == "pass", 3.0).when(quality["status"] == "warn", 2.0).when(quality["status"] == "not_arabic", 1.0).otherwise(0.0)
    return (
        base * 1000.0 + m["rtl_ratio"] * 50.0 + F.least(m["arabic_char_count"].cast("double"), F.lit(5000.0)) / 100.0
        - m["weird_glyph_ratio"] * 1500.0 - m["suspicious_arabic_char_ratio"] * 1200.0 - m["repeated_arabic_run_ratio"] * 1500.0
    )


def page_score(c: Column) -> Column:
    """The scale differs for texts with and without Arabic, as the choice of page texts has it."""
    t = text_of(c)
    status = lambda x: let(quality_status_of(x["t"], x["rtl"]), status_score)
    return let(F.struct(t.alias("t"), rtl_share(t).alias("rtl")), lambda x: F.when(contains_arabic(x["t"]), status(x)).otherwise(_native_score(x["t"], contains_arabic(x["t"]), x["rtl"])))


def text_metrics(c: Column) -> Column:
    """Counters and shares of one page's text."""
    return let(text_of(c), lambda t: let(tokens(t), lambda words: _text_metrics(t, words)))


def _text_metrics(t: Column, words: Column) -> Column:
    n = F.size(words)
    one, digit = F.size(F.filter(words, lambda w: F.length(w) == 1)), F.size(F.filter(words, lambda w: (F.length(w) <= 2) & w.rlike(r"(?U)\d")))
    long = lambda x, name: x.cast("long").alias(name)
    return F.struct(
        long(F.length(t), "chars"), long(count_of(t, "[؀-ۿ]"), "arabic_chars"), long(count_of(t, "[A-Za-z]"), "latin_chars"), long(count_of(t, r"(?U)\d"), "digits"),
        long(n, "tokens"), long(F.size(full_lines(t)), "lines"), long(count_of(t, "�"), "replacement_chars"), long(count_of(t, "[ØÙÃÂ]"), "mojibake_chars"),
        F.round(share(one, n), 4).alias("single_ratio"), F.round(share(digit, n), 4).alias("digit_fragment_ratio"),
    )
