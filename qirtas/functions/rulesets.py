"""Rule sets for texts of one kind of collection: normal form, measures, score, line rules, page text.

A set is named after the kind of paper it was made for:

``disclosure``  notices of a stock exchange, Arabic      ``statement``  financial statements, English
``chat``        papers sent by chat, Arabic              ``upload``     native texts to be passed on
``case``        files of a criminal case                 ``defence``    pleadings with their exhibits
``dispute``     scans of a labour dispute                ``gazette``    the official gazette in two columns
``law``         a law in numbered articles               ``appeal``, ``hearing``  transcripts, scored only

What a set shares with others is written once; what is its own is data. Literal corrections of a collection
are a parameter everywhere (pairs of wrong and right, applied in order), since they are long and belong to it.
Letters, digits and white space are those of Unicode. A null text counts as empty."""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .metrics import any_of, count_of, quality_status_of, rtl_share, weird_ratio
from .text import beyond, cleaned_if_arabic, compose, is_blank, let, lines, replace_all, strip, strip_end, strip_text, text_of, translate, unix_lines, where_beyond, where_there, without
from .udfs import nfc, nfkc

Pairs = Iterable[tuple[str, str]]

# Character classes.
BIDI = "[‎‏‪-‮⁦-⁩]"
CONTROL = "[" + "".join(f"\\x{i:02x}" for i in (*range(9), *range(11, 32), *range(127, 160))) + "]"  # Java looks single characters up in one table
CONTROL_NARROW = "[" + "".join(f"\\x{i:02x}" for i in (*range(9), 11, 12, *range(14, 32))) + "]"
AR, LETTER, MARKS = "[؀-ۿ]", "ء-ي", "[ً-ٰٟ]"
VOWELS = "ًٌٍَُِّْ"
EASTERN, WESTERN = "٠١٢٣٤٥٦٧٨٩", "0123456789"
DIGIT = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈➊-➒]"
DIGITS = rf"[[^\x00-/:-\x7fÀ-\u065f]&&{DIGIT}]+"  # the first part tells most characters
WIDE = "[" + "".join(f"\\x{i:02x}" for i in (*range(33), *range(127, 161))) + r"\u1680-\u3000]"  # all white space, and more
LINE_ENDS = r"[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028-\u2029]+"
FORM_FIRSTS, FORM_SECONDS = "IiNnDdAaTtSsBbFf", "DdAaMmOoIiUuRr"  # of the words of forms
FOLDED = "[\u0130\u0131\u017f\u212a]"  # their other case is an ASCII letter
LETTERS = f"[{string.ascii_letters}]"  # Java looks single characters up in one table
BEFORE, AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"  # the edges of a word

# Words that speak for a right reading.
DISCLOSURE_WORDS = (
    "الكويت", "بورصة", "شركة", "المستقبل", "الأجيال", "افصاح", "إفصاح", "الجمعية", "مجلس", "الإدارة", "البيانات", "المالية", "الربع", "النصف",
    "السنوية", "الدخل", "المركز", "الأرباح", "الخسائر", "رأس", "المال", "دينار", "فلس", "سهم", "أسهم", "تداول", "تسهيلات", "ائتمانية",
)
STATEMENT_WORDS = (
    "Future Kid", "Entertainment", "Real Estate", "K.S.C", "consolidated", "statement", "financial", "income", "profit", "loss", "assets", "liabilities",
    "equity", "cash", "flows", "Kuwaiti", "Dinars", "KD", "unaudited", "auditor", "subsidiaries", "quarter", "period", "year",
)
CASE_WORDS = (
    "النيابة", "نيابة", "التحقيق", "تحقيق", "محضر", "المتهم", "الشاكي", "المجني", "قضية", "حصر", "العاصمة", "مكافحة", "الاتجار", "الأشخاص", "سوق المال",
    "بوبيان", "نواف", "أرحمه", "ارحمه", "دبوس", "الشركة", "المادة", "قانون", "رئيس", "مجلس", "أقوال", "سؤال", "جواب", "الواقعة", "البلاغ",
)
CASE_WORDS_ENGLISH = ("civil id", "passport", "nationality", "date of birth", "expiry", "kuwait", "public prosecution", "ministry", "company", "university")
DEFENCE_WORDS = (
    "مذكرة", "دفاع", "حافظة", "مستندات", "محكمة", "القضية", "الدعوى", "النيابة", "الشاكي", "المتهم", "المدعي", "المدعى", "المادة", "القانون", "شركة",
    "إياس", "اياس", "بوبيان", "البتروكيماويات", "دبوس", "الدبوس", "نواف", "ارحمه", "أرحمه", "جامعة", "الخليج", "مجلس", "الأمناء", "الاستقالة", "الشيك",
    "شيك", "الإكراه", "التهديد", "شاهد", "المحامي", "وكيل", "دفوع", "طلبات",
)
DISPUTE_WORDS = ("محكمة", "الدعوى", "شركة", "العامل", "مجلس", "المادة", "الخبير")
GAZETTE_WORDS = ("الشركات", "اللائحة", "التنفيذية", "القانون", "الوزارة", "التجارة", "الصناعة", "قرار", "مادة", "الشركة", "الجمعية", "مجلس الإدارة", "رأس المال", "السجل التجاري", "المساهمين")

# Patterns and words of lines.
CASE_QUESTION = r"^\s*(?:[سج]\s*\p{Nd}+|\p{Nd}+\s*[سج]|[سج]\s*[:/.-])"
FIELD = "^[؀-ۿA-Za-z ()/.-]{2,%d}\\s*[:：]"
NUMBERED = r"^\s*(?:\p{Nd}+|[٠-٩]+|[أ-ي])[\-.)،:]\s+"
CASE_TITLES, CASE_OPENINGS = ("محضر", "النيابة", "نيابة", "مكتب", "التاريخ", "الموضوع", "السيد", "التهمة", "الرقم"), "دولة الكويت|وزارة|النيابة العامة|محكمة|إدارة|مكتب"
DEFENCE_TITLES = ("مذكرة", "حافظة", "مستند", "الموضوع", "الطلبات", "الدفاع", "الوقائع", "أولا", "ثانيا", "ثالثا", "رابعا", "خامسا")
DEFENCE_OPENINGS = "السادة|ضد|ضدنا|مقدمة|وكيل|المحكمة|محكمة|النيابة|شركة"
DISPUTE_TITLES = ("مذكرة", "محضر", "جدول الأعمال", "أسباب", "طلبات", "الدفاع", "الموضوع")
GAZETTE_OPENINGS = "قانون|قرار|مرسوم|مادة|الفصل|الباب|وزير|وزارة|بعد الاطلاع|وعلى|وبناء|صدر|نشر"
CASE_NOISE = ("ايزيا", "1انام", "اناا", "ب", "ا")
FOOTERS = ("الكويت - شرق", "الكويت -شرق", "الكويت - شرق --", "الكويت - شر ق")
CONTACTS, CONTACT_OPENINGS = ("بريد إلكتروني", "بريد إلقكتروني", "تلفون:", "فاكس:"), ("تلفون", "فاكس", "بريد إلكتروني", "بريد إلقكتروني")
LAW_HEADINGS = ("أحكام عامة", "الاستخدام", "التلمذة والتدريب المهني")
LAW_OPENINGS, LAW_BREAKS = ("بعد الاطلاع", "وعلى ", "وبعد ", "وبناء ", "وافق "), ("وعلى ", "وبعد ", "وبناء ", "وافق ")
APPEAL_LEFT_OUT = (
    "Public Prosecution - State of Kuwait", "Ministry of Interior", "General Department Of Criminal Investigation", "General Department of Criminal Investigation",
    "Department of Investigation Asimah", "Sharq criminal Investigation Office", "Sharq Criminal Investigation Office",
)
NO_TRUSTED_TEXT = "[صفحة مرفق/صورة. لم يستخرج OCR المحلي نصا عربيا موثوقا منها دون إدخال بيانات بالحدس.]"
BROKEN_TEXT = "[صفحة مرفق/صورة منخفضة الجودة. تم حجب ناتج OCR المحلي لأنه كان مفككا وغير موثوق، والنسخة الخام محفوظة في مجلد التدقيق.]"
VALIDATED = "visual_llm_validated_from_rendered_page"


def _sub(c: Column, pattern: str, right: str) -> Column:
    return F.regexp_replace(c, "(?U)" + pattern, right)


def _count(c: Column, pattern: str) -> Column:
    return count_of(c, "(?U)" + pattern)


def occurrences(c: Column, word: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(word), F.lit("")))) / len(word)).cast("long")


def word_hits(c: Column, words: Iterable[str], far: Column | None = None) -> Column:
    """Occurrences of all words; each is counted only in texts that hold it, and words that begin beyond ASCII are looked for
    only in texts with one of their first letters, which ``far`` tells if the characters beyond ASCII are at hand. ``c`` is
    named often."""
    words, none = list(words), F.lit(0).cast("long")
    found = sum((F.when(c.contains(w), occurrences(c, w)).otherwise(none) for w in words), none)
    firsts = "".join(sorted({w[0] for w in words}))
    if firsts and firsts[0] > "\x7f":
        found = F.when((beyond(c) if far is None else far).rlike(f"[{firsts}]"), found).otherwise(none)
    return F.when(c.isNotNull(), found)


def composed(c: Column, kind: Callable = nfc) -> Column:
    return compose(c, kind)


def digits_of(c: Column, far: Column | None = None) -> Column:
    """Digits of Unicode; those beyond ASCII are looked for in what is beyond ASCII, as their class is a long one."""
    return count_of(c, "[0-9]") + let(beyond(c) if far is None else far, lambda u: F.length(u) - F.length(_sub(u, DIGITS, "")))


def persian_letters(c: Column) -> Column:
    return translate(c, "کی", "كي")


def _blanks(c: Column, least: int = 2) -> Column:
    return where_there(c, ["\t", "  "], lambda t: F.regexp_replace(t, "[ \t]+" if least == 1 else "[ \t]{2,}", " "))


def _line_ends(c: Column) -> Column:
    c = where_there(c, [" \n"], lambda t: F.regexp_replace(t, " +\n", "\n"))
    return where_there(c, ["\n "], lambda t: F.regexp_replace(t, "\n +", "\n"))


def _few_empty(c: Column) -> Column:
    return where_there(c, ["\n\n\n\n"], lambda t: F.regexp_replace(t, "\n{4,}", "\n\n\n"))


def _opened(c: Column) -> Column:
    """Composed form with line ends as newlines, without direction marks; no-break spaces become spaces."""
    c = without(unix_lines(composed(text_of(c))), BIDI)
    return translate(c, " ﻿", " ")


def _spaced(c: Column) -> Column:
    """No space before a mark, one between a mark and the letter after it."""
    apart = lambda t: F.regexp_replace(t, f"([،؛:؟,.])(?=[{LETTER}])", "$1 ")
    near = let(c, lambda t: F.when(t.rlike(WIDE + "[،؛:؟,.]"), _sub(t, r"\s+([،؛:؟,.])", "$1")).otherwise(t))
    return let(near, lambda t: F.when(beyond(t).rlike(f"[{LETTER}]"), apart(t)).otherwise(t))


def _one_space(c: Column) -> Column:
    """One space for two and more blanks; texts that hold such are found by a wider and simpler class."""
    return let(c, lambda t: F.when(t.rlike(WIDE + "{2}"), _sub(t, r"\s{2,}", " ")).otherwise(t))


def _slashes(c: Column) -> Column:
    return where_there(c, ["/"], lambda t: _sub(t, r"\s*/\s*", " / "))


# Normal forms. Those of scans take out control characters before anything else is read.


def disclosure_form(c: Column, corrections: Pairs = ()) -> Column:
    t = translate(_opened(c), "؟؛،ØÙ�ـ", "?;,")
    t = persian_letters(F.replace(t, F.lit("﷼"), F.lit("ريال")))
    glued = lambda x: _glued(replace_all(x, corrections))
    return strip_text(_few_empty(_line_ends(_blanks(cleaned_if_arabic(t, then=glued, raw=text_of(c))))))


def _glued(c: Column) -> Column:
    """Three words that are often run into the one before."""
    for word in ("المحترمين", "العقارية", "لانتخاب"):
        c = _sub(c, rf"(?<=\S){word}{AFTER}", f" {word}")
    return c


def statement_form(c: Column) -> Column:
    t = translate(_opened(c), "—–ØÙ�", "--")
    return strip_text(_few_empty(_line_ends(_blanks(t))))


def chat_form(c: Column) -> Column:
    t = F.regexp_replace(translate(_opened(c), "�", ""), CONTROL_NARROW, "")
    return strip_text(_few_empty(_line_ends(_blanks(cleaned_if_arabic(t, raw=text_of(c))))))


def upload_form(c: Column) -> Column:
    t = _opened(c)
    return strip_text(_few_empty(_line_ends(_blanks(cleaned_if_arabic(t, otherwise=strip, raw=text_of(c)), 1))))


def _seen(c: Column) -> Column:
    """Without direction marks and control characters."""
    return without(F.regexp_replace(c, CONTROL, ""), BIDI)


def case_form(c: Column) -> Column:
    """Of case files and pleadings."""
    return _case_tail(F.regexp_replace(unix_lines(composed(text_of(c))), CONTROL, ""), BIDI)


def _case_tail(t: Column, marks: str = "") -> Column:
    """``marks`` is a class of what is taken out as well."""
    letters = "\u00a0کی\ufeffـ"
    plain = lambda x: F.translate(F.regexp_replace(x, marks, "") if marks else x, letters, " كي")
    return strip_text(_line_ends(_blanks(where_beyond(t, f"[{letters}{marks[1:-1]}]", plain))))


def scanned(c: Column) -> Column:
    """Compatibility form without direction marks and control characters: what the forms below begin with, once a text."""
    return _seen(composed(text_of(c), nfkc))


def dispute_form(c: Column, corrections: Pairs = (), ready: bool = False) -> Column:
    t = c if ready else F.regexp_replace(composed(text_of(c), nfkc), CONTROL, "")
    marks = MARKS if ready else f"[{BIDI[1:-1]}{MARKS[1:-1]}]"  # direction marks are what else ``scanned`` takes out
    plain = lambda x: F.translate(F.regexp_replace(x, marks, ""), "کیـ", "كي")
    t = translate(where_beyond(t, f"[{marks[1:-1]}کیـ]", plain), WESTERN, EASTERN)
    t = where_there(replace_all(t, corrections), ["فى"], lambda x: _sub(x, f"{BEFORE}فى{AFTER}", "في"))
    return strip_text(_one_space(_slashes(_spaced(t))))


def gazette_form(c: Column, corrections: Pairs = (), ready: bool = False) -> Column:
    t = translate(c if ready else scanned(c), " ﻿ـ", " ")
    t = persian_letters(without(t, MARKS))
    t = replace_all(F.replace(F.replace(t, F.lit("،"), F.lit("، ")), F.lit("؛"), F.lit("؛ ")), corrections)
    return strip_text(_blanks(_slashes(_spaced(t))))


def law_form(c: Column, corrections: Pairs = (), ready: bool = False) -> Column:
    t = persian_letters(translate(c if ready else scanned(c), "ـ", ""))
    t = translate(t, "٬٫;" + WESTERN + "`©«»" + VOWELS, "،.؛" + EASTERN)
    t = replace_all(t, corrections)
    t = _sub(t, rf"{BEFORE}قانون رقم\s*[^\n]{{0,14}}لسنة\s*[^\n]{{0,14}}٢٠١٠{AFTER}", "قانون رقم ٦ لسنة ٢٠١٠")
    t = F.regexp_replace(t, f"(?<![{LETTER}])فى(?![{LETTER}])", "في")
    return strip(_one_space(_spaced(t)))


def transcript_form(c: Column) -> Column:
    return strip(F.regexp_replace(_blanks(translate(text_of(c), "﻿", ""), 1), "\n{3,}", "\n\n"))


def polished_transcript(c: Column, corrections: Pairs = (), left_out: Iterable[str] = APPEAL_LEFT_OUT) -> Column:
    """A checked transcript without letterhead lines, corrected, no space before marks."""
    kept = F.filter(lines(text_of(c)), lambda x: ~strip(x).isin(*left_out))
    t = F.array_join(F.transform(kept, strip_end), "\n")
    t = _blanks(replace_all(t, corrections), 1)
    return strip(F.regexp_replace(F.regexp_replace(t, " ([؟،.])", "$1"), "\n{3,}", "\n\n"))


FORMS: dict[str, Callable] = {
    "disclosure": disclosure_form, "statement": statement_form, "chat": chat_form, "upload": upload_form, "case": case_form, "defence": case_form,
    "dispute": dispute_form, "gazette": gazette_form, "law": law_form, "appeal": transcript_form,
}


# Measures and scores.


def _long(c: Column, name: str) -> Column:
    return c.cast("long").alias(name)


def _filled(c: Column) -> Column:
    return F.size(F.filter(F.split(c, LINE_ENDS), lambda x: ~is_blank(x)))


def _one_letter(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"(?U)\s+"), lambda w: F.length(w) == 1))


def _token_counts(c: Column) -> Column:
    """Struct of the number of tokens and that of one character. Only the first and the last part of a split may be empty."""
    empty = lambda w: (w[0] == "").cast("int") + ((F.size(w) > 1) & (F.element_at(w, -1) == "")).cast("int")
    return let(F.split(c, r"(?U)\s+"), lambda w: F.struct((F.size(w) - empty(w)).alias("all"), F.size(F.filter(w, lambda x: F.length(x) == 1)).alias("one")))


def _short(c: Column) -> Column:
    """A text with two letters for every run of more ASCII letters. Its tokens (those of one character and those that begin with
    a letter or digit as well), lines, figures and characters other than such letters are as many as before."""
    return F.regexp_replace(c, LETTERS + "{3,}", "aa")


def _counted(t: Column, body: Callable) -> Column:
    """``body`` of a struct of the text, its short form and ``_shares``, counted in what is shorter."""
    both = F.struct(t.alias("t"), _short(t).alias("short"))
    return let(both, lambda x: let(F.struct(x["t"].alias("t"), x["short"].alias("short"), _shares(x["short"], F.length(x["t"])).alias("n")), body))


def _repeats(c: Column, least: int = 6, what: str = ".") -> Column:
    return count_of(c, rf"(?d)({what})\1{{{least - 1},}}")


def case_measures(c: Column, kind: str = "case") -> Column:
    """Struct of the counters of a page, after the case form."""
    words = lambda x: let(_token_counts(x["short"]), lambda w: _case_measures(x["t"], x["short"], x["n"], w, kind))
    return let(case_form(c), lambda t: _counted(t, words))


def _case_measures(t: Column, short: Column, n: Column, words: Column, kind: str) -> Column:
    chars, arabic, latin, digits, rest = n["n"], n["arabic"], n["latin"], n["digits"], n["rest"]
    least = lambda n: F.greatest(n, F.lit(1))
    out = [
        _long(chars, "chars"), _long(arabic, "arabic_chars"), _long(latin, "latin_letters"), _long(digits, "digits"), _long(words["all"], "tokens"), _long(_filled(short), "lines"),
        _long(occurrences(n["far"], "�"), "replacement_chars"),
    ]
    if kind == "defence":
        out.append(_long(count_of(n["far"], "[ØÙ]"), "mojibake_chars"))
    out += [_long(count_of(rest, r"[{}<>~^`_=\\|" + ("©#]" if kind == "defence" else "]")), "garbage_chars"), _long(_repeats(t), "long_repeats")]
    out.append(_long(word_hits(t, DEFENCE_WORDS if kind == "defence" else CASE_WORDS, n["far"]), "legal_anchor_hits"))
    if kind == "case":
        out.append(_long(let(F.lower(t), lambda low: word_hits(low, CASE_WORDS_ENGLISH)), "english_anchor_hits"))
    return F.struct(*out, F.round(words["one"] / least(words["all"]), 4).alias("single_token_ratio"), F.round((arabic + latin + digits) / least(chars), 4).alias("script_ratio"))


NONE = float("-inf")


def _sum(*terms: Column) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out.cast("double")


def case_score(c: Column) -> Column:
    return let(case_measures(c), case_score_of)


def case_score_of(m: Column) -> Column:
    score = _sum(
        F.least(m["chars"], F.lit(5000)) * 0.035, m["arabic_chars"] * 0.72, m["digits"] * 0.04, F.least(m["lines"], F.lit(80)) * 3.5, m["legal_anchor_hits"] * 95.0,
        m["script_ratio"] * 60.0, m["latin_letters"] * -0.7, m["replacement_chars"] * -150.0, m["garbage_chars"] * -22.0, m["long_repeats"] * -85.0, m["single_token_ratio"] * -240.0,
    )
    return F.when(m["chars"] == 0, NONE).otherwise(score)


def case_score_english(c: Column) -> Column:
    return let(case_measures(c), case_score_english_of)


def case_score_english_of(m: Column) -> Column:
    score = _sum(
        m["latin_letters"] * 1.2, m["digits"] * 0.22, m["english_anchor_hits"] * 100, F.least(m["lines"], F.lit(60)) * 2.0,
        m["arabic_chars"] * -0.3, m["garbage_chars"] * -20.0, m["long_repeats"] * -60.0,
    )
    return F.when((m["english_anchor_hits"] < 2) & (m["latin_letters"] < 120), NONE).otherwise(score)


def candidate_score(c: Column, lang: Column) -> Column:
    """The better of both scores; the English one counts for readings in English only."""
    return let(case_measures(c), lambda m: F.greatest(case_score_of(m), F.when(lang == "eng", case_score_english_of(m)).otherwise(NONE)))


def defence_score(c: Column) -> Column:
    return let(case_measures(c, "defence"), defence_score_of)


def defence_score_of(m: Column) -> Column:
    score = _sum(
        F.least(m["chars"], F.lit(5000)) * 0.035, m["arabic_chars"] * 0.78, m["digits"] * 0.05, F.least(m["lines"], F.lit(90)) * 3.5, m["legal_anchor_hits"] * 80.0, m["script_ratio"] * 70.0,
        m["latin_letters"] * -0.25, m["replacement_chars"] * -160.0, m["mojibake_chars"] * -160.0, m["garbage_chars"] * -28.0, m["long_repeats"] * -75.0, m["single_token_ratio"] * -220.0,
    )
    return F.when(m["chars"] == 0, NONE).otherwise(score)


def disclosure_tokens(c: Column) -> Column:
    return count_of(c, "[A-Za-z0-9؀-ۿ]+")


def statement_tokens(c: Column) -> Column:
    return count_of(c, "[A-Za-z0-9][A-Za-z0-9,()./%:-]*")


def disclosure_score(c: Column) -> Column:
    return let(text_of(c), _disclosure_score)


def _disclosure_score(t: Column) -> Column:
    return let(_shares(t), lambda n: _disclosure_score_of(t, n))


def _disclosure_score_of(t: Column, n: Column) -> Column:
    chars, arabic, latin, digits, words = n["n"], n["arabic"], n["latin"], n["digits"], disclosure_tokens(t)
    mojibake = count_of(t, "[ØÙ�]") + occurrences(t, "? ?")
    score = _sum(
        F.least(chars, F.lit(4000)) * 0.04, arabic * 0.55, digits * 0.08, F.least(_filled(t), F.lit(60)) * 4.0, word_hits(t, DISCLOSURE_WORDS) * 100.0,
        (arabic + latin + digits) / F.greatest(chars, F.lit(1)) * 90.0, _one_letter(t) / F.greatest(words, F.lit(1)) * -450.0, mojibake * -140.0, _repeats(t) * -75.0,
        count_of(t, r"[\[\]{}<>~¢©&=_\\|]") * -25.0, _count(t, f"{BEFORE}[a-z]{{2,}}{AFTER}") * -8.0,
    )
    return F.when(is_blank(t), NONE).otherwise(score)


def statement_score(c: Column) -> Column:
    low = lambda x: let(F.lower(x["t"]), lambda low: _statement_score(x["t"], low, x["short"], x["n"]))
    return let(text_of(c), lambda t: _counted(t, low))


def currencies(t: Column, low: Column, far: Column) -> Column:
    """Names of the currency, looked for in texts that hold one somewhere."""
    named = _count(t, f"(?i)(?=[KkDdFf\u212a]){BEFORE}(?:KD|KWD|Dinars?|fils){AFTER}")
    return F.when(any_of(low.contains(w) for w in ("kd", "kwd", "dinar", "fils")) | far.rlike(FOLDED), named).otherwise(0)


def _statement_score(t: Column, low: Column, short: Column, n: Column) -> Column:
    chars, digits, rest, words = n["n"], n["digits"], n["rest"], statement_tokens(short)
    letters = n["latin"] + count_of(n["far"], r"\p{L}")
    figures = _count(short, rf"(?=[(\-0-9\x80-\x{{10ffff}}])(?:\(?-?\p{{Nd}}{{1,3}}(?:,\p{{Nd}}{{3}})+(?:\.\p{{Nd}}+)?\)?|{BEFORE}\p{{Nd}}{{4}}{AFTER})")
    score = _sum(
        F.least(chars, F.lit(6000)) * 0.05, F.least(letters, F.lit(3500)) * 0.08, F.least(digits, F.lit(2000)) * 0.18, F.least(_filled(short), F.lit(100)) * 2.5,
        word_hits(low, [w.lower() for w in STATEMENT_WORDS]) * 65.0, currencies(t, low, n["far"]) * 20.0, figures * 8.0,
        (letters + digits) / F.greatest(chars, F.lit(1)) * 100.0, count_of(rest, r"[{}\[\]<>|~^]") * -30.0, count_of(n["far"], "[ØÙ�]") * -150.0,
        _one_letter(short) / F.greatest(words, F.lit(1)) * -300.0,
    )
    return F.when(is_blank(t), NONE).otherwise(score)


def chat_measures(c: Column) -> Column:
    """Struct of status, issues and counters, after the chat form."""
    t = chat_form(c)  # named twice only: the share of right-to-left letters is no JVM expression and stays outside of ``let``
    return let(F.struct(t.alias("t"), rtl_share(t, text_of(c)).alias("rtl")), lambda x: let(F.struct(x["t"].alias("t"), quality_status_of(x["t"], x["rtl"]).alias("q")), lambda y: _chat_measures(y["t"], y["q"])))


def _chat_measures(t: Column, q: Column) -> Column:
    return F.struct(
        q["status"].alias("status"), q["issues"].alias("issues"), _long(F.length(t), "chars"), _long(count_of(t, AR), "arabic_chars"), _long(digits_of(t), "digit_chars"), _long(_filled(t), "lines"),
        _long(count_of(t, "[Ā-ɏ]"), "latin_extended_noise"), _long(occurrences(t, "�"), "replacement_chars"), weird_ratio(t).alias("weird_glyph_ratio"), _long(disclosure_tokens(t), "tokens"),
    )


def chat_score(c: Column) -> Column:
    return let(chat_measures(c), chat_score_of)


def chat_score_of(m: Column) -> Column:
    bonus = F.when(m["status"] == "pass", 2500.0).when(m["status"] == "warn", 800.0).when(m["status"] == "not_arabic", -200.0).when(m["status"] == "fail", -900.0).otherwise(0.0)
    noise = m["latin_extended_noise"] + m["replacement_chars"] * 20
    return _sum(
        bonus, F.least(m["chars"], F.lit(6000)) * 0.025, m["arabic_chars"] * 0.16, m["digit_chars"] * 0.05, F.least(m["lines"], F.lit(80)) * 3.0, F.least(m["tokens"], F.lit(1000)) * 0.2,
        (m["arabic_chars"] + m["digit_chars"]) / F.greatest(m["chars"], F.lit(1)) * 300.0, noise * -65.0, m["weird_glyph_ratio"] * -2500.0,
    )


def chat_needs_reading(m: Column, statuses: Iterable[str] = ("fail", "warn", "not_arabic")) -> Column:
    """Whether a native text is weak enough to read the page again."""
    return m["status"].isin(*statuses) | (m["chars"] < 60) | (m["replacement_chars"] > 20) | (m["latin_extended_noise"] > 50) | (m["weird_glyph_ratio"] > 0.10)


def dispute_score(c: Column, corrections: Pairs = ()) -> Column:
    score = lambda t, n: _sum(
        n["arabic"], word_hits(t, DISPUTE_WORDS, n["far"]) * 20, n["latin"] * -1.5, occurrences(n["far"], "�") * -100, count_of(n["rest"], r"[<>_~{}\\^`]") * -5
    )
    return let(dispute_form(c, corrections), lambda t: let(_shares(t), lambda n: score(t, n)))


def form_words() -> str:
    """A pattern of words of forms; the first two letters are looked at before anything else, by simple classes."""
    return f"(?U)(?=[{FORM_FIRSTS}\u0130-\u017f][{FORM_SECONDS}\u0130-\u017f])(?i){BEFORE}(ID|Name|Date|Amount|Total|Salary|Bonus|Signature|Subject|From|To){AFTER}"


def dispute_score_english(c: Column, words: Iterable[str]) -> Column:
    """English forms and mails; ``words`` speak for them. Pages with few of them and of form words have no score."""
    words = [w.lower() for w in words]
    counted = lambda t: F.struct(let(F.lower(t), lambda low: word_hits(low, words)).alias("hits"), F.regexp_count(t, F.lit(form_words())).alias("form"))
    return let(composed(text_of(c), nfkc), lambda t: let(counted(t), lambda x: _dispute_score_english(t, x["hits"], x["form"])))


def _dispute_score_english(t: Column, hits: Column, form: Column) -> Column:
    score = lambda x: _dispute_score_english_of(x["t"], x["short"], x["n"], hits, form)
    return F.when(is_blank(t) | ((hits < 2) & (form < 4)), NONE).otherwise(_counted(t, score))


def _dispute_score_english_of(t: Column, short: Column, n: Column, hits: Column, form: Column) -> Column:
    latin, digits = n["latin"], n["digits"]
    return _sum(
        latin * 1.4, digits * 0.45, hits * 120, form * 35, F.least(_filled(short), F.lit(80)) * 4, (latin + digits) / F.greatest(n["n"], F.lit(1)) * 150, n["arabic"] * -2,
        count_of(n["rest"], r"[{}<>\\^`~]") * -20, _repeats(t) * -40,
    )


def dispute_try_english(c: Column, score: Column, corrections: Pairs = ()) -> Column:
    return let(dispute_form(c, corrections), lambda t: (score < 700) | ((count_of(t, AR) < 450) & (count_of(t, "[A-Za-z]") > 20)))


def gazette_score(c: Column, corrections: Pairs = ()) -> Column:
    return let(gazette_form(c, corrections), _gazette_score)


def _gazette_score(t: Column) -> Column:
    score = _sum(
        count_of(t, AR), word_hits(t, GAZETTE_WORDS) * 55, F.least(_filled(t), F.lit(80)) * 3, digits_of(t) * 0.05, _repeats(t, 5, f"[{LETTER}]") * -80, count_of(t, r"[{}<>\\^`~]") * -20,
        count_of(t, "[A-Za-z]") * -1.5,
    )
    return F.when(t == "", NONE).otherwise(score)


def appeal_score(c: Column) -> Column:
    return let(text_of(c), lambda t: _sum(count_of(t, AR), count_of(t, "[ØÙ�]") * -100, F.abs(F.length(t) - count_of(t, AR)) * -0.03))


def hearing_score(c: Column) -> Column:
    return let(text_of(c), lambda t: _sum(count_of(t, AR) * 2.0, F.length(t) * 0.15, count_of(t, "[ØÙ�]") * -15.0, count_of(t, CONTROL_NARROW) * -10.0))


SCORES: dict[str, Callable] = {
    "disclosure": disclosure_score, "statement": statement_score, "chat": chat_score, "case": case_score, "defence": defence_score, "dispute": dispute_score,
    "gazette": gazette_score, "appeal": appeal_score, "hearing": hearing_score,
}


def disclosure_summary(c: Column) -> Column:
    t = text_of(c)
    return F.struct(_long(F.length(t), "chars"), _long(count_of(t, AR), "arabic_chars"), _long(digits_of(t), "digit_chars"), _long(disclosure_tokens(t), "tokens"), _long(count_of(t, "[ØÙ�]"), "mojibake_markers"), _long(_filled(t), "lines"))


def statement_summary(c: Column) -> Column:
    t = text_of(c)
    return F.struct(_long(F.length(t), "chars"), _long(count_of(t, r"\p{L}"), "letters"), _long(digits_of(t), "digits"), _long(statement_tokens(t), "tokens"), _long(_filled(t), "lines"), _long(count_of(t, "[ØÙ�]"), "mojibake_markers"))


def case_flags(clean: Column, raw_chars: Column, score: Column) -> Column:
    """Names of what is wrong with a cleaned page of a case file; ``clean`` are its measures."""
    flag = lambda name, when: F.when(when, F.lit(name))
    return F.array_compact(F.array(
        flag("empty_after_cleanup", clean["chars"] == 0), flag("low_arabic_text", clean["arabic_chars"] < 80), flag("low_ocr_score", score < 180), flag("replacement_chars", clean["replacement_chars"] > 0),
        flag("high_garbage_chars", clean["garbage_chars"] > 20), flag("fragmented_tokens", (clean["single_token_ratio"] > 0.28) & (clean["tokens"] > 30)),
        flag("latin_noise", (clean["latin_letters"] > clean["arabic_chars"]) & (clean["english_anchor_hits"] < 2)), flag("heavy_cleanup", (raw_chars > 0) & (clean["chars"] / F.greatest(raw_chars, F.lit(1)) < 0.35)),
    ))


def defence_flags(clean: Column, raw_chars: Column, score: Column) -> Column:
    flag = lambda name, when: F.when(when, F.lit(name))
    return F.array_compact(F.array(
        flag("empty_after_cleanup", clean["chars"] == 0), flag("low_arabic_text", clean["arabic_chars"] < 70), flag("low_ocr_score", score < 180),
        flag("mojibake_or_replacement", (clean["replacement_chars"] > 0) | (clean["mojibake_chars"] > 0)), flag("fragmented_tokens", (clean["single_token_ratio"] > 0.30) & (clean["tokens"] > 35)),
        flag("heavy_cleanup", (raw_chars > 0) & (clean["chars"] / F.greatest(raw_chars, F.lit(1)) < 0.35)),
    ))


def case_shown(clean: Column, flags: Column, m: Column, score: Column, source: Column) -> Column:
    """What is shown of a cleaned page: its text, or a note where it can't be trusted."""
    has = lambda name: F.array_contains(flags, name)
    t, none = strip(text_of(clean)), m["legal_anchor_hits"] == 0
    read = (source != VALIDATED) & none
    return (
        F.when(t == "", F.lit("")).when(has("image_only_attachment"), t).when(has("low_ocr_score") & has("low_arabic_text") & none, F.lit(NO_TRUSTED_TEXT))
        .when(read & has("fragmented_tokens") & (m["single_token_ratio"] > 0.30), F.lit(BROKEN_TEXT)).when(read & (score < 180), F.lit(NO_TRUSTED_TEXT)).otherwise(t)
    )


def defence_shown(clean: Column, flags: Column, m: Column) -> Column:
    has = lambda name: F.array_contains(flags, name)
    t, none = strip(text_of(clean)), m["legal_anchor_hits"] == 0
    return F.when(t == "", F.lit(NO_TRUSTED_TEXT)).when(has("fragmented_tokens") & none, F.lit(BROKEN_TEXT)).when(has("low_ocr_score") & has("low_arabic_text") & none, F.lit(NO_TRUSTED_TEXT)).otherwise(t)


def case_try_english(m: Column, score: Column) -> Column:
    """Gates on the best reading so far: another language, another turn of the page."""
    return (score < 150) | (m["arabic_chars"] < 90) | ((m["latin_letters"] > 80) & (m["english_anchor_hits"] >= 1))


def case_try_turned(m: Column, score: Column) -> Column:
    none = m["legal_anchor_hits"] == 0
    return (score < 350) | ((m["single_token_ratio"] > 0.30) & none) | ((m["digits"] > m["arabic_chars"]) & none)


def defence_try_turned(m: Column, score: Column) -> Column:
    return (score < 350) | ((m["single_token_ratio"] > 0.32) & (m["legal_anchor_hits"] < 3))


# Lines.


def _trimmed(c: Column, edge: str) -> Column:
    """Without the characters of a class at either end, which are looked at first."""
    at_end = lambda t: F.when(F.substring(t, -1, 1).rlike(f"(?U)[{edge}]"), _sub(t, rf"[{edge}]+\z", "")).otherwise(t)
    return let(let(c, lambda t: F.when(F.substring(t, 1, 1).rlike(f"(?U)[{edge}]"), _sub(t, f"^[{edge}]+", "")).otherwise(t)), at_end)


def _clean(c: Column, edge: str) -> Column:
    return strip(_one_space(_trimmed(c, edge)))


def joined_words_apart(c: Column) -> Column:
    """Words of case files that are often run into the one before or after."""
    return let(c, lambda t: F.when(beyond(t).rlike(AR), _words_apart(t)).otherwise(t))


def _words_apart(c: Column) -> Column:
    c = _sub(c, f"(?<={AR})(?=(?:العامة|العاصمة|النيابة|القضية|المحكمة|الشركة|المتهم|الشاكي){AFTER})", " ")
    c = _sub(c, f"{BEFORE}(نيابة|النيابة)(العاصمة|العامة){AFTER}", "$1 $2")
    return _sub(c, f"{BEFORE}(دولة)(الكويت){AFTER}", "$1 $2")


def case_corrected(c: Column, corrections: Pairs = ()) -> Column:
    return joined_words_apart(replace_all(c, corrections))


def case_line(c: Column, corrections: Pairs = ()) -> Column:
    return _clean(case_corrected(_case_tail(c), corrections), r"\s\-_ـ*|\\/<>")


def defence_line(c: Column, corrections: Pairs = ()) -> Column:
    return _clean(replace_all(_case_tail(c), corrections), r"\s\-_ـ*|\\/<>")


def dispute_line(c: Column, corrections: Pairs = ()) -> Column:
    return _clean(dispute_form(c, corrections, ready=True), r"\s\-_ـ*|\\/<>.")


def gazette_line(c: Column, corrections: Pairs = ()) -> Column:
    return strip(_blanks(_trimmed(gazette_form(c, corrections, ready=True), r"\s\-_*|\\/<>.،؛:")))


def law_line(c: Column, corrections: Pairs = ()) -> Column:
    t = _trimmed(law_form(c, corrections, ready=True), r"\s.\-_*+|\\/")
    t = _sub(_sub(t, r"\s*([()])\s*", "$1"), r"\(\s*\)", "")
    return strip(_sub(F.regexp_replace(t, r"^مادة\(([٠-٩]+)\)$", "مادة ($1)"), r"\s{2,}", " "))


def _shares(t: Column, size: Column | None = None) -> Column:
    """Struct of counters, of the text without ASCII letters and of what is beyond ASCII in it, in which all else is counted.
    ``size`` is that of the text if ``t`` is its short form."""
    parts = let(F.regexp_replace(t, LETTERS + "+", ""), lambda r: F.struct(r.alias("rest"), beyond(r).alias("far")))
    return let(F.struct(parts.alias("p"), (F.length(t) if size is None else size).alias("n")), lambda x: _shares_of(x["p"]["rest"], x["p"]["far"], x["n"]))


def _shares_of(rest: Column, far: Column, n: Column) -> Column:
    return F.struct(
        (F.length(far) - F.length(F.regexp_replace(far, AR + "+", ""))).alias("arabic"), (n - F.length(rest)).alias("latin"), digits_of(rest, far).alias("digits"), n.alias("n"),
        rest.alias("rest"), far.alias("far"),
    )


BARE_NUMBER = r"^[()|.,:+\\/\-=_ \p{Nd}٠-٩]{1,10}$"
LONG_RUN = rf"([{LETTER}A-Za-z])\1{{5,}}"


def case_noise(t: Column) -> Column:
    return let(_shares(t), lambda s: _case_noise(t, s["arabic"], s["latin"], s["digits"], s["n"]))


def _case_noise(t: Column, arabic: Column, latin: Column, digits: Column, n: Column) -> Column:
    english = let(F.lower(t), lambda low: any_of(low.contains(w) for w in CASE_WORDS_ENGLISH))  # of short lines without Arabic only
    return (
        (t == "") | t.isin(*CASE_NOISE) | (t.rlike("[©#<>]") & (arabic < 80)) | t.rlike(BARE_NUMBER) | t.rlike(LONG_RUN) | ((n > 25) & ((arabic + latin + digits) / F.greatest(n, F.lit(1)) < 0.18))
        | ((arabic == 0) & (latin == 0) & (digits < 4)) | ((arabic < 2) & (latin == 0) & (n > 30)) | ((arabic < 3) & (digits > 18) & (n < 45)) | ((latin > 0) & (arabic == 0) & (n < 80) & ~english)
    )


def defence_noise(t: Column) -> Column:
    return let(_shares(t), lambda s: _defence_noise(t, s["arabic"], s["latin"], s["digits"], s["n"]))


def _defence_noise(t: Column, arabic: Column, latin: Column, digits: Column, n: Column) -> Column:
    return (
        (t == "") | t.rlike(BARE_NUMBER) | ((n > 25) & ((arabic + latin + digits) / F.greatest(n, F.lit(1)) < 0.18)) | ((arabic == 0) & (latin == 0) & (digits < 4)) | t.rlike(LONG_RUN)
        | (t.rlike("[©#<>]") & (arabic < 80))
    )


def dispute_noise(t: Column) -> Column:
    return let(_shares(t), lambda s: _dispute_noise(t, s["arabic"], s["digits"], s["n"]))


def _dispute_noise(t: Column, arabic: Column, digits: Column, n: Column) -> Column:
    return (
        (t == "") | t.rlike(LONG_RUN) | t.rlike(r"^[٠-٩ ()/\\|.,:+-]{1,8}$") | ((arabic <= 4) & (digits >= 8)) | ((arabic == 0) & (n < 35)) | ((arabic < 2) & (n > 25))
        | ((n <= 80) & ~t.rlike(r"[^\x00-\x7f]")) | ((n > 40) & (arabic / F.greatest(n, F.lit(1)) < 0.08))
    )


def is_year(t: Column) -> Column:
    return t.rlike(r"^(19|20)[0-9]{2}\z")


def gazette_noise(t: Column) -> Column:
    return let(_shares(t), lambda s: _gazette_noise(t, s["arabic"], s["n"]))


def _gazette_noise(t: Column, arabic: Column, n: Column) -> Column:
    sure = t.rlike(rf"([{LETTER}])\1{{5,}}") | t.rlike(r"^[0-9٠-٩ ()/.,:؛\-]+$") | t.contains("الكويت اليوم العدد") | t.rlike(r"(?U)^الأحد\s+\p{Nd}+") | t.rlike(r"(?U)^[0-9٠-٩]+\s+الأحد\s+")
    weak = ((arabic == 0) & (n < 40)) | ((n > 40) & (arabic / F.greatest(n, F.lit(1)) < 0.10))
    return (t == "") | (~is_year(t) & (sure | (~t.isin("قرر", "ملبس", "ا", "ب", "م") & weak)))


def law_noise(t: Column) -> Column:
    arabic, n = count_of(t, AR), F.length(t)
    return (t == "") | t.rlike(r"(?U)^[\(\[]?\s*[0-9٠-٩]{1,3}\s*[\)\]]?\z") | t.rlike(r"^[.\-_*+|\\/()٠-٩ ]+$") | ((arabic == 0) & (n < 40)) | ((arabic < 3) & (n > 20))


def without_footer(t: Column) -> Column:
    """A line without the address that follows it; empty if it is one, or if little else is on it."""
    footer = F.lit(None).cast("string")
    for marker in reversed(FOOTERS):
        at = F.instr(t, " " + marker)
        footer = F.when(t.startswith(marker), F.lit("")).when(at > 1, strip(t.substr(F.lit(1), at - 1))).otherwise(footer)
    places = F.array_min(F.filter(F.array(*[F.instr(t, m) for m in CONTACTS]), lambda x: x > 0))
    prefix = F.regexp_replace(t.substr(F.lit(1), places - 1), "^[ -]+|[ -]+$", "")
    contact = F.when(any_of(t.startswith(m) for m in CONTACT_OPENINGS), F.lit("")).when(places.isNotNull() & (F.length(t) > 80), F.when(F.length(prefix) >= 20, prefix).otherwise("")).otherwise(t)
    return F.coalesce(footer, contact)


def case_structural(t: Column) -> Column:
    return t.rlike("(?U)" + CASE_QUESTION) | t.rlike("(?U)" + FIELD % 45) | t.rlike("(?U)" + NUMBERED) | ((F.length(t) < 90) & any_of(t.contains(w) for w in CASE_TITLES)) | t.rlike(f"(?U)^(?:{CASE_OPENINGS}){AFTER}")


def defence_structural(t: Column) -> Column:
    return t.rlike("(?U)" + NUMBERED) | t.rlike("(?U)" + FIELD % 55) | ((F.length(t) < 110) & any_of(t.contains(w) for w in DEFENCE_TITLES)) | t.rlike(f"(?U)^(?:{DEFENCE_OPENINGS}){AFTER}")


def dispute_structural(t: Column) -> Column:
    return ((F.length(t) < 80) & any_of(t.contains(w) for w in DISPUTE_TITLES)) | t.rlike(r"^[٠-٩]+[\-.)،:]") | t.rlike(r"(?U)^[أ-ي][\-.)،:]\s+")


def gazette_structural(t: Column) -> Column:
    return t.rlike(f"^({GAZETTE_OPENINGS})") | t.rlike(r"^[0-9٠-٩]+[.)\-]") | t.rlike(r"^[أ-ي][.)\-]")


def _joins(ends: str, least: int, structural: Callable, least_next: int = 0) -> Callable:
    def joins(before: Column, line: Column) -> Column:
        return (before != "") & (line != "") & ~structural(line) & ~structural(before) & ~before.rlike(ends) & (F.length(before) >= least) & (F.length(line) >= least_next)

    return joins


case_joins = _joins("[.؟?!؛:]$", 28, case_structural, 8)
defence_joins = _joins("[.؟?!؛:]$", 28, defence_structural, 8)
dispute_joins = _joins("[.؟!؛:]$", 25, dispute_structural)


def gazette_joins(before: Column, line: Column) -> Column:
    number = (is_year(line) & before.isin("لسنة", "سنة")) | (line.rlike("^[0-9٠-٩]+$") & before.isin("رقم", "مادة"))
    return (before != "") & (line != "") & (number | (~gazette_structural(line) & ~before.rlike("[:.!؟؛]$") & (F.length(before) >= 18)))


# Pages.


def _paragraphs(own: Column, noise: Callable, joins: Callable, again: Callable) -> Column:
    """Cleaned lines folded to paragraphs: noise leaves one empty line, a line that joins the one before is cleaned with it."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def closed(state: Column) -> Column:
        return F.when(state["open"].isNull(), state["done"]).otherwise(F.concat(state["done"], F.array(state["open"])))

    def step(state: Column, line: Column) -> Column:
        blank = F.when(state["open"].isNull() | (state["open"] == ""), state).otherwise(F.struct(closed(state).alias("done"), F.lit("").alias("open")))
        joined = F.struct(state["done"].alias("done"), again(F.concat(state["open"], F.lit(" "), line)).alias("open"))
        return F.when(noise(line), blank).when(F.coalesce(joins(state["open"], line), F.lit(False)), joined).otherwise(F.struct(closed(state).alias("done"), line.alias("open")))

    return strip(F.array_join(F.aggregate(own, start, step, lambda s: closed(s)), "\n"))


def case_page(c: Column, corrections: Pairs = ()) -> Column:
    own = F.transform(lines(case_corrected(case_form(c), corrections)), lambda x: case_line(x, corrections))
    return _paragraphs(own, case_noise, case_joins, lambda x: case_line(x, corrections))


def defence_page(c: Column, corrections: Pairs = ()) -> Column:
    own = F.transform(lines(replace_all(case_form(c), corrections)), lambda x: defence_line(x, corrections))
    return _paragraphs(own, defence_noise, defence_joins, lambda x: defence_line(x, corrections))


def _split(c: Column) -> Column:
    """Lines of a scanned page; direction marks and control characters are out of each."""
    return F.split(scanned(unix_lines(text_of(c))), "\n")


def dispute_page(c: Column, corrections: Pairs = ()) -> Column:
    own = F.transform(_split(c), lambda x: let(dispute_line(x, corrections), without_footer))
    return _paragraphs(own, dispute_noise, dispute_joins, lambda x: dispute_form(x, corrections, ready=True))


def dispute_page_english(c: Column) -> Column:
    """Lines of an English page with something to read on them."""
    own = F.transform(F.split(translate(scanned(text_of(c)), " ﻿", " "), "\n"), lambda x: _trimmed(_blanks(strip(x)), r"\s\-_*|\\/<>."))
    solid = lambda x: count_of(x, r"[\p{L}\p{N}]")
    kept = F.filter(own, lambda x: (x != "") & (solid(x) > 0) & ~((F.length(x) > 30) & (solid(x) / F.length(x) < 0.15)) & ~x.rlike(r"^[()|.,:+\\/\-=_ ]{1,20}$"))
    return strip(F.array_join(kept, "\n"))


def gazette_page(c: Column, corrections: Pairs = ()) -> Column:
    own = F.transform(_split(c), lambda x: gazette_line(x, corrections))
    return _paragraphs(own, gazette_noise, gazette_joins, lambda x: gazette_form(x, corrections, ready=True))


def law_lines(c: Column, corrections: Pairs = ()) -> Column:
    """A page's cleaned lines; one empty line stands for noise, none at the end."""
    start = F.array().cast("array<string>")
    own = F.transform(_split(c), lambda x: law_line(x, corrections))
    last = lambda a: F.element_at(a, -1)
    step = lambda a, x: F.when(law_noise(x), F.when((F.size(a) > 0) & (F.try_element_at(a, F.lit(-1)) != ""), F.concat(a, F.array(F.lit("")))).otherwise(a)).otherwise(F.concat(a, F.array(x)))
    return F.aggregate(own, start, step, lambda a: F.when((F.size(a) > 0) & (F.try_element_at(a, F.lit(-1)) == ""), F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(a))


PAGES: dict[str, Callable] = {"case": case_page, "defence": defence_page, "dispute": dispute_page, "gazette": gazette_page}


# A law's articles.


def is_article_heading(t: Column) -> Column:
    """The word for an article, at most 24 characters in all, and no other letter but one that its number may leave."""
    compact = _sub(text_of(t), r"\s+", "")
    letters = F.regexp_replace(compact, f"[^{LETTER}]", "")
    rest = F.regexp_replace(letters, "^(.*?)مادة", "$1")
    return compact.contains("مادة") & (F.length(compact) <= 24) & rest.isin("", "ه", "م")


def is_law_heading(t: Column) -> Column:
    return (
        is_article_heading(t) | t.startswith("الباب ") | t.startswith("الفصل ") | t.startswith("المذكرة الإيضاحية") | t.isin(*LAW_HEADINGS)
        | (t.startswith("قانون رقم ") & (F.length(t) < 80)) | (t.contains("في شأن العمل في القطاع الأهلي") & (F.length(t) < 90))
    )


def is_list_item(t: Column) -> Column:
    return t.rlike(r"(?U)^([٠-٩]+[.\-،:]?\s+|[أابجدهوزحط]\s*[-.،:]|\*)")


def opens_paragraph(t: Column) -> Column:
    return any_of(t.startswith(w) for w in LAW_OPENINGS)


def law_text(own: Column, corrections: Pairs = ()) -> Column:
    """Lines of a law in order, empty ones included, as paragraphs with an empty line between: headings and items stand
    alone; an empty line ends a paragraph only after a full stop or before an opening."""
    kinds = "struct<done:array<string>,open:array<string>,gap:boolean>"
    start = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("open"), F.lit(False).alias("gap")).cast(kinds)
    whole = lambda a: law_form(F.array_join(a, " "), corrections, ready=True)
    flushed = lambda s: F.when(F.size(s["open"]) > 0, F.concat(s["done"], F.array(whole(s["open"])))).otherwise(s["done"])
    empty = F.array().cast("array<string>")

    def step(s: Column, line: Column) -> Column:
        alone = is_law_heading(line) | is_list_item(line) | line.startswith("*")
        previous = F.try_element_at(s["open"], F.lit(-1))
        stop = any_of(line.startswith(w) for w in LAW_BREAKS) | previous.rlike("[.؟!؛:]$")
        breaks = F.coalesce((s["gap"] & previous.isNotNull() & (previous != "") & stop) | (previous.isNotNull() & opens_paragraph(line)), F.lit(False))
        make = lambda done, open_, gap: F.struct(done.alias("done"), open_.alias("open"), F.lit(gap).alias("gap")).cast(kinds)
        return (
            F.when(line == "", make(s["done"], s["open"], True)).when(alone, make(F.concat(flushed(s), F.array(line)), empty, False))
            .when(breaks, make(flushed(s), F.array(line), False)).otherwise(make(s["done"], F.concat(s["open"], F.array(line)), False))
        )

    parts = F.filter(F.transform(F.aggregate(own, start, step, flushed), lambda x: law_line(x, corrections)), lambda x: x != "")
    unlike = let(parts, lambda p: F.filter(p, lambda x, i: (i == 0) | (x != F.try_element_at(p, F.when(i == 0, F.lit(1)).otherwise(i)))))

    def merge(a: Column, line: Column) -> Column:
        last = F.try_element_at(a, F.lit(-1))
        free = lambda x: ~is_law_heading(x) & ~is_list_item(x)
        on = F.coalesce(free(last) & free(line) & ~opens_paragraph(line) & ~last.rlike("[.؟!؛:]$"), F.lit(False))
        joined = law_form(F.concat(last, F.lit(" "), line), corrections, ready=True)
        return F.when(on, F.concat(F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(a, F.array(line)))

    final = F.array_join(F.aggregate(unlike, empty, merge), "\n\n")
    return strip(_sub(final, r"\s+(المذكرة الإيضاحية)", "\n\n$1"))


# Minutes put together from several engines.


def question_line(c: Column) -> Column:
    """A question or answer letter and its number in one spelling."""
    t = strip(text_of(c))
    ahead = _sub(t, rf"^([سج])\s*(\p{{Nd}}+){AFTER}(?d:(.*))$", "$1$2$3")
    return F.when(t.rlike(r"(?U)^\p{Nd}+\s*[سج]\s*$"), _sub(t, r"^(\p{Nd}+)\s*([سج])\s*$", "$2$1")).when(t.rlike(r"(?U)^[سج]\s*\p{Nd}+\s*$"), _sub(t, r"^([سج])\s*(\p{Nd}+)\s*$", "$1$2")).otherwise(ahead)


def minutes_lines(c: Column) -> Column:
    t = replace_all(unix_lines(text_of(c)), [("[Image of the Kuwaiti Ministry of Justice Logo]\n", ""), ("دولة\nالكويت", "دولة الكويت"), ("محضر تحقيق", "محضر التحقيق"), ("?", "؟")])
    own = F.transform(F.split(t, "\n"), lambda x: question_line(_sub(strip(_blanks(x)), r"^\[Signature:\s*(.*?)\]$", "$1")))
    return strip(F.regexp_replace(F.array_join(own, "\n"), "\n{3,}", "\n\n"))


def minutes_page(c: Column, everywhere: Pairs = (), here: Pairs = ()) -> Column:
    """Lines tidied, then the corrections of the whole and of this page."""
    return minutes_lines(replace_all(replace_all(minutes_lines(c), everywhere), here))


# Names and checks of files.


def stem_of(name: Column) -> Column:
    return F.regexp_replace(name, r"(?<=[^/.])\.[^./]*$", "")


def dated_stem(name: Column) -> Column:
    """Eight leading digits, else the stem in safe characters, else a hash."""
    safe = F.regexp_replace(F.regexp_replace(stem_of(name), "[^A-Za-z0-9_.-]+", "_"), "^[._-]+|[._-]+$", "")
    return F.when(name.rlike("^[0-9]{8}"), F.substring(name, 1, 8)).when(safe != "", safe).otherwise(F.substring(F.sha1(name), 1, 12))


def plain_stem(name: Column) -> Column:
    """The stem without characters that file systems refuse, else a hash."""
    safe = F.regexp_replace(strip(stem_of(name)), r'[<>:"/\\|?*\x00-\x1f]', "_")
    safe = F.regexp_replace(_sub(safe, r"\s+", " "), "^[ .]+|[ .]+$", "")
    return F.when(safe != "", safe).otherwise(F.substring(F.sha1(name), 1, 12))


def output_checks(c: Column) -> Column:
    """Counts that a finished text is checked by."""
    t = text_of(c)
    return F.struct(
        _long(F.length(t), "final_chars"), _long(count_of(t, AR), "arabic_chars"), _long(count_of(t, "[A-Za-z]"), "latin_letters"), _long(occurrences(t, "�"), "replacement_chars"), _long(count_of(t, "[ØÙ�]"), "mojibake_chars"),
        _long(count_of(t, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]"), "control_chars"), _long(occurrences(t, "[لم يتم استخراج"), "empty_markers"), _long(count_of(t, "(?m)^===== Page "), "page_markers"), (strip(t) == "").alias("empty"),
    )
