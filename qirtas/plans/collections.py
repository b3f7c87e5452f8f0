"""Queries over the rule sets of collections: scores, forms, line rules, flags, gates; on all documents and some made lines.

The tables hold no Arabic, so the made texts ``SAMPLES`` (negative ids) stand beside the documents, in Spark and in SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.functions import rulesets as R
from qirtas.operators import cascade

from .common import count, register, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

SAMPLES = (
    (-1, "محضر التحقيق\nفي القضية رقم 2264 لسنة 2025 حصر نيابة العاصمة\nوبسؤال المتهم عن الواقعة قال إنه لا يعلم شيئا عنها"),
    (-2, "س ١ ما اسمك\nج ١ أحمد\n12 | 34\n====\n\nالكويت - شرق الدور الثالث"),
    (-3, "شركة المستقبل تعلن عن إفصاح البيانات المالية للربع الأول، رأس المال 1,250,000 دينار [x] ~~ &&"),
    (-4, "مادة ( ١٢ )\nيجب على صاحب العمل أن يدفع الأجر\nوعلى العامل أن يؤدي عمله.\nب- إجازة\n2016\n(٧)"),
    (-5, "مذكرة بدفاع المدعي ضد شركة الخليج‏ لسنة\t\t٢٠٢٤ الشيك  والاستقالة ©© ØÙ �"),
    (-6, "هههههههه اااااا ......   aaaaaaa"),
    (-7, "Final Settlement Date: 12/03/2024 Amount KD 1,500.250 Total Salary Subject From To Name ID\nCivil ID and passport of the company, nationality Kuwait"),
    (-8, "كتاب العجارة والصناعة یوم الأحد ٣ في الكويت اليوم العدد ١٢ ، قرار ؛ مادة / فقرة"),
    (-9, ""),
    (-10, "   x \n\n\n\n\n y "),
)


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = spark.createDataFrame([(i, t) for i, t in SAMPLES], "doc_id long, text string")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text").unionByName(made)


def body():
    return F.col("text")


def quoted(t: str) -> str:
    return "'" + t.replace("'", "''") + "'"


SRC = "src as (select doc_id::bigint as doc_id, coalesce(text, '') as text from documents union all select * from (values " + ", ".join(f"({i}, {quoted(t)})" for i, t in SAMPLES) + ") v(doc_id, text))"
AR, LAT, NUM = r"[\x{0600}-\x{06ff}]", "[A-Za-z]", r"\p{Nd}"
RUN_CHARS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 .,!?;:-_#$%&*|/=+~()هاØÙ©x"
ARABIC_LETTERS = "".join(map(chr, range(0x621, 0x64B)))


def runs(least: int, chars: str = RUN_CHARS) -> str:
    return "|".join(("\\" + c if c in ".|*+?()[]{}^$\\/-" else c) + f"{{{least},}}" for c in dict.fromkeys(chars))


def hits(t: str, words) -> str:
    return "(" + " + ".join(f"(len(string_split({t}, {quoted(w)})) - 1)" for w in words) + ")"


def edge(word: str) -> str:
    return rf"(?:^|[^\p{{L}}\p{{N}}_]){word}"


def full(t: str) -> str:
    return rf"len(list_filter(string_split({t}, chr(10)), lambda x: regexp_replace(x, '^[\s\x{{00a0}}]+|[\s\x{{00a0}}]+$', '', 'g') <> ''))"


def short(t: str) -> str:
    return f"len(list_filter({words(t)}, lambda x: length(x) = 1))"


def words(t: str) -> str:
    return rf"list_filter(string_split_regex({t}, '[\s\x{{00a0}}]+'), lambda x: x <> '')"


BIDI, CTRL = r"[\x{200e}\x{200f}\x{202a}-\x{202e}\x{2066}-\x{2069}]", r"[\x{00}-\x{08}\x{0b}-\x{1f}\x{7f}-\x{9f}]"


def sub(t: str, pattern: str, right: str = "''") -> str:
    return f"regexp_replace({t}, '{pattern}', {right}, 'g')"


def chars_out(t: str, chars: str) -> str:
    for c in chars:
        t = f"replace({t}, chr({ord(c)}), '')"
    return t


def persian(t: str) -> str:
    return f"translate({t}, {quoted(chr(0x6A9) + chr(0x6CC))}, {quoted(chr(0x643) + chr(0x64A))})"


def trim(t: str) -> str:
    return sub(t, r"^[\s\x{00a0}]+|[\s\x{00a0}]+$")


def case_sql(t: str) -> str:
    x = sub(sub(f"nfc_normalize({t})", r"\r\n|\r", "chr(10)"), f"{BIDI}|{CTRL}")
    x = persian(chars_out(f"replace({x}, chr(160), ' ')", "﻿ـ"))
    return trim(sub(sub(x, r"[ \t]{2,}", "' '"), r" *\n *", "chr(10)"))


def statement_sql(t: str) -> str:
    x = sub(sub(f"nfc_normalize({t})", r"\r\n|\r", "chr(10)"), BIDI)
    x = chars_out(f"replace({x}, chr(160), ' ')", "﻿ØÙ�")
    x = f"replace(replace({x}, chr(8212), '-'), chr(8211), '-')"
    return trim(sub(sub(sub(x, r"[ \t]{2,}", "' '"), r" *\n *", "chr(10)"), r"\n\n\n\n+", "chr(10) || chr(10) || chr(10)"))


PUNCT = "،؛:؟,."


def spaced(x: str) -> str:
    x = sub(x, rf"[\s\x{{00a0}}]+([{PUNCT}])", r"'\1'")
    return sub(x, rf"([{PUNCT}])([\x{{0621}}-\x{{064a}}])", r"'\1 \2'")


MARKS = r"[\x{064b}-\x{065f}\x{0670}]"
EAST = quoted("٠١٢٣٤٥٦٧٨٩")


def dispute_sql(t: str) -> str:
    x = sub(f"replace({t}, chr(160), ' ')", f"{BIDI}|{CTRL}")
    x = sub(f"translate({persian(chars_out(x, chr(0x640)))}, '0123456789', {EAST})", MARKS)
    return trim(sub(sub(spaced(x), r"[\s]*/[\s]*", "' / '"), r"[\s]{2,}", "' '"))


def gazette_sql(t: str) -> str:
    x = sub(f"replace({t}, chr(160), ' ')", f"{BIDI}|{CTRL}")
    x = persian(sub(chars_out(x, "﻿ـ"), MARKS))
    x = f"replace(replace({x}, '،', '، '), '؛', '؛ ')"
    return trim(sub(sub(spaced(x), r"[\s]*/[\s]*", "' / '"), r"[ \t]{2,}", "' '"))


def law_sql(t: str) -> str:
    x = sub(f"replace({t}, chr(160), ' ')", f"{BIDI}|{CTRL}")
    x = persian(chars_out(x, "ـ`©«»ًٌٍَُِّْ"))
    x = f"translate({x}, {quoted('٬٫;0123456789')}, {quoted('،.؛٠١٢٣٤٥٦٧٨٩')})"
    return trim(sub(spaced(x), r"[\s]{2,}", "' '"))


def transcript_sql(t: str) -> str:
    return trim(sub(sub(chars_out(t, "﻿"), r"[ \t]+", "' '"), r"\n\n\n+", "chr(10) || chr(10)"))


FORM_SQL = {"statement": statement_sql, "case": case_sql, "dispute": dispute_sql, "gazette": gazette_sql, "law": law_sql, "appeal": transcript_sql}


def _form_query(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return texts(spark, sf_dir).select("doc_id", F.sha2(R.FORMS[name](body()), 256).alias("text_sha256"))

    query.__name__ = f"form_{name}"
    sql = FORM_SQL.get(name)
    register(QUERIES, ORACLES, f"with {SRC} select doc_id, sha256({sql('text')}) as text_sha256 from src" if sql else None)(query)


for _name in R.FORMS:
    if _name != "defence":  # the case form
        _form_query(_name)


def case_measures_sql(kind: str) -> str:
    legal = R.DEFENCE_WORDS if kind == "defence" else R.CASE_WORDS
    garbage = r"[{}<>~^`_=\\|©#]" if kind == "defence" else r"[{}<>~^`_=\\|]"
    own = f", {count('t', '[ØÙ]')} as mojibake_chars" if kind == "defence" else f", {hits('lower(t)', R.CASE_WORDS_ENGLISH)} as english_anchor_hits"
    return f"""f as (select doc_id, text as raw, {case_sql('text')} as t from src), m as (select doc_id, t, length(t) as chars, {count('t', AR)} as arabic_chars, {count('t', LAT)} as latin_letters, {count('t', NUM)} as digits,
 len({words('t')}) as tokens, {full('t')} as lines, {count('t', chr(0xFFFD))} as replacement_chars, {count('t', garbage)} as garbage_chars, {count('t', runs(6))} as long_repeats, {hits('t', legal)} as legal_anchor_hits{own},
 round({short('t')}::double / greatest(len({words('t')}), 1), 4) as single_token_ratio, round(({count('t', AR)} + {count('t', LAT)} + {count('t', NUM)})::double / greatest(length(t), 1), 4) as script_ratio from f)"""


CASE_SCORE = "(case when chars = 0 then '-inf'::double else least(chars, 5000) * 0.035::double + arabic_chars * 0.72::double + digits * 0.04::double + least(lines, 80) * 3.5::double + legal_anchor_hits * 95.0::double + script_ratio * 60.0::double - latin_letters * 0.7::double - replacement_chars * 150.0::double - garbage_chars * 22.0::double - long_repeats * 85.0::double - single_token_ratio * 240.0::double end)"
ENGLISH_SCORE = "(case when english_anchor_hits < 2 and latin_letters < 120 then '-inf'::double else latin_letters * 1.2::double + digits * 0.22::double + english_anchor_hits * 100.0::double + least(lines, 60) * 2.0::double - arabic_chars * 0.3::double - garbage_chars * 20.0::double - long_repeats * 60.0::double end)"
DEFENCE_SCORE = "(case when chars = 0 then '-inf'::double else least(chars, 5000) * 0.035::double + arabic_chars * 0.78::double + digits * 0.05::double + least(lines, 90) * 3.5::double + legal_anchor_hits * 80.0::double + script_ratio * 70.0::double - latin_letters * 0.25::double - replacement_chars * 160.0::double - mojibake_chars * 160.0::double - garbage_chars * 28.0::double - long_repeats * 75.0::double - single_token_ratio * 220.0::double end)"
SHOWN = "case when isinf({0}) then null else round({0}, 4) end"
TOKENS = "[A-Za-z0-9" + r"\x{0600}-\x{06ff}]+"
SCORE_SQL = {
    "disclosure": f"""with {SRC}, m as (select doc_id, case when {trim('text')} = '' then '-inf'::double else least(length(text), 4000) * 0.04::double + {count('text', AR)} * 0.55::double + {count('text', NUM)} * 0.08::double
 + least({full('text')}, 60) * 4.0::double + {hits('text', R.DISCLOSURE_WORDS)} * 100.0::double + ({count('text', AR)} + {count('text', LAT)} + {count('text', NUM)})::double / greatest(length(text), 1) * 90.0 - {short('text')}::double / greatest({count('text', TOKENS)}, 1) * 450.0
 - ({count('text', '[ØÙ' + chr(0xFFFD) + ']')} + {hits('text', ['? ?'])}) * 140.0::double - {count('text', runs(6))} * 75.0::double - {count('text', '[' + chr(92) + '[' + chr(92) + ']{}<>~¢©&=_' + chr(92) + chr(92) + '|]')} * 25.0::double
 - len(list_filter(regexp_extract_all(text, '[{chr(92)}p{{L}}{chr(92)}p{{N}}_]+'), lambda w: regexp_full_match(w, '[a-z]{{2,}}'))) * 8.0::double end as s from src) select doc_id, {SHOWN.format('s')} as score from m""",
    "case": f"with {SRC}, {case_measures_sql('case')} select doc_id, {SHOWN.format(CASE_SCORE)} as score from m",
    "defence": f"with {SRC}, {case_measures_sql('defence')} select doc_id, {SHOWN.format(DEFENCE_SCORE)} as score from m",
    "dispute": f"with {SRC}, f as (select doc_id, {dispute_sql('text')} as t from src) select doc_id, round(({count('t', AR)} + {hits('t', R.DISPUTE_WORDS)} * 20 - {count('t', LAT)} * 1.5 - {count('t', chr(0xFFFD))} * 100 - {count('t', '[<>_~{}' + chr(92) * 2 + '^`]')} * 5)::double, 4) as score from f",
    "gazette": f"with {SRC}, f as (select doc_id, {gazette_sql('text')} as t from src), m as (select doc_id, case when t = '' then '-inf'::double else {count('t', AR)} + {hits('t', R.GAZETTE_WORDS)} * 55 + least({full('t')}, 80) * 3 + {count('t', NUM)} * 0.05::double - {count('t', runs(5, ARABIC_LETTERS))} * 80 - {count('t', '[{}<>' + chr(92) * 2 + '^`~]')} * 20 - {count('t', LAT)} * 1.5::double end as s from f) select doc_id, {SHOWN.format('s')} as score from m",
    "appeal": f"with {SRC} select doc_id, round(({count('text', AR)} - {count('text', '[ØÙ' + chr(0xFFFD) + ']')} * 100 - abs(length(text) - {count('text', AR)}) * 0.03)::double, 4) as score from src",
    "hearing": f"with {SRC} select doc_id, round(({count('text', AR)} * 2.0 + length(text) * 0.15 - {count('text', '[ØÙ' + chr(0xFFFD) + ']')} * 15.0 - {count('text', '[' + chr(92) + 'x00-' + chr(92) + 'x08' + chr(92) + 'x0b' + chr(92) + 'x0c' + chr(92) + 'x0e-' + chr(92) + 'x1f]')} * 10.0)::double, 4) as score from src",
}


def finite(c):
    return F.when(c != float("-inf"), F.round(c, 4))


def _score_query(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return texts(spark, sf_dir).select("doc_id", R.SCORES[name](body()).alias("s")).select("doc_id", finite(F.col("s")).alias("score"))

    query.__name__ = f"score_{name}"
    register(QUERIES, ORACLES, SCORE_SQL.get(name))(query)


for _name in R.SCORES:
    _score_query(_name)


@register(QUERIES, ORACLES, f"with {SRC}, {case_measures_sql('case')} select doc_id, {SHOWN.format(ENGLISH_SCORE)} as english, {SHOWN.format('greatest(' + CASE_SCORE + ', ' + ENGLISH_SCORE + ')')} as better from m")
def score_case_english(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = texts(spark, sf_dir).select("doc_id", R.case_score_english(body()).alias("e"), R.candidate_score(body(), F.lit("eng")).alias("b"))
    return m.select("doc_id", finite(F.col("e")).alias("english"), finite(F.col("b")).alias("better"))


FORM_WORDS = ("Final Settlement", "Joining date", "Last working", "Basic Salary", "Subject", "Date", "Amount")
FORM = "|".join(("ID", "Name", "Date", "Amount", "Total", "Salary", "Bonus", "Signature", "Subject", "From", "To"))


@register(QUERIES, ORACLES, f"""with {SRC}, m as (select doc_id, text as t, {hits('lower(text)', [w.lower() for w in FORM_WORDS])} as hits, len(list_filter(regexp_extract_all(text, '[{chr(92)}p{{L}}{chr(92)}p{{N}}_]+'), lambda w: regexp_full_match(w, '(?i)({FORM})'))) as form from src)
 select doc_id, case when {trim('t')} = '' or (hits < 2 and form < 4) then null else round({count('t', LAT)} * 1.4::double + {count('t', NUM)} * 0.45::double + hits * 120 + form * 35 + least({full('t')}, 80) * 4 + ({count('t', LAT)} + {count('t', NUM)})::double / greatest(length(t), 1) * 150
 - {count('t', AR)} * 2 - {count('t', '[{}<>' + chr(92) * 2 + '^`~]')} * 20 - {count('t', runs(6))} * 40, 4) end as score from m""")
def score_dispute_english(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = texts(spark, sf_dir).select("doc_id", R.dispute_score_english(body(), FORM_WORDS).alias("s"))
    return s.select("doc_id", finite(F.col("s")).alias("score"))


def _measures_query(kind: str, names: list[str]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return texts(spark, sf_dir).select("doc_id", R.case_measures(body(), kind).alias("m")).select("doc_id", *[f"m.{n}" for n in names])

    query.__name__ = f"measures_{kind}"
    cast = [f"{n}::bigint as {n}" if not n.endswith("ratio") else n for n in names]
    register(QUERIES, ORACLES, f"with {SRC}, {case_measures_sql(kind)} select doc_id, {', '.join(cast)} from m")(query)


_SHARED = ["chars", "arabic_chars", "latin_letters", "digits", "tokens", "lines", "replacement_chars", "garbage_chars", "long_repeats", "legal_anchor_hits", "single_token_ratio", "script_ratio"]
_measures_query("case", [*_SHARED, "english_anchor_hits"])
_measures_query("defence", [*_SHARED, "mojibake_chars"])

CASE_FLAGS = f"""concat_ws('|', case when chars = 0 then 'empty_after_cleanup' end, case when arabic_chars < 80 then 'low_arabic_text' end, case when {CASE_SCORE} < 180 then 'low_ocr_score' end, case when replacement_chars > 0 then 'replacement_chars' end,
 case when garbage_chars > 20 then 'high_garbage_chars' end, case when single_token_ratio > 0.28 and tokens > 30 then 'fragmented_tokens' end, case when latin_letters > arabic_chars and english_anchor_hits < 2 then 'latin_noise' end,
 case when length(t) > 0 and chars::double / greatest(length(t) * 3, 1) < 0.35 then 'heavy_cleanup' end)"""
DEFENCE_FLAGS = f"""concat_ws('|', case when chars = 0 then 'empty_after_cleanup' end, case when arabic_chars < 70 then 'low_arabic_text' end, case when {DEFENCE_SCORE} < 180 then 'low_ocr_score' end,
 case when replacement_chars > 0 or mojibake_chars > 0 then 'mojibake_or_replacement' end, case when single_token_ratio > 0.30 and tokens > 35 then 'fragmented_tokens' end, case when length(t) > 0 and chars::double / greatest(length(t) * 3, 1) < 0.35 then 'heavy_cleanup' end)"""


def _flags_query(kind: str, flags, score, sql: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """As if cleaning had kept a third of what was read."""
        m = texts(spark, sf_dir).select("doc_id", R.case_measures(body(), kind).alias("m"))
        return m.select("doc_id", F.array_join(flags(F.col("m"), F.col("m.chars") * 3, score(F.col("m"))), "|").alias("flags"))

    query.__name__ = f"flags_{kind}"
    register(QUERIES, ORACLES, f"with {SRC}, {case_measures_sql(kind)} select doc_id, {sql} as flags from m")(query)


_flags_query("case", R.case_flags, R.case_score_of, CASE_FLAGS)
_flags_query("defence", R.defence_flags, R.defence_score_of, DEFENCE_FLAGS)


@register(QUERIES, ORACLES, f"with {SRC}, {case_measures_sql('case')}, g as (select *, {CASE_SCORE} as s from m) select doc_id, (s < 150 or arabic_chars < 90 or (latin_letters > 80 and english_anchor_hits >= 1)) as english, (s < 350 or (single_token_ratio > 0.30 and legal_anchor_hits = 0) or (digits > arabic_chars and legal_anchor_hits = 0)) as turned from g")
def gates_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = texts(spark, sf_dir).select("doc_id", R.case_measures(body()).alias("m"))
    s = R.case_score_of(F.col("m"))
    return m.select("doc_id", R.case_try_english(F.col("m"), s).alias("english"), R.case_try_turned(F.col("m"), s).alias("turned"))


@register(QUERIES, ORACLES, f"with {SRC}, {case_measures_sql('defence')}, g as (select *, {DEFENCE_SCORE} as s from m) select doc_id, (s < 350 or (single_token_ratio > 0.32 and legal_anchor_hits < 3)) as turned from g")
def gates_defence(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = texts(spark, sf_dir).select("doc_id", R.case_measures(body(), "defence").alias("m"))
    return m.select("doc_id", R.defence_try_turned(F.col("m"), R.defence_score_of(F.col("m"))).alias("turned"))


# Line rules: on stripped lines that are not blank.

LINES = rf"l as (select doc_id, unnest(range(0, len(ls))) as line_index, unnest(ls) as t from (select doc_id, list_filter(list_transform(string_split(replace(text, chr(160), ' '), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') as ls from src))"
S = f"s as (select *, {count('t', AR)} as a, {count('t', LAT)} as b, {count('t', NUM)} as d, length(t) as n from l)"
BARE = r"^[()|.,:+\\/\-=_ \p{Nd}]{1,10}$"
RUN6 = runs(6, ARABIC_LETTERS + "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def isin(words) -> str:
    return "t in (" + ", ".join(map(quoted, words)) + ")"


def holds(words, t: str = "t") -> str:
    return "(" + " or ".join(f"contains({t}, {quoted(w)})" for w in words) + ")"


def begins(words, t: str = "t") -> str:
    return "(" + " or ".join(f"starts_with({t}, {quoted(w)})" for w in words) + ")"


NOISE_SQL = {
    "case": f"{isin(R.CASE_NOISE)} or (regexp_matches(t, '[©#<>]') and a < 80) or regexp_matches(t, '{BARE}') or regexp_matches(t, '{RUN6}') or (n > 25 and (a + b + d)::double / n < 0.18) or (a = 0 and b = 0 and d < 4) or (a < 2 and b = 0 and n > 30) or (a < 3 and d > 18 and n < 45) or (b > 0 and a = 0 and not {holds(R.CASE_WORDS_ENGLISH, 'lower(t)')} and n < 80)",
    "defence": f"regexp_matches(t, '{BARE}') or (n > 25 and (a + b + d)::double / n < 0.18) or (a = 0 and b = 0 and d < 4) or regexp_matches(t, '{RUN6}') or (regexp_matches(t, '[©#<>]') and a < 80)",
    "dispute": rf"regexp_matches(t, '{RUN6}') or regexp_matches(t, '^[٠-٩ ()/\\|.,:+-]{{1,8}}$') or (a <= 4 and d >= 8) or (a = 0 and n < 35) or (a < 2 and n > 25) or (n <= 80 and not regexp_matches(t, '[^\x00-\x7f]')) or (n > 40 and a::double / n < 0.08)",
    "gazette": rf"not regexp_matches(t, '^(19|20)[0-9]{{2}}$') and (regexp_matches(t, '{runs(6, ARABIC_LETTERS)}') or regexp_matches(t, '^[0-9٠-٩ ()/.,:؛\-]+$') or contains(t, 'الكويت اليوم العدد') or regexp_matches(t, '^الأحد\s+\p{{Nd}}+') or regexp_matches(t, '^[0-9٠-٩]+\s+الأحد\s+') or (not {isin(['قرر', 'ملبس', 'ا', 'ب', 'م'])} and ((a = 0 and n < 40) or (n > 40 and a::double / n < 0.10))))",
    "law": r"regexp_matches(t, '^[\(\[]?\s*[0-9٠-٩]{1,3}\s*[\)\]]?$') or regexp_matches(t, '^[.\-_*+|\\/()٠-٩ ]+$') or (a = 0 and n < 40) or (a < 3 and n > 20)",
}
NOISE = {"case": R.case_noise, "defence": R.defence_noise, "dispute": R.dispute_noise, "gazette": R.gazette_noise, "law": R.law_noise}
END = r"([^\p{L}\p{N}_]|$)"
STRUCTURE_SQL = {
    "case": rf"regexp_matches(t, '^\s*(\p{{L}}?[سج]\s*\p{{Nd}}+|\p{{Nd}}+\s*[سج]|[سج]\s*[:/.-])') or regexp_matches(t, '^[\x{{0600}}-\x{{06ff}}A-Za-z ()/.-]{{2,45}}\s*[:：]') or regexp_matches(t, '^\s*(\p{{Nd}}+|[أ-ي])[\-.)،:]\s+') or (length(t) < 90 and {holds(R.CASE_TITLES)}) or regexp_matches(t, '^({R.CASE_OPENINGS}){END}')".replace(r"\p{L}?", ""),
    "defence": rf"regexp_matches(t, '^\s*(\p{{Nd}}+|[أ-ي])[\-.)،:]\s+') or regexp_matches(t, '^[\x{{0600}}-\x{{06ff}}A-Za-z ()/.-]{{2,55}}\s*[:：]') or (length(t) < 110 and {holds(R.DEFENCE_TITLES)}) or regexp_matches(t, '^({R.DEFENCE_OPENINGS}){END}')",
    "dispute": rf"(length(t) < 80 and {holds(R.DISPUTE_TITLES)}) or regexp_matches(t, '^[٠-٩]+[\-.)،:]') or regexp_matches(t, '^[أ-ي][\-.)،:]\s+')",
    "gazette": rf"regexp_matches(t, '^({R.GAZETTE_OPENINGS})') or regexp_matches(t, '^[0-9٠-٩]+[.)\-]') or regexp_matches(t, '^[أ-ي][.)\-]')",
    "law": rf"(contains(regexp_replace(t, '\s+', '', 'g'), 'مادة') and length(regexp_replace(t, '\s+', '', 'g')) <= 24 and regexp_matches(regexp_replace(t, '[^\x{{0621}}-\x{{064a}}]', '', 'g'), '^(مادة|[هم]مادة|مادة[هم])$')) or {begins(['الباب ', 'الفصل ', 'المذكرة الإيضاحية'])} or {isin(R.LAW_HEADINGS)} or (starts_with(t, 'قانون رقم ') and length(t) < 80) or (contains(t, 'في شأن العمل في القطاع الأهلي') and length(t) < 90)",
}
STRUCTURE = {"case": R.case_structural, "defence": R.defence_structural, "dispute": R.dispute_structural, "gazette": R.gazette_structural, "law": R.is_law_heading}


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from qirtas.operators.lines import line_table

    return line_table(texts(spark, sf_dir), ["doc_id"]).withColumnRenamed("line", "t")


def _line_query(prefix: str, name: str, rule, sql: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return line_rows(spark, sf_dir).filter(rule(F.col("t"))).select("doc_id", "line_index", F.col("t").alias("line"))

    query.__name__ = f"{prefix}_{name}"
    register(QUERIES, ORACLES, f"with {SRC}, {LINES}, {S} select doc_id, line_index, t as line from s where {sql}")(query)


for _name, _rule in NOISE.items():
    _line_query("noise", _name, _rule, NOISE_SQL[_name])
for _name, _rule in STRUCTURE.items():
    _line_query("structure", _name, _rule, STRUCTURE_SQL[_name])
_line_query("items", "law", R.is_list_item, r"regexp_matches(t, '^([٠-٩]+[.\-،:]?\s+|[أابجدهوزحط]\s*[-.،:]|\*)')")
_line_query("openings", "law", R.opens_paragraph, begins(R.LAW_OPENINGS))


def _joins_query(name: str, joins, ends: str, least: int, least_next: int):
    """Neighbouring lines of a text that belong to one paragraph."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        from pyspark.sql import Window

        rows = line_rows(spark, sf_dir).withColumn("before", F.lag("t").over(Window.partitionBy("doc_id").orderBy("line_index"))).filter("before is not null")
        return rows.filter(joins(F.col("before"), F.col("t"))).select("doc_id", "line_index")

    query.__name__ = f"joins_{name}"
    other = lambda c: STRUCTURE_SQL[name].replace("(t,", f"({c},").replace("length(t)", f"length({c})")
    sql = f"with {SRC}, {LINES}, p as (select *, lag(t) over (partition by doc_id order by line_index) as b from l) select doc_id, line_index from p where b is not null and not ({other('t')}) and not ({other('b')}) and not regexp_matches(b, '{ends}') and length(b) >= {least} and length(t) >= {least_next}"
    register(QUERIES, ORACLES, sql)(query)


_joins_query("case", R.case_joins, "[.؟?!؛:]$", 28, 8)
_joins_query("defence", R.defence_joins, "[.؟?!؛:]$", 28, 8)
_joins_query("dispute", R.dispute_joins, "[.؟!؛:]$", 25, 0)


def _page_query(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = texts(spark, sf_dir).select("doc_id", R.PAGES[name](body()).alias("t"))
        return out.select("doc_id", F.length("t").cast("long").alias("chars"), F.sha2("t", 256).alias("text_sha256"))

    query.__name__ = f"page_{name}"
    register(QUERIES, ORACLES)(query)


for _name in R.PAGES:
    _page_query(_name)


@register(QUERIES, ORACLES)
def page_dispute_english(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", F.sha2(R.dispute_page_english(body()), 256).alias("text_sha256"))


@register(QUERIES, ORACLES)
def page_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", F.sha2(R.law_text(R.law_lines(body())), 256).alias("text_sha256"))


@register(QUERIES, ORACLES)
def minutes_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", F.sha2(R.minutes_lines(body()), 256).alias("text_sha256"))


@register(QUERIES, ORACLES, rf"with {SRC}, {LINES} select doc_id, line_index, case when regexp_full_match(t, '\p{{Nd}}+\s*[سج]') then regexp_replace(t, '^(\p{{Nd}}+)\s*([سج])$', '\2\1') when regexp_matches(t, '^[سج]\s*\p{{Nd}}+([^\p{{L}}\p{{N}}_]|$)') then regexp_replace(t, '^([سج])\s*(\p{{Nd}}+)', '\1\2') else t end as line from l")
def question_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rows(spark, sf_dir).select("doc_id", "line_index", R.question_line(F.col("t")).alias("line"))


@register(QUERIES, ORACLES, f"""with {SRC}, f0 as (select doc_id, {case_sql('text')} as text from src), c as (select doc_id, 0 as stage, 'half' as variant, text[1:length(text) // 2] as text from f0 union all select doc_id, 1, 'whole', text from f0),
 k as (select *, {trim('text')} <> '' as viable from c), src2 as (select * from k), {case_measures_sql('case').replace('from src)', 'from src2)').replace('select doc_id, text as raw,', 'select doc_id, stage, variant, viable,').replace('m as (select doc_id, t,', 'm as (select doc_id, stage, variant, viable, t,')},
 z as (select *, {CASE_SCORE} as s from m), w as (select a.*, row_number() over (partition by a.doc_id order by a.viable::int desc, a.s desc, a.stage) as r from z a join z b on a.doc_id = b.doc_id and b.stage = 0
  where a.stage = 0 or (a.stage = 1 and (not b.viable or b.s < 150 or b.arabic_chars < 90 or (b.latin_letters > 80 and b.english_anchor_hits >= 1)))) select doc_id, variant, case when isinf(s) then null else round(s, 4) end as score from w where r = 1""")
def cascade_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of each text as the first reading, all of it as the second where the gate asks for one."""
    t = texts(spark, sf_dir).select("doc_id", R.case_form(body()).alias("text"))
    half = F.col("text").substr(F.lit(1), F.floor(F.length("text") / 2).cast("int"))
    rows = t.select("doc_id", F.inline(F.array(F.struct(F.lit(0).alias("stage"), F.lit("half").alias("variant"), half.alias("text")), F.struct(F.lit(1).alias("stage"), F.lit("whole").alias("variant"), F.col("text").alias("text")))))
    rows = rows.withColumn("m", R.case_measures(F.col("text"))).withColumn("score", R.case_score_of(F.col("m")))
    out = cascade.chosen(rows, ["doc_id"], {1: lambda best: R.case_try_english(best["m"], best["score"])}, order=["stage"])
    return out.select("doc_id", "variant", finite(F.col("score")).alias("score"))
