"""Queries over single texts: tokens, quality, fields, normal forms, lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qirtas.functions import fields, metrics, text, udfs
from qirtas.operators import choose, evaluate, lines

from .common import RATIOS, STATS, count, full_lines, register, reply, share, strip, table, tok

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
CASES, DATES = r"\b\d[\d/\-]{2,}\b", r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b"
RUNS = """runs as (select doc_id, count(*) filter (where len >= 5) as runs from (
  select doc_id, ch, count(*) as len from (select doc_id, i, ch, i - row_number() over (partition by doc_id, ch order by i) as g
    from (select doc_id, unnest(range(1, length(text) + 1)) as i, unnest(string_split(text, '')) as ch from src where regexp_matches(text, '{any}')) where ch <> chr(10))
  group by doc_id, ch, g) group by doc_id)"""
ANY5 = "|".join("\\" + c + "{5}" if c in ".|*+?()[]{}^$\\/-" else c + "{5}" for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 .,!?;:-_#$%&*|/=+~()")
RUNS = RUNS.replace("{any}", ANY5.replace("'", "''"))


def body():
    """The text column; made when a session is there."""
    return F.col("text")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@register(QUERIES, ORACLES, f"with src as (select doc_id, text from documents), {STATS} select doc_id, {RATIOS} from s")
def doc_token_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = docs(spark, sf_dir).select("doc_id", metrics.token_stats(body()).alias("s"))
    return s.select("doc_id", "s.token_count", F.round("s.single_char_ratio", 6).alias("single_char_ratio"), F.round("s.digit_fragment_ratio", 6).alias("digit_fragment_ratio"))


@register(QUERIES, ORACLES, f"with src as (select doc_id, text from documents), {STATS} select doc_id, (n = 0 or one::double / n > 0.3 or frag::double / n > 0.2) as low_quality from s")
def doc_low_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", metrics.low_quality(metrics.token_stats(body())).alias("low_quality"))


SCORE = f"""with raw as (select doc_id, {strip("text")} as text from documents), src as (select *, {full_lines("text")} as ls from raw), {STATS}, {RUNS}
select s.doc_id, n::bigint as token_count, len(ls)::bigint as line_count, round(case when text = '' or {reply("text")} then -1.0 else
  least(n, 120) / 120.0::double * 1.2 + least(len(ls), 12) / 12.0::double * 0.25 + least(({count("text", "[A-Za-z]")} + {count("text", "[0-9]")})::double / greatest(length(text), 1), 1.0) * 0.45
  + ((len(regexp_extract_all(text, '{CASES}')) > 0)::int + (len(regexp_extract_all(text, '{DATES}')) > 0)::int) * 0.12
  - {share("one", "n")} * 1.6 - {share("frag", "n")} * 1.3 - least(coalesce(runs, 0), 3) * 0.1 - (case when n >= 20 and len(ls) <= 1 then 0.2 else 0.0 end) end, 6) as quality_score
from s left join runs using (doc_id)"""


@register(QUERIES, ORACLES, SCORE)
def doc_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select(
        "doc_id", F.size(text.tokens(text.strip(body()))).cast("long").alias("token_count"), F.size(text.full_lines(text.strip(body()))).cast("long").alias("line_count"),
        F.round(metrics.quality_score(body()), 6).alias("quality_score"),
    )


FIELDS = f"select doc_id, array_to_string(regexp_extract_all(text, '{CASES}'), '|') as case_numbers, array_to_string(regexp_extract_all(text, '{DATES}'), '|') as dates, '' as articles from documents"


@register(QUERIES, ORACLES, FIELDS)
def doc_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", *[F.array_join(f(body()), "|").alias(n) for n, f in (("case_numbers", fields.case_numbers), ("dates", fields.dates), ("articles", fields.articles))])


@register(QUERIES, ORACLES, f"select lang, count(*)::bigint as docs, sum(len(regexp_extract_all(text, '{CASES}')))::bigint as case_numbers, sum(len(regexp_extract_all(text, '{DATES}')))::bigint as dates from documents group by lang")
def doc_field_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.groupBy("lang").agg(F.count("*").alias("docs"), F.sum(F.size(fields.case_numbers(body())).cast("long")).alias("case_numbers"), F.sum(F.size(fields.dates(body())).cast("long")).alias("dates"))


KEPT = rf"array_to_string(list_transform(list_filter(string_split(text, chr(10)), lambda x: not {reply('x')}), lambda x: regexp_replace(x, '\s+$', '')), chr(10))"


@register(QUERIES, ORACLES, rf"select doc_id, sha256(regexp_replace({strip(KEPT)}, '\n\n\n+', chr(10) || chr(10), 'g')) as text_sha256 from documents")
def replies_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.sha2(metrics.without_replies(body()), 256).alias("text_sha256"))


TIDY = strip(r"regexp_replace(regexp_replace(regexp_replace(text, '[ \t\x0b\f]+', ' ', 'g'), '[ \t]+\n', chr(10), 'g'), '\n\n\n+', chr(10) || chr(10), 'g')")


@register(QUERIES, ORACLES, f"select doc_id, sha256({strip(chr(114) + 'egexp_replace(text, ' + repr(chr(92) + 's+').replace(chr(92) * 2, chr(92)) + ', ' + repr(' ') + ', ' + repr('g') + ')')}) as text_sha256 from documents")
def normalised_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.sha2(text.normalise_legacy(body()), 256).alias("text_sha256"))


@register(QUERIES, ORACLES, f"select doc_id, sha256({TIDY}) as text_sha256 from documents")
def normalised_faithful(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.sha2(text.normalise_faithful(body()), 256).alias("text_sha256"))


@register(QUERIES, ORACLES, f"select doc_id, sha256({TIDY}) as text_sha256 from documents")
def normalised_llm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.sha2(text.normalise_llm(body()), 256).alias("text_sha256"))


WEIRD = r"[\x{00C0}-\x{02AF}\x{1D00}-\x{1EFF}]"


@register(QUERIES, ORACLES, rf"select doc_id, regexp_matches(text, '[\x{{0600}}-\x{{06FF}}]') as has_arabic, round({share(count('text', WEIRD), 'length(text)')}, 6) as weird_ratio, 0.0::double as suspicious_ratio, round({share(count('text', '[^' + chr(92) + 'x{0000}-' + chr(92) + 'x{024F}' + chr(92) + 'x{2000}-' + chr(92) + 'x{206F}]'), 'length(text)')}, 6) as nonstandard_ratio from documents")
def script_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = lambda c, n: F.round(c, 6).alias(n)
    return docs(spark, sf_dir).select("doc_id", metrics.contains_arabic(body()).alias("has_arabic"), r(metrics.weird_ratio(body()), "weird_ratio"), r(metrics.suspicious_ratio(body()), "suspicious_ratio"), r(metrics.nonstandard_ratio(body()), "nonstandard_ratio"))


@register(QUERIES, ORACLES, f"with src as (select doc_id, text from documents), {RUNS} select doc_id, runs::bigint as runs from runs where runs > 0")
def repeated_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = F.regexp_count(body(), F.lit(r"(?d)(.)\1{4,}")).cast("long")
    return docs(spark, sf_dir).select("doc_id", runs.alias("runs")).filter("runs > 0")


LINES = f"l as (select doc_id, len(ls) as total, unnest(range(0, len(ls))) as line_index, unnest(ls) as line from (select doc_id, {full_lines('text')} as ls from documents))"
CLASS = rf"""c as (select *, len({tok('line')}) as n, line_index <= least(total // 2, 10) as top, regexp_matches(lower(line), 'prosecution|attorney general|justice|deputy attorney') as header,
  regexp_matches(line, '{CASES}') as cs, regexp_matches(line, '{DATES}') as dt from l), k as (select doc_id, line_index, line, case when top and header and dt and n > 4 then null when n <= 8 and header and top then 'header'
  when n <= 14 and top and cs then 'case_line' when n <= 10 and top and dt then 'date_line' when line_index <= 2 and n <= 8 then 'title_line' end as label from c)"""


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.line_table(docs(spark, sf_dir), ["doc_id"])
    return rows.withColumn("label", fields.line_class(F.col("line"), F.col("line_index"), F.col("total_lines"))).filter("label is not null").select("doc_id", "line_index", "line", "label")


@register(QUERIES, ORACLES, f"with {LINES}, {CLASS} select doc_id, line_index, line, label from k where label is not null")
def line_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(spark, sf_dir)


@register(QUERIES, ORACLES, f"with {LINES}, {CLASS} select doc_id, line_index, label from (select *, row_number() over (partition by doc_id order by line_index) as r from k where label is not null) where r <= 8")
def first_eight_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refinement's own bound: eight lines a block."""
    w = Window.partitionBy("doc_id").orderBy("line_index")
    return classified(spark, sf_dir).withColumn("r", F.row_number().over(w)).filter("r <= 8").select("doc_id", "line_index", "label")


def overlap(a: str, b: str) -> str:
    t = lambda x: f"regexp_extract_all(lower({x}), '[0-9A-Za-z]+')"
    return f"(case when len({t(a)}) = 0 or len({t(b)}) = 0 then 0.0 else len(list_filter({t(a)}, lambda q: list_contains({t(b)}, q)))::double / len({t(a)}) end)"


DIG = lambda x: f"regexp_matches({x}, '[0-9]')"
VERDICT = rf"""p as (select a.doc_id, a.line_index, a.label, regexp_replace(a.line, '\s+', ' ', 'g') as a, regexp_replace(b.line, '\s+', ' ', 'g') as b from k a join k b on a.doc_id = b.doc_id and b.line_index = a.line_index + 1 where a.label is not null),
 o as (select *, {overlap('a', 'b')} as ov, length(b)::double / greatest(length(a), 1) as ratio, label in ('header', 'title_line') as title from p)
 select doc_id, line_index, label, case when {reply('b')} then 'hallucinated' when a = b then 'unchanged' when ratio < 0.45 or ratio > 2.2 then 'length_ratio'
  when len(string_split(a, ' ')) <= 5 and len(string_split(b, ' ')) > len(string_split(a, ' ')) + 3 then 'too_many_new_tokens' when {DIG('a')} and not {DIG('b')} then 'lost_digits'
  when label = 'case_line' and not {DIG('b')} then 'case_line_without_digits' when title and regexp_matches(a, '[A-Za-z]') <> regexp_matches(b, '[A-Za-z]') then 'script_shift'
  when title and not {DIG('a')} and {DIG('b')} then 'unexpected_digits' when title and ov < 0.6 then 'low_token_overlap' when label = 'case_line' and ov < 0.4 then 'low_token_overlap'
  when label = 'date_line' and ov < 0.6 then 'low_token_overlap' else 'accepted' end as verdict from o"""


@register(QUERIES, ORACLES, f"with {LINES}, {CLASS}, {VERDICT}")
def refinement_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each classified line against the next one of its document, as if that were its refinement."""
    rows = lines.line_table(docs(spark, sf_dir), ["doc_id"])
    rows = rows.withColumn("label", fields.line_class(F.col("line"), F.col("line_index"), F.col("total_lines")))
    rows = rows.withColumn("following", F.lead("line").over(Window.partitionBy("doc_id").orderBy("line_index"))).filter("label is not null and following is not null")
    return rows.select("doc_id", "line_index", "label", fields.refinement_verdict(F.col("line"), F.col("following"), F.col("label")).alias("verdict"))


METRICS = f"""with src as (select doc_id, text from documents), {STATS} select doc_id, length(text)::bigint as chars, {count('text', '[A-Za-z]')}::bigint as latin_chars, {count('text', '[0-9]')}::bigint as digits, n::bigint as tokens,
 len({full_lines('text')})::bigint as lines, round({share('one', 'n')}, 4) as single_ratio, round({share('frag', 'n')}, 4) as digit_fragment_ratio from s"""


@register(QUERIES, ORACLES, METRICS)
def page_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = docs(spark, sf_dir).select("doc_id", metrics.text_metrics(body()).alias("m"))
    return m.select("doc_id", "m.chars", "m.latin_chars", "m.digits", "m.tokens", "m.lines", "m.single_ratio", "m.digit_fragment_ratio")


OVERLAP = """with e as (select doc_id, text, text[1:length(text) // 2] as half from documents), a as (select doc_id, unnest(regexp_extract_all(lower(text), '[0-9A-Za-z]+')) as t from e),
 b as (select distinct doc_id, unnest(regexp_extract_all(lower(half), '[0-9A-Za-z]+')) as t from e), s as (select doc_id, sum((b.t is not null)::int)::double / count(*) as o from a left join b using (doc_id, t) group by doc_id)
 select doc_id, round(coalesce(o, 0.0), 4) as overlap from e left join s using (doc_id)"""


@register(QUERIES, ORACLES, OVERLAP)
def half_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token overlap of each text with its first half."""
    d = docs(spark, sf_dir).withColumn("half", body().substr(F.lit(1), F.floor(F.length("text") / 2).cast("int")))
    return evaluate.document_overlap(d, "doc_id", "text", "half").select("doc_id", F.round("overlap", 4).alias("overlap"))


@register(QUERIES, ORACLES)
def arabic_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = docs(spark, sf_dir).select("doc_id", metrics.quality_status(body()).alias("q"))
    return q.select("doc_id", "q.status", F.array_join("q.issues", "|").alias("issues"), F.round("q.metrics.rtl_ratio", 6).alias("rtl_ratio"), F.round(metrics.status_score(F.col("q")), 3).alias("score"))


@register(QUERIES, ORACLES)
def cleaned_arabic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.sha2(text.clean_arabic(body()), 256).alias("text_sha256"))


WRONG = (("the", "teh"), ("ing ", "ign "), ("tion", "toin"))


@register(QUERIES, ORACLES, "select doc_id, sha256(replace(replace(replace(text, 'the', 'teh'), 'ing ', 'ign '), 'tion', 'toin')) as text_sha256 from documents")
def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = F.array(*[F.struct(F.lit(a).alias("wrong"), F.lit(b).alias("right")) for a, b in WRONG])
    return docs(spark, sf_dir).select("doc_id", F.sha2(text.corrected(body(), rules), 256).alias("text_sha256"))


def benchmark_errors(passages: DataFrame) -> DataFrame:
    """Passages against themselves without their first four characters."""
    return passages.select("item_id", F.round(evaluate.character_error_rate(body(), body().substr(F.lit(5), F.length("text"))), 6).alias("cer"))


@register(QUERIES, ORACLES)
def character_errors_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error rate of every benchmark passage, over code points; no SQL, a test has it by brute force."""
    return benchmark_errors(table(spark, sf_dir, "benchmark"))


@register(QUERIES, ORACLES, "select item_id, round(levenshtein(text, text[5:])::double / length(text), 6) as cer from benchmark where not regexp_matches(text, '[^\\x00-\\x7F]')")
def character_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of ``character_errors_whole`` that its SQL can follow: ASCII passages, where both engines count alike."""
    return benchmark_errors(table(spark, sf_dir, "benchmark").filter(~body().rlike(r"[^\x00-\x7f]")))


@register(QUERIES, ORACLES)
def word_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark").withColumn("found", F.array_join(F.slice(text.tokens(body()), F.lit(3), F.greatest(F.size(text.tokens(body())), F.lit(1))), " "))
    out = b.select("item_id", udfs.word_error_rate("text", "found").alias("wer"), udfs.word_agreement("text", "found").alias("v"), udfs.similarity("text", "found").alias("similarity"))
    return out.select("item_id", F.round("wer", 6).alias("wer"), "v.disagreements", F.round("v.confidence", 6).alias("confidence"), F.round("similarity", 6).alias("similarity"))


@register(QUERIES, ORACLES)
def better_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text against its first half as the other reading."""
    d = docs(spark, sf_dir).withColumn("other", body().substr(F.lit(1), F.floor(F.length("text") / 2).cast("int")))
    return choose.better_pages(d, "text", "other").select("doc_id", "winner", F.length("chosen").cast("long").alias("chars"), "skipped_reason")
