"""Queries over content streams, folders of files, reviews and lists of names; all read the given tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.functions import text
from qirtas.operators import casefile, fonts, outputs, render, streams
from qirtas.sources.folders import read_folders, write_folders
from qirtas.sources import readings
from qirtas.sources.shared import shared_path
from qirtas.streaming import review

from .common import register, table, tok
from . import casefiles
from .measures import body, docs
from .sheets import ORACLES as SHEETS
from .sheets import turns

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
ACROSS = 8  # words a line of a written stream


def written_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as a content stream: its words along lines, as plain strings (with escapes and octal codes), as arrays with
    kerning, or as glyphs by a map of the text's own characters. Texts are dealt out first: a file may be one group of rows."""
    words = text.tokens(body())

    def escaped(w: Column) -> Column:
        for mark, code in (("\\", r"\\"), ("(", r"\("), (")", r"\)"), ("e", r"\145")):
            w = F.replace(w, F.lit(mark), F.lit(code))
        return w

    def move(i: Column) -> Column:
        return F.when(i == 0, "2 0 0 2 72 720 Tm ").when(i % ACROSS == 0, "-245 -7 TD ").otherwise("35 0 Td ")

    def show(w: Column, i: Column) -> Column:
        plain, half = w.rlike(r"^[\x21-\x7E]+$"), F.floor(F.length(w) / 2).cast("int")
        one = F.concat(move(i), F.lit("("), escaped(w), F.lit(") Tj"))
        two = F.concat(move(i), F.lit("[("), escaped(F.substring(w, F.lit(1), half)), F.lit(") -120 ("), escaped(F.substring(w, half + 1, F.length(w))), F.lit(")] TJ"))
        return F.when((i % 3 == 0) & plain, one).when((i % 3 == 1) & plain, two).otherwise(F.concat(move(i), F.lit("<"), F.hex(F.encode(w, "UTF-16BE")), F.lit("> Tj")))

    parts = F.transform(words, show)
    chars = F.filter(F.array_distinct(F.split(body(), "")), lambda c: c != "")
    glyphs = F.map_from_entries(F.transform(chars, lambda c: F.struct(F.ascii(c).alias("key"), c.alias("value"))))
    stream = F.encode(F.concat(F.lit("BT /F1 11 Tf "), F.array_join(parts, " "), F.lit(" ET")), "ISO-8859-1")
    dealt = docs(spark, sf_dir).repartition(4 * spark.sparkContext.defaultParallelism)
    return dealt.select("doc_id", stream.alias("stream"), F.create_map(F.lit("F1"), glyphs).alias("fonts"))


@register(QUERIES, ORACLES, rf"""with w as (select doc_id, unnest({tok("coalesce(text, '')")}) as word, generate_subscripts({tok("coalesce(text, '')")}, 1) - 1 as i from documents),
 s as (select doc_id, i, case when regexp_matches(word, '^[\x21-\x7E]+$') then word else regexp_replace(word, '[^\x{{0}}-\x{{FFFF}}]', '', 'g') end as word from w)
 select doc_id, (720 - 14 * (i // {ACROSS}))::double as y, count(*) as spans, min(72 + 70 * (i % {ACROSS}))::double as x_first, max(72 + 70 * (i % {ACROSS}))::double as x_last, string_agg(word, ' ' order by i) as line
 from s where word <> '' group by doc_id, i // {ACROSS}""")
def stream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and places of all texts, read back from their streams."""
    rows = streams.stream_rows(written_streams(spark, sf_dir), ["doc_id"], style="marked")
    lines = rows.groupBy("doc_id", "y").agg(F.collect_list(F.struct("xs", "ends", "line")).alias("rows"))
    words = F.array_sort(F.flatten(F.transform("rows", streams.placed_words)))
    return lines.select(
        "doc_id", "y", F.aggregate("rows", F.lit(0).cast("long"), lambda n, r: n + F.size(r["xs"])).alias("spans"),
        F.array_min(F.transform("rows", lambda r: r["xs"][0])).alias("x_first"), F.array_max(F.transform("rows", lambda r: F.element_at(r["xs"], -1))).alias("x_last"),
        F.when(F.size("rows") == 1, F.col("rows")[0]["line"]).otherwise(F.array_join(F.transform(words, lambda w: w["word"]), " ")).alias("line"),
    )


def rendered_talks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = turns(spark, sf_dir)
    files = t.select("conv_id", F.concat(F.lit("talk "), F.col("conv_id").cast("string")).alias("title")).distinct()
    marked = render.marked_pages(t, "conv_id").select("conv_id", F.col("rendered").alias("context"))
    titled = render.titled_markdown(t, files, "conv_id", "Local only.", empty="-").select("conv_id", F.col("rendered").alias("verbatim"))
    return marked.join(titled, "conv_id")


@register(QUERIES, ORACLES, f"""select conv_id, file, rendered_sha256 from (select conv_id, 'context.md' as file, rendered_sha256 from ({SHEETS["marked_texts"]}) a
 union all select conv_id, 'verbatim.md' as file, rendered_sha256 from ({SHEETS["titled_texts"]}) b)""")
def case_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's files, written as folders and read back."""
    path = shared_path(spark, "case-folders")
    write_folders(outputs.file_set(rendered_talks(spark, sf_dir), "conv_id"), path)
    return read_folders(spark, path).select(F.col("document").cast("long").alias("conv_id"), "file", F.sha2("content", 256).alias("rendered_sha256"))


PAGES_OF_SOURCES = """p as (select source, doc_id, length(coalesce(text, '')) as chars, length(coalesce(text, '')) % 7 = 0 as weak, lang = 'fr' as ocr from documents),
 w as (select *, row_number() over (partition by source order by doc_id) as place from p where weak), c as (select source, count(*) as weak_n from w group by source),
 l as (select source, string_agg(doc_id::varchar, ', ' order by doc_id) filter (where place <= 20) as weak20, string_agg(doc_id::varchar, ', ' order by doc_id) filter (where place <= 40) as weak40 from w group by source),
 t as (select source, count(*) as pages, sum(chars)::bigint as total_chars, sum(coalesce(ocr, false)::int) as ocr_pages from p group by source)"""


def source_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as documents, their texts as pages: weak ones by their length, read ones by their language."""
    rows = table(spark, sf_dir, "documents").withColumn("chars", F.length(F.coalesce("text", F.lit(""))))
    return outputs.document_notes(rows, "source", "doc_id", "chars", F.col("chars") % 7 == 0, F.col("lang") == "fr")


@register(QUERIES, ORACLES, f"""with {PAGES_OF_SOURCES} select coalesce(t.source, '') as name, '- [' || coalesce(t.source, '') || '](' || coalesce(t.source, '') || ') - pages: ' || pages::varchar || '; chars: ' || total_chars::varchar
 || case when ocr_pages > 0 then '; ocr fallback pages: ' || ocr_pages::varchar else '' end || case when weak_n > 0 then '; weak pages: ' || weak20 || case when weak_n > 20 then '...' else '' end else '' end as line
 from t left join c on c.source is not distinct from t.source left join l on l.source is not distinct from t.source""")
def index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outputs.index_lines(source_notes(spark, sf_dir), F.col("source"))


@register(QUERIES, ORACLES, f"with {PAGES_OF_SOURCES} select coalesce(c.source, '') as name, '- ' || coalesce(c.source, '') || ': ' || weak40 || case when weak_n > 40 then '...' else '' end as line from c join l on l.source is not distinct from c.source")
def audit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outputs.audit_lines(source_notes(spark, sf_dir), F.col("source"))


@register(QUERIES, ORACLES, f"with {PAGES_OF_SOURCES} select count(*) as documents, sum(pages)::bigint as pages, sum(total_chars)::bigint as chars, count(weak_n) as weak_documents from t left join c on c.source is not distinct from t.source")
def index_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outputs.corpus_head(source_notes(spark, sf_dir))


class RuleReviewer:
    """In place of a model: white space closed up, a doubt where something is asked, no text now and then; every third text
    fails at first."""

    def review(self, raw_text: str, attempt: int) -> str:
        if attempt == 1 and len(raw_text) % 3 == 0:
            raise TimeoutError("no reply")
        cleaned = "" if len(raw_text) % 5 == 0 else " ".join(raw_text.replace("\n", " ").split(" ")).strip()
        while "  " in cleaned:
            cleaned = cleaned.replace("  ", " ")
        return "```json\n" + json.dumps({"cleaned_text": cleaned, "uncertainties": ["asks"] if "?" in raw_text else []}) + "\n```"


REVIEWED = casefiles.SEGMENTS.replace(f"sha256(string_agg(body, {casefiles.NL} order by g.page)) as text_sha256", f"string_agg(body, {casefiles.NL} order by g.page) as raw")
REVIEWED = f"""with s as ({REVIEWED}), p as (select *, case when page_start = page_end then 'Page ' || page_start::varchar else 'Pages ' || page_start::varchar || '-' || page_end::varchar end || ': ' as place,
 case when length(raw) % 5 = 0 then raw else regexp_replace(raw, '[ \n]+', ' ', 'g') end as cleaned from s),
 n as (select *, list_transform((case when contains(raw, '?') then ['asks'] else [] end) || (case when length(raw) % 5 = 0 then ['{review.EMPTY_REPLY}'] else [] end), lambda x: place || x) as notes from p)
 select conv_id, id, sha256(string_agg(cleaned, {casefiles.NL} order by segment)) as cleaned_sha256, coalesce(string_agg(array_to_string(notes, '|'), '|' order by segment) filter (where len(notes) > 0), '') as uncertainties,
 sum(case when length(raw) % 3 = 0 then 2 else 1 end)::int as attempts, 'reviewed' as status from n group by conv_id, id"""


def digest(reviewed: DataFrame) -> DataFrame:
    return reviewed.select("conv_id", "id", F.sha2("cleaned_text", 256).alias("cleaned_sha256"), F.array_join("uncertainties", "|").alias("uncertainties"), "attempts", "status")


@register(QUERIES, ORACLES, REVIEWED)
def reviewed_talks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of every conversation, reviewed at once."""
    cover = casefile.coverage(*casefiles.ranges(spark, sf_dir), "conv_id")
    own = casefile.pages_of(cover, casefiles.turns(spark, sf_dir), "conv_id")
    return digest(review.review_pages(own, ["conv_id", "id"], RuleReviewer))


@register(QUERIES, ORACLES, REVIEWED)
def reviewed_talks_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as their turns come in: a stream over the table, joined to the documents' ranges."""
    cover = casefile.coverage(*casefiles.ranges(spark, sf_dir), "conv_id").select("conv_id", "id", "page_start", "page_end", (F.col("page_end") - F.col("page_start") + 1).alias("page_total"))
    schema = table(spark, sf_dir, "conversations").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(f"{sf_dir}/conversations.parque[t]")  # by a pattern: a file or a folder
    turns = stream.select("conv_id", (F.col("turn") + 1).cast("int").alias("page"), "text")
    pages = turns.join(cover.withColumn("page", F.explode(F.sequence("page_start", "page_end"))), ["conv_id", "page"])
    path = shared_path(spark, "reviews")
    review.write_reviews(review.review_stream(pages, ["conv_id", "id"], RuleReviewer), ["conv_id", "id"], f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return digest(spark.read.parquet(f"{path}/rows"))


class LayerReader:
    """In place of an engine: reads a page whose image is its text layer, by halves of lower case or as it is."""

    def __init__(self, variant: str):
        self.variant = variant

    def recognise(self, image: bytes) -> tuple[str, float | None, str | None]:
        text = image.decode()
        return (text.lower() if self.variant == "lower" else text), 1.0, None


@register(QUERIES, ORACLES, """with t as (select doc_id, sha256(coalesce(text, '')) as h, coalesce(text, '') as text from documents),
 f as (select h, min(text) as text from t group by h), s as (select h, text[1:length(text) // 2] as a, text[length(text) // 2 + 1:] as b from f),
 r as (select h, case when length(a) % 2 = 0 then lower(a) else a end as a, case when length(b) % 2 = 0 then lower(b) else b end as b from s)
 select doc_id, sha256(b || '|' || a) as texts_sha256, 4::bigint as readings, 1 as runs from t join r on r.h = t.h""")
def page_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as scans of two sides: each side read in two ways and kept, a second run over all reads nothing more; the better
    reading of each side, the right one first."""
    t = docs(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("sha256", F.sha2("text", 256))
    half = F.floor(F.length("text") / 2).cast("int")
    sides = F.array(F.struct(F.lit("left").alias("side"), F.substring("text", F.lit(1), half).alias("t")), F.struct(F.lit("right").alias("side"), F.substring("text", half + 1, F.length("text")).alias("t")))
    pages = t.select("sha256", F.lit(1).alias("page"), F.explode(sides).alias("s")).select("sha256", "page", "s.side", F.encode("s.t", "UTF-8").alias("image"))
    configs = spark.createDataFrame([("layer", "plain", None), ("layer", "lower", None)], "engine string, variant string, psm int")
    path, make = shared_path(spark, "readings"), lambda engine, variant, psm: LayerReader(variant)
    for _ in range(2):
        readings.read_missing(spark, path, pages, configs, make)
    kept = readings.readings(spark, path)
    best = readings.best_texts(kept, F.when((F.col("variant") == "lower") == (F.length("text") % 2 == 0), 1.0).otherwise(0.0))
    texts = readings.in_order(t.select(F.col("doc_id").alias("name"), "sha256"), best)
    made = readings.stored(spark, path).groupBy("sha256").agg(F.count("*").alias("readings"), F.countDistinct("run").cast("int").alias("runs"))
    digests = texts.select(F.col("name").alias("doc_id"), F.sha2(F.array_join("texts", "|"), 256).alias("texts_sha256"))
    return digests.join(t.select("doc_id", "sha256"), "doc_id").join(made, "sha256").select("doc_id", "texts_sha256", "readings", "runs")


def written_fonts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's characters as a font file of their own, glyphs from 1 on in order of code points: format 4 for every
    other doc_id whose characters fit it, format 12 for the rest; the file is cut in half where 7 divides doc_id - 3."""
    two = lambda x: F.lpad(F.hex(x.cast("long")), 4, "0")
    four = lambda x: F.lpad(F.hex(x.cast("long")), 8, "0")
    joined = lambda f: F.array_join(F.transform("points", f), "")
    chars = F.array_distinct(F.filter(F.split(body(), ""), lambda c: c != ""))
    rows = docs(spark, sf_dir).select("doc_id", F.array_sort(F.transform(chars, lambda c: F.ascii(c))).alias("points"))
    n = F.size("points")
    ends, shifts, places = joined(two), joined(lambda p, i: two(F.pmod(i + 1 - p, F.lit(65536)))), joined(lambda p: F.lit("0000"))
    segments = F.concat(F.lit("0004"), two(n * 8 + 24), F.lit("0000"), two(n * 2 + 2), F.lit("000000000000"), ends, F.lit("FFFF0000"), ends, F.lit("FFFF"), shifts, F.lit("0001"), places, F.lit("0000"))
    groups = F.concat(F.lit("000C0000"), four(n * 12 + 16), F.lit("00000000"), four(n), joined(lambda p, i: F.concat(four(p), four(p), four(i + 1))))
    small = (F.col("doc_id") % 2 == 0) & (n < 8000) & ~F.exists("points", lambda p: p >= 0xFFFF)
    table_ = F.concat(F.lit("000000010003"), F.when(small, "0001").otherwise("000A"), F.lit("0000000C"), F.when(small, segments).otherwise(groups))
    size = F.length(table_) / 2
    font = F.concat(F.lit("000100000001001000000000"), F.hex(F.encode(F.lit("cmap"), "UTF-8")), F.lit("000000000000001C"), four(size), table_)
    whole = F.unhex(font)
    return rows.select("doc_id", F.when(F.pmod("doc_id", F.lit(7)) == 3, F.substring(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int"))).otherwise(whole).alias("font"))


@register(QUERIES, ORACLES, r"""with c as (select doc_id, list_sort(list_distinct(regexp_extract_all(coalesce(text, ''), '(?s).'))) as c from documents),
 m as (select doc_id, doc_id % 7 = 3 as broken, list_filter(list_transform(c, lambda x: translate(x, chr(1705) || chr(1740) || chr(65279), chr(1603) || chr(1610))), lambda x: x <> '') as c from c)
 select doc_id, case when broken then null else len(c)::bigint end as glyphs, case when broken then null else array_to_string(c, '') end as characters from m""")
def embedded_fonts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters of all texts' fonts, read from their tables; null where the file is cut."""
    read = written_fonts(spark, sf_dir).select("doc_id", fonts.glyph_map(fonts.font_glyphs("font")).alias("m"))
    return read.select("doc_id", F.when(F.col("m").isNotNull(), F.size("m")).cast("long").alias("glyphs"), F.array_join(F.map_values("m"), "").alias("characters"))
