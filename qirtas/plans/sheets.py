"""Queries over pages as sheets and files: geometry, glyphs, rendered texts, checks; made texts stand beside the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.functions import fields, metrics, rulesets
from qirtas.operators import casefile, choose, glyphs, inventory, layout, lines, pixels, render

from .collections import AR, LAT, NUM, SRC, body, full, hits, sub, texts
from .common import count, register, reply, share, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
NL = "chr(10)"
SHOWN = rf"regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g')"


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "conversations")
    return t.select("conv_id", (F.col("turn") + 1).alias("page"), "role", "text")


T = "t as (select conv_id, turn + 1 as page, role, text from conversations)"


@register(QUERIES, ORACLES, f"with {T}, p as (select *, rtrim('===== Page ' || page::varchar || ' =====' || {NL} || {SHOWN}, chr(10)) as part from t) select conv_id, sha256(string_agg(part, {NL} || {NL} order by page) || {NL}) as rendered_sha256 from p group by 1")
def marked_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.marked_pages(turns(spark, sf_dir), "conv_id").select("conv_id", F.sha2("rendered", 256).alias("rendered_sha256"))


@register(QUERIES, ORACLES, f"""with {T}, p as (select conv_id, string_agg('## Page ' || page::varchar || {NL} || {NL} || case when {SHOWN} = '' then '-' else {SHOWN} end || {NL}, {NL} order by page) as parts from t group by 1)
 select conv_id, sha256(regexp_replace('# talk ' || conv_id::varchar || {NL} || {NL} || 'Local only.' || {NL} || {NL} || parts, '\\s+$', '') || {NL}) as rendered_sha256 from p""")
def titled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = turns(spark, sf_dir).select("conv_id", F.concat(F.lit("talk "), F.col("conv_id").cast("string")).alias("title")).distinct()
    return render.titled_markdown(turns(spark, sf_dir), files, "conv_id", "Local only.", empty="-").select("conv_id", F.sha2("rendered", 256).alias("rendered_sha256"))


HEAD = " || chr(10) || ".join(f"'{x}'" for x in render.HEADS["statement"])


@register(QUERIES, ORACLES, f"""with {T}, m as (select *, length(coalesce(text, '')) as chars, {count("coalesce(text, '')", NUM)} as digits from t), p as (select conv_id, count(*) as n, string_agg('===== Page ' || page::varchar || ' (source=' || role || ':plain/psm=None; chars=' || chars::varchar || '; digits=' || digits::varchar || ') =====' || {NL} || case when {SHOWN} = '' then '[NO TEXT EXTRACTED BY LOCAL OCR]' else {SHOWN} end || {NL}, {NL} order by page) as parts from m group by 1)
 select conv_id, sha256(regexp_replace('Source PDF: ' || conv_id::varchar || '.pdf' || {NL} || 'SHA256: ' || sha256(conv_id::varchar) || {NL} || 'Pages: ' || n::varchar || {NL} || {HEAD} || {NL} || {NL} || parts, '\\s+$', '') || {NL}) as rendered_sha256 from p""")
def statement_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = turns(spark, sf_dir).withColumn("s", rulesets.statement_summary(body())).select("conv_id", "page", "text", F.col("role").alias("engine"), F.lit("plain").alias("variant"), F.lit(None).cast("int").alias("psm"), "s.chars", "s.digits")
    name = F.col("conv_id").cast("string")
    files = t.groupBy("conv_id").agg(F.count("*").alias("page_count")).withColumn("name", F.concat(name, F.lit(".pdf"))).withColumn("sha256", F.sha2(name, 256))
    return render.document_with_head(t, files, "conv_id", "statement").select("conv_id", F.sha2("rendered", 256).alias("rendered_sha256"))


@register(QUERIES, ORACLES)
def chat_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = turns(spark, sf_dir).withColumn("s", rulesets.chat_measures(body()))
    pages = t.select("conv_id", "page", "text", F.col("role").alias("engine"), F.lit("plain").alias("variant"), F.lit(6).alias("psm"), F.lit("pass").alias("native_status"), "s.status", "s.chars", "s.arabic_chars")
    name = F.col("conv_id").cast("string")
    files = pages.groupBy("conv_id").agg(F.count("*").alias("page_count"), F.sum("chars").alias("embedded_chars")).withColumns({"name": F.concat(name, F.lit(".pdf")), "title": name, "sha256": F.sha2(name, 256), "embedded_pages": F.col("page_count"), "duplicate_of": F.lit(None).cast("string")})
    return render.chat_markdown(pages, files, "conv_id").select("conv_id", F.sha2("rendered", 256).alias("rendered_sha256"))


@register(QUERIES, ORACLES)
def chat_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = turns(spark, sf_dir).withColumn("m", rulesets.chat_measures(body())).select("conv_id", "page", F.col("role").alias("source"), F.lit("tesseract").alias("engine"), "m")
    r = inventory.run_summary(t, ["conv_id"])
    return r.select("conv_id", "pages", "total_chars", "total_arabic_chars", "total_noise_markers", F.to_json("chosen_sources").alias("sources"), F.to_json("chosen_statuses").alias("statuses"), F.array_join("weak_pages", ",").alias("weak_pages"), F.size("ocr_pages").cast("long").alias("ocr_pages"))


@register(QUERIES, ORACLES, rf"with {T}, l as (select conv_id, page, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') as ls from t) select conv_id, array_to_string(arg_min(ls, page)[1:3], '|') as first from l where len(ls) > 0 group by 1")
def first_readable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.first_lines(turns(spark, sf_dir), "conv_id").select("conv_id", F.array_join("lines", "|").alias("first"))


MOJI = "[ØÙ" + chr(0xFFFD) + "]"


@register(QUERIES, ORACLES, f"with {SRC} select doc_id, length(text)::bigint as chars, {count('text', AR)}::bigint as arabic_chars, {count('text', NUM)}::bigint as digit_chars, {count('text', '[A-Za-z0-9' + AR[1:-1] + ']+')}::bigint as tokens, {count('text', MOJI)}::bigint as mojibake_markers, {full('text')}::bigint as lines from src")
def summary_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", rulesets.disclosure_summary(body()).alias("s")).select("doc_id", "s.*")


@register(QUERIES, ORACLES, f"with {SRC} select doc_id, length(text)::bigint as chars, {count('text', chr(92) + 'p{L}')}::bigint as letters, {count('text', NUM)}::bigint as digits, {count('text', '[A-Za-z0-9][A-Za-z0-9,()./%:-]*')}::bigint as tokens, {full('text')}::bigint as lines, {count('text', MOJI)}::bigint as mojibake_markers from src")
def summary_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", rulesets.statement_summary(body()).alias("s")).select("doc_id", "s.*")


CTRL = "[" + r"\x00-\x08\x0b\x0c\x0e-\x1f\x{7f}-\x{9f}" + "]"


@register(QUERIES, ORACLES, f"with {SRC}, p as (select doc_id, '===== Page 1 =====' || chr(10) || text as text from src) select doc_id, length(text)::bigint as final_chars, {count('text', AR)}::bigint as arabic_chars, {count('text', LAT)}::bigint as latin_letters, {count('text', chr(0xFFFD))}::bigint as replacement_chars, {count('text', MOJI)}::bigint as mojibake_chars, {count('text', CTRL)}::bigint as control_chars, {hits('text', ['[لم يتم استخراج'])}::bigint as empty_markers, {count('text', '(?m)^===== Page ')}::bigint as page_markers from p")
def checked_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = texts(spark, sf_dir).withColumn("text", F.concat(F.lit("===== Page 1 =====\n"), F.col("text")))
    return t.select("doc_id", rulesets.output_checks(body()).alias("s")).select("doc_id", "s.*").drop("empty")


REPLIES = ("real line\nNo visible text detected.\nThe image appears blank or too faint to read.", "Scanned with X\nkept", "لا يوجد نص ظاهر في هذه الصورة.\nنص", "there is no text in the provided image. Sorry")
MADE = "src as (select doc_id::bigint as doc_id, text from documents union all select * from (values " + ", ".join(f"({-100 - i}, '{t}')" for i, t in enumerate(REPLIES)) + ") v(doc_id, text))"


@register(QUERIES, ORACLES, f"with {MADE}, l as (select doc_id, unnest(range(0, len(ls))) as line_index, unnest(ls) as line from (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') as ls from src)) select doc_id, line_index, line from l where {reply('line')}")
def reply_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model replies in all documents and in made texts that hold some."""
    made = spark.createDataFrame([(-100 - i, t) for i, t in enumerate(REPLIES)], "doc_id long, text string")
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text").unionByName(made)
    return lines.line_table(rows, ["doc_id"]).filter(metrics.no_text_reply(F.col("line"))).select("doc_id", "line_index", "line")


USUAL, EVERY = r"[\x{0621}-\x{064a}\x{060c}\x{061b}\x{061f}\x{066a}-\x{066c}\x{0660}-\x{0669}]", r"[\x{0600}-\x{06ff}\x{0750}-\x{077f}\x{08a0}-\x{08ff}\x{fb50}-\x{feff}]"
RUNS = "|".join(c + "{3,}" for c in map(chr, range(0x621, 0x64B)))


@register(QUERIES, ORACLES, f"with {SRC} select doc_id, round({share(count('text', EVERY) + ' - ' + count('text', USUAL), count('text', EVERY))}, 6) as suspicious_ratio, round({share('length(array_to_string(regexp_extract_all(text, ' + chr(39) + RUNS + chr(39) + '), ' + chr(39) * 2 + '))', count('text', EVERY))}, 6) as run_ratio from src")
def arabic_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", F.round(metrics.suspicious_ratio(body()), 6).alias("suspicious_ratio"), F.round(metrics.repeated_run_ratio(body()), 6).alias("run_ratio"))


LAWS = ("وفقا للمادة 12 والمادة 7 من القانون و مادة  5", "المادة ١٢ ثم المادةرقم")


@register(QUERIES, ORACLES, "with src as (select doc_id::bigint as doc_id, text from documents union all select * from (values " + ", ".join(f"({-200 - i}, '{t}')" for i, t in enumerate(LAWS)) + r") v(doc_id, text)) select doc_id, array_to_string(regexp_extract_all(text, '(المادة|مادة)\s+\p{Nd}+', 1), '|') as articles from src")
def article_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = spark.createDataFrame([(-200 - i, t) for i, t in enumerate(LAWS)], "doc_id long, text string")
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text").unionByName(made)
    return rows.select("doc_id", F.array_join(fields.articles(body()), "|").alias("articles"))


ARTICLES = "a as (select conv_id as d, turn as page, case when turn % 3 = 0 then 'مادة ( ' || turn::varchar || ' )' when turn % 5 = 1 then 'المادة ال' else 'نص ' || role end as line from conversations)"


@register(QUERIES, ORACLES, f"with {ARTICLES}, n as (select *, turn_on, case when turn_on then sum(turn_on::int) over (partition by d order by page) end as number from (select *, page >= 2 and line like 'مادة (%' as turn_on from a)) select d, page, number::bigint as number, case when number is null then line else 'مادة (' || translate(number::varchar, '0123456789', '٠١٢٣٤٥٦٧٨٩') || ')' end as line from n")
def renumbered_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as lines of a law, every third one the heading of an article."""
    turn = F.col("turn")
    made = F.when(turn % 3 == 0, F.concat(F.lit("مادة ( "), turn.cast("string"), F.lit(" )"))).when(turn % 5 == 1, F.lit("المادة ال")).otherwise(F.concat(F.lit("نص "), F.col("role")))
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("d"), turn.alias("page"), F.lit(0).alias("line_index"), made.alias("line"))
    return lines.renumbered(rows, "d", 2).select("d", "page", "number", "line")


@register(QUERIES, ORACLES, "select c_custkey, i::int as line_index, floor(y1 + i * (h::double / n))::int as line_y1, greatest(floor(y1 + (i + 1) * (h::double / n))::int, floor(y1 + i * (h::double / n))::int + 1) as line_y2 from (select c_custkey, (c_custkey * 91) % 900 as y1, 5 + c_custkey % 40 as h, 1 + c_custkey % 7 as n, unnest(range(0, 1 + c_custkey % 7)) as i from customer)")
def line_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", ((k * 91) % 900).cast("int").alias("y1"), (1 + k % 7).cast("int").alias("n_lines"), (5 + k % 40).cast("int").alias("h"))
    rows = rows.withColumn("y2", F.col("y1") + F.col("h")).withColumn("line_index", F.explode(F.sequence(F.lit(0), F.col("n_lines") - 1)))
    return layout.line_boxes(rows).select("c_custkey", "line_index", "line_y1", "line_y2")


@register(QUERIES, ORACLES, """select o_orderkey, not (h < 1800 and w * h < 5000000) and (trig in ('sparse_large_crop', 'under_read_large_crop') or (trig = 'empty' and h >= 2200) or (trig = 'low_quality' and w * h >= 5000000 and n < 120) or (w * h >= 8000000 and l < 8)) as chunked
 from (select o_orderkey, (o_orderkey * 37) % 4000 as w, (o_orderkey * 53) % 3500 as h, o_orderkey % 200 as n, o_orderkey % 20 as l, ['sparse_large_crop', 'empty', 'low_quality', 'none'][1 + o_orderkey % 4] as trig from orders)""")
def chunk_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    trigger = F.element_at(F.array(*[F.lit(x) for x in ("sparse_large_crop", "empty", "low_quality", "none")]), (k % 4 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", pixels.worth_chunking((k * 37) % 4000, (k * 53) % 3500, k % 200, k % 20, trigger).alias("chunked"))


@register(QUERIES, ORACLES, "select o_orderkey, round(sqrt((o_orderkey % 9) * (o_orderkey % 9) + 4.0::double), 6) as scale, ((o_orderkey % 500) + 0.5)::double as x, (-1 - (o_orderkey % 700))::double as y from orders")
def text_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    s = lambda c: c.cast("string")
    m = glyphs.text_matrix(F.concat_ws(" ", s(k % 9), F.lit("0"), F.lit("2"), F.lit("1"), F.concat(s(k % 500), F.lit(".5")), F.concat(F.lit("-"), s(k % 700 + 1)), F.lit("Tm")))
    return table(spark, sf_dir, "orders").select("o_orderkey", m.alias("m")).select("o_orderkey", F.round("m.scale", 6).alias("scale"), "m.x", "m.y")


@register(QUERIES, ORACLES, "select p_partkey, array_to_string(list_filter(list_transform(range(0, length(p_name)), lambda i: case when ascii(p_name[i + 1]) between 97 and 109 then upper(p_name[i + 1]) else '' end), lambda x: x <> ''), '') as decoded from part")
def decoded_glyphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as runs of glyphs; the font knows the first half of the alphabet, in capitals."""
    entries = F.create_map(*[x for i in range(97, 110) for x in (F.lit(i), F.lit(chr(i - 32)))])
    codes = F.hex(F.encode("p_name", "UTF-16BE"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(glyphs.glyph_units(codes, entries), "").alias("decoded"))


@register(QUERIES, ORACLES)
def span_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as the spans of a page, as lines and then as one text."""
    k = F.col("o_orderkey")
    spans = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("page"), ((k * 37) % 500).cast("double").alias("x"), ((k * 53) % 70).cast("double").alias("y"), k.cast("string").alias("text"), (k % 3 == 0).alias("rtl"))
    return glyphs.page_text(glyphs.line_table(spans, ["page"]), ["page"])


@register(QUERIES, ORACLES, "with f as (select doc_id, sha256(text) as sha256, row_number() over (order by lower(doc_id::varchar)) as r from documents), g as (select *, min(r) over (partition by sha256) as g from f), u as (select *, dense_rank() over (order by g) as d from g) select doc_id, r <= 20 as among_files, d <= 20 as among_contents from u where r <= 20 or d <= 20")
def limited_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty files by name, and those of the first twenty contents."""
    files = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("name"), F.sha2("text", 256).alias("sha256"))
    a = inventory.limited(files, 20).select("doc_id", F.lit(True).alias("a"))
    b = inventory.limited(files, 20, unique=True).select("doc_id", F.lit(True).alias("b"))
    return a.join(b, "doc_id", "full").select("doc_id", F.coalesce("a", F.lit(False)).alias("among_files"), F.coalesce("b", F.lit(False)).alias("among_contents"))


@register(QUERIES, ORACLES, "select r_regionkey, r_name from region where r_regionkey = 2")
def only_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.exactly_one(table(spark, sf_dir, "region").filter("r_regionkey = 2").select("r_regionkey", "r_name"), "region")


@register(QUERIES, ORACLES, "select doc_id, coalesce(nullif(trim(source), ''), doc_id::varchar || ':' || n_chars::varchar || ':' || coalesce(lang, '') || ':x') as review_key, case when n_chars % 2 = 0 then 'Page ' || doc_id::varchar else 'Pages ' || doc_id::varchar || '-' || (doc_id + 1)::varchar end || ': check' as doubt from documents")
def review_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.col("doc_id") + F.when(F.col("n_chars") % 2 == 0, 0).otherwise(1)
    doubt = casefile.qualified(F.array(F.lit("check")), F.col("doc_id"), end)[0]
    return table(spark, sf_dir, "documents").select("doc_id", casefile.review_key(F.col("source"), F.col("doc_id"), F.col("n_chars"), F.col("lang"), F.lit("x")).alias("review_key"), doubt.alias("doubt"))


@register(QUERIES, ORACLES, f"with {SRC}, w as (select doc_id, text as t, {count('text', AR)} > 0 as arabic from src) select doc_id, {sub('t', '^' + chr(92) + 's+|' + chr(92) + 's+$')} <> '' and doc_id % 2 = 0 as compared from w")
def compared_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", choose.worth_comparing(body(), F.col("doc_id") % 2 == 0).alias("compared"))


def sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grey page a part: bars of ink whose place and height follow from its key."""
    k = F.col("p_partkey")
    row = lambda ink: F.when(ink, F.repeat(F.lit("00"), 120)).otherwise(F.repeat(F.lit("FF"), 120))
    bars = F.transform(F.sequence(F.lit(0), F.lit(199)), lambda y: row(((y >= 20) & (y < 60 + k % 20)) | ((y >= 110) & (y < 150))))
    return table(spark, sf_dir, "part").select("p_partkey", F.lit(120).alias("width"), F.lit(200).alias("height"), F.unhex(F.array_join(bars, "")).alias("grey"))


@register(QUERIES, ORACLES, "select p_partkey, 0 as region, 0 as x1, 10 as y1, 120 as x2, (70 + p_partkey % 20)::int as y2 from part union all select p_partkey, 1, 0, 100, 120, 160 from part")
def ink_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.regions(sheets(spark, sf_dir), "p_partkey").select("p_partkey", "region", "x1", "y1", "x2", "y2")


@register(QUERIES, ORACLES, "select p_partkey, '20-' || (60 + p_partkey % 20)::varchar || '|110-150' as ranges, round((80 + p_partkey % 20) / 200.0::double, 6) as dark from part")
def ink_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sheets(spark, sf_dir).select("p_partkey", pixels.line_ranges("width", "height", "grey").alias("r"), pixels.not_white_share("width", "height", "grey").alias("d"))
    shown = F.array_join(F.transform("r", lambda x: F.concat(x["start"].cast("string"), F.lit("-"), x["end"].cast("string"))), "|")
    return s.select("p_partkey", shown.alias("ranges"), F.round("d", 6).alias("dark"))
