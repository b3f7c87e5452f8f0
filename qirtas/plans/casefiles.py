"""Queries over bundles: ranges, people, segments, resume, packets, geometry, page lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qirtas.functions import text
from qirtas.operators import casefile, layout, render
from qirtas.sources.pages import page_numbers

from .common import register, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as bundles: a turn is a page, numbered from 1."""
    return table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).cast("int").alias("page"), "role", text.text_of("text").alias("text"))


def ranges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Ranges that user turns open: from their page, of a length that varies, some reversed, their fields made from the
    turn; and the bundles, with their sizes."""
    t = turns(spark, sf_dir)
    size = (F.length("text") % 3).cast("int")
    start, end, page = F.col("page"), F.col("page") + size, F.col("page").cast("string")
    flip = F.length("text") % 5 == 0
    words = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    first = F.regexp_extract("text", "([A-Za-z]+)", 1)
    entries = t.filter("role = 'user'").select(
        "conv_id", F.col("page").alias("ord"), F.when(flip, end).otherwise(start).alias("page_start"), F.when(flip, start).otherwise(end).alias("page_end"), F.concat(F.lit("user "), page).alias("label"),
        F.when(F.col("page") % 2 == 0, "turn").alias("document_type"), F.array_join(F.slice(words, 1, 4), " ").alias("summary"), F.when(F.length("text") % 2 == 1, "read twice").alias("defense_relevance"),
        F.slice(words, 1, 3).alias("topics"), F.when(F.col("page") % 3 == 0, F.array(F.concat(F.lit("check "), page))).alias("ocr_watchlist"),
        F.array(F.struct(F.lit("user").alias("name"), first.alias("role"))).alias("people"), F.array(F.struct(F.lit("").alias("date"), first.alias("event"))).alias("date_events"),
    )
    notes = F.array(F.lit("made from turns"))
    bundles = t.groupBy("conv_id").agg(F.max("page").alias("page_total")).select(
        "conv_id", "page_total", F.concat(F.lit("bundle "), F.col("conv_id").cast("string")).alias("source_pdf"), F.lit("A conversation.").alias("bundle_description"), notes.alias("bundle_notes"), F.array(F.lit("check 3")).alias("global_ocr_watchlist")
    )
    return entries, bundles


T = "t as (select conv_id, (turn + 1)::int as page, role, coalesce(text, '') as text from conversations)"
W = "regexp_extract_all(text, '[A-Za-z]+')"
UNKNOWN = ", ".join("'" + casefile.FILLER[k] + "'" for k in ("label", "document_type", "summary", "defense_relevance")) + f", []::varchar[], ['{casefile.FILLER_WATCH}'], ''"
COVER = f"""{T}, b as (select conv_id, max(page) as total from t group by conv_id), e as (select conv_id, page as s, page + length(text) % 3 as f, page as ord, 'user ' || page::varchar as label, case when page % 2 = 0 then 'turn' else 'unknown' end as kind,
 array_to_string({W}[1:4], ' ') as summary, case when length(text) % 2 = 1 then 'read twice' else '' end as relevance, list_filter({W}[1:3], lambda x, i: list_position({W}[1:3], x) = i) as topics, case when page % 3 = 0 then ['check ' || page::varchar] else [] end as watch, regexp_extract(text, '([A-Za-z]+)', 1) as word from t where role = 'user'),
 c as (select e.*, total, least(s, total) as a, least(f, total) as z from e join b using (conv_id)), r as (select *, coalesce(max(z) over (partition by conv_id order by s, f, ord rows between unbounded preceding and 1 preceding), 0) + 1 as nxt from c),
 k as (select *, greatest(a, nxt) as ps from r where z >= nxt), every as (select conv_id, ps, z as pe, label, kind, summary, relevance, topics, watch, word from k union all select conv_id, nxt, ps - 1, {UNKNOWN} from k where ps > nxt
 union all select b.conv_id, coalesce(m, 0) + 1, total, {UNKNOWN} from b left join (select conv_id, max(z) as m from k group by conv_id) using (conv_id) where coalesce(m, 0) + 1 <= total),
 cover as (select conv_id, row_number() over (partition by conv_id order by ps) as number, 'doc-' || lpad(row_number() over (partition by conv_id order by ps)::varchar, 3, '0') as id, ps::int as page_start, pe::int as page_end, * exclude (conv_id, ps, pe) from every)"""


@register(QUERIES, ORACLES, f"with {COVER} select conv_id, id, label, page_start, page_end, kind as document_type, summary, relevance as defense_relevance, array_to_string(topics, '|') as topics, array_to_string(watch, '|') as ocr_watchlist from cover")
def case_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    cover = casefile.coverage(*ranges(spark, sf_dir), "conv_id")
    return cover.select("conv_id", "id", "label", "page_start", "page_end", "document_type", "summary", "defense_relevance", F.array_join("topics", "|").alias("topics"), F.array_join("ocr_watchlist", "|").alias("ocr_watchlist"))


@register(QUERIES, ORACLES, f"with {COVER} select cover.conv_id, id, t.page, length(t.text)::bigint as chars from cover join t on t.conv_id = cover.conv_id and t.page between page_start and page_end")
def case_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cover = casefile.coverage(*ranges(spark, sf_dir), "conv_id")
    return casefile.pages_of(cover, turns(spark, sf_dir), "conv_id").select("conv_id", "id", "page", F.length("text").cast("long").alias("chars"))


FIRST_WORD = r"regexp_extract(text, '([A-Za-z]+)', 1)"


@register(QUERIES, ORACLES, f"with {T}, m as (select conv_id, role as name, {FIRST_WORD} as r, min(page) as o from t group by 1, 2, 3) select conv_id, name, min(o)::int as first_met, coalesce(string_agg(nullif(r, ''), '|' order by o, r), '') as roles from m group by 1, 2")
def people_and_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers as people; the first word of a turn as a role."""
    t = turns(spark, sf_dir).withColumn("first_word", F.regexp_extract("text", "([A-Za-z]+)", 1))
    return casefile.people_roles(t, "conv_id", "page", "role", "first_word").withColumn("roles", F.array_join("roles", "|"))


@register(QUERIES, ORACLES, f"with {T}, w as (select conv_id, page, unnest(regexp_extract_all(text, '[A-Za-z]+')[1:3]) as value, unnest(range(0, len(regexp_extract_all(text, '[A-Za-z]+')[1:3]))) as pos from t), f as (select conv_id, value, min(page * 10 + pos) as met from w group by 1, 2) select conv_id, value, row_number() over (partition by conv_id order by met)::int as place from f")
def topics_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three words of every turn as its topics."""
    t = turns(spark, sf_dir).withColumn("topics", F.slice(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)), 1, 3))
    return casefile.unique_in_order(t, "conv_id", "page", "topics")


TIDY = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[ \t\x0b\f]+', ' ', 'g'), '[ \t]+\n', chr(10), 'g'), '\n\n\n+', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"
NL = "chr(10) || chr(10)"
FULL = "g.pages >= 2 or g.chars + n.size + 2 > 3000"
SEGMENTS = f"""with recursive {COVER}, x as (select c.conv_id, c.id, t.page, rtrim('### Page ' || t.page::varchar || {NL} || {TIDY}, chr(10)) as body from cover c join t on t.conv_id = c.conv_id and t.page between page_start and page_end),
 n as (select conv_id, id, page, body, length(body) as size, row_number() over (partition by conv_id, id order by page) as i from x),
 g as (select conv_id, id, i, page, 1 as pages, size as chars, 0 as segment from n where i = 1
 union all select n.conv_id, n.id, n.i, n.page, case when {FULL} then 1 else g.pages + 1 end, case when {FULL} then n.size else g.chars + n.size + 2 end, case when {FULL} then g.segment + 1 else g.segment end from g join n on n.conv_id = g.conv_id and n.id = g.id and n.i = g.i + 1)
 select g.conv_id, g.id, segment::bigint as segment, min(g.page)::bigint as page_start, max(g.page)::bigint as page_end, sha256(string_agg(body, {NL} order by g.page)) as text_sha256 from g join n on n.conv_id = g.conv_id and n.id = g.id and n.i = g.i group by g.conv_id, g.id, segment"""


@register(QUERIES, ORACLES, SEGMENTS)
def review_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    cover = casefile.coverage(*ranges(spark, sf_dir), "conv_id")
    own = casefile.pages_of(cover, turns(spark, sf_dir), "conv_id")
    out = casefile.review_segments(own, ["conv_id", "id"], "page", "text")
    return out.select("conv_id", "id", "segment", "page_start", "page_end", F.sha2("raw_text", 256).alias("text_sha256"))


@register(QUERIES, ORACLES, f"with {COVER} select conv_id, id from cover where not exists (select 1 from t where t.conv_id = cover.conv_id and t.page = cover.page_start and t.role = 'user')")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges that a user turn begins count as reviewed already."""
    cover = casefile.coverage(*ranges(spark, sf_dir), "conv_id")
    done = turns(spark, sf_dir).filter("role = 'user'").select("conv_id", F.col("page").alias("page_start"))
    return casefile.pending(cover, done, ["conv_id", "page_start"]).select("conv_id", "id")


@register(QUERIES, ORACLES, f"with {COVER} select conv_id, id from cover where exists (select 1 from t where t.conv_id = cover.conv_id and t.page = cover.page_start and t.role = 'user')")
def resume_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    cover = casefile.coverage(*ranges(spark, sf_dir), "conv_id")
    done = turns(spark, sf_dir).filter("role = 'user'").select("conv_id", F.col("page").alias("page_start"))
    return casefile.finished(cover, done, ["conv_id", "page_start"]).select("conv_id", "id")


def lines_sql(*parts: str) -> str:
    return "concat_ws(chr(10), " + ", ".join(parts) + ")"


def tail(t: str) -> str:
    return rf"regexp_replace({t}, '^\s+|\s+$', '', 'g')"


SPAN = "page_start::varchar || '-' || page_end::varchar"
HEADING = "'## Document ' || lpad(number::varchar, 2, '0') || ' - ' || label"
LOW = "case when label = '" + casefile.FILLER["label"] + "' then 'low' else 'low' end"
PEOPLE_SQL = "case when word <> '' then 'People: user (' || word || ')' when label like 'user %' then 'People: user' end"
PAGES_SQL = f"x as (select conv_id, page, case when {TIDY} = '' then '_No text extracted._' else {TIDY} end as body from t), pg as (select c.conv_id, number, string_agg({lines_sql(chr(39) * 2, chr(39) + '### Page ' + chr(39) + ' || page::varchar', chr(39) * 2, 'body')}, chr(10) order by page) as pages from cover c join x on x.conv_id = c.conv_id and x.page between page_start and page_end group by 1, 2)"
CONTEXT = f"""with {COVER}, {PAGES_SQL}, i as (select conv_id, count(*) as n, string_agg(number::varchar || '. ' || label || ' (pages ' || {SPAN} || '; type: ' || kind || '; confidence: low)' || chr(10) || '   ' || case when summary = '' then 'No summary available.' else summary end, chr(10) order by number) as items from cover group by 1),
 d as (select c.conv_id, string_agg({lines_sql("''", HEADING, "''", f"'Pages: ' || {SPAN}", "'Type: ' || kind", "'Confidence: low'", "'Language: unknown'", "case when summary <> '' then 'Summary: ' || summary end", "case when relevance <> '' then 'Defense relevance: ' || relevance end", "case when len(topics) > 0 then 'Topics: ' || array_to_string(topics, ', ') end", PEOPLE_SQL, "case when len(watch) > 0 then 'OCR watchlist: ' || array_to_string(watch, '; ') end", "pages")}, chr(10) order by number) as docs from cover c join pg using (conv_id, number) group by 1)
 select conv_id, sha256({tail(lines_sql("'# Case File Bundle'", "''", "'Source PDF: bundle ' || conv_id::varchar", "'Total pages: ' || total::varchar", "'Logical documents: ' || n::varchar", "''", "'A conversation.'", "''", "'## Bundle Notes'", "''", "'- made from turns'", "''", "'## Document Inventory'", "''", "items", "docs"))}) as rendered_sha256 from i join d using (conv_id) join b using (conv_id)"""


@register(QUERIES, ORACLES, CONTEXT)
def bundle_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, bundles = ranges(spark, sf_dir)
    cover = casefile.coverage(entries, bundles, "conv_id")
    return render.bundle_context(cover, turns(spark, sf_dir), bundles, "conv_id", "page", "text").select("conv_id", F.sha2("rendered", 256).alias("rendered_sha256"))


def some(title: str, body: str) -> str:
    return f"case when {body} is not null and {body} <> '' then {lines_sql(chr(39) * 2, chr(39) + '## ' + title + chr(39), chr(39) * 2, body)} end"


PACKET = f"""with {COVER}, m as (select conv_id, string_agg({lines_sql(f"'- Pages ' || {SPAN} || ': ' || label || ' [' || kind || ']'", "case when summary <> '' then '  Summary: ' || summary end", "case when relevance <> '' then '  Defense relevance: ' || relevance end")}, chr(10) order by number) as docs, count(*) as n,
 string_agg(case when relevance <> '' then '- Pages ' || {SPAN} || ' (' || label || '): ' || relevance end, chr(10) order by number) as points, string_agg(case when word <> '' then '- Undated: ' || word || ' (Document ' || id || ', pages ' || {SPAN} || ')' end, chr(10) order by number) as events from cover group by 1),
 w as (select conv_id, string_agg('- ' || v, chr(10) order by met) as topics from (select conv_id, v, min(number * 10 + pos) as met from (select conv_id, number, unnest(topics) as v, unnest(range(0, len(topics))) as pos from cover) group by 1, 2) group by 1),
 q as (select conv_id, string_agg('- ' || v, chr(10) order by met) as watch from (select conv_id, v, min(met) as met from (select conv_id, number as met, unnest(watch) as v from cover union all select conv_id, 0, 'check 3' from b) group by 1, 2) group by 1),
 p as (select conv_id, string_agg(nullif(v, ''), ', ' order by met) as roles from (select conv_id, word as v, min(number) as met from cover where label like 'user %' group by 1, 2) group by 1)
 select conv_id, sha256({tail(lines_sql("'# Defense Workbench'", "''", "'" + render.PACKET_INTRO + "'", "''", "'## Bundle Snapshot'", "''", "'- Source PDF: bundle ' || conv_id::varchar", "'- Total pages: ' || total::varchar", "'- Logical documents inferred: ' || n::varchar", "'- Bundle description: A conversation.'", "''", "'## Document Map'", "''", "docs", some("People and Roles", "(case when p.conv_id is not null then '- user' || coalesce(': ' || roles, '') end)"), some("Chronology", "events"), some("Topics", "topics"), "''", "'## Defense-Relevant Review Points'", "''", "points", some("OCR / Verification Watchlist", "watch")))}) as rendered_sha256
 from m join b using (conv_id) left join w using (conv_id) left join q using (conv_id) left join p using (conv_id)"""


@register(QUERIES, ORACLES, PACKET)
def case_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, bundles = ranges(spark, sf_dir)
    return render.case_packet(casefile.coverage(entries, bundles, "conv_id"), bundles, "conv_id").select("conv_id", F.sha2("rendered", 256).alias("rendered_sha256"))


GROUPED = f"""with {COVER}, {PAGES_SQL.replace("_No text extracted._", "(No retained text after local cleanup)")}, d as (select c.conv_id, count(*) as n, string_agg({lines_sql("''", HEADING, "''", f"'Pages: ' || {SPAN}", "'Type: ' || kind", "'Confidence: low'", "'Summary: ' || summary", "'Defense relevance: ' || relevance", "case when len(watch) > 0 then 'OCR watchlist:' || chr(10) || '- ' || array_to_string(watch, chr(10) || '- ') end", "pages")}, chr(10) order by number) as docs from cover c join pg using (conv_id, number) group by 1)
 select conv_id, sha256({tail(lines_sql("'# Grouped Case File Bundle'", "''", "'" + render.GROUPED_INTRO + "'", "''", "'Source PDF: bundle ' || conv_id::varchar", "'Total pages: ' || total::varchar", "'Logical documents: ' || n::varchar", "docs"))}) as rendered_sha256 from d join b using (conv_id)"""


@register(QUERIES, ORACLES, GROUPED)
def bundle_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, bundles = ranges(spark, sf_dir)
    pages = turns(spark, sf_dir).withColumn("text", text.normalise_llm("text"))
    return render.grouped_context(casefile.coverage(entries, bundles, "conv_id"), pages, bundles, "conv_id", "page", "text").select("conv_id", F.sha2("rendered", 256).alias("rendered_sha256"))


INDEX = f"""with {COVER}, d as (select conv_id, count(*) as n, string_agg({lines_sql("''", f"'- Pages ' || {SPAN} || ': ' || label || ' [' || kind || ']'", "'  Summary: ' || summary", "'  Defense relevance: ' || relevance", "case when len(watch) > 0 then '  OCR watchlist:' || chr(10) || '  - ' || array_to_string(watch, chr(10) || '  - ') end")}, chr(10) order by number) as docs from cover group by 1)
 select conv_id, sha256({tail(lines_sql("'# Manual Case Index'", "''", "'" + render.INDEX_INTRO + "'", "''", "'## Bundle Snapshot'", "''", "'- Source PDF: bundle ' || conv_id::varchar", "'- Total pages: ' || total::varchar", "'- Logical documents: ' || n::varchar", "'- Bundle description: A conversation.'", "''", "'## Document Map'", "docs", "''", "'## Bundle Notes'", "''", "'- made from turns'", "''", "'## Global OCR Watchlist'", "''", "'- check 3'"))}) as rendered_sha256 from d join b using (conv_id)"""


@register(QUERIES, ORACLES, INDEX)
def bundle_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, bundles = ranges(spark, sf_dir)
    return render.case_index(casefile.coverage(entries, bundles, "conv_id"), bundles, "conv_id").select("conv_id", F.sha2("rendered", 256).alias("rendered_sha256"))


REVIEWED = f"""with {COVER}, {PAGES_SQL}, d as (select c.conv_id, count(*) as n, string_agg({lines_sql("''", HEADING, "''", f"'Pages: ' || {SPAN}", "'Type: ' || kind", "case when summary <> '' then 'Summary: ' || summary end", "''", tail("pages"))}, chr(10) order by number) as docs,
 string_agg({lines_sql("''", HEADING, "''", "case when len(watch) > 0 then '- ' || array_to_string(watch, chr(10) || '- ') else '" + render.NO_DOUBTS + "' end")}, chr(10) order by number) as notes from cover c join pg using (conv_id, number) group by 1)
 select conv_id, sha256({tail(lines_sql("'# Reviewed Case File Bundle'", "''", "'Source PDF: bundle ' || conv_id::varchar", "'Total pages: ' || total::varchar", "'Logical documents: ' || n::varchar", "''", "'" + render.REVIEWED_INTRO + "'", "docs"))}) as context_sha256, sha256({tail(lines_sql("'# Review Notes'", "''", "'" + render.NOTES_INTRO + "'", "''", "'## Bundle-Level OCR Risks'", "''", "'- check 3'", "notes"))}) as notes_sha256 from d join b using (conv_id)"""


@register(QUERIES, ORACLES, REVIEWED)
def reviewed_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As if the pages came back from review as they are, the watchlist left open."""
    entries, bundles = ranges(spark, sf_dir)
    cover = casefile.coverage(entries, bundles, "conv_id")
    body = text.normalise_llm("text")
    pages = turns(spark, sf_dir).withColumn("b", body).withColumn("b", F.when(F.col("b") == "", render.NO_TEXT).otherwise(F.col("b")))
    part = F.concat(F.lit("### Page "), F.col("page").cast("string"), F.lit("\n\n"), F.col("b"))
    own = casefile.pages_of(cover.select("conv_id", "number", "page_start", "page_end"), pages, "conv_id").groupBy("conv_id", "number").agg(render.ordered(part, F.col("page"), "\n\n").alias("cleaned_text"))
    reviewed = cover.join(own, ["conv_id", "number"]).withColumnRenamed("ocr_watchlist", "uncertainties")
    context = render.reviewed_context(reviewed, bundles, "conv_id").select("conv_id", F.sha2("rendered", 256).alias("context_sha256"))
    return context.join(render.review_notes(reviewed, bundles, "conv_id").select("conv_id", F.sha2("rendered", 256).alias("notes_sha256")), "conv_id")


@register(QUERIES, ORACLES, f"with {T} select conv_id, to_json(struct_pack(source := conv_id, pages := list(struct_pack(page := page, role := role, chars := length(text)) order by page)))::varchar as json from t group by conv_id")
def bundle_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = turns(spark, sf_dir).withColumn("chars", F.length("text"))
    return render.to_pages_json(pages, "conv_id", ("page", "role", "chars"))


MASK = "c as (select doc_id, unnest(range(0, len(ls))) as i, unnest(ls) <> '' as on_ from (select doc_id, string_split(text, chr(10)) as ls from documents))"
ISLANDS = f"""with {MASK}, tot as (select doc_id, max(i) + 1 as total from c group by doc_id), o as (select doc_id, i, i - lag(i) over (partition by doc_id order by i) - 1 as gap from c where on_),
 n as (select *, sum(case when gap > 1 then 1 else 0 end) over (partition by doc_id order by i) as island from o), f as (select doc_id, island, min(i) as s, max(i) + 1 as e from n group by 1, 2)
 select doc_id, s::int as start, (case when total - e <= 1 then total else e end)::int as "end" from f join tot using (doc_id) where (case when total - e <= 1 then total else e end) - s >= 2"""


@register(QUERIES, ORACLES, ISLANDS)
def line_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-empty lines as ink: islands of two lines and more, over gaps of one."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return layout.segments(d, "doc_id", "i", F.col("line") != "", 1, 2)


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as regions of 25 pages, their keys as coordinates."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", ((k * 37) % 700).cast("int").alias("x1"), ((k * 91) % 900).cast("int").alias("y1"), (k % 3).alias("kind"))
    return c.select("c_nationkey", "c_custkey", "x1", "y1", (F.col("x1") + 10 + k % 90).cast("int").alias("x2"), (F.col("y1") + 5 + k % 40).cast("int").alias("y2"), F.when(F.col("kind") == 0, "text").otherwise("heuristic_block").alias("label"))


REGIONS = """with b as (select c_nationkey, c_custkey, ((c_custkey * 37) % 700)::int as x1, ((c_custkey * 91) % 900)::int as y1, 10 + c_custkey % 90 as w, 5 + c_custkey % 40 as h, c_custkey % 3 <> 0 as heuristic from customer),
 k as (select *, heuristic and w * h < 1000 * 800 * 0.008 and (w < 800 * 0.35 or h < 1000 * 0.04) as tiny from b), n as (select *, count(*) over (partition by c_nationkey) as n, sum((not tiny)::int) over (partition by c_nationkey) as kept from k)
 select c_nationkey, c_custkey from n where not tiny or n <= 1 or kept = 0"""


@register(QUERIES, ORACLES, REGIONS)
def kept_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir).withColumn("width", F.lit(800)).withColumn("height", F.lit(1000))
    return layout.kept_regions(b, "c_nationkey", "width", "height").select("c_nationkey", "c_custkey")


@register(QUERIES, ORACLES)
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of at most forty regions."""
    b = boxes(spark, sf_dir).withColumn("sheet", F.floor(F.col("c_custkey") / 40)).withColumn("region", F.col("c_custkey"))
    return layout.right_to_left(b, "sheet").select("sheet", "c_custkey", "reading_order")


VALLEY = """with s as (select o_custkey as page, ((o_orderkey * 131) % 600)::double as x, (o_orderkey % 9 + 1) * 10 as n from orders), c as (select page, least(floor(x / 20)::bigint, 30) as bin, sum(n) as n from s group by 1, 2),
 t as (select page, sum(n) as total from c group by 1 having sum(n) >= 50), p as (select page, total, unnest(range(6, 24)) as split from t),
 q as (select p.page, total, split, coalesce(sum(n) filter (where bin < split), 0) as l, coalesce(sum(n) filter (where bin between split - 1 and split + 1), 0) as v from p join c using (page) group by 1, 2, 3),
 z as (select *, least(l, total - l)::double / greatest(l, total - l) * (1.0 - v::double / total * 5) as score from q where l >= total * 0.15 and total - l >= total * 0.15), r as (select *, row_number() over (partition by page order by score desc, split) as r from z)
 select page, split * 20.0::double as boundary, round(score, 6) as score from r where r = 1 and score >= 0.3"""


@register(QUERIES, ORACLES, VALLEY)
def column_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as the spans of a page."""
    k = F.col("o_orderkey")
    s = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("page"), ((k * 131) % 600).cast("double").alias("x"), ((k % 9 + 1) * 10).alias("n"), F.lit(600.0).alias("width"))
    return layout.column_valley(s, "page", "x", "n", "width")


@register(QUERIES, ORACLES, "select c_custkey, greatest(0, x1 - 12)::int as x1, greatest(0, y1 - 10)::int as y1, least(800, x2 + 12)::int as x2, least(1000, y2 + 10)::int as y2 from (select c_custkey, ((c_custkey * 37) % 700) as x1, ((c_custkey * 91) % 900) as y1, ((c_custkey * 37) % 700) + 10 + c_custkey % 90 as x2, ((c_custkey * 91) % 900) + 5 + c_custkey % 40 as y2 from customer)")
def expanded_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = layout.expanded(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), F.lit(800), F.lit(1000))
    return boxes(spark, sf_dir).select("c_custkey", b.alias("b")).select("c_custkey", "b.x1", "b.y1", "b.x2", "b.y2")


@register(QUERIES, ORACLES, "with v as (select lang, list_sort(list(n_chars) filter (where n_chars > 0)) as v from documents group by lang) select lang, coalesce(v[len(v) // 2 + 1], 14)::double as upper_median from v")
def upper_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumn("n", F.col("n_chars").cast("double"))
    return layout.upper_median(d, ["lang"], "n", 14.0)


@register(QUERIES, ORACLES, """with s as (select page_id, 1 + page_id % 9 as a, 1 + page_id % 7 as b, page_id % 13 as c from pages)
 select page_id, a::varchar || '-' || b::varchar || ', ' || c::varchar as spec, case when b >= a and c >= 1 then array_to_string(list_transform(list_sort(list_distinct(range(a, b + 1) || [c])), lambda x: (x - 1)::varchar), ',') end as pages from s""")
def page_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of pages written from every page's number; descending ones and those with a zero are null."""
    part = lambda n, more=0: (F.pmod("page_id", F.lit(n)) + more).cast("string")
    specs = table(spark, sf_dir, "pages").select("page_id", F.concat(part(9, 1), F.lit("-"), part(7, 1), F.lit(", "), part(13)).alias("spec"))
    return specs.select("page_id", "spec", F.array_join(page_numbers(F.col("spec")), ",").alias("pages"))


@register(QUERIES, ORACLES, "select conv_id, turn, role from (select *, row_number() over (partition by conv_id order by length(coalesce(text, '')) desc, turn) as r from conversations) where r <= 3")
def longest_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "conversations")
    w = Window.partitionBy("conv_id").orderBy(F.length(text.text_of("text")).desc(), "turn")
    return t.withColumn("r", F.row_number().over(w)).filter("r <= 3").select("conv_id", "turn", "role")
