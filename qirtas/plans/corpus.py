"""Queries over candidates, documents and the corpus: choice, merging, inventory, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qirtas.functions import fields, metrics, rulesets, text
from qirtas.operators import choose, evaluate, inventory, lines, render

from .common import register, reply, share, strip, table, tok
from .measures import body, docs

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four readings of every text: whole, first half, lower case, empty; scored by their token count."""
    d = docs(spark, sf_dir)
    half = body().substr(F.lit(1), F.floor(F.length("text") / 2).cast("int"))
    readings = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(n).alias("variant"), c.alias("reading")) for i, (n, c) in enumerate([("empty", F.lit("")), ("half", half), ("raw", body()), ("lower", F.lower(body()))])])
    rows = d.select("doc_id", F.explode(readings).alias("v")).select("doc_id", "v.ord", "v.variant", F.col("v.reading").alias("text"))
    return rows.withColumn("score", F.size(text.tokens(body())).cast("double"))


VARIANTS = f"""v as (select doc_id, unnest([0, 1, 2, 3]) as ord, unnest(['empty', 'half', 'raw', 'lower']) as variant, unnest(['', text[1:length(text) // 2], text, lower(text)]) as reading from documents),
 r as (select *, len({tok('reading')})::double as score, row_number() over (partition by doc_id order by ({strip('reading')} <> '')::int desc, len({tok('reading')}) desc, ord) as rank from v)"""


@register(QUERIES, ORACLES, f"with {VARIANTS} select doc_id, variant, score from r where rank = 1")
def candidate_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return choose.best(variants(spark, sf_dir), ["doc_id"]).select("doc_id", "variant", "score")


@register(QUERIES, ORACLES, f"with {VARIANTS} select doc_id, variant, score, rank::int as rank from r where rank <= 3")
def candidate_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return choose.top(variants(spark, sf_dir), ["doc_id"], 3).select("doc_id", "variant", "score", "rank")


@register(QUERIES, ORACLES, f"with {VARIANTS}, t as (select doc_id, variant, regexp_extract_all(lower(reading), '[0-9A-Za-z]+') as w from v), u as (select doc_id, variant, list_distinct(w) as d, list_sort(list_distinct(w)) as s, w from t) select a.doc_id, a.variant as config, b.variant as other, len(a.w)::bigint as left_tokens, len(b.w)::bigint as right_tokens from u a join u b on a.doc_id = b.doc_id and a.variant < b.variant")
def variant_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every two readings of one text, by name, with their token counts."""
    rows = variants(spark, sf_dir).select("doc_id", F.col("variant").alias("config"), F.size(metrics.overlap_tokens(body())).cast("long").alias("left_tokens"))
    other = rows.select("doc_id", F.col("config").alias("other"), F.col("left_tokens").alias("right_tokens"))
    return rows.join(other, "doc_id").filter("config < other").select("doc_id", "config", "other", "left_tokens", "right_tokens")


@register(QUERIES, ORACLES)
def variant_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token overlap both ways of every two readings of one text, over whole texts; no SQL, a test has it by brute force."""
    return evaluate.pairwise_overlap(variants(spark, sf_dir), "doc_id", "variant", "text")


FOLD = f"""with {VARIANTS} select doc_id, arg_max(variant, ord) filter (where won) as variant from (select a.*, case when a.ord = 0 then true when a.ord = 1 then a.score > 0.2 when a.ord = 2 then a.score > b1.score + 0.2 or (a.score > b1.score + 0.05 and false) else
 false end as won from r a left join r b1 on a.doc_id = b1.doc_id and b1.ord = 1) group by doc_id"""


@register(QUERIES, ORACLES, FOLD)
def rescue_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as retries in order: each must beat the best so far."""
    rows = variants(spark, sf_dir).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("ord", "variant", "score"))).alias("t"))
    tries = F.transform("t", lambda x: F.struct(x["variant"].alias("variant"), x["score"].alias("score"), x["score"].cast("long").alias("n")))
    return rows.select("doc_id", choose.rescued(tries[0], F.slice(tries, 2, 3))["variant"].alias("variant"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


@register(QUERIES, ORACLES, f"select conv_id, (bool_and({strip('text')} = '') or bool_or({strip('text')} = '' or len({tok('text')}) < 5)) as needs_ocr, count(*)::bigint as pages, sum(({strip('text')} = '')::int)::bigint as empty_pages from (select conv_id, coalesce(text, '') as text from conversations) group by conv_id")
def needs_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    few = F.size(text.tokens(text.text_of("text"))) < 5
    return choose.documents_needing_ocr(turns(spark, sf_dir), "conv_id", "text", few)


def score_sql(t: str) -> str:
    """The quality score of a text on one line of ASCII without long runs."""
    n, w = f"len({tok(t)})", tok(t)
    one, frag = f"len(list_filter({w}, lambda x: length(x) = 1))", f"len(list_filter({w}, lambda x: length(x) <= 2 and regexp_matches(x, '[0-9]')))"
    cases, dates = r"\b\d[\d/\-]{2,}\b", r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b"
    return (
        f"(case when {t} = '' or {reply(t)} then -1.0 else least({n}, 120) / 120.0::double * 1.2 + 1 / 12.0::double * 0.25 + least(len(regexp_extract_all({t}, '[A-Za-z0-9]'))::double / greatest(length({t}), 1), 1.0) * 0.45"
        f" + ((len(regexp_extract_all({t}, '{cases}')) > 0)::int + (len(regexp_extract_all({t}, '{dates}')) > 0)::int) * 0.12 - {share(one, n)} * 1.6 - {share(frag, n)} * 1.3 - (case when {n} >= 20 then 0.2 else 0.0 end) end)"
    )


MERGE = f"""with n as (select conv_id, turn, regexp_replace(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'), '^ | $', '', 'g') as t from conversations), p as (select a.conv_id, a.turn, a.t as a, b.t as b from n a join n b on a.conv_id = b.conv_id and b.turn = a.turn + 1 where not regexp_matches(a.t || b.t, '[^\\x00-\\x7F]|(!|-|\\.|_|=|\\*|#){{5}}')),
 q as (select *, {score_sql('a')} as qa, {score_sql('b')} as qb, length(a)::double / greatest(length(b), 1) as ratio from p)
 select conv_id, turn, case when a <> '' and b <> '' and (ratio > 1.3 or ratio < 0.7) then case when qa > qb + 0.2 then 'primary_quality' when qb > qa + 0.2 then 'secondary_quality' when length(a) <= length(b) then 'primary_shorter' else 'secondary_shorter' end
 when a = '' and b <> '' then 'secondary_only' when a <> '' and b = '' then 'primary_only' when a = '' and b = '' then 'neither' else 'verify' end as rule from q"""


def turn_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn against the next as primary and secondary reading: the normal forms ``a`` and ``b``, and the rule."""
    following = Window.partitionBy("conv_id").orderBy("turn")
    t = turns(spark, sf_dir).select("conv_id", "turn", choose.normal_output(body()).alias("a"))
    t = t.withColumn("b", F.lead("a").over(following)).withColumn("next_turn", F.lead("turn").over(following)).filter("next_turn = turn + 1")
    return t.select("conv_id", "turn", "a", "b", choose.decided(F.col("a"), F.col("b")).alias("rule"))


@register(QUERIES, ORACLES)
def merge_rules_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule of every pair; no SQL, a test has it by brute force."""
    return turn_rules(spark, sf_dir).select("conv_id", "turn", "rule")


@register(QUERIES, ORACLES, MERGE)
def merge_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of ``merge_rules_whole`` that its SQL can follow: ASCII pairs without long runs, where both engines count alike."""
    plain = ~F.concat("a", "b").rlike(r"[^\x00-\x7F]|(!|-|\.|_|=|\*|#){5}")
    return turn_rules(spark, sf_dir).filter(plain).select("conv_id", "turn", "rule")


@register(QUERIES, ORACLES)
def merged_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = turns(spark, sf_dir).withColumn("following", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn")))
    return choose.merge_pairs(t, "text", "following").select("conv_id", "turn", "rule", F.round("confidence", 6).alias("confidence"), F.length("merged_text").cast("long").alias("chars"))


@register(QUERIES, ORACLES)
def stitched_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of a conversation as chunks that may overlap."""
    whole = choose.stitched_chunks(turns(spark, sf_dir), ["conv_id"], "turn", "text")
    return whole.select("conv_id", F.size(text.lines(F.col("text"))).cast("long").alias("lines"), F.sha2("text", 256).alias("text_sha256"))


TIDY_ONE = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '[ \t\x0b\f]+', ' ', 'g'), '[ \t]+\n', chr(10), 'g'), '\n\n\n+', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"
PART = lambda head, gap: rf"regexp_replace({head} || {gap} || {TIDY_ONE}, '^\s+|\s+$', '', 'g')"


@register(QUERIES, ORACLES, f"""select conv_id, sha256(string_agg({PART("'## Page ' || (turn + 1)::varchar", "chr(10) || chr(10)")}, chr(10) || chr(10) order by turn)) as rendered_sha256 from conversations group by conv_id""")
def bundle_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.document_text(turns(spark, sf_dir), "conv_id", "turn", "text", style="markdown").select("conv_id", F.sha2("rendered", 256).alias("rendered_sha256"))


@register(QUERIES, ORACLES, f"""select conv_id, sha256(string_agg({PART("'=== Page ' || (turn + 1)::varchar || ' ==='", "chr(10)")}, chr(10) || chr(10) order by turn)) as rendered_sha256 from conversations group by conv_id""")
def bundle_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.document_text(turns(spark, sf_dir), "conv_id", "turn", "text").select("conv_id", F.sha2("rendered", 256).alias("rendered_sha256"))


@register(QUERIES, ORACLES, f"select conv_id, sha256(coalesce(string_agg(nullif({strip('coalesce(text, ' + repr('') + ')')}, ''), chr(10) || chr(10) order by turn), '')) as text_sha256 from conversations group by conv_id")
def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.page_text(turns(spark, sf_dir), ["conv_id"], "turn", "text").select("conv_id", F.sha2("text", 256).alias("text_sha256"))


@register(QUERIES, ORACLES, "select source, round(coalesce(avg(quality), 0.0), 6) as confidence from documents left join labels using (doc_id) group by source")
def source_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as block confidences; documents without one don't count."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return render.page_confidence(rows, ["source"], "quality").select("source", F.round("confidence", 6).alias("confidence"))


HASHED = "h as (select doc_id, sha256(text) as sha256, text from documents), f as (select *, min((doc_id::varchar)) over (partition by sha256) as first from h)"


@register(QUERIES, ORACLES, f"with {HASHED} select doc_id, sha256, case when first <> doc_id::varchar then first end as duplicate_of from f")
def duplicate_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = docs(spark, sf_dir).withColumn("name", F.col("doc_id").cast("string"))
    return inventory.with_duplicates(d, "name", "text").select("doc_id", "sha256", "duplicate_of")


@register(QUERIES, ORACLES, "select coalesce(sum(n - 1), 0)::bigint as duplicates, count(*)::bigint as distinct_files from (select count(*) as n from documents group by sha256(text))")
def duplicate_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.duplicate_count(docs(spark, sf_dir).select(F.sha2("text", 256).alias("sha256")))


TOTALS = f"select source, count(*)::bigint as pages, sum(length(text))::bigint as chars, sum(({strip('text')} <> '')::int)::bigint as text_pages, array_to_string(list_sort(coalesce(list(doc_id) filter (where length(text) < 300), [])), ',') as weak_pages from documents group by source"


@register(QUERIES, ORACLES, TOTALS)
def source_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", "doc_id", "text")
    return inventory.document_totals(d, ["source"], "text", F.length("text") < 300, page="doc_id").withColumn("weak_pages", F.array_join("weak_pages", ","))


@register(QUERIES, ORACLES, f"with t as ({TOTALS}) select count(*)::bigint as documents, sum(pages)::bigint as pages, sum(chars)::bigint as chars, sum((weak_pages <> '' or chars < greatest(80, 40 * pages))::int)::bigint as weak_documents from t")
def corpus_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = inventory.document_totals(table(spark, sf_dir, "documents").select("source", "doc_id", "text"), ["source"], "text", F.length("text") < 300, page="doc_id")
    weak = inventory.is_weak_document(F.col("chars"), F.col("pages"), F.col("weak_pages"))
    return t.agg(F.count("*").alias("documents"), F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), F.sum(weak.cast("long")).alias("weak_documents"))


@register(QUERIES, ORACLES, "select lang, min(length(text))::bigint as shortest, median(length(text))::double as middle, max(length(text))::bigint as longest from documents group by lang")
def length_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("text").cast("long")
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.min(n).alias("shortest"), F.median(n).alias("middle"), F.max(n).alias("longest"))


@register(QUERIES, ORACLES, "select role, count(*)::bigint as turns, sum((len(regexp_extract_all(text, '[\\d.,/:-]+'))))::bigint as numbers from conversations group by role")
def number_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).groupBy("role").agg(F.count("*").alias("turns"), F.sum(F.size(fields.numbers(body())).cast("long")).alias("numbers"))


@register(QUERIES, ORACLES, "select event_type, time_bucket(interval '5 minutes', ts) as window_start, count(*)::bigint as n from events group by 1, 2")
def progress_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from qirtas.streaming.landing import event_counts

    return event_counts(table(spark, sf_dir, "events").select("ts", "event_type")).select("event_type", "window_start", "n")


ARTIFACT_LINES = ("No text is visible in the provided image.", "(No visible text to extract)", "No visible printed or handwritten text to extract from the provided image.", "There is no visible or legible text in the provided image.", "[The image contains no visible text.]", "(empty image, no text visible)", "Scanned with CamScanner")
ARTIFACT_SQL = f"""a as (select {list(ARTIFACT_LINES)} as ls, {[label for label, _ in lines.ARTIFACTS]} as labels), r as (select conv_id, turn, case when turn % 3 = 0 then turn % 7 end as i, text from conversations)"""


def artifact_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as pages; every third one ends with one of the lines."""
    line = F.element_at(F.array(*[F.lit(x) for x in ARTIFACT_LINES]), (F.col("turn") % 7 + 1).cast("int"))
    t = turns(spark, sf_dir).withColumn("turn", F.col("turn").cast("long"))
    return t.withColumn("text", F.when(F.col("turn") % 3 == 0, F.concat(text.text_of("text"), F.lit("\n  "), line, F.lit(" "))).otherwise(F.col("text")))


@register(QUERIES, ORACLES, f"with {ARTIFACT_SQL}, c as (select conv_id, labels[i + 1] as label, count(*) as removed, array_to_string(list_sort(list(distinct turn)), ',') as pages from r, a where i is not null group by 1, 2), l as (select unnest(labels) as label from a) select conv_id, label, coalesce(removed, 0)::bigint as removed, coalesce(pages, '') as pages from (select distinct conv_id from conversations) cross join l left join c using (conv_id, label)")
def artifact_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.artifact_counts(artifact_pages(spark, sf_dir), "turn", "text", ["conv_id"])
    return found.select("conv_id", "label", "removed", F.array_join("pages", ",").alias("pages"))


@register(QUERIES, ORACLES, f"with {ARTIFACT_SQL}, c as (select conv_id, labels[i + 1] as label, i, count(*) as removed, array_to_string(list_sort(list(distinct turn)), ', ') as pages from r, a where i is not null group by 1, 2, 3), l as (select unnest(labels) as label, unnest(range(0, len(labels))) as ord from a), k as (select distinct conv_id, 1 as n from conversations), o as (select k.conv_id, string_agg('- `' || label || '`: ' || coalesce(removed, 0)::varchar || case when pages is null then '' else ' (pages: ' || pages || ')' end, chr(10) order by ord) as items from k cross join l left join c using (conv_id, label) group by 1), t as (select conv_id, count(*) as n from conversations group by 1) select conv_id, sha256('# Local Cleanup Report' || chr(10) || chr(10) || 'Source OCR directory: out' || chr(10) || 'Source PDF: bundle' || chr(10) || 'Total pages: ' || n::varchar || chr(10) || 'Pages with no retained text after cleanup: 0' || chr(10) || chr(10) || '## Removed Artifact Counts' || chr(10) || chr(10) || items) as rendered_sha256 from o join t using (conv_id)")
def cleanup_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.artifact_counts(artifact_pages(spark, sf_dir), "turn", "text", ["conv_id"])
    own = turns(spark, sf_dir).groupBy("conv_id").agg(F.count("*").alias("page_total")).withColumns({"source_dir": F.lit("out"), "source_pdf": F.lit("bundle"), "empty_pages": F.array().cast("array<long>")})
    return render.cleanup_report(found, own, "conv_id").select("conv_id", F.sha2("rendered", 256).alias("rendered_sha256"))


@register(QUERIES, ORACLES, r"""with u as (select page_id, regexp_replace(url, '^[^:]+://', '') as bare, page_id::varchar || '.pdf' as f from pages), v as (select page_id, regexp_replace(bare, '[^A-Za-z0-9]+', ' ', 'g') || '.pdf' as name from u), w as (select page_id, name, name[1:-5] as st from v)
 select page_id, case when regexp_matches(name, '^[0-9]{8}') then name[1:8] else regexp_replace(regexp_replace(st, '[^A-Za-z0-9_.-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g') end as dated, regexp_replace(st, '^[ .]+|[ .]+$', '', 'g') as plain from w""")
def url_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses as names of files."""
    name = F.concat(F.regexp_replace(F.regexp_replace("url", "^[^:]+://", ""), "[^A-Za-z0-9]+", " "), F.lit(".pdf"))
    return table(spark, sf_dir, "pages").select("page_id", rulesets.dated_stem(name).alias("dated"), rulesets.plain_stem(name).alias("plain"))


@register(QUERIES, ORACLES)
def adjudicated_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn as a native page against the next as its recognised text."""
    t = turns(spark, sf_dir).withColumn("following", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn")))
    d = choose.adjudicated(t, "text", "following")
    return d.select("conv_id", "turn", "decision.source", F.round("decision.confidence", 6).alias("confidence"), "decision.digit_agreement", F.round("decision.similarity", 6).alias("similarity"))



@register(QUERIES, ORACLES, r"""with s as (select doc_id, text, case when strpos(text, 'the ') > 0 then strpos(text, 'the ') end as a, case when strpos(text, 'The ') > 0 then strpos(text, 'The ') end as b from documents), f as (select *, least(coalesce(a, b), coalesce(b, a)) as pos from s),
 c as (select doc_id, case when pos > 1 then text[pos:] else text end as t, case when pos > 1 then 'trimmed_before_start_pattern:' || case when pos = coalesce(a, -1) then 'the ' else 'The ' end end as n1 from f),
 e as (select *, strpos(t, 'zzz') as z, strpos(t, '. ') as p from c) select doc_id, sha256(regexp_replace(case when z > 0 then t[1:z - 1] when p > 0 then t[1:p - 1] else t end, '^\s+|\s+$', '', 'g')) as text_sha256, concat_ws('|', n1, case when z > 0 then 'trimmed_after_end_pattern:zzz' when p > 0 then 'trimmed_after_end_pattern:\. ' end) as notes from e""")
def cut_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = docs(spark, sf_dir).select("doc_id", lines.cut_to_document(body(), ["the ", "The "], ["zzz", r"\. "]).alias("c"))
    return out.select("doc_id", F.sha2("c.text", 256).alias("text_sha256"), F.array_join("c.notes", "|").alias("notes"))
