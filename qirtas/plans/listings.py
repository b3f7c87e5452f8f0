"""Queries over lists of names, levels of measures and the display order of lines; all read the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.functions import bidi
from qirtas.operators import contrast, levels, prefixes, thumbnails

from .common import STATS, count, register, reply, share, table
from .measures import CASES, DATES

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SECTIONS = r"s as (select distinct unnest([regexp_extract(url, '^[a-z]+://[^/]+'), regexp_extract(url, '^[a-z]+://[^/]+/[^/]+/')]) as prefix from pages where page_id % 3 <> 0)"


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites and their first folders, of two thirds of the addresses: what the others are matched with."""
    part = lambda p: F.regexp_extract("url", p, 0)
    rows = table(spark, sf_dir, "pages").filter("page_id % 3 <> 0")
    return rows.select(F.explode(F.array(part("^[a-z]+://[^/]+"), part("^[a-z]+://[^/]+/[^/]+/"))).alias("prefix")).distinct()


@register(QUERIES, ORACLES, f"with {SECTIONS} select page_id, max_by(prefix, length(prefix)) as prefix from pages left join s on starts_with(url, prefix) group by page_id")
def page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.longest_prefix(table(spark, sf_dir, "pages"), "page_id", "url", sections(spark, sf_dir), "prefix")


@register(QUERIES, ORACLES, r"with s as (select distinct regexp_extract(url, '^[a-z]+://[^/]+/') as prefix, upper(regexp_extract(url, '^[a-z]+://([^/]+)/', 1)) as site from pages) select site, max_by(url, lower(url)) as url from pages join s on starts_with(url, prefix) group by site")
def page_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every site the last address; an error if a site had none."""
    p = table(spark, sf_dir, "pages")
    sites = p.select(F.regexp_extract("url", "^[a-z]+://[^/]+/", 0).alias("prefix"), F.upper(F.regexp_extract("url", "^[a-z]+://([^/]+)/", 1)).alias("site")).distinct()
    return prefixes.select_targets(p, "url", sites, "prefix", "site")


@register(QUERIES, ORACLES, "with f as (select distinct conv_id // 2 as file from conversations), t as (select conv_id // 2 as file, length(trim(coalesce(text, ''), ' ')) as n from conversations where turn > 0) select f.file, count(n) as page_count, coalesce(sum((n >= 40)::int), 0)::bigint as embedded_pages, coalesce(sum(n), 0)::bigint as embedded_chars from f left join t on t.file = f.file group by f.file")
def folder_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of conversations as files, their later turns as pages."""
    rows = table(spark, sf_dir, "conversations").withColumn("file", F.expr("conv_id div 2"))
    return prefixes.folder_inventory(rows.filter("turn > 0"), rows.select("file").distinct(), "file", F.col("text"), 40)


@register(QUERIES, ORACLES, f"""with src as (select v.config, source as document, doc_id as page, case when v.config = 'raw' then coalesce(text, '') else lower(coalesce(text, '')) end as text from documents, (select unnest(['raw', 'lower']) as config) v),
 {STATS}, m as (select config, document, page, n, one, frag, {count("text", CASES)} as case_numbers, {count("text", DATES)} as dates, len(list_filter(string_split(text, chr(10)), lambda x: {reply("x")})) as replies, (length(text) % 11)::double as score,
 case when config = 'raw' then (length(text) % 7)::double end as confidence, (n = 0 or one::double / n > 0.3 or frag::double / n > 0.2) as low from s),
 g as (select grouping(config, document, page) as g, config, document, page, count(*) as pages, sum(n)::bigint as tokens, sum(one)::bigint as single, sum(frag)::bigint as fragments, sum(case_numbers)::bigint as case_numbers, sum(dates)::bigint as dates, 0::bigint as articles,
 sum(replies)::bigint as reply_lines, round(coalesce(avg(score), -1), 4) as avg_score, round(coalesce(avg(confidence), 0), 4) as avg_confidence, sum(low::int)::bigint as failed, sum((not low)::int)::bigint as passed
 from m group by grouping sets ((), (config), (config, document), (config, document, page)))
 select case g when 7 then 'all' when 3 then 'configuration' when 1 then 'document' else 'page' end as level, config, document, page, pages, tokens, single, fragments, case_numbers, dates, articles, reply_lines, round({share("single", "tokens")}, 6) as single_char_ratio, round({share("fragments", "tokens")}, 6) as digit_fragment_ratio,
 avg_score, avg_confidence, failed, passed from g""")
def metric_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as documents and their texts as pages, read as they are and in lower case."""
    t = F.coalesce("text", F.lit(""))
    read = F.array(*[F.struct(F.lit(n).alias("config"), c.alias("text"), (F.length(c) % 11).alias("score"), k.cast("int").alias("confidence")) for n, c, k in (("raw", t, F.length(t) % 7), ("lower", F.lower(t), F.lit(None)))])
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", F.explode(read).alias("v")).select("source", "doc_id", "v.*")
    return levels.document_levels(rows, "config", "source", "doc_id", "text", "score", "confidence")


ALPHABET, RIGHT = "abcdefghijklmnopqrstuvwxyz", "".join(map(chr, range(0x621, 0x63B)))


@register(QUERIES, ORACLES, f"""with w as (select doc_id, unnest(regexp_extract_all(text, '[a-z]+')) as word, generate_subscripts(regexp_extract_all(text, '[a-z]+'), 1) - 1 as i from documents),
 r as (select doc_id, i // 12 as line, i // 3 as run, max(word) filter (where i % 3 = 0) as plain, string_agg(translate(word, '{ALPHABET}', '{RIGHT}'), ' ' order by i) filter (where i % 3 <> 0) as turned from w group by all),
 l as (select doc_id, line, string_agg(plain || coalesce(' ' || reverse(turned), ''), ' ' order by run) as shown from r group by all)
 select doc_id, count(*) as lines, sha256(string_agg(shown, chr(10) order by line)) as shown_sha256 from l group by doc_id""")
def bidi_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in lines of twelve words, two of three in right-to-left letters, in display order."""
    words = F.regexp_extract_all("text", F.lit("[a-z]+"), F.lit(0))
    mixed = F.transform(words, lambda w, i: F.when(i % 3 == 0, w).otherwise(F.translate(w, ALPHABET, RIGHT)))
    rows = table(spark, sf_dir, "documents").filter(F.col("text").rlike("[a-z]")).select("doc_id", mixed.alias("w"))
    starts = F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 12).cast("int"))
    lines = F.transform(starts, lambda k: F.array_join(F.slice(F.col("w"), k * 12 + 1, 12), " "))
    shown = bidi.display_order(F.array_join(lines, "\n"))
    return rows.select("doc_id", F.size(starts).cast("long").alias("lines"), F.sha2(shown, 256).alias("shown_sha256"))


BYTES = """b as (select doc_id, ('0x' || unnest(regexp_extract_all(hex(encode(text)), '..')))::int as value from documents), c as (select doc_id, value, count(*) as n from b group by all),
 r as (select doc_id, value, sum(n) over u as n0, sum(value * n) over u as s0, sum(n) over w as n, sum(value * n) over w as s from c window u as (partition by doc_id order by value), w as (partition by doc_id)),
 d as (select *, n0::double as a, (n - n0)::double as z, s0::double / n0::double - (s - s0)::double / nullif(n - n0, 0)::double as apart from r),
 o as (select *, row_number() over (partition by doc_id order by coalesce(a * z * (apart * apart), -1) desc, value) as place from d)"""


@register(QUERIES, ORACLES, f"with {BYTES} select doc_id, value as threshold, n0::bigint as dark, n::bigint as pixels from o where place = 1")
def byte_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's bytes as the pixels of a page: the threshold between its dark and light ones."""
    pages = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("grey"))
    return contrast.otsu_thresholds(contrast.histograms(pages, "doc_id"), "doc_id")


@register(QUERIES, ORACLES, f"with {BYTES} select b.doc_id, sum((b.value > o.value)::int)::bigint as light from b join o on o.doc_id = b.doc_id and o.place = 1 group by b.doc_id")
def byte_pages_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages, one row of pixels high, in black and white."""
    pages = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("grey")).filter("length(grey) > 0").withColumns({"width": F.length("grey"), "height": F.lit(1)})
    binary = contrast.page_variants(pages, "doc_id", ["binary"])
    return contrast.histograms(binary, "doc_id").groupBy("doc_id").agg(F.coalesce(F.sum(F.when(F.col("value") == 255, F.col("n"))), F.lit(0).cast("long")).alias("light"))


@register(QUERIES, ORACLES, """with p as (select vec_id, list_transform(embedding, lambda x: least(greatest(floor(128 + 256 * x::double), 0), 255)) as v from embeddings),
 m as (select t.vec_id as target, s.vec_id as source, list_sum(list_transform(list_zip(t.v, s.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) / 64 as mse from p t join p s on s.vec_id % 100 <> 0 where t.vec_id % 100 = 0),
 b as (select *, row_number() over (partition by target order by mse, source::varchar) as place from m where mse < 1000)
 select p.vec_id as target, b.source::varchar as source, b.mse from p left join b on b.target = p.vec_id and place = 1 where p.vec_id % 100 = 0""")
def nearest_thumbnails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as thumbnails of eight by eight: of every hundredth the one of the others that differs least."""
    value = lambda x: F.greatest(F.least(F.floor(128 + 256 * x.cast("double")), F.lit(255)), F.lit(0))
    grey = F.unhex(F.array_join(F.transform("embedding", lambda x: F.lpad(F.hex(value(x)), 2, "0")), ""))
    pages = table(spark, sf_dir, "embeddings").select("vec_id", grey.alias("grey"))
    found = thumbnails.nearest_pages(pages.filter("vec_id % 100 = 0"), pages.filter("vec_id % 100 <> 0"), "vec_id", "vec_id", width=8)
    return found.select("target", "source", "mse")
