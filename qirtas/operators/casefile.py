"""Logical documents as page ranges: normalising, covering, joining with pages, aggregates, review segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qirtas.functions.text import normalise_llm, strip, text_of


# What an entry says where nothing is known, and what the entry for pages that none covers says.
DEFAULTS = {"label": "Unlabeled document", "document_type": "unknown", "confidence": "low", "language": "unknown", "summary": "", "defense_relevance": ""}
FILLER = {
    "label": "Unclassified bundle segment", "document_type": "unknown", "confidence": "low", "language": "unknown",
    "summary": "The OCR text in this page range should be reviewed manually to confirm the document type and relevance.",
    "defense_relevance": "Manual review recommended because the bundle classifier could not confidently label this segment.",
}
FILLER_WATCH = "Document boundary classification was uncertain for this page range."
LISTS = ("key_dates", "organizations", "topics", "evidence_types", "ocr_watchlist")
PEOPLE, EVENTS = "array<struct<name:string,role:string>>", "array<struct<date:string,event:string>>"


def clean_scalar(c: Column, default: str = "") -> Column:
    t = strip(text_of(c.cast("string")))
    return F.when(t == "", F.lit(default)).otherwise(t) if default else t


def clean_list(c: Column) -> Column:
    """Stripped, non-empty, distinct in their order; null counts as empty."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: strip(text_of(x))), lambda x: x != ""))


def clean_people(c: Column) -> Column:
    """(name, role) structs: named ones, each pair once; bare names are structs with an empty role already."""
    tidy = F.transform(F.coalesce(c, F.array().cast(PEOPLE)), lambda p: F.struct(strip(text_of(p["name"])).alias("name"), strip(text_of(p["role"])).alias("role")))
    return F.array_distinct(F.filter(tidy, lambda p: p["name"] != ""))


def people_from_names(c: Column) -> Column:
    return F.transform(c, lambda n: F.struct(n.alias("name"), F.lit("").alias("role")))


def clean_date_events(c: Column) -> Column:
    tidy = F.transform(F.coalesce(c, F.array().cast(EVENTS)), lambda p: F.struct(strip(text_of(p["date"])).alias("date"), strip(text_of(p["event"])).alias("event")))
    return F.filter(tidy, lambda p: (p["date"] != "") | (p["event"] != ""))


def page_ranges(entries: DataFrame) -> DataFrame:
    """Entries with numbers for both ends, from 1, in order; columns ``page_start`` and ``page_end`` may be strings."""
    a, b = F.expr("try_cast(page_start as int)"), F.expr("try_cast(page_end as int)")
    rows = entries.withColumn("_a", a).withColumn("_b", b).filter("_a >= 1 and _b >= 1")
    return rows.withColumn("page_start", F.least("_a", "_b")).withColumn("page_end", F.greatest("_a", "_b")).drop("_a", "_b")


def candidates(entries: DataFrame) -> DataFrame:
    """Entries with usable ranges and every field cleaned, absent ones with their defaults."""
    rows, have = page_ranges(entries), set(entries.columns)
    field = lambda n, kind: F.col(n) if n in have else F.lit(None).cast(kind)
    rows = rows.withColumns({n: clean_scalar(field(n, "string"), d) for n, d in DEFAULTS.items()} | {n: clean_list(field(n, "array<string>")) for n in LISTS})
    return rows.withColumns({"people": clean_people(field("people", PEOPLE)), "date_events": clean_date_events(field("date_events", EVENTS))})


def coverage(entries: DataFrame, bundles: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """Every page of each bundle in exactly one logical document: entries by start and end (ties as they came, by
    ``order``), cut to the pages that no earlier one has, dropped if none is left, gaps filled with documents that say so.
    ``bundles`` has ``page_total``.

    The first free page is one more than the largest end so far, as dropped entries end before it."""
    rows = candidates(entries).join(bundles.select(key, "page_total"), key)
    clip = lambda c: F.greatest(F.lit(1), F.least("page_total", c))
    rows = rows.withColumn("_a", clip("page_start")).withColumn("_b", clip("page_end"))
    ties = [order] if order in entries.columns else []
    before = Window.partitionBy(key).orderBy("page_start", "page_end", *ties).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_next", F.coalesce(F.max("_b").over(before), F.lit(0)) + 1).filter("_b >= _next")
    fields = [*DEFAULTS, *LISTS, "people", "date_events"]
    kept = rows.select(key, F.greatest("_a", "_next").alias("page_start"), F.col("_b").alias("page_end"), *fields, "_next")
    gaps = kept.filter("page_start > _next").select(key, F.col("_next").alias("page_start"), (F.col("page_start") - 1).alias("page_end"))
    last = kept.groupBy(key).agg(F.max("page_end").alias("_last"))
    tail = bundles.select(key, "page_total").join(last, key, "left").withColumn("_from", F.coalesce("_last", F.lit(0)) + 1).filter("_from <= page_total or _last is null")
    tail = tail.select(key, F.col("_from").alias("page_start"), F.col("page_total").alias("page_end"))
    none = {n: F.array().cast("array<string>") for n in LISTS} | {"people": F.array().cast(PEOPLE), "date_events": F.array().cast(EVENTS), "ocr_watchlist": F.array(F.lit(FILLER_WATCH))}
    unknown = gaps.unionByName(tail).withColumns({n: F.lit(v) for n, v in FILLER.items()} | none)
    every = kept.drop("_next").unionByName(unknown)
    number = F.row_number().over(Window.partitionBy(key).orderBy("page_start"))
    return every.select(key, F.format_string("doc-%03d", number).alias("id"), number.alias("number"), "page_start", "page_end", *fields)


def pages_of(entries: DataFrame, pages: DataFrame, key: str, page: str = "page") -> DataFrame:
    """Entries joined to their pages: each range becomes its page numbers, an equi-join that any key size allows."""
    numbers = entries.withColumn(page, F.explode(F.sequence("page_start", "page_end")))
    return numbers.join(pages, [key, page])


def documents_of(entries: DataFrame, key: str) -> DataFrame:
    """One row a bundle with its logical documents as an array ``docs`` in order; a bundle is one file of papers."""
    fields = [c for c in entries.columns if c not in (key, "number")]
    return entries.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("number", *fields))).alias("docs"))


def people_of(docs: Column) -> Column:
    """(name, roles) of all documents: names as they were first met, each one's roles in their order."""
    met = F.flatten(F.transform(docs, lambda d: d["people"]))
    names = F.array_distinct(F.transform(F.filter(met, lambda p: p["name"] != ""), lambda p: p["name"]))
    roles = lambda n: F.array_distinct(F.transform(F.filter(met, lambda p: (p["name"] == n) & (p["role"] != "")), lambda p: p["role"]))
    return F.transform(names, lambda n: F.struct(n.alias("name"), roles(n).alias("roles")))


def events_of(docs: Column) -> Column:
    """Dated events of all documents, each with its document and pages."""
    own = lambda d: F.transform(d["date_events"], lambda e: F.struct(d["id"].alias("document_id"), d["page_start"].alias("page_start"), d["page_end"].alias("page_end"), e["date"].alias("date"), e["event"].alias("event")))
    return F.filter(F.flatten(F.transform(docs, own)), lambda e: (e["date"] != "") | (e["event"] != ""))


def distinct_of(docs: Column, field: str) -> Column:
    return F.array_distinct(F.flatten(F.transform(docs, lambda d: d[field])))


def people_roles(rows: DataFrame, key: str, order: str, name: str, role: str) -> DataFrame:
    """Each name's distinct non-empty roles in the order first met, and where the name was first met."""
    met = rows.filter(text_of(name) != "").select(key, F.col(name).alias("name"), text_of(role).alias("role"), F.col(order).alias("ord"))
    roles = met.groupBy(key, "name", "role").agg(F.min("ord").alias("ord"))
    own = F.array_sort(F.collect_list(F.when(F.col("role") != "", F.struct("ord", "role"))))
    return roles.groupBy(key, "name").agg(F.min("ord").alias("first_met"), F.transform(own, lambda x: x["role"]).alias("roles"))


def unique_in_order(rows: DataFrame, key: str, order: str, values: str) -> DataFrame:
    """Distinct values of an array column over a bundle's entries, with the place each was first met."""
    met = rows.select(key, F.col(order).alias("ord"), F.posexplode(values).alias("pos", "value"))
    first = met.groupBy(key, "value").agg(F.min(F.struct("ord", "pos")).alias("at"))
    return first.select(key, "value", F.row_number().over(Window.partitionBy(key).orderBy("at")).alias("place"))


def date_events(rows: DataFrame, key: str, events: str) -> DataFrame:
    return rows.select(key, "id", "page_start", "page_end", F.explode(clean_date_events(F.col(events))).alias("e")).select(key, F.col("id").alias("document_id"), "page_start", "page_end", "e.date", "e.event")


def headed_page(number: Column, text: Column) -> Column:
    return strip(F.concat(F.lit("### Page "), number.cast("string"), F.lit("\n\n"), normalise_llm(text)))


def review_segments(pages: DataFrame, keys: list[str], page: str, text: str, max_chars: int = 3000, max_pages: int = 2) -> DataFrame:
    """Pages of each entry, headed and in the form for models, packed greedily in order: a segment ends where the next page
    would be one too many, or the text, with two characters between pages, too long. ``raw_text`` is what a reviewer gets.
    The fold goes over one entry's pages at a time, by their lengths."""
    rows = pages.select(*keys, F.col(page).cast("long").alias("page"), headed_page(F.col(page), F.col(text)).alias("body"))
    listed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("page", "body"))).alias("pages"))
    segment = "struct<first:int,n:int,chars:int>"
    start = F.struct(F.array().cast(f"array<{segment}>").alias("done"), F.lit(None).cast(segment).alias("open"))

    def step(state: Column, p: Column) -> Column:
        now, size = state["open"], F.length(p["p"]["body"])
        full = now.isNotNull() & ((now["n"] >= max_pages) | (now["chars"] + size + 2 > max_chars))
        one = F.struct(p["i"].alias("first"), F.lit(1).alias("n"), size.alias("chars"))
        more = F.struct(now["first"].alias("first"), (now["n"] + 1).alias("n"), (now["chars"] + size + 2).alias("chars"))
        return (
            F.when(now.isNull(), F.struct(state["done"].alias("done"), one.alias("open"))).when(full, F.struct(F.concat(state["done"], F.array(now)).alias("done"), one.alias("open")))
            .otherwise(F.struct(state["done"].alias("done"), more.alias("open")))
        )

    numbered = F.transform("pages", lambda p, i: F.struct(i.cast("int").alias("i"), p.alias("p")))
    packed = F.aggregate(numbered, start, step, lambda s: F.concat(s["done"], F.array(s["open"])))
    cut = F.transform(packed, lambda s: F.slice(F.col("pages"), s["first"] + 1, s["n"]))
    out = listed.select(*keys, F.posexplode(cut).alias("segment", "s"))
    return out.select(
        *keys, F.col("segment").cast("long").alias("segment"), F.col("s")[0]["page"].alias("page_start"), F.element_at("s", -1)["page"].alias("page_end"),
        strip(F.array_join(F.transform("s", lambda p: p["body"]), "\n\n")).alias("raw_text"),
    )


def review_key(id_: Column, start: Column, end: Column, label: Column, kind: Column) -> Column:
    """What an entry is known by between runs: its id, else its range, label and type."""
    own = strip(text_of(id_.cast("string")))
    rest = F.concat_ws(":", *[text_of(c.cast("string")) for c in (start, end, label, kind)])
    return F.when(own != "", own).otherwise(rest)


def qualified(items: Column, start: Column, end: Column) -> Column:
    """A reviewer's doubts, each with its pages."""
    return F.transform(items, lambda x: uncertainty_label(start, end, x))


def uncertainty_label(start: Column, end: Column, note: Column) -> Column:
    where = F.when(start == end, F.concat(F.lit("Page "), start.cast("string"))).otherwise(F.concat(F.lit("Pages "), start.cast("string"), F.lit("-"), end.cast("string")))
    return F.concat(where, F.lit(": "), note)


def pending(entries: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Entries that no checkpoint row has."""
    return entries.join(done.select(*keys).distinct(), keys, "left_anti")


def finished(entries: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return entries.join(done.select(*keys).distinct(), keys, "left_semi")


def parse_json_object(reply: Column, schema: str) -> Column:
    """A model's JSON object, with or without a code fence or words around it; null if there is none."""
    bare = F.regexp_replace(F.regexp_replace(strip(text_of(reply)), r"^```(?:json)?\s*", ""), r"\s*```\z", "")
    return F.from_json(F.regexp_extract(bare, r"(?s)(\{.*\})", 1), schema, {"mode": "PERMISSIVE"})


def parse_review(reply: Column) -> Column:
    """Struct of a review's cleaned text and doubts; null where the reply holds no object."""
    r = parse_json_object(reply, "cleaned_text string, uncertainties array<string>")
    return F.when(r.isNotNull() & (r["cleaned_text"].isNotNull() | r["uncertainties"].isNotNull()), F.struct(strip(text_of(r["cleaned_text"])).alias("cleaned_text"), clean_list(r["uncertainties"]).alias("uncertainties")))
