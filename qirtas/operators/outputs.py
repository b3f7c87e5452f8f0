"""What a run writes: the files of each document, the output that was asked for, and the index and audit of all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qirtas.functions.text import text_of

# Names of a document's files, and how many weak pages index and audit list.
FILES = {"verbatim": "verbatim.md", "provenance": "provenance.json", "context": "context.md", "case_packet": "case_packet.md", "case_index": "case_index.json"}
IN_INDEX, IN_AUDIT = 20, 40


def file_set(rendered: DataFrame, key: str) -> DataFrame:
    """``document, files`` for the sink: of the columns named in ``FILES``, those that are there and not null; files that
    come from preparation (packet and index) are written only if not empty."""
    have = [c for c in FILES if c in rendered.columns]
    one = lambda c: F.struct(F.lit(FILES[c]).alias("name"), F.col(c).alias("content"))
    full = lambda c: F.when(F.col(c).isNotNull() & ((F.col(c) != "") if c.startswith("case_") else F.lit(True)), one(c))
    return rendered.select(F.col(key).cast("string").alias("document"), F.filter(F.array(*[full(c) for c in have]), lambda f: f.isNotNull()).alias("files"))


def primary_output(form: Column, profile: Column, json: Column, context: Column, markdown: Column, text: Column) -> Column:
    """The one output that was asked for: JSON, the context prepared for models, Markdown, else plain text."""
    return F.when(form == "json", json).when((form == "markdown") & (profile == "llm"), context).when(form == "markdown", markdown).otherwise(text)


def first_values(rows: DataFrame, key: str, value: str, most: int) -> DataFrame:
    """``key, n, first``: how many values each key has and the first ``most`` in order. No more than that are brought
    together, whatever a key's rows."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(value))
    few = rows.select(key, value).withColumn("_place", place).filter(F.col("_place") <= most)
    first = few.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("first"))
    return rows.groupBy(key).agg(F.count(value).alias("n")).join(first, key, "left").select(key, "n", F.coalesce("first", F.array().cast(f"array<{rows.schema[value].dataType.simpleString()}>")).alias("first"))


def cut_list(first: Column, n: Column, most: int, more: str = "...") -> Column:
    return F.concat(F.array_join(F.slice(first, 1, most).cast("array<string>"), ", "), F.when(n > most, F.lit(more)).otherwise(""))


def document_notes(pages: DataFrame, key: str, page: str, chars: str, weak: Column, read: Column) -> DataFrame:
    """Totals of each document, with its first weak pages: pages, total_chars, ocr_pages, weak_n, weak (up to 40)."""
    rows = pages.select(key, F.col(page).alias("page"), F.col(chars).alias("chars"), F.coalesce(weak, F.lit(False)).alias("weak"), F.coalesce(read, F.lit(False)).alias("read"))
    totals = rows.groupBy(key).agg(F.count("*").alias("pages"), F.coalesce(F.sum("chars"), F.lit(0)).alias("total_chars"), F.sum(F.col("read").cast("long")).alias("ocr_pages"))
    listed = first_values(rows.filter("weak"), key, "page", IN_AUDIT).select(F.col(key).alias("_key"), F.col("n").alias("weak_n"), F.col("first").alias("weak"))
    joined = totals.join(listed, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    return joined.withColumns({"weak_n": F.coalesce("weak_n", F.lit(0)), "weak": F.coalesce("weak", F.array().cast(listed.schema["weak"].dataType))})


def index_lines(notes: DataFrame, name: Column) -> DataFrame:
    """A line of the index a document; lists of weak pages end after 20. The lines are rows, so the index of any number of
    documents is written in parts, in the order of names."""
    said = F.concat_ws(
        "; ", F.concat(F.lit("pages: "), F.col("pages").cast("string")), F.concat(F.lit("chars: "), F.col("total_chars").cast("string")),
        F.when(F.col("ocr_pages") > 0, F.concat(F.lit("ocr fallback pages: "), F.col("ocr_pages").cast("string"))),
        F.when(F.col("weak_n") > 0, F.concat(F.lit("weak pages: "), cut_list(F.col("weak"), F.col("weak_n"), IN_INDEX))),
    )
    n = text_of(name)
    return notes.select(n.alias("name"), F.concat(F.lit("- ["), n, F.lit("]("), n, F.lit(") - "), said).alias("line"))


def audit_lines(notes: DataFrame, name: Column) -> DataFrame:
    """A line of the audit a document with weak pages; lists end after 40."""
    n = text_of(name)
    return notes.filter("weak_n > 0").select(n.alias("name"), F.concat(F.lit("- "), n, F.lit(": "), cut_list(F.col("weak"), F.col("weak_n"), IN_AUDIT)).alias("line"))


def corpus_head(notes: DataFrame) -> DataFrame:
    """One row with what heads index and audit: documents, pages, characters, documents with weak pages."""
    return notes.agg(F.count("*").alias("documents"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"), F.coalesce(F.sum("total_chars"), F.lit(0)).alias("chars"), F.coalesce(F.sum((F.col("weak_n") > 0).cast("long")), F.lit(0)).alias("weak_documents"))
