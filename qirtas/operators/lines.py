"""Lines of pages: the flat table, scan artifacts, article numbers, cutting to a document."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qirtas.functions.metrics import any_of
from qirtas.functions.rulesets import is_article_heading
from qirtas.functions.text import eastern_digits, full_lines, strip, strip_end, text_of, unix_lines

# Lines that scanners and recognition models leave, with their labels.
ARTIFACTS = (
    ("no_text_visible", r"(?i)^\(?No text is visible in the provided image\.\)?$"),
    ("no_visible_text_to_extract", r"(?i)^\(?No visible text to extract\)?$"),
    ("no_visible_printed_or_handwritten_text", r"(?i)^\(?No visible printed or handwritten text to extract from the provided image\.\)?$"),
    ("no_visible_or_legible_text", r"(?i)^There is no visible or legible text in the provided image\.$"),
    ("image_contains_no_visible_text", r"(?i)^\[The image contains no visible text\.\]$"),
    ("empty_image_no_text_visible", r"(?i)^\(?empty image, no text visible\)?$"),
    ("camscanner", r"(?i).*CamScanner.*"),
)


def line_table(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """A row a non-blank line: keys, its index from 0, the number of such lines on the page, its text. The text is
    split once a page and goes no further than that: the rows are taken out by an outer generator, as the optimiser would
    put a test for empty arrays, with the split once more for each line, below an inner one."""
    split = pages.select(*keys, full_lines(text_of(text)).alias("_lines"))
    rows = F.transform("_lines", lambda line, i: F.struct(F.size("_lines").cast("long").alias("total_lines"), i.cast("long").alias("line_index"), line.alias("line")))
    return split.select(*keys, rows.alias("_lines")).select(*keys, F.inline_outer("_lines")).filter("line_index is not null")


def artifact_label(line: Column) -> Column:
    out = F.lit(None).cast("string")
    for label, pattern in reversed(ARTIFACTS):
        out = F.when(strip(line).rlike(pattern), label).otherwise(out)
    return out


def has_artifact(c: Column) -> Column:
    return any_of(strip(c).rlike(p) for _, p in ARTIFACTS)


def without_artifacts(c: Column) -> Column:
    """Struct of the page's text without artifact lines and their labels, one a line removed."""
    own = F.split(unix_lines(text_of(c)), "\n")
    kept = F.filter(own, lambda x: ~has_artifact(x))
    text = F.array_join(F.transform(kept, strip_end), "\n")
    return F.struct(strip(F.regexp_replace(text, "\n{3,}", "\n\n")).alias("text"), F.array_compact(F.transform(own, artifact_label)).alias("labels"))


def artifact_counts(pages: DataFrame, page: str, text: str, keys: list[str] | None = None) -> DataFrame:
    """Of every label, those without a line too: lines removed and the pages they were on (a document's own pages, where
    ``keys`` names documents)."""
    keys = keys or []
    spark = pages.sparkSession
    labels = spark.createDataFrame([(i, label) for i, (label, _) in enumerate(ARTIFACTS)], "ord int, label string")
    rows = pages.select(*keys, F.col(page).cast("long").alias("page"), F.explode(without_artifacts(F.col(text))["labels"]).alias("label"))
    found = rows.groupBy(*keys, "label", "page").agg(F.count("*").alias("n")).groupBy(*keys, "label").agg(F.sum("n").alias("removed"), F.array_sort(F.collect_list("page")).alias("pages"))
    every = pages.select(*keys).distinct().crossJoin(F.broadcast(labels)) if keys else labels
    out = every.join(found, [*keys, "label"], "left")
    return out.select(*keys, "ord", "label", F.coalesce("removed", F.lit(0)).cast("long").alias("removed"), F.coalesce("pages", F.array().cast("array<long>")).alias("pages"))


def renumbered(rows: DataFrame, doc: str, first_page: int = 8, line: str = "line") -> DataFrame:
    """Article headings from ``first_page`` on get their running number within the document (``number``) and are written
    anew with it; other lines stay, their number null. One running sum a document."""
    order = Window.partitionBy(doc).orderBy("page", "line_index").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_on", is_article_heading(F.col(line)) & (F.col("page") >= first_page))
    rows = rows.withColumn("number", F.when(F.col("_on"), F.sum(F.col("_on").cast("long")).over(order)))
    anew = F.concat(F.lit("مادة ("), eastern_digits(F.col("number")), F.lit(")"))
    return rows.withColumn(line, F.when(F.col("_on"), anew).otherwise(F.col(line))).drop("_on")


def _found(t: Column, pattern: str) -> Column:
    """Place of the first match, from 1; null without one."""
    return F.when(t.rlike(pattern), F.regexp_instr(t, F.lit(pattern)))


def cut_to_document(c: Column, starts: Iterable[str] = (), ends: Iterable[str] = ()) -> Column:
    """Struct of a text cut to its document and notes. It begins at the earliest match of a start pattern, and ends
    before the match of the first end pattern that occurs after that; what does not occur cuts nothing."""
    t, starts, ends = text_of(c), list(starts), list(ends)
    hits = F.array_compact(F.array(*[F.when(_found(t, p).isNotNull(), F.struct(_found(t, p).alias("at"), F.lit(i).alias("i"), F.lit(p).alias("p"))) for i, p in enumerate(starts)]))
    first = F.array_min(hits) if starts else F.lit(None).cast("struct<at:int,i:int,p:string>")
    cut = F.when(first["at"] > 1, t.substr(first["at"], F.length(t))).otherwise(t)
    notes = F.when(first["at"] > 1, F.array(F.concat(F.lit("trimmed_before_start_pattern:"), first["p"]))).otherwise(F.array().cast("array<string>"))
    text, note = cut, F.lit(None).cast("string")
    for p in reversed(ends):
        at = _found(cut, p)
        text = F.when(at.isNotNull(), F.when(at > 1, cut.substr(F.lit(1), at - 1)).otherwise(F.lit(""))).otherwise(text)
        note = F.when(at.isNotNull(), F.lit(f"trimmed_after_end_pattern:{p}")).otherwise(note)
    return F.struct(strip(text).alias("text"), F.concat(notes, F.array_compact(F.array(note))).alias("notes"))
