"""Files and texts by content hash, totals and corpus summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qirtas.functions.text import strip, text_of


def with_duplicates(files: DataFrame, name: str, content: str) -> DataFrame:
    """``sha256`` and ``duplicate_of``: the first name, ignoring case, with the same content, null for that one.

    The smallest name of each hash is aggregated first and joined back, so a hash that many share is no one task's work."""
    hashed = files.withColumn("sha256", F.sha2(F.col(content), 256))
    first = hashed.groupBy("sha256").agg(F.min(F.struct(F.lower(F.col(name).cast("string")).alias("l"), F.col(name).alias("n"))).alias("f"))
    out = hashed.join(first, "sha256")
    return out.withColumn("duplicate_of", F.when(F.col("f.n") != F.col(name), F.col("f.n"))).drop("f")


def duplicate_count(files: DataFrame) -> DataFrame:
    """Files beyond the first of each hash."""
    n = files.groupBy("sha256").agg(F.count("*").alias("n"))
    return n.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).cast("long").alias("duplicates"), F.count("*").alias("distinct_files"))


def document_totals(pages: DataFrame, keys: list[str], text: str, weak: Column, page: str = "page") -> DataFrame:
    t = text_of(text)
    return pages.groupBy(*keys).agg(
        F.count("*").alias("pages"), F.sum(F.length(t).cast("long")).alias("chars"), F.sum((strip(t) != "").cast("long")).alias("text_pages"),
        F.array_sort(F.collect_list(F.when(weak, F.col(page)))).alias("weak_pages"),
    )


def is_weak_document(chars: Column, pages: Column, weak_pages: Column, least: int = 80, a_page: int = 40) -> Column:
    return (F.size(weak_pages) > 0) | (chars < F.greatest(F.lit(least), pages * a_page))


def counters(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counts of each value as a map a key."""
    n = rows.groupBy(*keys, value).agg(F.count("*").alias("n"))
    return n.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(value), F.col("n"))))).alias("counts"))


def exactly_one(rows: DataFrame, what: str = "row") -> DataFrame:
    """The rows, or an error at run time unless there is exactly one. One number is counted and joined to the rows, so
    they stay where they are."""
    n = rows.agg(F.count("*").alias("_n"))
    wrong = F.raise_error(F.concat(F.lit(f"not exactly one {what} but "), F.col("_n").cast("string")))
    checked = n.select(F.when(F.col("_n") == 1, F.col("_n")).otherwise(wrong.cast("long")).alias("_n"))
    none = checked.filter("_n <> 1").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
    return rows.crossJoin(F.broadcast(checked)).filter("_n = 1").drop("_n").unionByName(none)


def propagated(files: DataFrame, outputs: DataFrame, name: str | None = None, text: str | None = None, header: str = "Source PDF: ") -> DataFrame:
    """Outputs of unique contents, for every file with that content. With ``name`` and ``text``, the first line of the
    text that names the source names each file's own."""
    rows = files.join(outputs, "sha256")
    if name and text:
        own = F.regexp_replace(F.col(name), r"([\\$])", r"\\$1")
        rows = rows.withColumn(text, F.regexp_replace(F.col(text), F.lit(rf"(?s)^(.*?)(?m:^){header}[^\n]*"), F.concat(F.lit(f"$1{header}"), own)))
    return rows


def limited(files: DataFrame, n: int, name: str = "name", unique: bool = False) -> DataFrame:
    """The first ``n`` files by name without regard to case (all if 0); ``unique`` counts contents, so that a file whose
    content came before does not use up the limit."""
    if not n:
        return files
    key = F.lower(F.col(name))
    if not unique:
        return files.orderBy(key, name).limit(n)
    first = files.groupBy("sha256").agg(F.min(F.struct(key.alias("l"), F.col(name).alias("n"))).alias("f")).orderBy("f").limit(n).select("sha256")
    return files.join(first, "sha256")


def run_summary(pages: DataFrame, keys: list[str], measures: str = "m", least: int = 60) -> DataFrame:
    """A document's run: pages, characters, Arabic characters, noise marks, counts of sources and statuses as maps, weak
    pages and pages read by an engine. ``measures`` is a struct of chars, arabic_chars, latin_extended_noise,
    replacement_chars and status; ``source`` and ``engine`` say where a page's text came from. Counts of values are added up
    before they are put in maps; only pages that are weak or read again are listed."""
    m = lambda n: F.col(f"{measures}.{n}")
    weak = m("status").isin("fail", "warn") | (m("chars") < least)
    by = pages.groupBy(*keys, "source", m("status").alias("status")).agg(
        F.count("*").alias("pages"), F.sum(m("chars")).alias("chars"), F.sum(m("arabic_chars")).alias("arabic"), F.sum(m("latin_extended_noise") + m("replacement_chars")).alias("noise"),
        F.collect_list(F.when(weak, F.col("page"))).alias("weak"), F.collect_list(F.when(F.col("engine") == "tesseract", F.col("page"))).alias("read"),
    )
    tally = lambda c: F.map_from_entries(F.transform(F.array_sort(F.array_distinct(F.collect_list(c))), lambda x: F.struct(x.alias("k"), F.lit(0).cast("long").alias("n"))))
    out = by.groupBy(*keys).agg(
        F.sum("pages").alias("pages"), F.sum("chars").alias("total_chars"), F.sum("arabic").alias("total_arabic_chars"), F.sum("noise").alias("total_noise_markers"),
        F.collect_list(F.struct("source", "pages")).alias("s"), F.collect_list(F.struct("status", "pages")).alias("t"), tally("source").alias("chosen_sources"), tally("status").alias("chosen_statuses"),
        F.array_sort(F.flatten(F.collect_list("weak"))).alias("weak_pages"), F.array_sort(F.flatten(F.collect_list("read"))).alias("ocr_pages"),
    )
    add = lambda counts, name: lambda k, _: F.aggregate(F.filter(counts, lambda x: x[name] == k), F.lit(0).cast("long"), lambda n, x: n + x["pages"])
    out = out.withColumn("chosen_sources", F.transform_values("chosen_sources", add("s", "source"))).withColumn("chosen_statuses", F.transform_values("chosen_statuses", add("t", "status")))
    return out.drop("s", "t")
