"""Measures of configurations, documents and pages, all levels in one pass by grouping sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qirtas.functions import fields, metrics
from qirtas.functions.text import let, text_of, tokens

LEVELS = ("all", "configuration", "document", "page")
COUNTS = ("tokens", "single", "fragments", "case_numbers", "dates", "articles", "reply_lines")


def page_measures(text: Column) -> Column:
    """Struct of what is added up: tokens, those of one character and digit fragments, fields, lines that are replies."""

    def counted(words: Column) -> Column:
        short = F.size(F.filter(words, lambda t: F.length(t) == 1))
        digits = F.size(F.filter(words, lambda t: (F.length(t) <= 2) & t.rlike(r"(?U)\d")))
        found = [F.size(words), short, digits, F.size(fields.case_numbers(text)), F.size(fields.dates(text)), F.size(fields.articles(text)), F.size(F.filter(F.split(text_of(text), "\n"), metrics.no_text_reply))]
        return F.struct(*[c.cast("long").alias(n) for c, n in zip(found, COUNTS, strict=True)])

    return let(tokens(text_of(text)), counted)


def status(single: Column, tokens: Column, fragments: Column) -> Column:
    """``fail`` for low quality, else ``pass``."""
    low = (tokens == 0) | (single / tokens > 0.3) | (fragments / tokens > 0.2)
    return F.when(low, "fail").otherwise("pass")


def document_levels(pages: DataFrame, config: str, document: str, page: str, text: str, score: str | None = None, confidence: str | None = None) -> DataFrame:
    """A row for everything, each configuration, each document of it and each page (``level`` says which): pages, counts,
    shares, means of score and confidence, and how many pages fail or pass. One shuffle, with partial sums before it. An empty table gives no rows."""
    value = lambda c: F.col(c).cast("double") if c else F.lit(None).cast("double")
    rows = pages.select(F.col(config).alias("config"), F.col(document).alias("document"), F.col(page).alias("page"), page_measures(F.col(text)).alias("m"), value(score).alias("score"), value(confidence).alias("confidence"))
    rows = rows.select("config", "document", "page", "m.*", "score", "confidence").withColumn("status", status(F.col("single"), F.col("tokens"), F.col("fragments")))
    sets = [[], [F.col("config")], [F.col("config"), F.col("document")], [F.col("config"), F.col("document"), F.col("page")]]
    n = F.count("*")
    grouped = rows.groupingSets(sets, "config", "document", "page").agg(
        F.grouping_id().alias("g"), n.alias("pages"), *[F.sum(c).alias(c) for c in COUNTS], F.round(F.coalesce(F.avg("score"), F.lit(-1.0)), 4).alias("avg_score"), F.round(F.coalesce(F.avg("confidence"), F.lit(0.0)), 4).alias("avg_confidence"),
        F.sum((F.col("status") == "fail").cast("long")).alias("failed"), F.sum((F.col("status") == "pass").cast("long")).alias("passed"),
    )
    level = F.element_at(F.array(*map(F.lit, LEVELS)), F.when(F.col("g") == 7, 1).when(F.col("g") == 3, 2).when(F.col("g") == 1, 3).otherwise(4))
    share = lambda c: F.round(F.when(F.col("tokens") > 0, F.col(c) / F.col("tokens")).otherwise(F.lit(0.0)), 6)
    return grouped.select(level.alias("level"), "config", "document", "page", "pages", *COUNTS, share("single").alias("single_char_ratio"), share("fragments").alias("digit_fragment_ratio"), "avg_score", "avg_confidence", "failed", "passed")
