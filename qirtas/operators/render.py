"""Text, Markdown and JSON of documents, bundles and corpora, as ordered aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qirtas.functions.text import for_profile, full_lines, strip, text_of


def ordered(text: Column, order: Column, separator: str) -> Column:
    """An aggregate: texts joined in the order of a column."""
    listed = F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t"))))
    return F.array_join(F.transform(listed, lambda x: x["t"]), separator)


def page_heading(number: Column, style: str) -> Column:
    n = number.cast("string")
    return F.concat(F.lit("## Page "), n) if style == "markdown" else F.concat(F.lit("=== Page "), n, F.lit(" ==="))


def document_text(pages: DataFrame, key: str, page: str, text: str, style: str = "text", profile: str = "faithful") -> DataFrame:
    """One rendered text a document; ``page`` counts from 0, headings from 1."""
    body = for_profile(F.col(text), profile)
    gap = "\n\n" if style == "markdown" else "\n"
    part = strip(F.concat(page_heading(F.col(page) + 1, style), F.lit(gap), body))
    return pages.groupBy(key).agg(strip(ordered(part, F.col(page), "\n\n")).alias("rendered"))


def page_text(blocks: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """Non-empty block texts in reading order, a blank line between."""
    full = F.when(strip(text_of(text)) != "", strip(text_of(text)))
    return blocks.groupBy(*keys).agg(ordered(full, F.col(order), "\n\n").alias("text"))


def page_confidence(blocks: DataFrame, keys: list[str], confidence: str) -> DataFrame:
    return blocks.groupBy(*keys).agg(F.coalesce(F.avg(confidence), F.lit(0.0)).alias("confidence"))


def legacy_rows(pages: DataFrame, profile: str = "faithful") -> DataFrame:
    """The flat result rows: page, text in the profile's form, confidence, regions, method."""
    return pages.select("page", for_profile(F.col("text"), profile).alias("text"), "confidence", F.size("blocks").alias("regions"), F.col("source_kind").alias("method"))


# Sentences of the rendered files.
NO_TEXT, NOT_KEPT, NO_SUMMARY = "_No text extracted._", "(No retained text after local cleanup)", "No summary available."
PACKET_INTRO = "This packet is an OCR-based organizational aid for counsel review. All names, dates, and quotations should be verified against the source pages before relying on them."
REVIEWED_INTRO = "This file is a cleaned LLM-reviewed edition of the OCR bundle. It is intended for analysis and drafting, but any disputed wording should still be checked against the scan."
NOTES_INTRO = "These are the remaining ambiguities flagged during the LLM cleanup pass. They are the places to verify directly against the scan before quoting or relying on them."
NO_DOUBTS = "- No remaining high-confidence ambiguities were flagged by the review model."
INDEX_INTRO = "This index was prepared locally from the OCR rerun. No API or model review was used after OCR."
GROUPED_INTRO = "This file was cleaned locally and grouped manually. No API or model review was used after OCR."
RISK_INTRO = "This report was prepared locally after the OCR rerun. It identifies where the cleaned text is still risky for citation or legal analysis."


def joined(*parts: Column | str) -> Column:
    """Parts on lines of their own; null parts are left out, empty ones are empty lines."""
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def said(prefix: str, c: Column) -> Column:
    """A line for a value, null if it is empty."""
    return F.when(text_of(c) != "", F.concat(F.lit(prefix), c))


def bullets(values: Column, mark: str = "- ") -> Column:
    """A line an item, null for none."""
    return F.when(F.size(values) > 0, F.array_join(F.transform(values, lambda x: F.concat(F.lit(mark), x)), "\n"))


def section(title: str, body: Column) -> Column:
    return F.when(body.isNotNull(), joined("", f"## {title}", "", body))


def _n(c: Column) -> Column:
    return c.cast("string")


def _span(d) -> Column:
    return F.concat(_n(d["page_start"]), F.lit("-"), _n(d["page_end"]))


def _listed(prefix: str, values: Column, gap: str = ", ") -> Column:
    return F.when(F.size(values) > 0, F.concat(F.lit(prefix), F.array_join(values, gap)))


def _pages_below(entries: DataFrame, pages: DataFrame, key: str, page: str, body: Column) -> DataFrame:
    """Per logical document its pages under their headings (``pages_text``)."""
    numbers = entries.select(key, "number", F.explode(F.sequence("page_start", "page_end")).alias(page))
    rows = numbers.join(pages.select(key, page, body.alias("_body")), [key, page], "left")
    part = joined("", F.concat(F.lit("### Page "), _n(F.col(page))), "", text_of("_body"))
    return rows.groupBy(key, "number").agg(ordered(part, F.col(page), "\n").alias("pages_text"))


def _heading(e: str = "label") -> Column:
    return F.concat(F.lit("## Document "), F.format_string("%02d", F.col("number")), F.lit(" - "), F.col(e))


def bundle_context(entries: DataFrame, pages: DataFrame, bundles: DataFrame, key: str, page: str, text: str) -> DataFrame:
    """Markdown of a bundle: its inventory, then every logical document with its pages in the form for models. ``bundles``
    has source_pdf, page_total, bundle_description and bundle_notes."""
    d = F.col
    item = joined(
        F.concat(_n(d("number")), F.lit(". "), d("label"), F.lit(" (pages "), _span({"page_start": d("page_start"), "page_end": d("page_end")}), F.lit("; type: "), d("document_type"), F.lit("; confidence: "), d("confidence"), F.lit(")")),
        F.concat(F.lit("   "), F.when(d("summary") != "", d("summary")).otherwise(NO_SUMMARY)),
    )
    named = F.transform("people", lambda p: F.when(text_of(p["role"]) != "", F.concat(p["name"], F.lit(" ("), p["role"], F.lit(")"))).otherwise(p["name"]))
    head = joined(
        "", _heading(), "", F.concat(F.lit("Pages: "), _n(d("page_start")), F.lit("-"), _n(d("page_end"))), F.concat(F.lit("Type: "), d("document_type")), F.concat(F.lit("Confidence: "), d("confidence")), F.concat(F.lit("Language: "), d("language")),
        said("Summary: ", d("summary")), said("Defense relevance: ", d("defense_relevance")), _listed("Topics: ", d("topics")), _listed("Evidence types: ", d("evidence_types")), _listed("Key dates: ", d("key_dates")),
        _listed("Organizations: ", d("organizations")), _listed("People: ", named), _listed("OCR watchlist: ", d("ocr_watchlist"), "; "),
    )
    body = for_profile(F.col(text), "llm")
    below = _pages_below(entries, pages.withColumn("_t", body), key, page, F.when(F.col("_t") == "", NO_TEXT).otherwise(F.col("_t")))
    rows = entries.join(below, [key, "number"]).withColumn("_part", joined(head, F.col("pages_text")))
    whole = rows.groupBy(key).agg(F.count("*").alias("n"), ordered(item, F.col("number"), "\n").alias("items"), ordered(F.col("_part"), F.col("number"), "\n").alias("parts"))
    out = joined(
        "# Case File Bundle", "", F.concat(F.lit("Source PDF: "), d("source_pdf")), F.concat(F.lit("Total pages: "), _n(d("page_total"))), F.concat(F.lit("Logical documents: "), _n(d("n"))),
        F.when(text_of("bundle_description") != "", joined("", d("bundle_description"))), section("Bundle Notes", bullets(d("bundle_notes"))), "", "## Document Inventory", "", d("items"), d("parts"),
    )
    return bundles.join(whole, key).select(key, strip(out).alias("rendered"))


def case_packet(entries: DataFrame, bundles: DataFrame, key: str) -> DataFrame:
    """The organising packet of a bundle: snapshot, map, people, chronology, topics, evidence, review points, watchlist."""
    from .casefile import distinct_of, documents_of, events_of, people_of

    rows = documents_of(entries, key).join(bundles, key)
    docs = F.col("docs")
    lines_of = lambda f: F.array_join(F.transform(docs, f), "\n")
    place = lambda d: joined(
        F.concat(F.lit("- Pages "), _span(d), F.lit(": "), d["label"], F.lit(" ["), d["document_type"], F.lit("]")), said("  Summary: ", d["summary"]), said("  Defense relevance: ", d["defense_relevance"])
    )
    person = lambda p: F.when(F.size(p["roles"]) > 0, F.concat(p["name"], F.lit(": "), F.array_join(p["roles"], ", "))).otherwise(p["name"])
    event = lambda e: F.concat(F.when(e["date"] == "", "Undated").otherwise(e["date"]), F.lit(": "), e["event"], F.lit(" (Document "), e["document_id"], F.lit(", pages "), _span(e), F.lit(")"))
    point = F.transform(F.filter(docs, lambda d: d["defense_relevance"] != ""), lambda d: F.concat(F.lit("Pages "), _span(d), F.lit(" ("), d["label"], F.lit("): "), d["defense_relevance"]))
    watch = F.array_distinct(F.concat(F.coalesce("global_ocr_watchlist", F.array().cast("array<string>")), F.flatten(F.transform(docs, lambda d: d["ocr_watchlist"]))))
    out = joined(
        "# Defense Workbench", "", PACKET_INTRO, "", "## Bundle Snapshot", "", F.concat(F.lit("- Source PDF: "), F.col("source_pdf")), F.concat(F.lit("- Total pages: "), _n(F.col("page_total"))),
        F.concat(F.lit("- Logical documents inferred: "), _n(F.size(docs))), said("- Bundle description: ", F.col("bundle_description")), "", "## Document Map", "", lines_of(place),
        section("People and Roles", bullets(F.transform(people_of(docs), person))), section("Chronology", bullets(F.transform(events_of(docs), event))), section("Topics", bullets(distinct_of(docs, "topics"))),
        section("Evidence and Materials", bullets(distinct_of(docs, "evidence_types"))), "", "## Defense-Relevant Review Points", "", bullets(point), section("OCR / Verification Watchlist", bullets(watch)),
    )
    return rows.select(key, strip(out).alias("rendered"))


def reviewed_context(reviewed: DataFrame, bundles: DataFrame, key: str) -> DataFrame:
    """Reviewed documents (number, label, page_start, page_end, document_type, summary, cleaned_text) of each bundle."""
    part = joined(
        "", _heading(), "", F.concat(F.lit("Pages: "), _n(F.col("page_start")), F.lit("-"), _n(F.col("page_end"))), F.concat(F.lit("Type: "), F.col("document_type")), said("Summary: ", F.col("summary")), "", strip(text_of("cleaned_text"))
    )
    whole = reviewed.groupBy(key).agg(F.count("*").alias("n"), ordered(part, F.col("number"), "\n").alias("parts"))
    out = joined(
        "# Reviewed Case File Bundle", "", F.concat(F.lit("Source PDF: "), F.col("source_pdf")), F.concat(F.lit("Total pages: "), _n(F.col("page_total"))), F.concat(F.lit("Logical documents: "), _n(F.col("n"))), "", REVIEWED_INTRO, F.col("parts")
    )
    return bundles.join(whole, key).select(key, strip(out).alias("rendered"))


def review_notes(reviewed: DataFrame, bundles: DataFrame, key: str) -> DataFrame:
    """What reviewers left open (``uncertainties``), document by document."""
    part = joined("", _heading(), "", F.coalesce(bullets(F.col("uncertainties")), F.lit(NO_DOUBTS)))
    whole = reviewed.groupBy(key).agg(ordered(part, F.col("number"), "\n").alias("parts"))
    out = joined("# Review Notes", "", NOTES_INTRO, section("Bundle-Level OCR Risks", bullets(F.col("global_ocr_watchlist"))), F.col("parts"))
    return bundles.join(whole, key).select(key, strip(out).alias("rendered"))


def cleaned_markdown(pages: DataFrame, bundles: DataFrame, key: str, page: str, text: str, title: str, intro: str) -> DataFrame:
    part = joined("", F.concat(F.lit("## Page "), _n(F.col(page))), "", F.when(text_of(text) != "", F.col(text)).otherwise(NOT_KEPT))
    whole = pages.groupBy(key).agg(F.count("*").alias("n"), ordered(part, F.col(page), "\n").alias("parts"))
    out = joined(f"# {title}", "", F.concat(F.lit("Source PDF: "), F.col("source_pdf")), F.concat(F.lit("Total pages: "), _n(F.col("n"))), "", intro, F.col("parts"))
    return bundles.join(whole, key).select(key, strip(out).alias("rendered"))


def case_index(entries: DataFrame, bundles: DataFrame, key: str) -> DataFrame:
    """The index of a bundle put together by hand."""
    watch = F.when(F.size("ocr_watchlist") > 0, joined("  OCR watchlist:", bullets(F.col("ocr_watchlist"), "  - ")))
    item = joined(
        "", F.concat(F.lit("- Pages "), _n(F.col("page_start")), F.lit("-"), _n(F.col("page_end")), F.lit(": "), F.col("label"), F.lit(" ["), F.col("document_type"), F.lit("]")),
        F.concat(F.lit("  Summary: "), text_of("summary")), F.concat(F.lit("  Defense relevance: "), text_of("defense_relevance")), watch,
    )
    whole = entries.groupBy(key).agg(F.count("*").alias("n"), ordered(item, F.col("number"), "\n").alias("items"))
    out = joined(
        "# Manual Case Index", "", INDEX_INTRO, "", "## Bundle Snapshot", "", F.concat(F.lit("- Source PDF: "), F.col("source_pdf")), F.concat(F.lit("- Total pages: "), _n(F.col("page_total"))), F.concat(F.lit("- Logical documents: "), _n(F.col("n"))),
        F.concat(F.lit("- Bundle description: "), text_of("bundle_description")), "", "## Document Map", F.col("items"), section("Bundle Notes", bullets(F.col("bundle_notes"))), section("Global OCR Watchlist", bullets(F.col("global_ocr_watchlist"))),
    )
    return bundles.join(whole, key).select(key, strip(out).alias("rendered"))


def grouped_context(entries: DataFrame, pages: DataFrame, bundles: DataFrame, key: str, page: str, text: str) -> DataFrame:
    """Cleaned pages under their logical documents; ``text`` is clean already."""
    watch = F.when(F.size("ocr_watchlist") > 0, joined("OCR watchlist:", bullets(F.col("ocr_watchlist"))))
    head = joined(
        "", _heading(), "", F.concat(F.lit("Pages: "), _n(F.col("page_start")), F.lit("-"), _n(F.col("page_end"))), F.concat(F.lit("Type: "), F.col("document_type")), F.concat(F.lit("Confidence: "), F.col("confidence")),
        F.concat(F.lit("Summary: "), text_of("summary")), F.concat(F.lit("Defense relevance: "), text_of("defense_relevance")), watch,
    )
    below = _pages_below(entries, pages, key, page, F.when(text_of(text) != "", F.col(text)).otherwise(NOT_KEPT))
    whole = entries.join(below, [key, "number"]).groupBy(key).agg(F.count("*").alias("n"), ordered(joined(head, F.col("pages_text")), F.col("number"), "\n").alias("parts"))
    out = joined("# Grouped Case File Bundle", "", GROUPED_INTRO, "", F.concat(F.lit("Source PDF: "), F.col("source_pdf")), F.concat(F.lit("Total pages: "), _n(F.col("page_total"))), F.concat(F.lit("Logical documents: "), _n(F.col("n"))), F.col("parts"))
    return bundles.join(whole, key).select(key, strip(out).alias("rendered"))


def cleanup_report(counts: DataFrame, bundles: DataFrame, key: str) -> DataFrame:
    """What cleaning took out: ``counts`` as ``lines.artifact_counts`` gives them by ``key``; ``bundles`` has source_dir,
    source_pdf, page_total and empty_pages."""
    pages = F.when(F.size("pages") > 0, F.concat(F.lit(" (pages: "), F.array_join("pages", ", "), F.lit(")"))).otherwise("")
    line = F.concat(F.lit("- `"), F.col("label"), F.lit("`: "), F.col("removed").cast("string"), pages)
    whole = counts.groupBy(key).agg(ordered(line, F.col("ord"), "\n").alias("items"))
    out = joined(
        "# Local Cleanup Report", "", F.concat(F.lit("Source OCR directory: "), F.col("source_dir")), F.concat(F.lit("Source PDF: "), F.col("source_pdf")), F.concat(F.lit("Total pages: "), _n(F.col("page_total"))),
        F.concat(F.lit("Pages with no retained text after cleanup: "), _n(F.size("empty_pages"))), F.when(F.size("empty_pages") > 0, F.concat(F.lit("Empty pages after cleanup: "), F.array_join("empty_pages", ", "))),
        "", "## Removed Artifact Counts", "", F.col("items"),
    )
    return bundles.join(whole, key).select(key, strip(out).alias("rendered"))


def risk_report(counts: DataFrame, entries: DataFrame, bundles: DataFrame, key: str, areas: list[str]) -> DataFrame:
    """Where a cleaned bundle is still risky; ``areas`` are lines that were written for it by hand."""
    taken = F.when((F.col("label") != "camscanner") & (F.size("pages") > 0), F.concat(F.lit("- Removed `"), F.col("label"), F.lit("` hallucination lines from pages: "), F.array_join("pages", ", "), F.lit(".")))
    marks = F.max(F.when(F.col("label") == "camscanner", F.size("pages"))).alias("marks")
    alerts = counts.groupBy(key).agg(ordered(taken, F.col("ord"), "\n").alias("taken"), marks)
    watch = F.when(F.size("ocr_watchlist") > 0, F.concat(F.lit("- Pages "), _n(F.col("page_start")), F.lit("-"), _n(F.col("page_end")), F.lit(" ("), F.col("label"), F.lit("): "), F.array_join("ocr_watchlist", "; ")))
    whole = entries.groupBy(key).agg(ordered(watch, F.col("number"), "\n").alias("watch"))
    out = joined(
        "# OCR Risk Report", "", RISK_INTRO, "", "## Cleanup Alerts", "", F.when(F.col("taken") != "", F.col("taken")), F.concat(F.lit("- Removed scanner watermark lines from "), _n(F.coalesce("marks", F.lit(0))), F.lit(" pages.")),
        section("Bundle-Level Risks", bullets(F.col("global_ocr_watchlist"))), "", "## Page-Specific High-Risk Areas", "", *[f"- {a}" for a in areas], "", "## Document Watchlist", "", F.when(F.col("watch") != "", F.col("watch")),
    )
    return bundles.join(alerts, key).join(whole, key, "left").select(key, strip(out).alias("rendered"))


# Heads of the texts that the corpus scripts leave, and what stands for a page without text.
HEADS = {
    "disclosure": ("Extraction: local deterministic OCR only. No OpenAI, Gemini, or external LLM/API calls.", "Engines compared per page: native/glyph PDF extraction + Tesseract ara+eng variants."),
    "statement": ("Extraction: local deterministic OCR/text extraction only. No OpenAI, Gemini, cloud OCR, or external LLM/API calls.", "Engines compared per page: native PDF text + local Tesseract eng OCR variants."),
    "upload": ("Extraction: deterministic native/glyph PDF text extraction; OCR required only when audit flags a bad or empty text layer.",),
}
EMPTY = {"disclosure": "[NO TEXT EXTRACTED BY LOCAL OCR]", "statement": "[NO TEXT EXTRACTED BY LOCAL OCR]", "upload": "[NO TEXT EXTRACTED]", "case": "[صفحة مرفق/صورة. لم يستخرج OCR المحلي نصا عربيا موثوقا منها.]"}


def _psm(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def page_note(kind: str) -> Column:
    """What a page's mark says of its source, for pages with engine, variant, psm and counts (chars, arabic_chars, digits), or
    with source, quality_status and quality_issues."""
    if kind == "upload":
        issues = F.when(F.size("quality_issues") > 0, F.concat(F.lit("; issues="), F.array_join("quality_issues", ","))).otherwise("")
        return F.concat(F.lit("source="), F.col("source"), F.lit("; quality="), F.col("quality_status"), issues)
    last = F.concat(F.lit("; digits="), _n(F.col("digits"))) if kind == "statement" else F.concat(F.lit("; arabic="), _n(F.col("arabic_chars")))
    return F.concat(F.lit("source="), _psm(F.col("engine")), F.lit(":"), _psm(F.col("variant")), F.lit("/psm="), _psm(F.col("psm")), F.lit("; chars="), _n(F.col("chars")), last)


def document_with_head(pages: DataFrame, files: DataFrame, key: str, kind: str, page: str = "page", text: str = "text") -> DataFrame:
    """A document's text under its head, every page behind a mark; ``files`` has name, sha256 and page_count."""
    mark = F.concat(F.lit("===== Page "), _n(F.col(page)), F.lit(" ("), page_note(kind), F.lit(") ====="))
    body = strip(text_of(text))
    part = joined(mark, F.when(body == "", EMPTY[kind]).otherwise(body), "")
    whole = pages.groupBy(key).agg(ordered(part, F.col(page), "\n").alias("parts"))
    out = joined(F.concat(F.lit("Source PDF: "), F.col("name")), F.concat(F.lit("SHA256: "), F.col("sha256")), F.concat(F.lit("Pages: "), _n(F.col("page_count"))), *HEADS[kind], "", F.col("parts"))
    return files.join(whole, key, "left").select(key, F.concat(strip(out), F.lit("\n")).alias("rendered"))


def marked_pages(pages: DataFrame, key: str, page: str = "page", text: str = "text", empty: str = "") -> DataFrame:
    """Pages behind plain marks, an empty line between."""
    body = strip(text_of(text))
    part = F.regexp_replace(F.concat(F.lit("===== Page "), _n(F.col(page)), F.lit(" =====\n"), F.when(body == "", empty).otherwise(body)), r"(?U)\s+\z", "")
    return pages.groupBy(key).agg(F.concat(strip(ordered(part, F.col(page), "\n\n")), F.lit("\n")).alias("rendered"))


def titled_markdown(pages: DataFrame, files: DataFrame, key: str, policy: str, page: str = "page", text: str = "text", empty: str = "") -> DataFrame:
    """Markdown under the file's title and a line on how it was read; ``files`` has title."""
    body = strip(text_of(text))
    part = joined(F.concat(F.lit("## Page "), _n(F.col(page))), "", F.when(body == "", empty).otherwise(body), "")
    whole = pages.groupBy(key).agg(ordered(part, F.col(page), "\n").alias("parts"))
    out = joined(F.concat(F.lit("# "), F.col("title")), "", policy, "", F.col("parts"))
    return files.join(whole, key, "left").select(key, F.concat(strip(out), F.lit("\n")).alias("rendered"))


def first_lines(pages: DataFrame, key: str, n: int = 3, page: str = "page", text: str = "text") -> DataFrame:
    """The first lines of a document's first page with any (``lines``)."""
    own = pages.select(key, F.col(page).alias("page"), full_lines(text_of(text)).alias("l")).filter(F.size("l") > 0)
    return own.groupBy(key).agg(F.slice(F.min_by("l", "page"), 1, n).alias("lines"))


def chat_markdown(pages: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Markdown of a paper sent by chat: what is known of the file, its first lines, then its pages with their source.
    ``pages``: page, text, engine, variant, psm, native_status, status, chars, arabic_chars; ``files``: name, title, sha256,
    page_count, embedded_pages, embedded_chars, duplicate_of."""
    source = F.concat(_psm(F.col("engine")), F.lit(":"), _psm(F.col("variant")), F.when(F.col("psm").isNotNull(), F.concat(F.lit("/psm="), _n(F.col("psm")))).otherwise(""))
    note = F.concat(F.lit("_Source: "), source, F.lit("; native_quality="), _psm(F.col("native_status")), F.lit("; chosen_quality="), F.col("status"), F.lit("; chars="), _n(F.col("chars")), F.lit("; arabic="), _n(F.col("arabic_chars")), F.lit("_"))
    body = strip(text_of("text"))
    part = joined(F.concat(F.lit("## Page "), _n(F.col("page"))), "", note, "", F.when(body == "", "[NO TEXT EXTRACTED BY LOCAL PIPELINE]").otherwise(body), "")
    whole = pages.groupBy(key).agg(ordered(part, F.col("page"), "\n").alias("parts"))
    opening = F.when(F.size("lines") > 0, joined("- First readable lines:", bullets(F.col("lines"), "  - ")))
    same = F.when(F.col("duplicate_of").isNotNull(), F.concat(F.lit("- Duplicate of: `"), inline_code(F.col("duplicate_of")), F.lit("`")))
    out = joined(
        F.concat(F.lit("# "), F.col("title")), "", "## Document Metadata", "", F.concat(F.lit("- Source PDF: `"), inline_code(F.col("name")), F.lit("`")), F.concat(F.lit("- SHA256: `"), F.col("sha256"), F.lit("`")),
        F.concat(F.lit("- Pages: "), _n(F.col("page_count"))), F.concat(F.lit("- Embedded text pages: "), _n(F.col("embedded_pages"))), F.concat(F.lit("- Embedded text characters: "), _n(F.col("embedded_chars"))),
        "- Extraction mode: local native/glyph text extraction with local Tesseract fallback on weak pages", "- External services: none; no OpenAI, Gemini, cloud OCR, or external LLM/API calls", same, opening, "", "---", "", F.col("parts"),
    )
    rows = files.join(whole, key, "left").join(first_lines(pages, key), key, "left")
    return rows.select(key, F.concat(strip(out), F.lit("\n")).alias("rendered"))


def truncated_list(values: Column, n: int) -> Column:
    """The first n of a list, with three dots if there are more."""
    shown = F.array_join(F.slice(values, 1, n), ", ")
    return F.when(F.size(values) > n, F.concat(shown, F.lit(", ..."))).otherwise(shown)


def inline_code(c: Column) -> Column:
    return F.translate(c, "`", "'")


def to_pages_json(pages: DataFrame, key: str, fields: tuple[str, ...] = ("page", "text", "confidence", "source_kind")) -> DataFrame:
    """The nested document tree as JSON: pages in order (the first field), with the fields that are asked for."""
    listed = F.array_sort(F.collect_list(F.struct(*fields)))
    return pages.groupBy(key).agg(listed.alias("pages")).select(key, F.to_json(F.struct(F.col(key).alias("source"), "pages")).alias("json"))
