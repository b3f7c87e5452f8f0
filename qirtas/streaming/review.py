"""Review of documents by a model, in one go or as their pages come in.

A document's pages are packed into segments (``casefile.review_segments``), each is sent to a reviewer, and the replies make
the document's cleaned text and doubts. As a stream, a document waits in keyed state until its last page is there; a segment
whose review fails is tried again, at once or after a while, and the number of its attempts is part of the state. A
document's rows leave the state once, together, and are written under the number of their batch, so a restart that runs a
batch again replaces its rows.

Defined results: a page that comes twice counts once, with the smallest of its texts; pages beyond a document's number of
pages, or that come once it is done, change nothing; a document of which pages never come is never reviewed; a reply without
cleaned text keeps the raw text and says so; a segment that fails ``attempts`` times makes its document ``failed``, with the
raw text kept, so that a later run may take it up again (``casefile.pending`` on the reviewed ones). Null texts are empty. In
the state a finished document is one flag.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from qirtas.functions.text import strip, text_of
from qirtas.operators import casefile

# Attempts, sizes of segments, the note where a model gave no text, the lines of a request.
ATTEMPTS, MAX_CHARS, MAX_PAGES = 3, 3000, 2
EMPTY_REPLY = "Review model returned empty cleaned text; raw OCR chunk was preserved."
RAW_FOLLOWS = "Raw OCR text follows:\n"
REPLY = "segment long, page_start long, page_end long, raw_text string, reply string, error string, attempts int"
STATE = "kept string, finished boolean"


class Reviewer(Protocol):
    """Made once a task. ``attempt`` counts from 1; a failure raises."""

    def review(self, raw_text: str, attempt: int) -> str: ...


def request_text(prompt: str, label: Column, kind: Column, start: Column, end: Column, summary: Column, risks: Column, raw: Column) -> Column:
    """What a model is asked: the prompt, what is known of the document, and the text."""
    said = lambda name, c, default="": F.concat(F.lit(f"{name}: "), F.coalesce(c.cast("string"), F.lit(default)), F.lit("\n"))
    pages = F.concat(F.lit("Pages: "), start.cast("string"), F.lit("-"), end.cast("string"), F.lit("\n"))
    watch = F.array_join(F.coalesce(risks, F.array().cast("array<string>")), "; ")
    return F.concat(F.lit(f"{prompt}\n\n"), said("Document label", label, "Unknown"), said("Document type", kind, "unknown"), pages, said("Summary hint", summary), said("Known OCR risks", watch), F.lit(f"\n{RAW_FOLLOWS}"), text_of(raw))


def asked(reviewer: Reviewer, raw: str, before: int, upto: int) -> tuple[str | None, str | None, int]:
    """Reply, error and attempts in all, after at most ``upto`` attempts of which ``before`` were made earlier."""
    error = None
    for attempt in range(before + 1, upto + 1):
        try:
            return reviewer.review(raw, attempt), None, attempt
        except Exception as e:  # noqa: BLE001  a review that fails is tried again, then a row that says so
            error = str(e) or type(e).__name__
    return None, error, max(before, upto)


def replies(segments: DataFrame, keys: list[str], make: Callable[[], Reviewer], attempts: int = ATTEMPTS) -> DataFrame:
    """Segments (segment, page_start, page_end, raw_text) with their replies; failures are rows with an error."""
    schema = "".join(f"`{k}` {segments.schema[k].dataType.simpleString()}, " for k in keys) + REPLY

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reviewer = make()
        for batch in batches:
            found = [asked(reviewer, raw, 0, attempts) for raw in batch["raw_text"]]
            out = pd.DataFrame(found, columns=["reply", "error", "attempts"], index=batch.index).astype({"reply": object, "error": object, "attempts": "int32"})
            yield pd.concat([batch, out], axis=1)

    return segments.select(*keys, "segment", "page_start", "page_end", "raw_text").mapInPandas(ask, schema)


def reviewed(replies: DataFrame, keys: list[str]) -> DataFrame:
    """A row a document: cleaned text, doubts with their pages, attempts and status. A document's segments come together."""
    parts = F.array_sort(F.collect_list(F.struct("segment", "page_start", "page_end", "raw_text", "reply", "error", "attempts")))
    rows = replies.groupBy(*keys).agg(parts.alias("parts"))
    read = F.transform("parts", lambda p: F.struct(p.alias("p"), casefile.parse_review(p["reply"]).alias("r")))
    empty = lambda x: x["p"]["error"].isNull() & (text_of(x["r"]["cleaned_text"]) == "")
    cleaned = lambda x: F.when(text_of(x["r"]["cleaned_text"]) == "", x["p"]["raw_text"]).otherwise(x["r"]["cleaned_text"])
    own = lambda x: F.coalesce(x["r"]["uncertainties"], F.array().cast("array<string>"))
    notes = lambda x: casefile.qualified(F.when(empty(x), F.concat(own(x), F.array(F.lit(EMPTY_REPLY)))).otherwise(own(x)), x["p"]["page_start"], x["p"]["page_end"])
    rows = rows.withColumn("read", read)
    texts = F.filter(F.transform("read", lambda x: strip(text_of(cleaned(x)))), lambda t: t != "")
    failed = F.exists("parts", lambda p: p["error"].isNotNull())
    return rows.select(
        *keys, strip(F.array_join(texts, "\n\n")).alias("cleaned_text"), F.flatten(F.transform("read", notes)).alias("uncertainties"),
        F.aggregate("parts", F.lit(0), lambda a, p: a + p["attempts"]).alias("attempts"), F.when(failed, "failed").otherwise("reviewed").alias("status"),
    )


def review_pages(pages: DataFrame, keys: list[str], make: Callable[[], Reviewer], page: str = "page", text: str = "text", attempts: int = ATTEMPTS, max_chars: int = MAX_CHARS, max_pages: int = MAX_PAGES) -> DataFrame:
    """All documents of a table at once."""
    once = pages.groupBy(*keys, page).agg(F.min(text_of(text)).alias(text))
    return reviewed(replies(casefile.review_segments(once, keys, page, text, max_chars, max_pages), keys, make, attempts), keys)


def packed(pages: list[tuple[int, str]], max_chars: int, max_pages: int) -> list[tuple[int, int, str]]:
    """First page, last page and text of each segment, as ``casefile.review_segments`` packs them."""
    out: list[list[tuple[int, str]]] = []
    size = 0
    for number, body in pages:
        if not out or len(out[-1]) >= max_pages or size + len(body) + 2 > max_chars:
            out.append([])
            size = -2
        out[-1].append((number, body))
        size += len(body) + 2
    return [(s[0][0], s[-1][0], "\n\n".join(b for _, b in s).strip()) for s in out]


def review_stream(pages: DataFrame, keys: list[str], make: Callable[[], Reviewer], total: str = "page_total", page: str = "page", text: str = "text", attempts: int = ATTEMPTS, at_once: int = ATTEMPTS, wait_ms: int = 5000, max_chars: int = MAX_CHARS, max_pages: int = MAX_PAGES) -> DataFrame:
    """Replies as a stream of rows, those of ``replies``; ``total`` is the number of pages of a row's document. Of the
    ``attempts``, ``at_once`` are made in one go and the others each after a wait of ``wait_ms``; only a stream that waits has
    timeouts, so one that does not can end with what is there."""
    waits = at_once < attempts
    rows = pages.select(*keys, F.col(page).cast("long").alias("page"), casefile.headed_page(F.col(page), text_of(text)).alias("body"), F.col(total).cast("long").alias("total"))
    schema = "".join(f"`{k}` {pages.schema[k].dataType.simpleString()}, " for k in keys) + REPLY
    names = [*keys, *(c.split()[0] for c in REPLY.split(", "))]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept, finished = state.get if state.exists else ("{}", False)
        held = json.loads(kept or "{}")
        seen, done, total = held.get("pages", {}), held.get("done", []), held.get("total")
        for batch in batches:
            for number, body, n in zip(batch["page"], batch["body"], batch["total"], strict=True):
                total = int(n) if total is None else total
                seen[str(number)] = min(body, seen.get(str(number), body))
        if finished:
            return
        if total is None or len(seen) < total:
            state.update((json.dumps({"pages": seen, "done": done, "total": total}), False))
            return
        reviewer = make()
        segments = packed(sorted((int(n), b) for n, b in seen.items()), max_chars, max_pages)
        done = done or [[None, None, 0] for _ in segments]
        for i, ((_, _, raw), (reply, _, before)) in enumerate(zip(segments, done, strict=True)):
            if reply is None and before < attempts:
                done[i] = list(asked(reviewer, raw, before, min(attempts, before + (at_once if not before else 1))))
        if all(reply is not None or tried >= attempts for reply, _, tried in done):
            state.update(("", True))
            yield pd.DataFrame([(*key, i, *segment, *own) for i, (segment, own) in enumerate(zip(segments, done, strict=True))], columns=[*keys, "segment", "page_start", "page_end", "raw_text", "reply", "error", "attempts"])[names]
            return
        state.update((json.dumps({"pages": seen, "done": done, "total": total}), False))
        state.setTimeoutDuration(wait_ms)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if waits else GroupStateTimeout.NoTimeout
    return rows.groupBy(*keys).applyInPandasWithState(step, schema, STATE, "append", timeout)


def write_reviews(stream: DataFrame, keys: list[str], path: str, checkpoint: str, once: bool = True):
    """Start the stream of replies; reviewed documents are kept as Parquet, those of a batch under its number. ``once`` ends
    with what is there and is for streams that don't wait."""

    def keep(batch: DataFrame, number: int) -> None:
        reviewed(batch, keys).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 second")).start()
