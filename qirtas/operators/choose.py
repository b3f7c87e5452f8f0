"""The choice among candidate texts: best of many, primary against secondary, native against recognised,
retries in order, stitching of chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qirtas.functions.metrics import low_quality, page_score, quality_score, sanitised, token_stats
from qirtas.functions.text import EASTERN, INVISIBLE, MARKS_WIDE, TATWEEL, WESTERN, cleaned_if_arabic, compose, full_lines, let, normalise_legacy, squeeze, strip, text_of
from qirtas.functions.udfs import similarity, word_agreement


def ranked(candidates: DataFrame, keys: list[str], score: str = "score", order: str = "ord", text: str = "text") -> DataFrame:
    """``rank`` from 1 within the keys: texts that aren't blank first, by falling score, the first on ties."""
    viable = (strip(text_of(text)) != "").cast("int")
    by = Window.partitionBy(*keys).orderBy(viable.desc(), F.col(score).desc(), F.col(order))
    return candidates.withColumn("rank", F.row_number().over(by))


def best(candidates: DataFrame, keys: list[str], **columns: str) -> DataFrame:
    return ranked(candidates, keys, **columns).filter("rank = 1").drop("rank")


def top(candidates: DataFrame, keys: list[str], n: int, **columns: str) -> DataFrame:
    return ranked(candidates, keys, **columns).filter(F.col("rank") <= n)


def documents_needing_ocr(pages: DataFrame, doc: str, text: str, failed: Column) -> DataFrame:
    """A document is read again if it has no text at all, or a page that is empty or failed."""
    blank = strip(text_of(text)) == ""
    return pages.groupBy(doc).agg((F.bool_and(blank) | F.bool_or(blank | failed)).alias("needs_ocr"), F.count("*").alias("pages"), F.sum(blank.cast("long")).alias("empty_pages"))


def decided(a: Column, b: Column) -> Column:
    """Which rule of the merge applies to two normalised texts: a side, or ``verify``."""
    return let(F.struct(quality_score(a).alias("q"), quality_score(b).alias("r")), lambda s: _decided(a, b, s["q"], s["r"]))


def _decided(a: Column, b: Column, q: Column, r: Column) -> Column:
    ratio = F.length(a) / F.greatest(F.length(b), F.lit(1))
    far = (a != "") & (b != "") & ((ratio > 1.3) | (ratio < 0.7))
    return (
        F.when(far & (q > r + 0.2), "primary_quality").when(far & (r > q + 0.2), "secondary_quality")
        .when(far & (F.length(a) <= F.length(b)), "primary_shorter").when(far, "secondary_shorter")
        .when((a == "") & (b != ""), "secondary_only").when((a != "") & (b == ""), "primary_only").when((a == "") & (b == ""), "neither").otherwise("verify")
    )


def normal_output(c: Column) -> Column:
    return normalise_legacy(sanitised(c))


def merge_pairs(pairs: DataFrame, primary: str, secondary: str) -> DataFrame:
    """Adds ``rule``, ``merged_text`` and ``confidence``; difflib is handed only the texts of pairs that need it."""
    sides = F.struct(normal_output(F.col(primary)).alias("_a"), normal_output(F.col(secondary)).alias("_b"))
    both = let(sides, lambda x: F.struct(x["_a"].alias("_a"), x["_b"].alias("_b"), decided(x["_a"], x["_b"]).alias("rule")))
    rows = pairs.withColumn("_m", both).select("*", F.inline(F.array("_m"))).drop("_m")  # a generator: what it gives is not made anew for each use
    checked, neither = F.col("rule") == "verify", F.col("rule") == "neither"
    asked = word_agreement(F.when(checked, F.col("_a")), F.when(checked, F.col("_b")))
    text = F.when(F.col("rule").startswith("secondary"), F.col("_b")).when(neither, "").otherwise(F.col("_a"))
    rows = rows.withColumn("_v", asked).withColumn("merged_text", text).withColumn("confidence", F.when(checked, F.col("_v.confidence")).when(neither, 0.0).otherwise(0.5))
    return rows.drop("_a", "_b", "_v")


def better_pages(pairs: DataFrame, native: str, recognised: str) -> DataFrame:
    """Adds ``winner``, ``chosen`` and ``skipped_reason``; the recognised text wins only with a strictly higher score."""
    clean = lambda c: cleaned_if_arabic(text_of(c), otherwise=strip)
    rows = pairs.withColumn("_a", clean(F.col(native))).withColumn("_b", clean(F.col(recognised)))
    rows = rows.withColumn("_wins", (F.col("_b") != "") & (page_score(F.col("_b")) > page_score(F.col("_a"))))
    rows = rows.withColumn("winner", F.when(F.col("_wins"), "ocr").otherwise("native")).withColumn("chosen", F.when(F.col("_wins"), F.col("_b")).otherwise(F.col("_a")))
    return rows.withColumn("skipped_reason", F.when(F.col("_b") == "", "ocr_empty")).drop("_a", "_b", "_wins")


def adjudicated(pairs: DataFrame, native: str, recognised: str, resolved: str | None = None, enough: float = 0.92) -> DataFrame:
    """Adds ``decision`` (a struct of text, confidence, source, digit_agreement, similarity): a native page text against
    the recognised one. ``resolved`` is a column that a resolver left, if there is one; it decides where neither text
    stands alone and they differ. Similarity is asked for only where both have characters."""
    from qirtas.functions.fields import numbers

    rows = pairs.withColumn("_a", text_of(native)).withColumn("_b", text_of(recognised))
    both = (F.col("_a") != "") & (F.col("_b") != "") & (F.col("_a") != F.col("_b"))
    plain, asked = rows.filter(~both), rows.filter(both)
    plain = plain.withColumn("_s", F.when(F.col("_a") == F.col("_b"), 1.0).otherwise(0.0))
    rows = plain.unionByName(asked.withColumn("_s", similarity("_a", "_b")).withColumn("_t", similarity("_b", "_a")), allowMissingColumns=True)
    rows = rows.withColumn("_same", numbers(F.col("_a")) == numbers(F.col("_b"))).withColumn("_t", F.coalesce("_t", "_s"))
    a, b, s, same = F.col("_a"), F.col("_b"), F.col("_s"), F.col("_same")
    full_a, full_b = strip(a) != "", strip(b) != ""
    bonus = F.when(same, 0.25).otherwise(0.0)
    better = full_b & (F.when(b == "", 0.0).otherwise(F.col("_t") + bonus) > F.when(a == "", 0.0).otherwise(s + bonus))
    unsure = F.greatest(F.lit(0.4), F.least(F.lit(0.75), s))
    out = lambda text, confidence, source: F.struct(text.alias("text"), confidence.cast("double").alias("confidence"), F.lit(source).alias("source"), same.alias("digit_agreement"), s.alias("similarity"))
    found = strip(text_of(resolved)) != "" if resolved else F.lit(False)
    decision = (
        F.when(full_a & (a == b), out(a, F.lit(1.0), "native_confirmed_by_ocr")).when(full_a & (s >= enough) & same, out(a, F.greatest(F.lit(0.85), s), "native_confirmed_by_ocr"))
        .when(~full_a & full_b, out(b, F.lit(0.75), "ocr_only")).when(full_a & ~full_b, out(a, F.lit(0.75), "native_only"))
        .when(found, out(text_of(resolved) if resolved else a, F.lit(0.8), "page_resolver")).when(better, out(b, unsure, "ocr_preferred")).otherwise(out(a, unsure, "native_preferred"))
    )
    return rows.withColumn("decision", decision).drop("_a", "_b", "_s", "_t", "_same")


def worth_comparing(native: Column, maybe_arabic: Column) -> Column:
    """Whether a native page text is read against the recognised one at all."""
    return (strip(text_of(native)) != "") & F.coalesce(maybe_arabic, F.lit(False))


def rescue_trigger(c: Column, area: Column) -> Column:
    """Why a region deserves another pass: empty, low quality, too few tokens for its area; else null."""
    t = strip(text_of(c))
    stats = token_stats(t)
    n = stats["token_count"]
    return (
        F.when(t == "", "empty").when(low_quality(stats), "low_quality")
        .when((area >= 6_000_000) & (n < F.greatest(F.lit(40), F.floor(area / 140_000))), "sparse_large_crop").when((area >= 1_000_000) & (n < 24), "under_read_large_crop")
    )


def improves(score: Column, n: Column, best_score: Column, best_n: Column) -> Column:
    """A clear gain, a modest gain with more text, or any gain on nothing."""
    return (score > best_score + 0.2) | ((score > best_score + 0.05) & (n >= F.floor(best_n * 1.15))) | ((best_score < 0) & (score > best_score))


def rescued(first: Column, tries: Column) -> Column:
    """The best so far over tries in their order; both are (name, score, n) structs."""
    return F.aggregate(tries, first, lambda best_, x: F.when(improves(x["score"], x["n"], best_["score"], best_["n"]), x).otherwise(best_))


def line_signature(c: Column) -> Column:
    """The legacy normal form of a line; its compatibility form, if it needs one, is made before (``stitched_chunks``)."""
    c = F.translate(F.translate(c, INVISIBLE + TATWEEL, ""), EASTERN + "أإآٱى", WESTERN + "ااااي")
    return squeeze(F.regexp_replace(c, MARKS_WIDE, ""))


def stitched(chunks: Column, signs: Column, longest: int = 6) -> Column:
    """Lines of chunks in order, each chunk without the lines (at most ``longest``) that the text so far ends with.
    ``signs``: for each chunk a text of the same lines to compare by."""
    line = "array<struct<t:string,s:string>>"

    def overlap(have: Column, new: Column) -> Column:
        limit = F.least(F.size(have), F.size(new), F.lit(longest))
        k = F.when(limit > 0, F.sequence(limit, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
        sign = lambda a: F.transform(a, lambda x: x["s"])
        same = F.filter(k, lambda i: sign(F.slice(have, F.size(have) - i + 1, i)) == sign(F.slice(new, F.lit(1), i)))
        return F.coalesce(F.try_element_at(same, F.lit(1)), F.lit(0))

    def add(have: Column, new: Column) -> Column:
        rest = F.slice(new, overlap(have, new) + 1, F.greatest(F.size(new), F.lit(1)))
        return F.when(F.size(new) == 0, have).when(F.size(have) == 0, new).otherwise(F.concat(have, rest))

    pairs = F.transform(F.arrays_zip(chunks.alias("t"), signs.alias("s")), lambda x: F.arrays_zip(full_lines(x["t"]).alias("t"), F.transform(full_lines(x["s"]), line_signature).alias("s")))
    whole = F.aggregate(F.transform(pairs, lambda p: F.transform(p, lambda x: F.struct(x["t"].alias("t"), x["s"].alias("s")))), F.array().cast(line), add)
    return F.array_join(F.transform(whole, lambda x: x["t"]), "\n")


def stitched_chunks(chunks: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """One stitched ``text`` a key from chunk rows in order."""
    rows = chunks.withColumn("_t", text_of(text)).withColumn("_s", compose(F.col("_t")))
    listed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("_t").alias("t"), F.col("_s").alias("s")))).alias("c"))
    return listed.select(*keys, stitched(F.transform("c", lambda x: x["t"]), F.transform("c", lambda x: x["s"])).alias("text"))
