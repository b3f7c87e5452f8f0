"""Readings in stages: later ones count only where a gate on the best so far asks for them; checked texts come before all."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qirtas.functions.text import strip, text_of

VALIDATED_SCORE = 99999.0


def chosen(candidates: DataFrame, keys: list[str], gates: dict[int, Callable[[Column], Column]], order: list[str], stage: str = "stage", score: str = "score", text: str = "text") -> DataFrame:
    """The best candidate a key. ``gates`` tells by stage whether its candidates count, from the best of stage 0 (a
    struct of the candidate's columns); a stage also counts where stage 0 has no text. One aggregation: of every stage
    the best is kept, so a key's candidates never meet in a list."""
    names = [c for c in candidates.columns if c not in keys]
    viable = (strip(text_of(text)) != "").cast("int")
    place = F.struct(viable.alias("viable"), F.col(score).alias("score"), F.struct(*[(-F.col(c)).alias(c) for c in order]).alias("order"))
    row = F.struct(*names)
    parts = [F.max_by(F.when(F.col(stage) == s, F.struct(place.alias("place"), row.alias("row"))), F.when(F.col(stage) == s, place)).alias(f"s{s}") for s in [0, *gates]]
    best = candidates.groupBy(*keys).agg(*parts)
    out = F.col("s0")
    for s, gate in gates.items():
        asked = F.col("s0").isNull() | (F.col("s0.place.viable") == 0) | gate(F.col("s0.row"))
        out = F.when(asked & F.col(f"s{s}").isNotNull() & (out.isNull() | (F.col(f"s{s}.place") > out["place"])), F.col(f"s{s}")).otherwise(out)
    return best.select(*keys, out["row"].alias("_row")).select(*keys, "_row.*")


def overridden(pages: DataFrame, checked: DataFrame, keys: list[str], text: str = "text", score: str = "score", source: str = "source", label: str = "visual_llm_validated_from_rendered_page", points: float = VALIDATED_SCORE) -> DataFrame:
    """Pages with the text that someone checked in place of what was read, where there is one. ``checked``: keys and text."""
    own = checked.select(*keys, F.col(text).alias("_checked")).dropDuplicates(keys)
    rows = pages.join(own, keys, "left")
    have = F.col("_checked").isNotNull()
    rows = rows.withColumn(text, F.coalesce("_checked", text)).withColumn(score, F.when(have, points).otherwise(F.col(score))).withColumn(source, F.when(have, F.lit(label)).otherwise(F.col(source)))
    return rows.drop("_checked")


def engine_text(pages: DataFrame, outputs: DataFrame, keys: list[str], engine: str = "engine", text: str = "text") -> DataFrame:
    """The text of the engine that was decided on for each page. ``pages`` has keys and engine, ``outputs`` those and text;
    a page whose engine left nothing is an error."""
    rows = pages.join(outputs.select(*keys, engine, F.col(text).alias("_text"), F.lit(True).alias("_there")).dropDuplicates([*keys, engine]), [*keys, engine], "left")
    missing = F.raise_error(F.concat(F.lit("no output of "), F.col(engine)))
    return rows.withColumn(text, F.when(F.col("_there"), text_of("_text")).otherwise(missing.cast("string"))).drop("_text", "_there")
