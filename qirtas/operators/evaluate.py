"""Transcriptions against the truth and against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qirtas.functions.metrics import overlap_tokens
from qirtas.functions.text import text_of
from qirtas.functions.udfs import token_overlaps, word_error_rate


def character_error_rate(truth: Column, found: Column) -> Column:
    """Edit distance over the truth's length; for an empty truth 0 if nothing was found and else 1."""
    a, b = text_of(truth), text_of(found)
    return F.when(a == "", F.when(b == "", 0.0).otherwise(1.0)).otherwise(F.levenshtein(a, b) / F.length(a))


def evaluated(found: DataFrame, truth: DataFrame, key: str, text: str, true_text: str) -> DataFrame:
    """Error rates where there is a truth, nulls where there is none."""
    rows = found.join(truth, key, "left")
    have = F.col(true_text).isNotNull()
    return rows.withColumn("cer", F.when(have, character_error_rate(F.col(true_text), F.col(text)))).withColumn("wer", F.when(have, word_error_rate(true_text, text)))


def document_overlap(pairs: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """Share of the left text's tokens that the right text has, for whole documents: a join on key and token,
    where comparing two lists would take their product."""
    a = pairs.select(key, F.explode(overlap_tokens(F.col(left))).alias("token")).groupBy(key, "token").agg(F.count("*").alias("n"))
    b = pairs.select(key, F.explode(F.array_distinct(overlap_tokens(F.col(right)))).alias("token"), F.lit(1).alias("there"))
    shared = a.join(b, [key, "token"], "left").groupBy(key).agg((F.sum(F.when(F.col("there") == 1, F.col("n")).otherwise(0)) / F.sum("n")).alias("overlap"))
    return pairs.select(key).join(shared, key, "left").select(key, F.coalesce("overlap", F.lit(0.0)).alias("overlap"))


def pairwise_overlap(texts: DataFrame, key: str, config: str, text: str) -> DataFrame:
    """Token overlap both ways of every two configurations of one document, by name. A document's few texts come
    together as tokens, made once a text; a set of each makes the work grow with the tokens and not their product."""
    rows = texts.filter(F.col(key).isNotNull()).select(key, F.struct(F.col(config).alias("config"), F.array_join(overlap_tokens(F.col(text)), " ").alias("tokens")).alias("t"))
    whole = rows.groupBy(key).agg(F.collect_list("t").alias("t")).select(F.col(key).alias("key"), "t.config", "t.tokens")
    kinds = {"key": whole.schema["key"].dataType, "config": T.StringType(), "other": T.StringType(), "left_in_right": T.DoubleType(), "right_in_left": T.DoubleType()}
    sides = whole.mapInArrow(token_overlaps, T.StructType([T.StructField(n, k) for n, k in kinds.items()]))
    return sides.select(F.col("key").alias(key), "config", "other", F.round("left_in_right", 4).alias("left_in_right"), F.round("right_in_left", 4).alias("right_in_left"))
