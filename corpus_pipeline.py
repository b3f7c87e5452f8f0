"""A training corpus in five stages: language, near duplicates, repeated passages, source mix, pieces.

Each stage takes the documents that the one before kept, written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.llm.language import UNKNOWN, predict_language
from qirtas.llm.mixing import mixed_documents
from qirtas.llm.pieces import piece_summary
from qirtas.llm.queries import PIECES, remainder, table, vocabulary
from qirtas.llm.repeats import remove_repeats
from qirtas.llm.shared import in_sieve, whole_row, write_table
from qirtas.llm.similar import similar_components

SEPARATORS = r"[\x20\x09-\x0D]+"
SURE = 0.8  # score from which a predicted language is taken for a missing one


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, whether or not a model could be fitted. A null language becomes the
    predicted one if its score is at least ``SURE``; others stay as they are, so no clean text is lost to a guess.

    A null or empty text has no letter and goes; repeated rows stay, each; null doc_ids stay; extra columns, whatever
    their names, are passed on; an empty table gives no rows."""
    out = predict_language(docs, lambda d: remainder(d, 4) != 2, keep=docs.columns)
    out = out.filter((F.col("lang_pred") != UNKNOWN) | F.col("row.text").rlike(r"\p{L}"))
    found = F.when((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= SURE), F.col("lang_pred"))
    return out.select(F.col("row").withField("lang", F.coalesce("row.lang", found)).alias("row")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are alike, directly or through others, the one with the smallest doc_id stays.

    Rows are told apart by doc_id and text, so of two texts under one doc_id each follows its own group. Documents without
    words are like nothing and stay; of rows with one doc_id that are all to stay, those with equal
    texts are one; a null doc_id stays only where no other of its group has one; extra columns, whatever their names, are
    passed on; an empty table gives no rows."""
    found = similar_components(docs)
    stay = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias("key"), "text_key").agg(F.count("*").alias("times"))
    rows = docs.select(F.col("doc_id").alias("own"), F.xxhash64("doc_id", "text").alias("own_key"), whole_row(docs).alias("row"))
    rows = rows.join(stay, F.col("own").eqNullSafe(F.col("key")) & (F.col("own_key") == F.col("text_key")))
    once = rows.filter("times = 1").select("row.*")
    return once.unionByName(rows.filter("times > 1").withColumn("text", F.col("row.text")).dropDuplicates(["own", "text"]).select("row.*"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay in the document with the smallest doc_id; a document of which
    nothing is left goes.

    Null, empty and short texts stay as they are, and so do rows with a null doc_id; repeated rows are changed each;
    ``n_chars``, where there is one, follows a changed text; extra columns, whatever their names, are passed on; an empty
    table gives no rows. Only documents that may have changed are shuffled."""
    changed = remove_repeats(docs).filter("kept is not null").select(F.col("doc_id").alias("key"), F.col("words_sha256").alias("sha"), "kept").dropDuplicates(["key", "sha"])
    changed = write_table(changed, "stage-changed")
    packed = docs.select(F.col("doc_id").alias("own"), whole_row(docs).alias("row"))
    packed = packed.withColumn("there", in_sieve(changed.select(F.col("key").alias("own")), "own"))
    rest = packed.filter("not there").select("row")
    words = F.sha2(F.trim(F.regexp_replace("row.text", SEPARATORS, " ")), 256)
    out = packed.filter("there").withColumn("words", words).join(changed, (F.col("own") == F.col("key")) & (F.col("words") == F.col("sha")), "left")
    row = F.col("row").withField("text", F.coalesce("kept", "row.text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("kept").isNull(), F.col("row.n_chars")).otherwise(F.length("kept")).cast(docs.schema["n_chars"].dataType))
    out = out.filter("kept is null or kept <> ''").select(row.alias("row"))
    return rest.select("row.*").unionByName(out.select("row.*"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weight; a document comes as often as the mix draws it.

    Documents without words are never drawn; a null source is one of its own; repeated rows are drawn alike; extra
    columns, whatever their names, are passed on; an empty table gives no rows."""
    return mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document, with the scores of its best segmentations; null and empty texts have none."""
    return piece_summary(docs, vocabulary(PIECES))


STAGES = [("language", known_language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("source_mix", source_mix), ("pieces", encoded)]
ORACLE_SQL = None  # kernels, searches, draws and lattices have no SQL; tests/llm holds each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = write_table(docs, f"stage-{name}")
    return docs
