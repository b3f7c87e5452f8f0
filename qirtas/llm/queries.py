"""The queries of this folder: thin readings of the operators, with the columns that are asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .oracles import ORACLES

VOCABULARY, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id, n: int):
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(n))


def op1_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_quality

    out = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), lambda d: remainder(d, 3) != 1)
    held = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_language_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import predict_language

    out = predict_language(table(spark, sf_dir, "documents"), lambda d: remainder(d, 4) != 2)
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "draws")


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .winnowing import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import crc_column, read_token_files, write_token_files

    files, ranks = write_token_files(table(spark, sf_dir, "documents"), vocabulary(VOCABULARY), end_id=2)
    return read_token_files(spark, files, ranks).mapInArrow(crc_column, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest

    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.pmod("vec_id", F.lit(100)) == 0)).select("query_id", "rank", "vec_id", "score")


def op8_piece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pieces import piece_summary

    return piece_summary(table(spark, sf_dir, "documents"), vocabulary(PIECES))


def op9_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), vocabulary(VOCABULARY))


def op10_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .similar import similar_components

    return similar_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .audit import audit_filters

    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .kdtree import exact_top_k

    vectors = table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors.filter(F.pmod("vec_id", F.lit(100)) == 0))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_repeated_spans, op2_quality_fm, op3_language_kernel, op4_source_mix, op5_winnowing, op6_token_files, op7_one_bit_neighbours, op8_piece_nbest, op9_length_histogram, op10_shingle_join, op11_spelling_variants, op12_filter_audit, op13_inner_products, pipeline)}
__all__ = ["ORACLES", "QUERIES"]
