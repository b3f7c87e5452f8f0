"""Readings of pages by several configurations of engines, kept between runs.

What is to be read is every page (content hash, page, side) under every configuration, less what the table of readings has.
Readings are written under the number of their run and a bucket of the content's hash, by dynamic partition overwrite: a run
that failed has left nothing and is made again under the same number, a run that is repeated replaces its own rows. Of a page
read again the last run counts.

Defined results: pages of equal content, page and side are read once; a null content hash is not read; a page whose reading
fails is a row with the error, and is read again in the next run; an empty work list writes nothing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qirtas.sources.pages import Engine

KEY, CONFIG = ["sha256", "page", "side"], ["engine", "variant", "psm"]
READING = "sha256 string, page int, side string, engine string, variant string, psm int, success boolean, error string, text string, confidence double"
STORED = f"{READING}, run int, bucket string"


def stored(spark: SparkSession, path: str) -> DataFrame:
    """All rows that any run has written; none if there was no run."""
    from py4j.protocol import Py4JJavaError

    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    except Py4JJavaError as e:
        raise OSError(f"cannot look at {path}") from e
    return spark.read.schema(STORED).parquet(path) if there else spark.createDataFrame([], STORED)


def readings(spark: SparkSession, path: str) -> DataFrame:
    """The last reading of each page and configuration."""
    last = Window.partitionBy(*KEY, *CONFIG).orderBy(F.desc("run"))
    return stored(spark, path).withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")


def work_list(pages: DataFrame, configs: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Pages under the configurations that have not read them. ``configs`` are a handful, given by hand; they go along with
    every page."""
    images = pages.filter("sha256 is not null").groupBy(*KEY).agg(F.min("image").alias("image"))
    listed = F.array(*[F.struct(*[F.lit(r[c]).cast("int" if c == "psm" else "string").alias(c) for c in CONFIG]) for r in configs.select(*CONFIG).distinct().orderBy(*CONFIG).collect()])
    listed = listed.cast("array<struct<engine:string,variant:string,psm:int>>")
    every = images.withColumn("c", F.explode(listed)).select(*KEY, "image", "c.*")
    if force:
        return every
    there = done.filter("success").select(*KEY, *CONFIG).distinct()
    same = [every[k].eqNullSafe(there[k]) for k in ("page", "side", "engine", "variant", "psm")]
    condition = every["sha256"] == there["sha256"]
    for s in same:
        condition &= s
    return every.join(there, condition, "left_anti")


def read_pages(work: DataFrame, make: Callable[[str, str, int | None], Engine]) -> DataFrame:
    """The readings of a work list; an engine is made once a task and configuration."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engines: dict = {}
        for batch in batches:
            rows = []
            for i in range(len(batch)):
                r = batch.iloc[i]
                config = (r["engine"], r["variant"], None if pd.isna(r["psm"]) else int(r["psm"]))
                try:
                    if config not in engines:
                        engines[config] = make(*config)
                    text, confidence, error = engines[config].recognise(r["image"])
                except Exception as e:  # noqa: BLE001  a page that fails is a row that says so
                    text, confidence, error = "", None, str(e) or type(e).__name__
                rows.append((r["sha256"], r["page"], r["side"], *config, error is None, error, text, confidence))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in READING.split(", ")]).astype({"page": "Int32", "psm": "Int32", "confidence": "Float64"})

    return work.mapInPandas(read, READING)


def read_missing(spark: SparkSession, path: str, pages: DataFrame, configs: DataFrame, make: Callable[[str, str, int | None], Engine], force: bool = False) -> int:
    """Read what is missing (all if ``force``) and keep it; the number of the run. ``pages``: sha256, page, side, image."""
    done = stored(spark, path)
    run = (done.agg(F.max("run").alias("n")).first()["n"] or 0) + 1
    found = read_pages(work_list(pages, configs, readings(spark, path), force), make).withColumns({"run": F.lit(run), "bucket": F.substring("sha256", 1, 2)})
    found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "bucket").parquet(path)
    return run


def best_texts(read: DataFrame, score) -> DataFrame:
    """Of each page the reading of highest ``score`` (by engine, variant and psm on ties); empty where all failed."""
    rows = read.withColumn("_score", F.when(F.col("success"), score))
    first = F.struct(F.col("_score").isNull().alias("none"), (-F.col("_score")).alias("score"), *CONFIG)
    return rows.groupBy(*KEY).agg(F.min_by(F.struct("engine", "variant", "psm", "text", F.col("_score").alias("score")), first).alias("b")).select(*KEY, "b.*")


def in_order(files: DataFrame, best: DataFrame, sides: tuple[str, ...] = ("right", "left")) -> DataFrame:
    """``name`` and the texts of its pages in order, each page's sides in that of ``sides``: files of equal content get the
    same texts. Texts of a file come together."""
    place = F.coalesce(F.nullif(F.array_position(F.lit(list(sides)), F.col("side")), F.lit(0)), F.lit(len(sides) + 1))
    texts = best.groupBy("sha256").agg(F.array_sort(F.collect_list(F.struct("page", place.alias("place"), "side", "text"))).alias("parts"))
    return files.join(texts, "sha256").select("name", F.transform("parts", lambda p: p["text"]).alias("texts"))
