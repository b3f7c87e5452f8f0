"""Sources: files by content, page lists, JSON of documents and page caches; the interface of engines that read pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BOX = "STRUCT<x1:INT,y1:INT,x2:INT,y2:INT>"
SPAN = f"STRUCT<text:STRING,confidence:DOUBLE,bbox:{BOX},engine_id:STRING,adjudicated:BOOLEAN>"
META = "metadata:MAP<STRING,STRING>"  # of any level: values that are objects or lists stay JSON
LINE = f"STRUCT<text:STRING,confidence:DOUBLE,bbox:{BOX},engine_id:STRING,spans:ARRAY<{SPAN}>,{META}>"
BLOCK = f"STRUCT<type:STRING,bbox:{BOX},reading_order:INT,confidence:DOUBLE,engine_id:STRING,text:STRING,lines:ARRAY<{LINE}>,{META}>"
PAGE = f"STRUCT<page:INT,width:INT,height:INT,source_kind:STRING,confidence:DOUBLE,text:STRING,blocks:ARRAY<{BLOCK}>,{META}>"
DOCUMENT = f"STRUCT<source_pdf:STRING,dpi:INT,pages:ARRAY<{PAGE}>,{META}>"
CANDIDATE = "STRUCT<engine:STRING,variant:STRING,psm:INT,success:BOOLEAN,error:STRING,text:STRING,score:DOUBLE,quality:MAP<STRING,STRING>>"
PAGE_CACHE = f"source_pdf STRING, page INT, dpi INT, native_status STRING, quality MAP<STRING,STRING>, candidates ARRAY<{CANDIDATE}>, chosen {CANDIDATE}"


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files of a folder with their hash, by name without regard to case; contents stay on the executors."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return raw.select("path", name.alias("name"), "length", F.sha2("content", 256).alias("sha256"))


def documents_json(spark: SparkSession, path: str) -> DataFrame:
    """Document trees, one JSON object a file; absent fields get their defaults."""
    raw = spark.read.schema("value STRING").text(path, wholetext=True)
    doc = raw.select(F.from_json("value", DOCUMENT).alias("d")).select("d.*")
    return doc.withColumn("dpi", F.coalesce("dpi", F.lit(400))).withColumn("pages", F.coalesce("pages", F.array().cast(f"array<{PAGE}>")))


def page_cache(spark: SparkSession, path: str) -> DataFrame:
    """A folder of cached pages; candidates without a score count as negative infinity."""
    return spark.read.schema(PAGE_CACHE).option("multiLine", True).option("recursiveFileLookup", True).json(path)


def block_rows(documents: DataFrame) -> DataFrame:
    """The flat block table of document trees; texts are derived from the spans, not read."""
    pages = documents.select("source_pdf", F.explode("pages").alias("p"))
    blocks = pages.select("source_pdf", F.col("p.page").alias("page"), F.explode("p.blocks").alias("b"))
    line = lambda x: F.trim(F.array_join(F.transform(x["spans"], lambda s: F.coalesce(s["text"], F.lit(""))), ""))
    text = F.array_join(F.filter(F.transform("b.lines", line), lambda t: t != ""), "\n")
    return blocks.select("source_pdf", "page", "b.reading_order", F.col("b.type").alias("block_type"), "b.bbox", "b.confidence", "b.engine_id", text.alias("text"))


def page_numbers(spec: Column, total: Column | None = None) -> Column:
    """``1-5,7`` as sorted distinct pages from 0. Without a total, an empty, descending or zero entry is null; with
    one, the spec is read leniently: pages count from 1 and are cut to the total, an empty spec means all."""
    parts = F.transform(F.split(F.regexp_replace(spec, r"\s", ""), ","), lambda p: F.split(p, "-"))
    ends = F.transform(parts, lambda p: F.struct(F.expr("cast(0 as int)").alias("z"), p[0].try_cast("int").alias("a"), F.element_at(p, -1).try_cast("int").alias("b")))
    bad = F.exists(ends, lambda e: e["a"].isNull() | e["b"].isNull() | (e["a"] < 1) | (e["b"] < e["a"]))
    every = F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(ends, lambda e: e["a"] <= e["b"]), lambda e: F.sequence(e["a"], e["b"])))))
    if total is None:
        return F.when(~bad, F.transform(every, lambda x: x - 1))
    return F.when(F.trim(spec) == "", F.sequence(F.lit(1), total)).otherwise(F.filter(every, lambda x: (x >= 1) & (x <= total)))


class Engine(Protocol):
    """Reads an image. ``available`` is asked on the driver; ``recognise`` runs on executors and never raises."""

    engine_id: str

    def available(self) -> bool: ...

    def recognise(self, image: bytes) -> tuple[str, float | None, str | None]: ...


def available(engines: dict[str, Engine], order: tuple[str, ...]) -> list[str]:
    """Engines that are ready, in order of preference."""
    return [e for e in order if e in engines and engines[e].available()]


def engine_named(engines: dict[str, Engine], name: str) -> Engine:
    if name not in engines:
        raise ValueError(f"unknown engine {name!r}; there are {', '.join(sorted(engines))}")
    return engines[name]


def routed(mode: str, engines: dict[str, Engine], order: tuple[str, ...]) -> tuple[str, str | None]:
    """Primary and secondary engine of a mode: a named engine alone; ``auto`` takes the first two available."""
    ready = available(engines, order)
    if mode != "auto":
        if mode not in engines or not engines[mode].available():
            raise ValueError(f"engine {mode!r} is not available")
        return mode, next((e for e in ready if e != mode), None) if mode == "gemini" else None
    if not ready:
        raise ValueError("no engine is available")
    return ready[0], ready[1] if len(ready) > 1 else None


def recognised(regions: DataFrame, image: str, make: Callable[[], Engine]) -> DataFrame:
    """Regions with the engine's text; the engine is made once a task, failures become rows."""
    keep = [f for f in regions.schema.fields if f.name != image]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in keep) + "engine_id string, text string, success boolean, confidence double, error string"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = make()
        for batch in batches:
            rows = []
            for raw in batch[image]:
                try:
                    text, confidence, error = engine.recognise(raw)
                except Exception as e:  # noqa: BLE001  a page that fails is a row that says so
                    text, confidence, error = "", None, str(e)
                rows.append((engine.engine_id, text, error is None, confidence, error))
            found = pd.DataFrame(rows, columns=["engine_id", "text", "success", "confidence", "error"], index=batch.index)
            yield pd.concat([batch.drop(columns=[image]), found], axis=1)

    return regions.mapInPandas(read, schema)
