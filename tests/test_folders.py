"""The sink of case folders: what is written is read back, and failed attempts leave nothing."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from qirtas.operators import outputs
from qirtas.sources import folders

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCHEMA = folders.WRITTEN


def there(path):
    return sorted(os.path.join(d, f) for d, _, files in os.walk(path) for f in files)


def test_round_trip_and_modes(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    rows = [("a", [("x.md", "one"), ("é/..\\%.md", "zwei\n")]), ("b" * 300, [("y", None)]), (None, [("z", "")]), (".", [("..", "dots")]), ("none", []), ("null", None)]
    folders.write_folders(spark.createDataFrame(rows, SCHEMA).repartition(3), path)
    got = {(r.document if len(r.document) < 99 else "b", r.file): r.content for r in folders.read_folders(spark, path).collect()}
    assert got == {("a", "x.md"): "one", ("a", "é/..\\%.md"): "zwei\n", ("b", "y"): "", ("%", "z"): "", (".", ".."): "dots"}
    folders.write_folders(spark.createDataFrame([("a", [("x.md", "again")])], SCHEMA), path)
    assert folders.read_folders(spark, path).count() == 6
    folders.write_folders(spark.createDataFrame([("c", [("x", "new")])], SCHEMA), path, "overwrite")
    assert [tuple(r) for r in folders.read_folders(spark, path).collect()] == [("c", "x", "new")] and len(there(tmp_path)) - sum(f.endswith(".crc") for f in there(tmp_path)) == 2


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "none")
    assert folders.read_folders(spark, path).collect() == []
    folders.write_folders(spark.createDataFrame([], SCHEMA), path)
    assert folders.read_folders(spark, path).collect() == [] and len(there(path)) == 1


def test_a_failing_attempt_leaves_nothing(tmp_path):
    writer = folders.FolderWriter(str(tmp_path), False)
    row = lambda d: Row(document=d, files=[Row(name="f", content=d)])

    def breaks():
        yield row("first")
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        writer.write(breaks())
    assert there(tmp_path) == []
    lost = writer.write(iter([row("first"), row("second")]))  # an attempt whose result never came
    good = writer.write(iter([row("first"), row("second"), row("first")]))
    assert len(there(tmp_path)) == 5 and folders.FolderReader(str(tmp_path)).partitions()[0].folder == ""
    writer.commit([good, None])
    reader = folders.FolderReader(str(tmp_path))
    assert sorted(x for p in reader.partitions() for x in reader.read(p)) == [("first", "f", "first"), ("first~2", "f", "first"), ("second", "f", "second")]
    assert not any(lost.part in f for f in there(tmp_path)) and len(there(tmp_path)) == 4
    other = folders.FolderWriter(str(tmp_path), True)
    other.write(iter([row("third")]))
    other.abort([])
    assert len(there(tmp_path)) == 4


RETRY = """
import os, sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from qirtas.sources import folders
path, mark = sys.argv[1:]
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
@F.udf("string")
def once(i):
    if i == 7:
        try:
            os.close(os.open(mark, os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return str(i)
        raise OSError("fails once")
    return str(i)
df = spark.range(0, 10, 1, 2).select(F.col("id").cast("string").alias("document"), F.array(F.struct(F.lit("f").alias("name"), once("id").alias("content"))).alias("files"))
spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
folders.write_folders(df, path)
got = sorted((int(r.document), r.content) for r in folders.read_folders(spark, path).collect())
assert got == [(i, str(i)) for i in range(10)], got
print("READ", len(got))
"""


def test_a_task_that_fails_once_leaves_no_second_file(tmp_path):
    path, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    done = subprocess.run([sys.executable, "-c", RETRY, path, mark], capture_output=True, text=True, timeout=240, env=os.environ | {"PYTHONPATH": ROOT})
    assert "READ 10" in done.stdout, done.stderr[-2000:]
    assert os.path.exists(mark) and len([f for f in there(path) if f.endswith("/f")]) == 10 and len(os.listdir(f"{path}/parts")) == 2


def test_file_sets_and_outputs(spark):
    rows = spark.createDataFrame([(1, "v", "{}", "c", "", None), (2, None, "{}", "", "p", "[]")], "id long, verbatim string, provenance string, context string, case_packet string, case_index string")
    got = {r.document: [(f.name, f.content) for f in r.files] for r in outputs.file_set(rows, "id").collect()}
    assert got == {"1": [("verbatim.md", "v"), ("provenance.json", "{}"), ("context.md", "c")], "2": [("provenance.json", "{}"), ("context.md", ""), ("case_packet.md", "p"), ("case_index.json", "[]")]}
    asked = spark.createDataFrame([("json", "llm"), ("markdown", "llm"), ("markdown", "faithful"), ("text", "llm")], "f string, p string")
    out = asked.select(outputs.primary_output(F.col("f"), F.col("p"), F.lit("j"), F.lit("c"), F.lit("m"), F.lit("t")).alias("o")).collect()
    assert [r.o for r in out] == ["j", "c", "m", "t"]


def test_lists_end_after_20_and_40(spark):
    rows = spark.range(100).selectExpr("if(id < 50, 'many', if(id < 90, 'forty', 'few')) as d", "id as page", "2L as chars")
    notes = outputs.document_notes(rows, "d", "page", "chars", F.col("page") < 93, F.col("d") == "few")
    index = {r.name: r.line for r in outputs.index_lines(notes, F.col("d")).collect()}
    audit = {r.name: r.line for r in outputs.audit_lines(notes, F.col("d")).collect()}
    assert index["few"] == "- [few](few) - pages: 10; chars: 20; ocr fallback pages: 10; weak pages: 90, 91, 92"
    assert index["many"].endswith(", 18, 19...") and audit["many"].endswith(", 38, 39...") and audit["forty"].endswith(", 88, 89")
    assert tuple(outputs.corpus_head(notes).first()) == (3, 100, 200, 3) and tuple(outputs.corpus_head(notes.limit(0)).first()) == (0, 0, 0, 0)
