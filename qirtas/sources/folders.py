"""Folders of rendered files as a sink and a source: a folder a document, committed as a whole.

``df.write.format("case_folders").mode("append").save(path)`` writes rows of ``document string, files
array<struct<name:string,content:string>>``; ``spark.read.format("case_folders").load(path)`` gives ``document, file,
content``. Every attempt of a task writes below a name of its own, ``parts/<run>.<attempt>/<document>/<file>``. The commit
puts down one list of the attempts that count, ``_runs/<run>.json``, by a rename, and deletes what other attempts of the run
have left; readers see listed attempts only. So a task that fails, is tried again or runs twice leaves no second file, a run
that fails leaves nothing, and a reader sees a run whole or not at all. The driver handles a name a task, never the files.

Defined results: names are kept, but for separators, control characters, percent signs and a first dot, which are written as
percent codes; longer ones than 200 bytes end in a hash; a null or empty name is ``%``; a null content is empty; a document
that one task gets twice has its later files under ``~2`` and so on; a document without files is not written. Overwriting
deletes earlier runs once the new one is committed. An empty table commits a run without files. A path without runs reads
as no rows."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

NAME = "case_folders"
READ, WRITTEN = "document string, file string, content string", "document string, files array<struct<name:string,content:string>>"
LONGEST = 200


def store(path: str):
    """File system and path of an address; a plain path is local."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path.rstrip("/")
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].strip("/")
    found, rest = fs.FileSystem.from_uri(path)
    return found, rest.rstrip("/")


def safe_name(name: str | None) -> str:
    out = re.sub(r"[\x00-\x1f\x7f/\\%]|^\.", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), name or "") or "%"
    raw = out.encode()
    return out if len(raw) <= LONGEST else raw[: LONGEST - 17].decode("utf-8", "ignore") + "~" + hashlib.sha256(raw).hexdigest()[:16]


def listed(files, folder: str, recursive: bool = False) -> list:
    from pyarrow import fs

    return files.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=recursive))


def runs(files, root: str) -> dict[str, list[str]]:
    """Committed runs and the attempts that count."""
    out = {}
    for info in listed(files, f"{root}/_runs"):
        if info.base_name.endswith(".json"):
            with files.open_input_stream(info.path) as f:
                out[info.base_name[:-5]] = json.loads(f.read())["parts"]
    return out


@dataclass
class Attempt(WriterCommitMessage):
    part: str | None
    documents: int
    files: int


@dataclass
class Part(InputPartition):
    folder: str


class FolderWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.run = path, overwrite, uuid.uuid4().hex

    def write(self, rows: Iterator) -> Attempt:
        files, root = store(self.path)
        part, met, n = f"{self.run}.{uuid.uuid4().hex}", Counter(), 0
        try:
            for row in rows:
                if not row.files:
                    continue
                name = safe_name(row.document)
                met[name] += 1
                folder = f"{root}/parts/{part}/{name}" + (f"~{met[name]}" if met[name] > 1 else "")
                files.create_dir(folder, recursive=True)
                for f in row.files:
                    with files.open_output_stream(f"{folder}/{safe_name(f.name)}") as out:
                        out.write((f.content or "").encode())
                    n += 1
        except BaseException:
            if met:
                files.delete_dir(f"{root}/parts/{part}")
            raise
        return Attempt(part if met else None, sum(met.values()), n)

    def commit(self, messages: list[Attempt]) -> None:
        files, root = store(self.path)
        parts = sorted(m.part for m in messages if m and m.part)
        earlier = runs(files, root) if self.overwrite else {}
        self._drop(files, root, self.run, set(parts))
        files.create_dir(f"{root}/_runs", recursive=True)
        with files.open_output_stream(f"{root}/_runs/{self.run}.tmp") as out:
            out.write(json.dumps({"parts": parts, "documents": sum(m.documents for m in messages if m), "files": sum(m.files for m in messages if m)}).encode())
        files.move(f"{root}/_runs/{self.run}.tmp", f"{root}/_runs/{self.run}.json")
        for run in earlier:
            files.delete_file(f"{root}/_runs/{run}.json")
            self._drop(files, root, run, set())

    def abort(self, messages: list[Attempt]) -> None:
        files, root = store(self.path)
        self._drop(files, root, self.run, set())

    @staticmethod
    def _drop(files, root: str, run: str, keep: set[str]) -> None:
        for info in listed(files, f"{root}/parts"):
            if info.base_name.startswith(f"{run}.") and info.base_name not in keep:
                files.delete_dir(info.path)


class FolderReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Part]:
        files, root = store(self.path)
        return [Part(f"{root}/parts/{p}") for parts in runs(files, root).values() for p in parts] or [Part("")]

    def read(self, partition: Part) -> Iterator[tuple[str, str, str]]:
        if not partition.folder:
            return
        files, _ = store(self.path)
        for info in listed(files, partition.folder, recursive=True):
            if info.is_file:
                document, file = info.path.split("/")[-2:]
                with files.open_input_stream(info.path) as f:
                    yield unquote(document), unquote(file), f.read().decode()


class CaseFolders(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return READ

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> FolderWriter:
        return FolderWriter(self.options["path"], overwrite)


def write_folders(df: DataFrame, path: str, mode: str = "append") -> None:
    """``df``: document, files. One row a document, so that its files are written by one task."""
    df.sparkSession.dataSource.register(CaseFolders)
    df.selectExpr("cast(document as string) as document", "cast(files as array<struct<name:string,content:string>>) as files").write.format(NAME).mode(mode).save(path)


def read_folders(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(CaseFolders)
    return spark.read.format(NAME).load(path)
