"""Files in the shared folder, written and read by executors: a local or mounted path through the
operating system, any other store through pyarrow's file systems."""

from __future__ import annotations

import os
import uuid


def _local(uri: str) -> str | None:
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if uri.startswith("/") else None


def write_file(uri: str, content: bytes) -> None:
    """Write whole or not at all: to a name of its own first, then renamed, so that a second attempt of a
    task does no harm."""
    path, own = _local(uri), f".{uuid.uuid4().hex}.tmp"
    if path:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path + own, "wb") as f:
            f.write(content)
        os.replace(path + own, path)
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(path + own) as f:
        f.write(content)
    store.move(path + own, path)


def read_file(uri: str) -> bytes:
    if path := _local(uri):
        with open(path, "rb") as f:
            return f.read()
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(path) as f:
        return f.read()
