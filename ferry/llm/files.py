"""Files that tasks write and read themselves, on whatever store the scratch folder is in."""

from __future__ import annotations

import posixpath
import uuid
from contextlib import contextmanager

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a Hadoop-style URI or an absolute path."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


@contextmanager
def writing(uri: str):
    """An output stream whose file appears under its name only once it is complete.

    A task that is retried or runs twice writes the same bytes under the same name.
    """
    store, path = locate(uri)
    store.create_dir(posixpath.dirname(path), recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(draft, compression=None) as out:
        yield out
    store.move(draft, path)
