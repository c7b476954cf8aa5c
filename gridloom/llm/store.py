"""Files in the shared folder, opened from executors: local paths or any pyarrow file system."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from urllib.parse import unquote, urlparse


def _local(uri: str) -> str | None:
    u = urlparse(uri)
    return unquote(u.path) if u.scheme in ("", "file") else None


@contextmanager
def create(uri: str):
    """A binary stream whose file appears under its name only when it is complete.

    A task that runs again, or twice at once, replaces the file as a whole.
    """
    path = _local(uri)
    if path is None:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(uri)
        store.create_dir(os.path.dirname(path), recursive=True)
        part = f"{path}.{uuid.uuid4().hex}.part"
        try:
            with store.open_output_stream(part) as f:
                yield f
        except BaseException:
            store.delete_file(part)
            raise
        store.move(part, path)
        return
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    try:
        with open(part, "wb") as f:
            yield f
    except BaseException:
        os.unlink(part)
        raise
    os.replace(part, path)


@contextmanager
def reading(uri: str):
    """A seekable binary stream."""
    path = _local(uri)
    if path is None:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(uri)
        with store.open_input_file(path) as f:
            yield f
        return
    with open(path, "rb") as f:
        yield f
