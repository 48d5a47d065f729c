"""Byte ranges of files in any store that the executors reach through ``pyarrow.fs``."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; ``file:/a``, ``file:///a`` and ``/a`` are the same."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def new_file(folder: str, suffix: str) -> str:
    """A name no other attempt uses: a repeated task leaves an orphan, never a clash."""
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"


def open_output(uri: str):
    fs, path = resolve(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(path)


def file_size(uri: str) -> int:
    fs, path = resolve(uri)
    return fs.get_file_info(path).size


class RangeReader:
    """Ranged reads of one file; keeps it open between them."""

    def __init__(self, uri: str):
        fs, path = resolve(uri)
        self.file = fs.open_input_file(path)
        self.size = self.file.size()

    def read(self, offset: int, length: int) -> bytes:
        return self.file.read_at(length, offset)

    def close(self) -> None:
        self.file.close()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()
