"""Small helpers for binary files in the shared folder, used inside tasks."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from pyarrow import fs
from pyspark.sql import DataFrame

READERS = 4_096  # tasks that share the files of a collection


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and bare path of a URI or an absolute path."""
    if urlparse(path).scheme == "file":
        return fs.LocalFileSystem(), urlparse(path).path
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def apart(files: DataFrame) -> DataFrame:
    """A row per file, dealt one by one to as many tasks as there are files, ``READERS`` at most.

    The number keeps adaptive execution from merging the tiny rows into one task that reads all files.
    """
    return files.repartition(max(1, min(files.count(), READERS)))


class AttemptFile:
    """A new file whose name no other attempt of the task shares; only a committed manifest row makes it count."""

    def __init__(self, folder: str, stem: str, suffix: str):
        self.path = f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}{suffix}"
        system, bare = locate(self.path)
        system.create_dir(bare.rsplit("/", 1)[0], recursive=True)
        self._stream = system.open_output_stream(bare, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self._stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._stream.close()


def open_file(path: str):
    """A random-access input file."""
    system, bare = locate(path)
    return system.open_input_file(bare)
