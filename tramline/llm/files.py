"""Binary files in a folder that all executors share, written and read by tasks."""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyarrow import fs


def _at(url: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", url))


def make_folder(url: str) -> str:
    system, path = _at(url)
    system.create_dir(path, recursive=True)
    return url


class Output:
    """A file that bears its name only once it is whole; each attempt of a task writes one of its own."""

    def __init__(self, folder: str, stem: str, suffix: str):
        self.url = f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"
        self._system, self._path = _at(self.url)
        self._stream = self._system.open_output_stream(f"{self._path}.part", compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self._stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._stream.close()
        self._system.move(f"{self._path}.part", self._path)


def open_stream(url: str) -> pa.NativeFile:
    system, path = _at(url)
    return system.open_input_stream(path, compression=None, buffer_size=1 << 20)


def open_random(url: str) -> pa.NativeFile:
    system, path = _at(url)
    return system.open_input_file(path)
