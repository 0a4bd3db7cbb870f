"""Flat files in the shared folder, on any file system that a URI names."""

from __future__ import annotations

import uuid

import numpy as np
from pyarrow import fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class FlatFile:
    """Written under a name of its own and moved to its place at the end, so a lost or repeated task leaves a whole file or none."""

    def __init__(self, path: str) -> None:
        self.system, self.path = locate(path)
        self.partial = f"{self.path}.{uuid.uuid4().hex}.partial"
        self.system.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.stream = self.system.open_output_stream(self.partial)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def close(self) -> None:
        self.stream.close()
        self.system.move(self.partial, self.path)


def mapped(path: str, dtype: np.dtype) -> np.ndarray:
    """A file's values, memory-mapped where the file system is mounted, else read."""
    system, place = locate(path)
    size = system.get_file_info(place).size
    if not size:
        return np.zeros(0, dtype)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(place, dtype=dtype, mode="r")
    with system.open_input_file(place) as opened:
        return np.frombuffer(opened.read(), dtype=dtype)
