"""Arrays in the shared folder: written whole by tasks, memory-mapped by workers.

A path is a local one (plain or file:) that all machines share, or any URI that
pyarrow's file systems open. The latter cannot be mapped: a worker holds copies of single
arrays in memory, up to a budget, and writes none to its own disks.
"""

from __future__ import annotations

import io
import os
import uuid
from collections import OrderedDict
from urllib.parse import unquote, urlparse

import numpy as np


def _local(path: str) -> str | None:
    u = urlparse(path)
    return unquote(u.path) if u.scheme in ("", "file") else None


def save(path: str, array: np.ndarray) -> None:
    """Writes beside the target and renames: a repeated or concurrent task leaves the same whole file."""
    at = _local(path)
    if at is not None:
        os.makedirs(os.path.dirname(at), exist_ok=True)
        part = f"{at}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            np.save(f, array)
        os.replace(part, at)
        return
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    system.create_dir(os.path.dirname(name), recursive=True)
    part = f"{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as f:
        np.save(f, array)
    system.move(part, name)


def load(path: str) -> np.ndarray:
    """Memory-mapped where the path is a local one; else a copy in memory."""
    at = _local(path)
    if at is not None:
        return np.load(at, mmap_mode="r")
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_stream(name) as f:
        return np.load(io.BytesIO(f.read()))


class Open:
    """Arrays by path; those not used for longest are closed beyond a number of maps or a size of copies."""

    def __init__(self, maps: int, copied: int):
        self.maps, self.copied, self.held = maps, copied, OrderedDict()

    def get(self, path: str) -> np.ndarray:
        if path in self.held:
            self.held.move_to_end(path)
            return self.held[path]
        array = load(path)
        self.held[path] = array
        while len(self.held) > 1 and (len(self.held) > self.maps or self._bytes() > self.copied):
            self.held.popitem(last=False)
        return array

    def _bytes(self) -> int:
        return sum(a.nbytes for a in self.held.values() if not isinstance(a, np.memmap))
