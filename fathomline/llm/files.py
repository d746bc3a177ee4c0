"""Files in the shared folder, from tasks, and memory that tasks give back."""

from __future__ import annotations

import ctypes
import re

import pyarrow as pa
from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path on it."""
    return fs.FileSystem.from_uri(uri) if re.match(r"\w+:", uri) else (fs.LocalFileSystem(), uri)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: a worker is used again by later stages, beside other workers."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass
