"""Arrays in the shared folder, written by tasks and memory-mapped by workers."""

import os
import tempfile
from urllib.parse import urlparse

import numpy as np


def local(path: str) -> str | None:
    """The path as the operating system names it, or None for a store that it does not mount."""
    parts = urlparse(path)
    return parts.path if parts.scheme in ("", "file") else None


def save(path: str, array: np.ndarray) -> None:
    """Write under a name of its own, then rename: a task that runs again leaves the same file."""
    here = local(path)
    if here is None:
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(path)
        with store.open_output_stream(name) as out:
            np.save(out, array)
        return
    os.makedirs(os.path.dirname(here), exist_ok=True)
    handle, name = tempfile.mkstemp(dir=os.path.dirname(here))
    with os.fdopen(handle, "wb") as out:
        np.save(out, array)
    os.replace(name, here)


def mapped(path: str) -> np.ndarray:
    """Map an array into memory. From a store that is not mounted it is copied to the worker's temporary folder first;
    the copy has no name any more once it is mapped, so nothing stays behind."""
    here = local(path)
    if here is not None:
        return np.load(here, mmap_mode="r")
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    handle, copy = tempfile.mkstemp()
    try:
        with os.fdopen(handle, "wb") as out, store.open_input_stream(name) as rows:
            while block := rows.read(1 << 22):
                out.write(block)
        return np.load(copy, mmap_mode="r")
    finally:
        os.unlink(copy)
