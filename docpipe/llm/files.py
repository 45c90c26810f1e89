"""Files that tasks write and read by URI, through the file systems of Arrow.

A task writes under a name of its own attempt and reports the name in its result. Only names in
the results of tasks that ended well are read later, so a task that is run again, or twice at
the same time, leaves at most a file that nobody refers to.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


@contextmanager
def new_file(folder: str, suffix: str):
    """Gives ``(uri, stream)`` of a new file below the folder's URI."""
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    with store.open_output_stream(f"{path}/{name}", compression=None) as stream:
        yield f"{folder}/{name}", stream


def open_file(uri: str):
    """Random access; a local file is mapped into memory, so that reading copies nothing."""
    store, path = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        store = fs.LocalFileSystem(use_mmap=True)
    return store.open_input_file(path)
