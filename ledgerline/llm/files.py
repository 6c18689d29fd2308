"""Binary files on any store that pyarrow's file systems reach.

Tasks write each file under a name of its own and report it in a manifest
that Spark commits; readers open only what the manifest lists. A task that is
lost and runs again writes another file, and the first one is never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def new_name(folder: str, prefix: str, suffix: str) -> str:
    return f"{folder}/{prefix}-{uuid.uuid4().hex}{suffix}"


def create(uri: str):
    """An output stream; the folder is made when it is missing."""
    system, path = place(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path)


def open_read(uri: str):
    """A random-access file: ``read_at(length, offset)`` reads a range."""
    system, path = place(uri)
    return system.open_input_file(path)
