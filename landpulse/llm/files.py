"""Files of the operators in the shared folder, read and written by tasks."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def write_file(folder: str, suffix: str, data: bytes) -> str:
    """Writes data under a name that no other task or attempt uses; the name counts only once a table lists it."""
    uri = f"{folder}/{uuid.uuid4().hex}{suffix}"
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(data)
    return uri


def read_file(uri: str) -> bytes:
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_stream(path) as src:
        return src.read()


def read_range(uri: str, offset: int, length: int) -> bytes:
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as src:
        return src.read_at(length, offset)
