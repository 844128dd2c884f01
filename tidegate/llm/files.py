"""Binary files that tasks write into and read from the shared folder."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def join_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def attempt_name(stem: str, suffix: str) -> str:
    """A file name no other attempt of a task uses: only names that a finished task reports are read."""
    return f"{stem}-{uuid.uuid4().hex[:12]}{suffix}"


def open_output(path: str):
    system, place = pafs.FileSystem.from_uri(path)
    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(place, compression=None)


def open_input(path: str):
    system, place = pafs.FileSystem.from_uri(path)
    return system.open_input_file(place)
