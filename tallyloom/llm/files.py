"""Files that tasks write themselves: any store, temporary names, one rename."""

from __future__ import annotations

import uuid
from contextlib import contextmanager, suppress

import pyarrow.fs
from pyspark import TaskContext


def store(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store that holds a folder (local, HDFS or object store) and the path inside it."""
    return pyarrow.fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{folder}")


def attempt() -> str:
    """A mark no other attempt of a task has."""
    task = TaskContext.get()
    return f"{task.attemptNumber() if task else 'driver'}-{uuid.uuid4().hex[:8]}"


def publish(fs: pyarrow.fs.FileSystem, temporary: str, final: str) -> None:
    """Give a finished file its name. An earlier attempt that got there first wrote the same bytes."""
    try:
        fs.move(temporary, final)
    except OSError:
        if fs.get_file_info(final).type != pyarrow.fs.FileType.File:
            raise
        with suppress(OSError):
            fs.delete_file(temporary)


@contextmanager
def written(fs: pyarrow.fs.FileSystem, final: str):
    """A stream whose file appears under its name when the block ends well, and not at all otherwise."""
    folder, _, name = final.rpartition("/")
    temporary = f"{folder}/_temporary-{name}-{attempt()}"
    try:
        with fs.open_output_stream(temporary, compression=None) as out:
            yield out
        publish(fs, temporary, final)
    except BaseException:
        with suppress(OSError):
            fs.delete_file(temporary)
        raise
