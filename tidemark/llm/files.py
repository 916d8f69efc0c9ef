"""Files on shared storage, written and read by executors' Python."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import pyarrow.fs as pafs


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI (file, hdfs, s3, gs and so on) and the path in it."""
    return pafs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def publish(uri: str) -> Iterator:
    """A stream whose file appears under its name only once it is complete.

    Each attempt of a task writes under a name of its own; attempts write the
    same bytes, so whichever comes last leaves the file as it should be.
    """
    fs, path = resolve(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path}.{uuid.uuid4().hex}.part"
    try:
        with fs.open_output_stream(own) as out:
            yield out
        try:
            fs.move(own, path)
        except OSError:  # some file systems don't replace
            fs.delete_file(path)
            fs.move(own, path)
    except BaseException:
        with contextlib.suppress(OSError):
            fs.delete_file(own)
        raise
