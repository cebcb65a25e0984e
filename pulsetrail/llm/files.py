"""Files that tasks read and write by themselves, on any file system Arrow knows."""

from __future__ import annotations

from pyarrow import fs


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it of a path as Spark writes it (``file:/x``, ``hdfs://...``, ``s3://...``)."""
    if "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def make_folder(path: str) -> None:
    system, place = resolve(path)
    system.create_dir(place, recursive=True)
