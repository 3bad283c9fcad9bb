"""File systems by URI, for what runs on executors outside Spark's own readers and writers."""

from __future__ import annotations


def opened(uri: str):
    """``(file system, path)`` of a folder or file, such as ``/data/x``, ``file:///data/x``, ``hdfs://...``, ``s3://...``."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri.rstrip("/")
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/").rstrip("/")
    system, path = fs.FileSystem.from_uri(uri)
    return system, path.rstrip("/")
