"""Byte access for executors: any file system pyarrow knows, addressed by URI."""

from __future__ import annotations

from functools import lru_cache

from pyarrow import fs


#: The names that Hadoop gives to object stores, and those of the library below.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


@lru_cache(maxsize=8)
def _file_system(prefix: str) -> fs.FileSystem:
    return fs.FileSystem.from_uri(prefix + "/")[0]


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``uri`` and the path in it; a bare path is local."""
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    scheme, _, rest = uri.partition("://")
    scheme = SCHEMES.get(scheme, scheme)
    authority, _, path = rest.partition("/")
    where = _file_system(f"{scheme}://{authority}")
    # Object stores keep the bucket in the path; the others don't.
    return where, (f"{authority}/{path}" if scheme in ("s3", "gs") else f"/{path}")


def create(uri: str):
    where, path = locate(uri)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    return where.open_output_stream(path, compression=None)


def open_at(uri: str):
    where, path = locate(uri)
    return where.open_input_file(path)
