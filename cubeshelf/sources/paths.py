"""One way from a path to a file system that Python code can open."""

from __future__ import annotations

from urllib.parse import urlsplit


def open_fs(path: str):
    """(file system, path within it) for a local path or a `scheme://` one.

    Paths are taken as they are (spaces, accents, `%` and `#` included), never
    as encoded URIs. `s3a://` and `s3n://`, the Hadoop names, mean `s3://`."""
    from pyarrow import fs as pafs
    if "://" not in path or path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/") if path.startswith("file:") else path
    scheme, rest = path.split("://", 1)
    host, _, inner = rest.partition("/")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    found, base = pafs.FileSystem.from_uri(f"{scheme}://{host}/")
    return found, f"{base.rstrip('/')}/{inner}" if urlsplit(f"{scheme}://{host}").netloc else f"/{inner}"
