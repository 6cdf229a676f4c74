"""Files in the shared folder that tasks read and write themselves."""

from __future__ import annotations

#: Schemes of Hadoop's file systems that pyarrow knows by another name.
SAME_STORE = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "gs": "gs"}


def store(path: str):
    """(file system, path in it) of a folder named by a path or URI."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        path = "/" + rest.lstrip("/")
    elif scheme == "dbfs":
        path = "/dbfs/" + rest.lstrip("/")
    elif scheme in SAME_STORE:
        path = f"{SAME_STORE[scheme]}:{rest}"
    return fs.FileSystem.from_uri(path)
