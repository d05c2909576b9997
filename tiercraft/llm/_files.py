"""Files in the shared folder, opened through pyarrow from any task: local paths, HDFS and object stores alike."""

from __future__ import annotations

import re

from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address, and the folder's path in it."""
    if re.match(r"file:/", folder):
        folder = re.sub(r"^file:/+", "/", folder)
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder
