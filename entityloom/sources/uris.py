"""Folders that clients reach by themselves, outside of Spark's readers and writers."""

from __future__ import annotations

import re

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path of ``uri``; ``file:/a``, as Spark writes it, is ``file:///a``."""
    local = re.sub(r"^file:/*(?=/)", "file://", uri)
    if "://" not in local:
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(local)
