"""File systems of paths, as pyarrow's public file-system layer knows them."""

from __future__ import annotations

from pyarrow import fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (any scheme that pyarrow knows) or of a plain local path."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path
