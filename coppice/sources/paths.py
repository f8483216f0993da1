"""Where inputs lie: an argument first, then an environment variable, then a default; local paths and URIs alike."""

from __future__ import annotations

import os
import re
from fnmatch import fnmatch
from urllib.parse import unquote


def resolve(given: str | None, variable: str, default: str, must_exist: bool = True) -> str:
    """The path to use; an error names the place if nothing is there."""
    path = given or os.environ.get(variable) or default
    if must_exist and not exists(path):
        raise FileNotFoundError(f"not found: {path}")
    return path


def system_of(path: str):
    """The file system and the path in it. Spark's file sources name local files with one stroke after the colon."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), unquote(re.sub("^file:/*", "/", path))
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def exists(path: str) -> bool:
    system, p = system_of(path)
    return system.get_file_info(p).type.name != "NotFound"


def listed(path: str, ending: str) -> list[str]:
    """The files of a folder with an ending, sorted by path; a file is a list of itself. The last part of a path may be a pattern."""
    from pyarrow import fs

    folder, _, last = path.rstrip("/").rpartition("/")
    pattern = last if any(c in last for c in "*?[") else None
    system, p = system_of(folder if pattern else path)
    if not pattern and system.get_file_info(p).type != fs.FileType.Directory:
        return [path]
    fits = lambda name: name.endswith(ending) and (pattern is None or fnmatch(name, pattern)) and not name.startswith((".", "_"))
    own = sorted(f.path for f in system.get_file_info(fs.FileSelector(p)) if f.type == fs.FileType.File and fits(f.base_name))
    return [f"{(folder if pattern else path).rstrip('/')}/{x.rpartition('/')[2]}" for x in own]


def content(path: str) -> str:
    system, p = system_of(path)
    with system.open_input_stream(p) as f:
        return f.read().decode("utf-8")


def opened(path: str):
    """A file to read at any place; it has seek, read and close."""
    system, p = system_of(path)
    return system.open_input_file(p)


def streamed(path: str):
    """A file to read from its begin on."""
    system, p = system_of(path)
    return system.open_input_stream(p)
