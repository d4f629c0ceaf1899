"""Raw files in the shared folder, through any file system that Arrow knows."""

from __future__ import annotations

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a path or URI."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def make_folder(path: str) -> None:
    system, inner = opened(path)
    system.create_dir(inner, recursive=True)


def write_file(path: str, data: bytes) -> None:
    system, inner = opened(path)
    with system.open_output_stream(inner) as out:
        out.write(data)


def read_file(path: str) -> bytes:
    system, inner = opened(path)
    with system.open_input_file(inner) as f:
        return f.read()
