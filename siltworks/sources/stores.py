"""Small files of stream sources and sinks, in any store that pyarrow opens (paths or URIs)."""

from __future__ import annotations

import pyarrow.fs as pafs


def opened(location: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path or URI, and the path in it."""
    if "://" in location or location.startswith("file:"):
        return pafs.FileSystem.from_uri(location)
    return pafs.LocalFileSystem(), location


def names(location: str) -> list[str]:
    """Names in a folder, in order; none where there is no such folder."""
    fs, path = opened(location)
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted(x.base_name for x in found)


def read_text(location: str) -> str:
    fs, path = opened(location)
    with fs.open_input_stream(path) as f:
        return f.read().decode()


def write_text(location: str, text: str) -> None:
    """The whole file or nothing: written beside it, then moved to its name."""
    fs, path = opened(location)
    folder, _, name = path.rpartition("/")
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/.{name}.part") as f:
        f.write(text.encode())
    fs.move(f"{folder}/.{name}.part", path)


def exists(location: str) -> bool:
    fs, path = opened(location)
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def remove(location: str) -> None:
    fs, path = opened(location)
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_file(path)
