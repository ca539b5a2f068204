"""File systems as tasks see them: local and mounted folders through the
standard library, any other scheme through ``pyarrow.fs``."""

from __future__ import annotations

import io
import os

from pyarrow import fs


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """(file system, path in it) of a folder or file URI; a plain path, and
    ``file:`` in any spelling, is local."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), os.path.abspath(uri)
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def is_local(store: fs.FileSystem) -> bool:
    return isinstance(store, fs.LocalFileSystem)


def inside(base: str, relative: str) -> str:
    """``base/relative``, refusing names that would leave the folder."""
    parts = relative.split("/")
    if relative.startswith("/") or ".." in parts or not parts[-1]:
        raise ValueError(f"not a path inside the folder: {relative!r}")
    return f"{base.rstrip('/')}/{relative}"


class _Raw(io.RawIOBase):
    """A store's file as the standard library expects one: a place before the
    start is an ``OSError``."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        place = offset + (0 if whence == 0 else self.file.tell() if whence == 1 else self.file.size())
        if place < 0:
            raise OSError("seek before the start")
        return self.file.seek(place)

    def tell(self) -> int:
        return self.file.tell()

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)

    def close(self) -> None:
        if not self.closed:
            self.file.close()
        super().close()


def random_access(uri: str) -> io.BufferedReader:
    """A file of a store, opened for reading at any place."""
    store, path = open_store(uri)
    return io.BufferedReader(_Raw(store.open_input_file(path)), 1 << 16)
