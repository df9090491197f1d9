"""Byte ranges of files in the places that tasks share: what a Python data source reads and writes.

Paths are URIs of any file system that Arrow knows (``file``, ``hdfs``, ``s3``, ``gs``) or plain paths of a shared mount.
"""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs


def place(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path within it; ``file:/x`` as Spark writes it counts as ``file:///x``."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


def found(path: str, ending: str = "") -> list[tuple[str, int]]:
    """(path, size) of a file, or of the files of a folder (not below), by name; hidden ones, and those with another ending, left out."""
    where, inner = place(path)
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    info = where.get_file_info(inner)
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    rows = [i for i in where.get_file_info(pafs.FileSelector(inner)) if i.type == pafs.FileType.File and i.base_name[:1] not in "._" and i.base_name.lower().endswith(ending.lower())]
    return sorted((prefix + i.path, i.size) for i in rows)


def opened(path: str):
    where, inner = place(path)
    return where.open_input_file(inner)


class Parts:
    """Files that tasks write into a folder and a commit makes visible: a lost or repeated attempt leaves nothing behind that readers see."""

    def __init__(self, folder: str, ending: str):
        self.folder, self.ending, self.run = folder.rstrip("/"), ending, uuid.uuid4().hex

    def _inner(self, name: str) -> tuple[pafs.FileSystem, str]:
        where, inner = place(self.folder)
        return where, f"{inner}/{name}"

    def pending(self, partition: int, attempt: int | str):
        """(name, stream) of one attempt's file, hidden until committed."""
        name = f"_pending-{self.run}/part-{partition:05d}-{attempt}{self.ending}"
        where, path = self._inner(name)
        where.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return name, where.open_output_stream(path)

    def commit(self, names: list[str]) -> None:
        for name in names:
            where, source = self._inner(name)
            base = name.rsplit("/", 1)[1]
            where.move(source, self._inner(f"{base[: len('part-00000')]}-{self.run}{self.ending}")[1])
        self.abort()

    def abort(self) -> None:
        where, path = self._inner(f"_pending-{self.run}")
        if where.get_file_info(path).type != pafs.FileType.NotFound:
            where.delete_dir(path)

    def refuse_existing(self) -> None:
        where, path = place(self.folder)
        if where.get_file_info(path).type != pafs.FileType.NotFound and any(i.type == pafs.FileType.File for i in where.get_file_info(pafs.FileSelector(path))):
            raise FileExistsError(self.folder)
