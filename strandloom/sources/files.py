"""Byte ranges of files for readers that frame their own records: listing, splits, reads at a place.

Tasks open paths by their scheme (local, ``file:``, and what pyarrow has: ``s3:``, ``gs:``, ``hdfs:``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql.datasource import InputPartition

#: Bytes of a file that one task reads, and from how many splits on smaller ones are widened up to that.
SPLIT, SPLITS = 64 << 20, 256


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path within it."""
    return pafs.FileSystem.from_uri(path)


def listed(paths: list[str], suffix: tuple[str, ...] = ()) -> list[tuple[str, int]]:
    """(path, size) of files and of the files in folders, in order; names that begin with _ or . are passed over."""
    out = []
    for path in paths:
        fs, inner = opened(path)
        head = path[: len(path) - len(inner)] if path.endswith(inner) else ""
        info = fs.get_file_info(inner)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = [info] if info.type == pafs.FileType.File else [x for x in fs.get_file_info(pafs.FileSelector(inner)) if x.type == pafs.FileType.File and x.base_name[0] not in "_." and (not suffix or x.base_name.endswith(suffix))]
        out += sorted((head + x.path, x.size) for x in found)
    return out


@dataclass
class Split(InputPartition):
    """Bytes [start, end) of a file of ``size`` bytes."""

    path: str
    start: int
    end: int
    size: int


def splits(files: list[tuple[str, int]], size: int = SPLIT) -> list[Split]:
    return [Split(path, at, min(at + size, n), n) for path, n in files for at in range(0, n, size)]


def dealt(files: list[tuple[str, int]], size: int = SPLIT) -> list[Split]:
    """Splits of ``size`` bytes; where the files would have more than SPLITS of them, wider ones (up to SPLIT), so that small splits don't make ever more tasks."""
    return splits(files, max(size, min(SPLIT, -(-sum(n for _, n in files) // SPLITS))))


class Bytes:
    """A file, read at any place."""

    def __init__(self, path: str):
        fs, inner = opened(path)
        self.file = fs.open_input_file(inner)
        self.size = self.file.size()

    def at(self, offset: int, n: int) -> bytes:
        n = min(n, self.size - offset)
        return self.file.read_at(n, offset) if n > 0 else b""

    def __enter__(self) -> Bytes:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()
