"""User-defined document loaders, run as a Python data source.

A loader turns one file path into (text, metadata) pairs. It is registered under a name with a
description and read with ``spark.read.format("loader_" + name).load(folder)``, or with ``readStream``.
Options other than path, depth and settle_ms are the loader's own arguments.
Files are listed by the tasks and opened through Arrow file systems, so local, HDFS and object-store
folders work; rows travel as Arrow batches.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

Loader = Callable[..., Iterable[tuple[str, dict[str, str]]]]


@dataclass(frozen=True)
class Registered:
    name: str
    description: str
    load: Loader


LOADERS: dict[str, Registered] = {}


def document_loader(name: str, description: str) -> Callable[[Loader], Loader]:
    def add(fn: Loader) -> Loader:
        LOADERS[name] = Registered(name, description, fn)
        return fn

    return add


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a folder or file, given with or without a scheme."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def read_text(path: str) -> str:
    system, inner = file_system(path)
    with system.open_input_stream(inner) as source:
        return source.read().decode("utf-8")


@document_loader("lines", "every line of a text file is one document")
def load_lines(path: str) -> Iterator[tuple[str, dict[str, str]]]:
    for number, line in enumerate(read_text(path).removesuffix("\n").split("\n")):
        yield line, {"line": str(number)}


@document_loader("whole", "a text file is one document")
def load_whole(path: str) -> Iterator[tuple[str, dict[str, str]]]:
    yield read_text(path), {}


SCHEMA = "file_name string, page_label string, text string, metadata map<string,string>"
ARROW = pa.schema([("file_name", pa.string()), ("page_label", pa.string()), ("text", pa.string()), ("metadata", pa.map_(pa.string(), pa.string()))])
BATCH_ROWS, BATCH_CHARS = 4096, 8 << 20


def _hidden(path: str) -> bool:
    return any(part.startswith((".", "_")) for part in path.strip("/").split("/"))


class FolderPartition(InputPartition):
    """A folder whose files a task lists and loads; ``since`` and ``until`` bound their modification times in ns."""

    def __init__(self, path: str, whole: bool, since: int = 0, until: int | None = None):
        self.path, self.whole, self.since, self.until = path, whole, since, until


@dataclass
class Folders:
    """The loading half that batch and stream share: the driver sees folders only, tasks see files."""

    load: Loader
    root: str
    depth: int
    names: list[str] | None = None  # file names that may be read, None for all

    def partitions(self, since: int = 0, until: int | None = None) -> list[FolderPartition]:
        """One for every folder down to ``depth``; the last level is listed whole, with all below it."""
        system, root = file_system(self.root)
        scheme = self.root.split("://")[0] + "://" if "://" in self.root and not self.root.startswith("file:") else ""
        level, out = [root.rstrip("/")], []
        for depth in range(self.depth + 1):
            out += [FolderPartition(scheme + folder, depth == self.depth, since, until) for folder in level]
            if depth < self.depth:
                found = [f for folder in level for f in system.get_file_info(fs.FileSelector(folder))]
                level = sorted(f.path for f in found if f.type == fs.FileType.Directory and not _hidden(f.base_name))
        return out

    def read(self, part: FolderPartition) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(part.path)
        scheme = part.path.removesuffix(folder) if "://" in part.path and not part.path.startswith("file:") else ""
        rows, chars = [], 0
        for info in sorted(system.get_file_info(fs.FileSelector(folder, recursive=part.whole)), key=lambda f: f.path):
            name = info.base_name
            if info.type != fs.FileType.File or _hidden(info.path[len(folder):]) or (self.names is not None and name not in self.names):
                continue
            if not part.since < (info.mtime_ns or 1) <= (part.until or sys.maxsize):
                continue
            for text, extra in self.load(scheme + info.path):
                rows.append((name, "1", text, list(extra.items())))
                chars += len(text)
                if len(rows) >= BATCH_ROWS or chars >= BATCH_CHARS:
                    yield self._batch(rows)
                    rows, chars = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(ARROW)], schema=ARROW)


class LoaderReader(DataSourceReader):
    """Batch reading; a filter on the file name keeps the others from being opened at all."""

    def __init__(self, folders: Folders):
        self.folders = folders

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            named = getattr(f, "attribute", None) == ("file_name",)
            wanted = [f.value] if named and isinstance(f, EqualTo) else list(f.value) if named and isinstance(f, In) else None
            if wanted is None:
                yield f  # left to Spark
            else:
                known = self.folders.names
                self.folders.names = [w for w in wanted if known is None or w in known]

    def partitions(self) -> list[FolderPartition]:
        return self.folders.partitions()

    def read(self, partition: FolderPartition) -> Iterator[pa.RecordBatch]:
        return self.folders.read(partition)


class LoaderStreamReader(DataSourceStreamReader):
    """Files by modification time: an offset is a point in time, so neither the driver nor the log lists files.

    A batch holds the files changed after its start and up to its end. ``settle_ms`` keeps the end that far
    behind the clock, for stores whose files appear after their time stamp.
    """

    def __init__(self, folders: Folders, settle_ms: int):
        self.folders, self.settle_ms = folders, settle_ms

    def initialOffset(self) -> dict:
        return {"until_ns": 0}

    def latestOffset(self) -> dict:
        return {"until_ns": time.time_ns() - self.settle_ms * 1_000_000}

    def partitions(self, start: dict, end: dict) -> list[FolderPartition]:
        return self.folders.partitions(start["until_ns"], end["until_ns"])

    def read(self, partition: FolderPartition) -> Iterator[pa.RecordBatch]:
        return self.folders.read(partition)


def data_source(loader: Registered) -> type[DataSource]:
    """A data source class that carries its loader along to the processes that plan and read."""

    class LoaderSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return f"loader_{loader.name}"

        def schema(self) -> str:
            return SCHEMA

        def _folders(self) -> Folders:
            own = {k: v for k, v in self.options.items() if k not in ("path", "depth", "settle_ms")}
            load = partial(loader.load, **own) if own else loader.load
            return Folders(load, self.options["path"], int(self.options.get("depth", "1")))

        def reader(self, schema) -> LoaderReader:
            return LoaderReader(self._folders())

        def streamReader(self, schema) -> LoaderStreamReader:
            return LoaderStreamReader(self._folders(), int(self.options.get("settle_ms", "10000")))

    return LoaderSource


def register_loaders(spark: SparkSession) -> None:
    """Make every registered loader readable as ``loader_<name>``, by batch and by stream."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for loader in LOADERS.values():
        spark.dataSource.register(data_source(loader))
