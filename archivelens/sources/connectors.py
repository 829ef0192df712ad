"""Archives as data sources of Spark: ``spark.read.format("archive")`` (inventory S1, S4, S5).

A source lists its documents on the driver and reads them in tasks, in parts of a bounded number of files.  New kinds of
storage implement two functions; names that are reserved fail with a plain message.
"""

from __future__ import annotations

import fnmatch
import os
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FILES_A_PART = 256
SCHEMA = "filename string, filepath string, size_bytes bigint, modified timestamp, content string"


class FolderFiles(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class ArchiveReader(DataSourceReader):
    """Text files below a mounted folder that fit a pattern; hidden ones are left out."""

    def __init__(self, options: dict):
        self.root, self.pattern = options.get("path"), options.get("pattern", "*.md")
        if not self.root:
            raise ValueError("the source needs a path")

    def partitions(self) -> list[InputPartition]:
        found = []
        for folder, folders, names in os.walk(self.root):
            folders[:] = sorted(x for x in folders if not x.startswith("."))
            found += [os.path.join(folder, n) for n in sorted(names) if not n.startswith(".") and fnmatch.fnmatch(n, self.pattern)]
        return [FolderFiles(found[i : i + FILES_A_PART]) for i in range(0, len(found), FILES_A_PART)] or [FolderFiles([])]

    def read(self, partition: FolderFiles) -> Iterator[tuple]:
        for path in partition.paths:
            stat = os.stat(path)
            with open(path, encoding="utf-8", errors="replace", newline="") as f:
                yield os.path.basename(path), path, stat.st_size, datetime.fromtimestamp(stat.st_mtime, timezone.utc).replace(tzinfo=None), f.read()


class ArchiveSource(DataSource):
    """Documents of an archive: one row for each file."""

    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(self.options)


def _reserved(scheme: str) -> type[DataSource]:
    class Reserved(DataSource):
        @classmethod
        def name(cls) -> str:
            return scheme

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            raise NotImplementedError(f"no connector for {scheme} yet")

    return Reserved


SOURCES = {"archive": ArchiveSource} | {x: _reserved(x) for x in ("gdrive", "dropbox")}


def register(spark: SparkSession) -> None:
    """Make all sources known to a session, by their names."""
    for source in SOURCES.values():
        spark.dataSource.register(source)
