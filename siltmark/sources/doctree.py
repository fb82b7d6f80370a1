"""A data source that lists document trees, spark.read.format("doctree").load(root), and readers of what it lists.

Spark's own file sources leave out names with a leading underscore, what lies in hidden directories, and empty files, all
of which belong to a tree here. Directories are looked into from the root down until there are enough to list
in parallel; symbolic links to files count, those to directories aren't followed. Files are read apart from listing, dealt
evenly over tasks. The root is a path that driver and executors share.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from siltmark.functions.paths import is_indexable, parse_extensions
from siltmark.schema import INDEX_VERSION, READ_BLOCK, SUPPORTED

#: Directories to have before listing goes parallel, and directories that the driver looks into at most to find them.
TASKS, LOOKS = 256, 256


def walk(root: str, top: str = "") -> Iterator[str]:
    """Paths of the files below root/top, relative to root."""
    for where, dirs, names in os.walk(os.path.join(root, top) if top else root):
        dirs.sort()
        for name in sorted(names):
            yield os.path.relpath(os.path.join(where, name), root).replace(os.sep, "/")


class DocTree(DataSource):
    @classmethod
    def name(cls) -> str:
        return "doctree"

    def schema(self) -> str:
        return "rel_path string, size bigint, mtime double, content binary"

    def reader(self, schema):
        return DocTreeReader(self.options)


class Entry(InputPartition):
    def __init__(self, top: str, whole: bool):
        super().__init__(top)
        self.top, self.whole = top, whole


class DocTreeReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"].removeprefix("file://")
        self.allowed = parse_extensions(options.get("extensions")) or frozenset(SUPPORTED)
        self.content = options.get("content", "false").lower() == "true"

    def partitions(self):
        if not os.path.isdir(self.root):
            raise FileNotFoundError(f"the tree does not exist: {self.root}")
        todo, files, looks = [""], [], 0
        while todo and len(todo) < TASKS and looks < LOOKS:
            looks += 1
            top = todo.pop(0)
            for e in sorted(os.scandir(os.path.join(self.root, top)), key=lambda e: e.name):
                name = f"{top}/{e.name}" if top else e.name
                if e.is_dir(follow_symlinks=False):
                    todo.append(name)
                elif e.is_file():
                    files.append(name)
        found = [Entry(top, True) for top in todo]
        found += [Entry("\0".join(files[i : i + 1000]), False) for i in range(0, len(files), 1000)]
        return found or [Entry("", False)]

    def read(self, partition):
        names = walk(self.root, partition.top) if partition.whole else (n for n in partition.top.split("\0") if n)
        for name in names:
            full = os.path.join(self.root, name)
            if is_indexable(name, self.allowed) and os.path.isfile(full):
                stat = os.stat(full)
                data = None
                if self.content:
                    with open(full, "rb") as f:
                        data = f.read()
                yield name, stat.st_size, stat.st_mtime, data


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DocTree)


def _dealt(listing: DataFrame) -> DataFrame:
    """Spread over tasks by a hash of the path."""
    return listing.repartition("rel_path")


def with_content(listing: DataFrame, root: str) -> DataFrame:
    """The listed files (rel_path and other columns) with their content; files that are gone by then are left out."""
    names = [c for c in listing.columns if c != "content"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(len(batch)):  # one by one, as a file can be large
                row = batch.iloc[i : i + 1].copy()
                try:
                    with open(os.path.join(root, row["rel_path"].iloc[0]), "rb") as f:
                        row["content"] = [f.read()]
                except FileNotFoundError:
                    continue
                yield row

    kinds = dict(listing.dtypes)
    return _dealt(listing.select(*names)).mapInPandas(read, ", ".join([*(f"`{c}` {kinds[c]}" for c in names), "content binary"]))


def hashed(listing: DataFrame, root: str, version: str = INDEX_VERSION) -> DataFrame:
    """(rel_path, size, mtime, file_hash) of the listed files: SHA-256 of the index version, a zero byte and the content, read in blocks."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for name in batch["rel_path"]:
                digest = hashlib.sha256(version.encode() + b"\0")
                try:
                    with open(os.path.join(root, name), "rb") as f:
                        while block := f.read(READ_BLOCK):
                            digest.update(block)
                    found.append(digest.hexdigest())
                except FileNotFoundError:
                    found.append(None)
            yield batch.assign(file_hash=found)[batch.columns.tolist() + ["file_hash"]].dropna(subset=["file_hash"])

    return _dealt(listing.select("rel_path", "size", "mtime")).mapInPandas(read, "rel_path string, size bigint, mtime double, file_hash string")
