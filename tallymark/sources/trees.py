"""Trees of text files: listing them and writing them, as Spark data sources.

Spark's own file sources leave out files without a byte and cannot name the files they write.
Here the folders of a tree are listed side by side, one task each, and every written file has
the name its rows tell. Both work on any file system that ``pyarrow.fs`` opens by its address
(local or mounted, S3, GCS, ABFS, HDFS).
"""

from __future__ import annotations

import fnmatch
import sys
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage)

# Tasks get these classes with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTING = "tallymark_listing"
TREE = "tallymark_tree"
LISTING_SCHEMA = "source_file string, bytes bigint, modified timestamp"
TREE_SCHEMA = "source_file string, line string"
BATCH = 10_000


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address and the path in it, without a slash at the end."""
    if root.startswith("file:"):
        root = "/" + root.removeprefix("file:").lstrip("/")
    for name in ("s3a://", "s3n://"):
        if root.startswith(name):
            root = "s3://" + root.removeprefix(name)
    system, path = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
    return system, path.rstrip("/") or "/"


def visible(name: str) -> bool:
    """Names that Spark's file sources read."""
    return not name.startswith(("_", "."))


@dataclass
class Folder(InputPartition):
    """A folder to list: with all below it, or only its own files."""

    path: str
    deep: bool


class ListingReader(DataSourceReader):
    def __init__(self, root: str, glob: str, tasks: int) -> None:
        self.root, self.glob, self.tasks = root, glob, tasks

    def _entries(self, system: fs.FileSystem, path: str) -> list[fs.FileInfo]:
        return [e for e in system.get_file_info(fs.FileSelector(path)) if visible(e.base_name)]

    def partitions(self) -> list[Folder]:
        """Whole levels are opened until there are folders enough; deeper ones are left to tasks."""
        system, root = opened(self.root)
        shallow, level = [], [root]
        while level and len(level) < self.tasks:
            shallow += level
            level = [e.path for path in level for e in self._entries(system, path)
                     if e.type == fs.FileType.Directory]
        return [Folder(p, False) for p in shallow] + [Folder(p, True) for p in level]

    def read(self, partition: Folder):
        system, root = opened(self.root)
        left, rows = [partition.path], []
        while left:
            for entry in self._entries(system, left.pop()):
                if entry.type == fs.FileType.Directory:
                    if partition.deep:
                        left.append(entry.path)
                elif entry.is_file and fnmatch.fnmatchcase(entry.base_name, self.glob):
                    rows.append((entry.path[len(root.rstrip("/")) + 1:], entry.size, entry.mtime))
                if len(rows) == BATCH:
                    yield _batch(rows)
                    rows = []
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.timestamp("us", "UTC"))],
        names=["source_file", "bytes", "modified"])


class Listing(DataSource):
    @classmethod
    def name(cls) -> str:
        return LISTING

    def schema(self) -> str:
        return LISTING_SCHEMA

    def reader(self, schema) -> ListingReader:
        return ListingReader(
            self.options["path"], self.options.get("glob", "*"), int(self.options.get("tasks", 64)))


class TreeWriter(DataSourceArrowWriter):
    """Rows that come file by file; a file appears under its name when it is whole.

    A task that is run again writes the same files again, and a move replaces what was there.
    """

    def __init__(self, root: str) -> None:
        self.root = root

    def write(self, iterator) -> WriterCommitMessage:
        system, root = opened(self.root)
        name, stream, started = None, None, None

        def finish() -> None:
            if stream is not None:
                stream.close()
                system.move(started, f"{root}/{name}")

        for batch in iterator:
            names, lines = batch.column(0), batch.column(1)
            for start, stop in _runs(names):
                if (own := names[start].as_py()) != name:
                    finish()
                    name = own
                    folder, _, file = f"{root}/{name}".rpartition("/")
                    system.create_dir(folder, recursive=True)
                    started = f"{folder}/_{file}-{uuid.uuid4().hex}"
                    stream = system.open_output_stream(started)
                texts = [t for t in lines.slice(start, stop - start).to_pylist() if t is not None]
                if texts:
                    stream.write(("\n".join(texts) + "\n").encode())
        finish()
        return WriterCommitMessage()


def _runs(names: pa.Array) -> list[tuple[int, int]]:
    """From where to where neighbouring rows have equal names."""
    coded = names.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    if not len(coded):
        return []
    cuts = [0, *(i + 1 for i in (coded[1:] != coded[:-1]).nonzero()[0].tolist()), len(coded)]
    return list(zip(cuts, cuts[1:]))


class Tree(DataSource):
    @classmethod
    def name(cls) -> str:
        return TREE

    def schema(self) -> str:
        return TREE_SCHEMA

    def writer(self, schema, overwrite: bool) -> TreeWriter:
        return TreeWriter(self.options["path"])


def list_tree(spark: SparkSession, root: str, glob: str = "*", tasks: int = 64) -> DataFrame:
    """Path below ``root``, size and time of every file whose name fits, empty ones included.

    At least ``tasks`` folders are listed side by side where the tree has so many; no list of
    files passes through the driver.
    """
    spark.dataSource.register(Listing)
    return spark.read.format(LISTING).options(path=root, glob=glob, tasks=str(tasks)).load()


def write_tree(lines: DataFrame, root: str, order: list[str]) -> None:
    """Rows (source_file, line) as text files of those names, each file's lines in ``order``.

    A NULL line adds nothing, so a file with no other is empty. A file is written by one task,
    row by row.
    """
    lines.sparkSession.dataSource.register(Tree)
    placed = lines.repartition("source_file").sortWithinPartitions("source_file", *order)
    placed.select("source_file", "line").write.format(TREE).mode("append").option("path", root).save()
