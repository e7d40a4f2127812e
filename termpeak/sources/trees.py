"""Directory trees as Spark's own readers do not show them: every name, in tasks."""

from __future__ import annotations

import os
import posixpath
from collections.abc import Iterator
from itertools import chain, islice
from typing import TYPE_CHECKING

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from termpeak.plans.layout import scratch_path

if TYPE_CHECKING:
    from pyarrow.fs import FileSystem

ENTRIES = 10_000  # of a directory that are held as rows at a time
READ_BYTES = 4 << 20  # of files that are held as rows at a time, or one larger file


def tree_root(spark: SparkSession, path: str) -> str:
    """The directory as a plain path on a local file system, as a URI on any other."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = system.makeQualified(hadoop).toUri()
    if uri.getScheme() in (None, "file"):
        return uri.getPath().rstrip("/")
    return uri.toString().rstrip("/")


def open_tree(root: str) -> tuple[FileSystem, str]:
    """Arrow's file system for a root, and the root's path on it."""
    from pyarrow import fs  # only tasks that read or write trees need it

    if root.startswith("/"):
        return fs.LocalFileSystem(), root
    system, path = fs.FileSystem.from_uri(root)
    return system, path.rstrip("/")


def _entries(system: FileSystem, directory: str) -> Iterator[tuple[str, int | None]]:
    """The names in a directory and the sizes of its files, null for what is no file."""
    from pyarrow import fs

    if isinstance(system, fs.LocalFileSystem):
        # entry by entry, where Arrow makes a list of all
        with os.scandir(directory) as found:
            for entry in found:
                yield entry.name, entry.stat().st_size if entry.is_file() else None
        return
    for info in system.get_file_info(fs.FileSelector(directory)):
        yield info.base_name, info.size if info.is_file else None


def tree_files(spark: SparkSession, path: str) -> DataFrame:
    """``filename`` (its path below ``path``) and ``size`` of every file of a tree.

    Names that begin with ``_`` or ``.`` are listed like any other. The tree is listed
    level by level, each directory by one task; what a level has is written to the
    shared scratch folder, so that the directories never come to the driver.
    """
    root = tree_root(spark, path)

    def entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = open_tree(root)
        for frame in frames:
            for directory in frame["filename"]:
                found = _entries(system, posixpath.join(base, directory))
                while some := list(islice(found, ENTRIES)):
                    names = [posixpath.join(directory, name) for name, _ in some]
                    sizes = [size for _, size in some]
                    yield pd.DataFrame({"filename": names, "size": sizes}, dtype=object)

    schema = "filename string, size long"
    level = spark.createDataFrame([("",)], "filename string")
    files = spark.createDataFrame([], schema)
    while True:
        place = scratch_path(spark, "level")
        level.mapInPandas(entries, schema).write.parquet(place)
        here = spark.read.schema(schema).parquet(place)
        files = files.unionAll(here.where("size is not null"))
        level = here.where("size is null").select("filename")
        if level.isEmpty():
            return files
        level = level.repartition(spark.sparkContext.defaultParallelism)


def tree_contents(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """``filename`` and the bytes, ``value``, of some files of a tree.

    A file is read whole by the task that has its name.
    """
    root = tree_root(spark, path)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = open_tree(root)
        names, values, held = [], [], 0
        for name in chain.from_iterable(f["filename"] for f in frames):
            with system.open_input_stream(posixpath.join(base, name)) as stream:
                value = stream.read()
            if names and held + len(value) > READ_BYTES:
                yield pd.DataFrame({"filename": names, "value": values}, dtype=object)
                names, values, held = [], [], 0
            names.append(name)
            values.append(value)
            held += len(value)
        if names:
            yield pd.DataFrame({"filename": names, "value": values}, dtype=object)

    dealt = files.select("filename").repartition(spark.sparkContext.defaultParallelism)
    return dealt.mapInPandas(read, "filename string, value binary")

