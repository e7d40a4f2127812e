"""Results that appear whole, all of them or none."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    system, place = _located(spark, path)
    return system.exists(place)


def _located(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def directory_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a directory, which should be few: they come to the driver."""
    system, place = _located(spark, path)
    found = system.listStatus(place)
    return [found[k].getPath().getName() for k in range(len(found))]


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a directory to a name that nothing has; an error if that fails."""
    system, place = _located(spark, target)
    if system.exists(place):
        raise FileExistsError(f"{target} exists already")
    system.mkdirs(place.getParent())
    if not system.rename(_located(spark, source)[1], place):
        raise OSError(f"{source} could not be renamed to {target}")


def remove(spark: SparkSession, path: str) -> None:
    system, place = _located(spark, path)
    system.delete(place, True)


@contextmanager
def published(spark: SparkSession, *paths: str) -> Iterator[list[str]]:
    """Directories to write to, which become ``paths`` together at the end.

    None of the paths may exist; that is checked before any work. What is written goes
    to directories beside them. If the work succeeds they are renamed one after the
    other; should a rename fail, those before it are taken back. If the work fails, the
    paths stay as they were and what was written is deleted. A directory that was not
    written is not renamed.

    Each rename is one step of the file system; a reader may see the first path for the
    moment before the second is there. On object stores a rename is a copy.
    """
    for path in paths:
        if path_exists(spark, path):
            raise FileExistsError(f"{path} exists already")
    mark = uuid4().hex
    staged = [f"{path.rstrip('/')}.staged-{mark}" for path in paths]
    done: list[str] = []
    try:
        yield staged
        for source, target in zip(staged, paths, strict=True):
            if path_exists(spark, source):
                rename(spark, source, target)
                done.append(target)
    except BaseException:
        for path in done:
            remove(spark, path)
        raise
    finally:
        for path in staged:
            remove(spark, path)
