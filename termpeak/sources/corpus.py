"""Documents as a directory tree of text files, one document per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termpeak.functions.records import line_text
from termpeak.sources.trees import tree_contents, tree_files

HIDDEN = ("fail", "skip", "read")


def load_corpus(spark: SparkSession, path: str, hidden: str = "fail") -> DataFrame:
    """``filename``, ``content``, ``label`` of every file below the directory ``path``.

    ``filename`` is the file's path below ``path``, so it is unique; ``label`` is the
    name of the file's directory. The whole file is the content, headers included. A
    file of zero bytes gives no row: Spark skips it, and it has no words.

    Spark's readers pass over files and directories whose names begin with ``_`` or
    ``.``. If there are any, this raises a ``ValueError`` that names some of them;
    ``hidden="skip"`` leaves them out instead, and ``hidden="read"`` reads them too:
    the whole tree is listed and read by tasks with Arrow's file systems (local, HDFS,
    S3, GCS), and no list of it comes to the driver. That is the only mode that runs
    Python on the executors.

    Every file is a seek and an open. Read such a tree once, write it with
    :func:`~termpeak.sources.ndjson.write_ndjson` or as Parquet, and query that;
    for that one read, a smaller ``spark.sql.files.openCostInBytes`` packs more
    small files into a task.
    """
    if hidden not in HIDDEN:
        raise ValueError(f"hidden={hidden!r}; one of {', '.join(map(repr, HIDDEN))}")
    if hidden == "read":
        root = _resolved(spark, path)[1].toUri().getPath().rstrip("/")
        files = tree_files(spark, path).where("size > 0")
        return tree_contents(spark, path, files).select(
            "filename",
            line_text(F.col("value").cast("string")).alias("content"),
            _directory(F.col("filename"), root).alias("label"),
        )
    root, passed_over = _look_at(spark, path)
    if passed_over and hidden == "fail":
        raise ValueError(f"not readable by Spark, as hidden: {', '.join(passed_over)}")
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return files.select(
        _below(root).alias("filename"),
        line_text(F.col("value")).alias("content"),
        F.element_at(F.split(_full_path(), "/"), -2).alias("label"),
    )


def _full_path() -> Column:
    # file_path is percent-encoded; url_decode would also turn + into a space
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(encoded)


def _below(root: str) -> Column:
    """The path of the row's file below the root."""
    # the path without scheme and host, which have one to three slashes
    plain = F.regexp_replace(_full_path(), "^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?(?=/)", "")
    return F.substring(plain, F.lit(len(root) + 2), F.length(plain))


def _directory(filename: Column, root: str) -> Column:
    """The name of a file's directory; the tree's own for a file at its top."""
    name = F.get(F.slice(F.split(filename, "/"), -2, 1), F.lit(0))
    return F.when(F.contains(filename, F.lit("/")), name).otherwise(F.lit(root.split("/")[-1]))


def _resolved(spark: SparkSession, path: str):
    """The directory's file system and its path there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, system.resolvePath(place)


def _look_at(spark: SparkSession, path: str, most: int = 5) -> tuple[str, list[str]]:
    """The directory's plain path, and some hidden names at any depth below it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    system, root = _resolved(spark, path)
    special = "\\*?[]{}"
    literal = "".join(f"\\{c}" if c in special else c for c in root.toString())
    found: list[str] = []
    level = literal
    while len(found) < most:
        hits = system.globStatus(hadoop.Path(f"{level}/[_.]*"))
        found += [hits[k].getPath().toString() for k in range(min(len(hits), most))]
        level += "/*"
        if not len(system.globStatus(hadoop.Path(level))):
            break
    return root.toUri().getPath().rstrip("/"), found[:most]
