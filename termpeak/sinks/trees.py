"""Documents as a directory tree: one file to a document, under its name."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termpeak.sinks.publish import published
from termpeak.sources.trees import open_tree, tree_root


def write_corpus(docs: DataFrame, path: str) -> None:
    """Each document's ``content`` as a file ``filename`` below the new directory ``path``.

    Files are UTF-8; null content makes an empty file. Names are paths of one or more
    parts and may begin with ``_`` or ``.``. A missing name, one that leads out of the
    tree, and one that stands there twice raise an error. The tree appears under
    ``path`` when it is whole, or not at all: it is written beside it and renamed.
    A task writes each file under a name of its own and moves it into place, so that
    tasks run twice leave one file.

    One file to a document suits tools that read such trees. Every file is a create and
    a rename for the file system; for Spark itself write Parquet or JSON lines.
    """
    spark = docs.sparkSession
    parts = F.split("filename", "/")
    wrong = F.col("filename").isNull() | F.exists(parts, lambda p: p.isin("", ".", ".."))
    error = F.raise_error(F.concat(F.lit("not a name below the tree: "), F.col("shown")))
    shown = F.coalesce("filename", F.lit("null"))
    named = docs.select(F.col("filename").cast("string"), "content", shown.alias("shown"))
    named = named.withColumn("filename", F.when(wrong, error).otherwise(F.col("filename")))
    twice = named.groupBy("filename").count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"{twice['count']} documents are named {twice['filename']!r}")

    with published(spark, path) as (staged,):
        root = tree_root(spark, staged)

        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, base = open_tree(root)
            made = set()
            for batch in batches:
                # value by value, not as a list of all texts beside the batch
                for name, content in zip(*batch.columns, strict=True):
                    target = posixpath.join(base, name.as_py())
                    parent = posixpath.dirname(target)
                    if parent not in made:
                        system.create_dir(parent, recursive=True)
                        made.add(parent)
                    own = posixpath.join(parent, f".{uuid4().hex}")
                    with system.open_output_stream(own) as stream:
                        stream.write(content.as_py() or b"")
                    system.move(own, target)
                yield pa.RecordBatch.from_pydict({"files": [batch.num_rows]})

        content = F.col("content").cast("string").cast("binary")
        made = named.select("filename", content.alias("content")).mapInArrow(write, "files long")
        made.agg(F.sum("files")).collect()
        system, base = open_tree(root)
        system.create_dir(base, recursive=True)  # a tree without documents
