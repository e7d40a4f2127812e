"""Peak document per term, from documents or from files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession

from termpeak.operators.peak import merge_peaks, peak_document
from termpeak.operators.term_frequency import term_frequency
from termpeak.sinks.lines import write_peaks
from termpeak.sinks.publish import directory_names, path_exists, published, remove
from termpeak.sources.ndjson import (
    decode_documents,
    decoded_lines,
    malformed_lines,
    observed_documents,
    raw_lines,
)


def peak_documents(docs: DataFrame) -> DataFrame:
    """``word``, ``filename``, ``n`` for documents with ``filename`` and ``content``.

    One shuffle in all, of at most one row per word and map task.
    """
    return peak_document(term_frequency(docs))


def run_job(
    spark: SparkSession,
    input_path: str | list[str],
    output_path: str,
    rejects_path: str | None = None,
    partitions: int | None = None,
) -> None:
    """JSON lines in, peak lines out.

    A malformed line fails the job, unless ``rejects_path`` is given: then the peaks
    are computed without such lines, and they are written there, byte for byte, in a
    second pass that is made only if there are any. Both paths must not exist, which
    is checked before any work. They appear together when both passes are done; if
    either fails, neither does.

    ``partitions`` deals the lines out anew before they are counted. That shuffles
    the whole input, which pays only for one that cannot be split, such as a few
    large compressed files.
    """
    raw = raw_lines(spark, input_path)
    if partitions is not None:
        raw = raw.repartition(partitions)
    lines = decoded_lines(raw)
    if rejects_path is None:
        with published(spark, output_path) as (staged,):
            write_peaks(peak_documents(decode_documents(lines)), staged)
        return
    with published(spark, output_path, rejects_path) as (staged, staged_rejects):
        rejects = Observation("rejects")
        write_peaks(peak_documents(observed_documents(lines, rejects)), staged)
        if rejects.get["rejects"]:
            malformed_lines(raw_lines(spark, input_path)).write.text(staged_rejects)


def update_peaks(spark: SparkSession, path: str, docs: DataFrame) -> None:
    """Add documents to the peaks stored at ``path``; make them if there are none.

    Peaks are partial maxima, so the new documents and the stored peaks are all that is
    read, never the documents of before. Every update is a version of its own, a Parquet
    directory that appears whole by a rename; the versions before the one it was made
    from are deleted, that one stays for those who read it. Two updates at a time make
    the same version, and the later one fails and leaves nothing.
    """
    versions = _versions(spark, path)
    last = versions[-1] if versions else -1
    peaks = peak_documents(docs)
    if versions:
        peaks = merge_peaks(_version(spark, path, last), peaks)
    with published(spark, _version_path(path, last + 1)) as (staged,):
        peaks.write.parquet(staged)
    for old in versions[:-1]:
        remove(spark, _version_path(path, old))


def stored_peaks(spark: SparkSession, path: str) -> DataFrame:
    """``word``, ``filename``, ``n`` as of the last :func:`update_peaks`."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no peaks are stored at {path}")
    return _version(spark, path, versions[-1])


def _version_path(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/version-{number:08d}"


def _version(spark: SparkSession, path: str, number: int) -> DataFrame:
    schema = "word string, filename string, n long"
    return spark.read.schema(schema).parquet(_version_path(path, number))


def _versions(spark: SparkSession, path: str) -> list[int]:
    names = directory_names(spark, path) if path_exists(spark, path) else []
    return sorted(int(n[8:]) for n in names if re.fullmatch("version-[0-9]{8,}", n))
