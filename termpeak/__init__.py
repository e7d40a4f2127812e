"""Term statistics over large document collections, as Spark DataFrame steps."""

from termpeak.operators.peak import format_peak, merge_peaks, peak_document
from termpeak.operators.term_frequency import term_frequency
from termpeak.operators.tokenize import normalize_documents, tokenize
from termpeak.plans.peaks import peak_documents, run_job, stored_peaks, update_peaks
from termpeak.sinks.lines import output_lines, read_peaks, write_peaks
from termpeak.sinks.tables import read_documents, write_documents
from termpeak.sinks.trees import write_corpus
from termpeak.sources.corpus import load_corpus
from termpeak.sources.ndjson import (
    decode_documents,
    encode_documents,
    quarantine_documents,
    read_ndjson,
    write_ndjson,
)
from termpeak.sources.trees import tree_files

__all__ = [
    "decode_documents",
    "encode_documents",
    "format_peak",
    "load_corpus",
    "merge_peaks",
    "normalize_documents",
    "output_lines",
    "peak_document",
    "peak_documents",
    "quarantine_documents",
    "read_documents",
    "read_ndjson",
    "read_peaks",
    "run_job",
    "stored_peaks",
    "term_frequency",
    "tokenize",
    "tree_files",
    "update_peaks",
    "write_corpus",
    "write_documents",
    "write_ndjson",
    "write_peaks",
]
