from tidemark.sources.landing import (
    incremental_extract,
    load_schema,
    read_accounted,
    read_landing,
    resolve_schema,
    save_schema,
)
from tidemark.sources.marks import extract_since_mark, load_mark
from tidemark.sources.pages import infer_pages, read_pages
from tidemark.sources.tables import read_partition, read_table

__all__ = [
    "extract_since_mark",
    "incremental_extract",
    "infer_pages",
    "load_mark",
    "load_schema",
    "read_accounted",
    "read_landing",
    "read_pages",
    "read_partition",
    "read_table",
    "resolve_schema",
    "save_schema",
]
