from tidemark.sinks.keyed_table import KeyedTable
from tidemark.sinks.storage import shared_dir
from tidemark.sinks.tables import ensure_table, replace_partition, save_full, write_backfill

__all__ = ["KeyedTable", "ensure_table", "replace_partition", "save_full", "shared_dir", "write_backfill"]
