from orebelt.streaming.ingest import (
    append_stream,
    load_files,
    read_appended,
    read_files_stream,
    read_table_stream,
    rows_added,
)

__all__ = [
    "append_stream",
    "load_files",
    "read_appended",
    "read_files_stream",
    "read_table_stream",
    "rows_added",
]
