from orebelt.sinks.tables import (
    annotate,
    materialize,
    preview,
    register_files,
    remove_old_contents,
    table_comment,
    table_properties,
    write_delimited,
    write_documents,
)

__all__ = [
    "annotate",
    "materialize",
    "preview",
    "register_files",
    "remove_old_contents",
    "table_comment",
    "table_properties",
    "write_delimited",
    "write_documents",
]
