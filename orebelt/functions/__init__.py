from orebelt.functions.columns import (
    cast_columns,
    clean_column_names,
    explode_records,
    flatten_struct,
    snake_case,
    standardize_names,
    trim_strings,
    typed,
    with_lineage,
)
from orebelt.functions.text import (
    compact_stamp,
    iso_stamp,
    link_names,
    snapshot_name,
    thousands,
    with_prefix,
)

__all__ = [
    "cast_columns",
    "clean_column_names",
    "compact_stamp",
    "explode_records",
    "flatten_struct",
    "iso_stamp",
    "link_names",
    "snake_case",
    "snapshot_name",
    "standardize_names",
    "thousands",
    "trim_strings",
    "typed",
    "with_lineage",
    "with_prefix",
]
