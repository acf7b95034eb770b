from orebelt.sources.documents import read_records
from orebelt.sources.files import (
    file_inventory,
    file_layouts,
    infer_raw_schema,
    inventory_by_folder,
    latest_file,
    read_delimited,
    read_json_documents,
    remembered_columns,
)

__all__ = [
    "file_inventory",
    "file_layouts",
    "infer_raw_schema",
    "inventory_by_folder",
    "latest_file",
    "read_delimited",
    "read_json_documents",
    "read_records",
    "remembered_columns",
]
