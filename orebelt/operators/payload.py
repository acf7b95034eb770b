"""JSON payloads: parse them, wrap them in an envelope, split rows into bounded documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE_METADATA = "struct<source_url: string, fetched_at: string, record_count: bigint>"


def parse_payload(
    df: DataFrame, json_column: str, schema: str | T.StructType, records: str | None = None
) -> DataFrame:
    """Add the parsed ``payload``, its record array as ``records`` and the ``record_count``.

    ``records`` is the path of the array inside the payload (``"data"``); None leaves the two
    record columns out. Text that does not parse gives NULL fields and a NULL count.
    """
    parsed = df.withColumn("payload", F.from_json(json_column, schema))
    if records is None:
        return parsed
    array = F.col(f"payload.{records}")
    return parsed.withColumns(
        {"records": array, "record_count": F.when(array.isNotNull(), F.size(array)).cast("bigint")}
    )


def payload_keys(json_column: str) -> Column:
    """Top-level keys of a JSON object."""
    return F.json_object_keys(json_column)


def envelope_schema(record: str | T.StructType) -> str:
    """Schema text of an envelope whose records have the fields of ``record``."""
    inner = record.simpleString() if isinstance(record, T.StructType) else record
    return f"metadata {ENVELOPE_METADATA}, data struct<data: array<{inner}>>"


def wrap_envelope(
    df: DataFrame, records: str, source_url: str | Column, fetched_at: Column
) -> DataFrame:
    """Add ``document``: the JSON text ``{"metadata": {...}, "data": {"data": [...]}}``."""
    url = F.lit(source_url) if isinstance(source_url, str) else source_url
    metadata = F.struct(
        url.alias("source_url"),
        fetched_at.alias("fetched_at"),
        F.size(F.coalesce(F.col(records), F.array())).cast("bigint").alias("record_count"),
    )
    body = F.struct(F.col(records).alias("data"))
    envelope = F.struct(metadata.alias("metadata"), body.alias("data"))
    options = {"ignoreNullFields": "false"}
    return df.withColumn("document", F.to_json(envelope, options))


def pack_records(
    df: DataFrame, fields: Sequence[Column], *, by: Sequence[str] = (), size: int = 1000
) -> DataFrame:
    """Rows -> arrays ``records`` of at most ``size`` structs, apart for each value of ``by``.

    Rows are numbered where they are scanned, and ``size`` neighbours share a document. So a
    document is bounded no matter how many rows share a ``by`` value, and the numbering needs no
    shuffle. Use it on a frame that comes straight from a scan, where the numbers repeat when a
    lost task is run again.
    """
    chunk = "_chunk"
    numbered = df.withColumn(chunk, F.expr(f"monotonically_increasing_id() div {int(size)}"))
    return (
        numbered.groupBy(*by, chunk)
        .agg(F.collect_list(F.struct(*fields)).alias("records"))
        .drop(chunk)
    )
