"""Stored datasets: full refresh, annotations, text and document files."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orebelt.functions.columns import quoted
from orebelt.session import delete_folder, list_folder


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _table(name: str) -> str:
    return ".".join(quoted(part) for part in name.split("."))


def annotate(
    spark: SparkSession,
    name: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Set the comment and properties of a table, e.g. ``{"quality": "gold"}``."""
    if _is_view(spark, name):
        given = {**({} if comment is None else {"comment": comment}), **(properties or {})}
        if given:
            spark.sql(f"ALTER VIEW {_table(name)} SET TBLPROPERTIES ({_pairs(given)})")
        return
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {_table(name)} IS {_text(comment)}")
    if properties:
        spark.sql(f"ALTER TABLE {_table(name)} SET TBLPROPERTIES ({_pairs(properties)})")


def _pairs(properties: Mapping[str, str]) -> str:
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def table_comment(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_table(name)}").filter("col_name = 'Comment'")
    row = rows.first()
    return row["data_type"] if row else None


def table_properties(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW TBLPROPERTIES {_table(name)}")


def materialize(
    df: DataFrame,
    name: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    *,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Store ``df`` as a table, replacing its earlier content, and return the stored table.

    With a ``path`` the rows are first written in full to a new folder below it, as a table of their own, and
    only then does the name, a view, point there: a refresh that fails leaves the previous content in place,
    and ``df`` may read the table it replaces. The switch is one change in the catalog, whatever changes in
    columns or partitions, so a reader finds the previous content or the new one at any time. Tables and
    folders of earlier content stay until ``remove_old_contents``, as a reader may have found them already.
    Without a ``path`` the table is overwritten in the warehouse folder.

    ``sort_by`` sorts within each task, without a shuffle, so that a filter on those columns skips
    row groups.
    """
    spark = df.sparkSession
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    writer = df.write.format("parquet").partitionBy(*partition_by)
    if path is None:
        writer.mode("overwrite").saveAsTable(name)
    else:
        version = f"{path}/content-{uuid.uuid4().hex}"
        writer.save(version)
        _switch(spark, name, version, _stored_schema(df.schema, partition_by), partition_by, comment, properties)
        return spark.read.table(name)
    annotate(spark, name, comment, properties)
    return spark.read.table(name)


def _stored_schema(schema: T.StructType, partition_by: Sequence[str]) -> T.StructType:
    """As a table has it: partition columns last, everything nullable."""
    last = {name: place for place, name in enumerate(partition_by)}
    fields = sorted(schema.fields, key=lambda f: last.get(f.name, -1))
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def _create(spark: SparkSession, name: str, location: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    parts = f"PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    spark.sql(f"CREATE TABLE {_table(name)} ({schema.toDDL()}) USING parquet {parts} LOCATION {_text(location)}")
    if partition_by:
        spark.catalog.recoverPartitions(name)


CONTENT = "content_table"  # property of a view: the table that it shows


def _switch(
    spark: SparkSession,
    name: str,
    version: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    comment: str | None,
    properties: Mapping[str, str] | None,
) -> None:
    content = f"{name}__{version.rsplit('-', 1)[-1]}"
    _create(spark, content, version, schema, partition_by)
    known: dict[str, str] = {}
    if spark.catalog.tableExists(name):
        if _is_view(spark, name):
            known = {r["key"]: r["value"] for r in table_properties(spark, name).collect()}
            known = {k: v for k, v in known.items() if not k.startswith("view.") and k != "comment"}
            comment = table_comment(spark, name) if comment is None else comment
        else:  # one that was not stored by path so far
            spark.sql(f"DROP TABLE {_table(name)}")
    given = {**known, **(properties or {}), CONTENT: content}
    said = "" if comment is None else f"COMMENT {_text(comment)}"
    spark.sql(
        f"CREATE OR REPLACE VIEW {_table(name)} {said} TBLPROPERTIES ({_pairs(given)}) AS SELECT * FROM {_table(content)}"
    )


def _contents(spark: SparkSession, name: str) -> list[str]:
    """The tables of the contents of ``name``, qualified as that is."""
    space, _, base = name.rpartition(".")
    tables = spark.catalog.listTables(space or None, f"{base}__*")
    is_content = re.compile(rf"{re.escape(base)}__[0-9a-f]{{32}}", re.I).fullmatch
    return [f"{space}.{t.name}" if space else t.name for t in tables if is_content(t.name)]


def table_location(spark: SparkSession, name: str) -> str:
    """Where the rows of a table lie, or those of the table that a view of ``materialize`` shows."""
    if _is_view(spark, name):
        name = table_properties(spark, name).filter(f"key = '{CONTENT}'").first()["value"]
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_table(name)}").filter("col_name = 'Location'")
    return rows.first()["data_type"]


def remove_old_contents(spark: SparkSession, name: str, path: str) -> list[str]:
    """Delete what ``materialize`` has left below ``path`` from before the current content."""
    current = table_location(spark, name).rstrip("/").rsplit("/", 1)[-1]
    old = [
        entry
        for entry in list_folder(spark, path)
        if (folder := entry.rstrip("/").rsplit("/", 1)[-1]).startswith("content-") and folder != current
    ]
    if len(old) == len(list_folder(spark, path)):
        raise ValueError(f"{name} is not stored below {path}")
    for content in _contents(spark, name):
        if not content.lower().endswith(current.removeprefix("content-").lower()):
            spark.sql(f"DROP TABLE IF EXISTS {_table(content)}")
    for entry in old:
        delete_folder(spark, entry)
    return old


def register_files(spark: SparkSession, name: str, path: str, schema: T.StructType) -> None:
    """A table over the files at ``path``; columns that have come up since are added to it."""
    if not spark.catalog.tableExists(name):
        _create(spark, name, path, _stored_schema(schema, ()))
        return
    known = set(spark.read.table(name).columns)
    new = T.StructType([T.StructField(f.name, f.dataType) for f in schema if f.name not in known])
    if new.fields:
        spark.sql(f"ALTER TABLE {_table(name)} ADD COLUMNS ({new.toDDL()})")


def write_delimited(
    df: DataFrame, path: str, *, sep: str = "\t", header: bool = True, mode: str = "errorifexists"
) -> None:
    """Delimited text that keeps the padding of names and values; NULL is an empty field."""
    (
        df.write.mode(mode)
        .option("header", str(header).lower())
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("emptyValue", "")
        .csv(path)
    )


def write_documents(
    df: DataFrame, path: str, *, document: str = "document", one_per_file: bool = False
) -> None:
    """JSON text, one document per line, or one per file."""
    writer = df.select(document).write
    if one_per_file:
        writer = writer.option("maxRecordsPerFile", 1)
    writer.text(path)


def preview(df: DataFrame, n: int = 100, *order: str) -> DataFrame:
    """The first ``n`` rows; give an order to see the same rows each time."""
    return (df.orderBy(*order) if order else df).limit(n)
