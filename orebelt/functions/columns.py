"""Column clean-up: names, white space, types, nesting, lineage.

Every function is ``DataFrame -> DataFrame`` and adds a single projection, so the result works
on batch and streaming frames alike and stays inside whole-stage code generation.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """``name`` as one back-quoted identifier, safe for spaces and dots."""
    return "`" + name.replace("`", "``") + "`"


def clean_column_names(df: DataFrame) -> DataFrame:
    """Strip leading and trailing white space from every column name."""
    return df.toDF(*[name.strip() for name in df.columns])


def snake_case(name: str) -> str:
    """``"Nation ID"`` -> ``"nation_id"``, ``"recordCount"`` -> ``"record_count"``."""
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", name.strip())
    return re.sub(r"[^0-9a-zA-Z]+", "_", spaced).strip("_").lower()


def standardize_names(df: DataFrame) -> DataFrame:
    """All column names in snake_case; a clash between two results is an error."""
    names = [name if name.startswith("_") else snake_case(name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"several columns would be called {clashes}")
    return df.toDF(*names)


def trim_strings(df: DataFrame, *columns: str) -> DataFrame:
    """Trim the space character off the named string columns (default: all of them)."""
    wanted = set(columns or df.columns)
    return df.select(
        *[
            F.trim(quoted(f.name)).alias(f.name)
            if f.name in wanted and isinstance(f.dataType, T.StringType)
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


# Text that stands for "no value" in a number column.
PLACEHOLDERS = ("", "-")


WHOLE_NUMBERS = ("tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long")


def typed(column: Column, data_type: str) -> Column:
    """Trim text, then cast; what is not a value of ``data_type`` becomes NULL.

    For the types of whole numbers, ``123.0`` and ``1.23E2`` are the number 123, while a number with
    a fraction is no value. ``try_cast`` keeps the bad row alive for the quality rules, where a plain
    ANSI cast would end the job. Floating-point parsing signals bad text by an exception inside the
    cast, which costs far more than a parse, so the usual placeholders are told apart beforehand.
    """
    text = F.trim(column.cast("string"))
    cast = text.try_cast(data_type)
    if data_type in ("double", "float"):
        return F.when(~text.isin(*PLACEHOLDERS), cast)
    if data_type in WHOLE_NUMBERS:
        number = text.try_cast("decimal(38,9)")
        whole = F.when(number == F.floor(number), F.floor(number).try_cast(data_type))
        return F.coalesce(cast, F.when(~text.isin(*PLACEHOLDERS), whole))
    return cast


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """``typed`` over several columns, e.g. ``{"year": "smallint", "value": "double"}``.

    Numbers are held to the same rule as text: one with a fraction is no whole number.
    """
    missing = [name for name in types if name not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")


    def cast(name: str) -> Column:
        column = F.col(quoted(name))
        kind = df.schema[name].dataType
        if isinstance(kind, T.NumericType):
            if types[name] in WHOLE_NUMBERS and not isinstance(kind, T.IntegralType):
                whole = F.floor(column) if isinstance(kind, T.DecimalType) else F.rint(column)
                column = F.when(column == whole, column)
            return column.try_cast(types[name])
        return typed(column, types[name])

    return df.select(
        *[cast(name).alias(name) if name in types else F.col(quoted(name)) for name in df.columns]
    )


def with_lineage(
    df: DataFrame, *, time_column: str = "_ingestion_time", file_part: str = "file_path"
) -> DataFrame:
    """Add ``_source_file`` and the load time to a frame that scans files.

    ``file_part`` is a field of Spark's hidden ``_metadata`` column: ``file_path`` or
    ``file_name``.
    """
    return df.select(
        *[F.col(quoted(name)) for name in df.columns if name != "_metadata"],
        F.col(f"_metadata.{file_part}").alias("_source_file"),
        F.current_timestamp().alias(time_column),
    )


def flatten_struct(df: DataFrame, column: str) -> DataFrame:
    """Replace a struct column by its fields, in place."""
    return df.select(
        *[
            F.col(f"{quoted(name)}.*") if name == column else F.col(quoted(name))
            for name in df.columns
        ]
    )


def explode_records(
    df: DataFrame, records: str, *, keep: Sequence[str] = (), alias: str = "record"
) -> DataFrame:
    """One row per array element, next to the ``keep`` columns; an empty array gives no row."""
    return df.select(F.explode(F.col(records)).alias(alias), *keep)
