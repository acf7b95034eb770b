"""Snapshots: many full copies under names that carry a time; the greatest name is current."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebelt.functions.columns import quoted


def latest_name(df: DataFrame, name: str, suffix: str = ".json") -> DataFrame:
    """One row, ``latest``: the greatest name that ends in ``suffix`` (NULL if there is none)."""
    column = F.col(quoted(name))
    return df.filter(column.endswith(suffix)).agg(F.max(column).alias("latest"))


def latest_snapshot(df: DataFrame, name: str, suffix: str = ".json") -> DataFrame:
    """The rows of the latest snapshot.

    The name is found by a scalar subquery inside the plan, which reads the name column only; on
    a table partitioned by the name the second read then opens a single partition.
    """
    return df.filter(F.col(quoted(name)) == latest_name(df, name, suffix).scalar())
