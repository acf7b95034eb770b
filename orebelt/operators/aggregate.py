"""Global and grouped aggregates over tall ``(series, year, period, value)`` rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def summary_stats(
    df: DataFrame, measure: str, period: str, start: int | None = None, end: int | None = None
) -> DataFrame:
    """Mean, sample standard deviation, first and last period and row count of a closed range.

    Always one row: over no rows the count is 0 and the rest NULL. The deviation of a single
    row is NULL.
    """
    if start is not None and end is not None:
        df = df.filter(F.col(period).between(start, end))
    elif start is not None:
        df = df.filter(F.col(period) >= start)
    elif end is not None:
        df = df.filter(F.col(period) <= end)
    return df.agg(
        F.mean(measure).alias(f"mean_{measure}"),
        F.stddev(measure).alias(f"stddev_{measure}"),
        F.min(period).alias(f"start_{period}"),
        F.max(period).alias(f"end_{period}"),
        F.count("*").alias(f"{period}_count"),
    )


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """Number of rows as a one-row frame; a Parquet scan reads no column for it."""
    return df.agg(F.count("*").alias(name))


def yearly_sums(
    df: DataFrame,
    keys: Sequence[str | Column] = ("series_id", "year"),
    measure: str | Column = "value",
    period: str | Column = "period",
    pattern: str = "Q%",
    periods: Sequence[str] | None = None,
) -> DataFrame:
    """Sum of the measure per key over the periods that match ``pattern``.

    ``periods`` restricts the sum to an explicit list, for instance to leave a fifth "quarter"
    out. Keys and measure may be expressions, so untrimmed tables can be grouped directly.
    """
    period = F.col(period) if isinstance(period, str) else period
    wanted = period.isin(list(periods)) if periods is not None else period.like(pattern)
    return df.filter(wanted).groupBy(*keys).agg(F.sum(measure).alias("total_value"))
