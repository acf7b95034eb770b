"""Best row per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebelt.functions.columns import quoted


def with_group_max(df: DataFrame, keys: Sequence[str], measure: str, name: str) -> DataFrame:
    """Attach the group's maximum to each of its rows.

    Maxima are taken on the map side first and joined back, a join in which adaptive execution can split a
    group that holds too many rows: no group is brought together, as a window would. To pick the best
    rows only, use ``arg_max_per_group``.
    """
    own = [f"_key_{place}" for place in range(len(keys))]
    best = df.groupBy(*[F.col(quoted(key)).alias(o) for key, o in zip(keys, own)]).agg(F.max(measure).alias("_best"))
    same = reduce(and_, (df[key].eqNullSafe(best[o]) for key, o in zip(keys, own)))
    return df.join(best, same).select(*[df[quoted(c)] for c in df.columns], F.col("_best").alias(name))


def arg_max_per_group(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    *,
    ties: bool = True,
    tie_break: Sequence[str | Column] = (),
) -> DataFrame:
    """The rows with the greatest measure of each group.

    ``ties=True`` keeps every row that equals the maximum; a group without any value is absent.
    ``ties=False`` keeps one row per group, the first by ``tie_break``; a group whose values are
    all NULL then keeps one such row. NaN ranks above every number.

    Both are a rank that is cut at 1, which Spark also applies before the shuffle: each map task
    sends only its own best rows per group, so a group that holds most of the table arrives at
    its reducer as a handful of rows. Sum up first: with one row per group and period, ties are
    bounded by the number of periods.
    """
    rank = "_orebelt_rank"
    if ties:
        order = Window.partitionBy(*keys).orderBy(F.desc(measure))
        ranked = df.filter(F.col(measure).isNotNull()).withColumn(rank, F.rank().over(order))
    else:
        order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(measure), *tie_break)
        ranked = df.withColumn(rank, F.row_number().over(order))
    return ranked.filter(F.col(rank) == 1).drop(rank)


def latest_per_key(df: DataFrame, keys: Sequence[str], time_column: str) -> DataFrame:
    """Rows of the latest delivery of each key, for tables that hold a file's re-delivery too.

    A delivery may hold any number of rows of a key, so they are not brought together: the latest
    time per key is aggregated and the rows are matched against it, a join in which adaptive
    execution can split a hot key.
    """
    latest = df.groupBy(
        *[F.col(quoted(key)).alias(f"_key_{place}") for place, key in enumerate(keys)]
    ).agg(F.max(time_column).alias("_latest"))
    same_key = [df[key].eqNullSafe(F.col(f"_key_{place}")) for place, key in enumerate(keys)]
    matches = reduce(and_, same_key, df[time_column] == F.col("_latest"))
    return df.join(latest, matches, "left_semi")


def top_n(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows by ``order``: each task keeps ``n`` rows, no full sort is shuffled."""
    return df.orderBy(*order).limit(n)


def sort_rows(df: DataFrame, *order: str | Column) -> DataFrame:
    """All rows in global order, with the plan below run once.

    A global sort samples its input for the ranges first, and would run a scan and join below it
    a second time for that. The rows are therefore put down in a shuffle before, balanced in
    size, and both the sample and the sort read them from there; a stored table needs no more than
    ``orderBy``. Rows that are equal in ``order`` are told apart by a hash of the whole row, so that a value that
    many rows have is cut into several ranges; only rows that are equal in all columns stay together.
    """
    hashable = [F.col(quoted(f.name)) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return df.hint("rebalance").orderBy(*order, F.xxhash64(*hashable))
