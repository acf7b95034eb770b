"""Enrichment from a yearly dimension, and differences of key sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebelt.functions.columns import quoted
from orebelt.session import stage

BROADCAST_BYTES = 32 << 20
SALT = "_salt"
FINE = 16  # many small shares of a key even out where a few would meet in a task


FIXED_WIDTH = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def _measurable(kind: T.DataType) -> bool:
    return isinstance(kind, (*FIXED_WIDTH, T.StringType, T.BinaryType))


def measured_bytes(df: DataFrame) -> int:
    """Bytes the rows of ``df`` take in memory, counted by one distributed aggregate."""
    variable = [
        F.coalesce(F.octet_length(quoted(f.name)), F.lit(0))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    odd = [f.name for f in df.schema.fields if not _measurable(f.dataType)]
    if odd:
        raise ValueError(f"cannot bound the size of nested columns {odd}")
    width = F.lit(16 + 8 * len(df.columns)).cast("bigint")
    for extra in variable:
        width = width + extra
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only if its measured size is within ``limit``.

    Beyond it, or with nested columns, the frame is returned unmarked: the join is shuffled, and
    adaptive execution splits a year that holds too many rows over several tasks.
    """
    measurable = all(_measurable(f.dataType) for f in df.schema.fields)
    return F.broadcast(df) if measurable and measured_bytes(df) <= limit else df


def one_row_per_key(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """``df`` unchanged if ``key`` is unique; otherwise the query fails and names a duplicate."""
    message = F.concat(F.lit(f"duplicate {key} in dimension: "), F.col(key).cast("string"))
    checked = F.when(F.col("_copies") > 1, F.raise_error(message)).otherwise(F.col(key))
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("_copies"), *[F.max(a).alias(a) for a in attributes])
        .select(checked.alias(key), *attributes)
    )


def enrich_by_year(
    observations: DataFrame,
    dimension: DataFrame,
    attributes: Sequence[str] = ("population",),
    *,
    year: str = "year",
    dimension_year: str = "year",
    how: str = "left",
    unique: bool = False,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the attributes of the observation's year.

    ``how="left"`` keeps observations of unknown years with NULL attributes, ``"inner"`` drops
    them. A year with several dimension rows multiplies its observations; ``unique=True`` makes
    such a year an error instead.

    The observations are never shuffled for a dimension that fits into a broadcast. With
    ``unique=True`` and a one- or two-byte year that is certain without looking: at most 65,536
    fixed-width rows. Otherwise the size is measured first and ``limit`` decides; the rows are the
    same either way. A year that holds many of the rows is split by adaptive execution, or, where that is
    off, by ``spread_hot_keys``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    clashes = sorted(set(attributes) & set(observations.columns))
    if clashes:
        raise ValueError(f"the observations already have columns {clashes}")
    key = "_dimension_year"
    year_type = observations.schema[year].dataType
    small_key = isinstance(year_type, (T.ByteType, T.ShortType))
    side = dimension.select(
        F.col(quoted(dimension_year)).alias(key), *[F.col(quoted(a)) for a in attributes]
    ).filter(F.col(key).isNotNull())
    fixed = all(isinstance(side.schema[a].dataType, FIXED_WIDTH) for a in attributes)
    if unique:
        if small_key:
            # Years outside the observations' type cannot match; the key keeps its own type.
            low, high = (-128, 127) if isinstance(year_type, T.ByteType) else (-32768, 32767)
            side = side.filter(F.col(key).between(low, high))
        side = one_row_per_key(side, key, attributes)
    bounded = unique and small_key and fixed
    small = F.broadcast(side) if bounded else broadcast_if_small(side, limit)
    if small is side and not observations.isStreaming and not _splits_joins(observations.sparkSession):
        columns = [F.col(quoted(c)) for c in (*observations.columns, *attributes)]
        spread, shares = spread_hot_keys(observations, side, year, key)
        met = [spread[year] == shares[key], spread[SALT] == shares[f"{SALT}_of_{key}"]]
        return spread.join(shares, met, how).select(*columns)
    return observations.join(small, observations[year] == small[key], how).drop(key)


def _splits_joins(spark: SparkSession) -> bool:
    """Whether adaptive execution splits a task of a join that reads too much."""
    names = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(spark.conf.get(name) == "true" for name in names)


def spread_hot_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt, so that no key of ``left`` is more than a fraction of a task's share of the rows.

    Keys with more than one ``FINE``-th of what a shuffle partition holds on average are dealt to salts of that size,
    by a hash of the row, and have their rows in ``right`` once for each. There are at most ``FINE`` of those
    for every shuffle partition, which is what is sent to all tasks. ``left`` is read once more, for its keys alone.
    """
    parts = FINE * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot, salts, name = f"{SALT}_key", f"{SALT}s", f"{SALT}_of_{right_key}"
    counts = stage(left.groupBy(F.col(quoted(left_key)).alias(hot)).agg(F.count("*").alias("_rows")), "key-counts")
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    share = F.ceil(F.col("_rows") * parts / F.lit(max(1, total)))
    many = F.broadcast(counts.filter(F.col("_rows") * parts > total).select(hot, share.alias(salts)))
    hashable = [F.col(quoted(f.name)) for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    dealt = F.pmod(F.xxhash64(*hashable), F.coalesce(salts, F.lit(1))).alias(SALT)
    left = left.join(many, left[left_key] == many[hot], "left").select(*map(F.col, map(quoted, left.columns)), dealt)
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(salts, F.lit(1)) - 1)).alias(name)
    columns = [F.col(quoted(c)) for c in right.columns]
    return left, right.join(many, right[right_key] == many[hot], "left").select(*columns, each)


def orphans(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose key the source does not list.

    The listed keys are made distinct first, on the map side to begin with, so a name that is
    listed over and over is one row in the join.
    """
    return target.join(source.select(key).distinct(), key, "left_anti")


def name_difference(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the target that the source does not list; keys are never NULL.

    Both sides are distinct by the join key already, so the join needs no shuffle of its own.
    """
    return orphans(target.select(key).distinct(), source, key)
