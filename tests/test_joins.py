import pytest

from orebelt import (
    broadcast_if_small,
    enrich_by_year,
    measured_bytes,
    name_difference,
    one_row_per_key,
    orphans,
)


@pytest.fixture(scope="module")
def observations(spark):
    return spark.createDataFrame(
        [("s", 2013, 1.0), ("s", 2014, 2.0), ("s", None, 3.0)],
        "series_id string, year smallint, value double",
    )


@pytest.fixture(scope="module")
def two_nations(spark):
    return spark.createDataFrame(
        [(2013, 10), (2013, 11), (2014, 20), (None, 5)], "year int, population bigint"
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_second_nation_multiplies_rows_unless_years_must_be_unique(observations, two_nations):
    joined = enrich_by_year(observations, two_nations)
    got = sorted((r["year"] or 0, r["population"] or 0) for r in joined.collect())
    assert got == [(0, 0), (2013, 10), (2013, 11), (2014, 20)]
    with pytest.raises(Exception, match="duplicate .* in dimension: 2013"):
        enrich_by_year(observations, two_nations, unique=True).collect()


def test_same_result_with_and_without_broadcast(spark, observations, two_nations):
    small = enrich_by_year(observations, two_nations)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = enrich_by_year(observations, two_nations, limit=0)
        assert "SortMergeJoin" in plan(shuffled)
        assert sorted(map(str, shuffled.collect())) == sorted(map(str, small.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_smallint_year_needs_no_look_at_the_dimension(observations, two_nations, monkeypatch):
    def forbidden(df, limit=None):
        raise AssertionError("measured although bounded")

    monkeypatch.setattr("orebelt.operators.joins.measured_bytes", forbidden)
    bounded = enrich_by_year(observations, two_nations.filter("population <> 11"), unique=True)
    assert "BroadcastHashJoin" in plan(bounded)
    with pytest.raises(AssertionError):
        enrich_by_year(observations, two_nations)


def test_years_beyond_smallint_stay_for_wider_observations(spark, two_nations):
    wide = spark.createDataFrame([(100_000, 1.0)], "year int, value double")
    dimension = spark.createDataFrame([(100_000, 7)], "year int, population bigint")
    assert enrich_by_year(wide, dimension, unique=True).first()["population"] == 7


def test_broadcast_is_dropped_beyond_the_limit(spark):
    df = spark.range(1000).selectExpr("id AS year", "repeat('x', 100) AS name")
    size = measured_bytes(df)
    assert 1000 * 108 <= size <= 1000 * 200
    assert "hint" in broadcast_if_small(df, size)._jdf.queryExecution().logical().toString().lower()
    assert broadcast_if_small(df, size - 1) is df
    with pytest.raises(ValueError, match="nested"):
        measured_bytes(spark.sql("SELECT array(1) AS a"))


def test_unique_key_check_passes_rows_through(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert sorted(map(tuple, one_row_per_key(df, "k", ["v"]).collect())) == [(1, "a"), (2, None)]


def test_orphans(spark):
    target = spark.createDataFrame([("a", 1), ("d", 2), ("d2", 3)], "name string, n int")
    source = spark.createDataFrame([("a",), ("a",), ("b",)], "name string")
    assert sorted(map(tuple, orphans(target, source, "name").collect())) == [("d", 2), ("d2", 3)]
    names = name_difference(target, source, "name")
    assert sorted(r["name"] for r in names.collect()) == ["d", "d2"]


def test_unknown_join_type(observations, two_nations):
    with pytest.raises(ValueError, match="how"):
        enrich_by_year(observations, two_nations, how="full")


def test_attribute_names_must_be_new(observations, two_nations):
    with pytest.raises(ValueError, match="value"):
        enrich_by_year(
            observations, two_nations.withColumnRenamed("population", "value"), ["value"]
        )


def test_a_hot_year_is_split_when_the_dimension_is_too_large(spark, monkeypatch):
    monkeypatch.setattr("orebelt.operators.joins.broadcast_if_small", lambda df, limit: df)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(0, 300_000, 1, 8)
        observations = rows.selectExpr(
            "cast(if(id % 3 = 0, 1999, 1000 + id % 997) AS int) AS year",
            "cast(xxhash64(id) AS string) AS value",
        )
        dimension = spark.range(1000, 2100).selectExpr("cast(id AS int) year", "id AS population")
        for how in ("left", "inner"):
            joined = enrich_by_year(observations, dimension, how=how)
            assert len(joined.collect()) == 300_000
            assert "skew=true" in plan(joined)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_nested_attributes_are_never_broadcast_unmeasured(spark):
    observations = spark.createDataFrame([("s", 2013)], "series_id string, year smallint")
    dimension = spark.createDataFrame([(2013, [1, 2])], "year smallint, tags array<int>")
    for unique in (False, True):
        joined = enrich_by_year(observations, dimension, ["tags"], unique=unique)
        assert "strategy=broadcast" not in joined._jdf.queryExecution().logical().toString()
        assert [tuple(r) for r in joined.collect()] == [("s", 2013, [1, 2])]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_hot_year_is_split_without_adaptive_execution(spark, monkeypatch, how):
    from pyspark.sql import functions as F

    monkeypatch.setattr("orebelt.operators.joins.broadcast_if_small", lambda df, limit: df)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        observations = spark.range(0, 200_000, 1, 8).selectExpr(
            "cast(if(id % 3 = 0, 1999, if(id % 50 = 1, null, 1000 + id % 997)) AS int) AS year", "id AS value"
        )
        # 1999 stands there twice, and not all years do.
        years = spark.range(1000, 1900).selectExpr("cast(id AS int) year", "id AS population")
        dimension = years.unionByName(spark.range(2).selectExpr("1999 AS year", "id AS population"))
        joined = enrich_by_year(observations, dimension, how=how)
        assert joined.columns == ["year", "value", "population"]
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] <= 3 * sizes[len(sizes) // 2]
        plain = observations.join(dimension, "year", how).select("year", "value", "population")
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
        assert "Cartesian" not in plan(joined) and "NestedLoop" not in plan(joined)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
