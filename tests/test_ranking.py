import math
import random

import pytest
from pyspark.sql import functions as F

from orebelt import (
    arg_max_per_group,
    latest_per_key,
    sort_rows,
    top_n,
    with_group_max,
    yearly_sums,
)

SCHEMA = "k string, p int, v double"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_ties_nulls_and_nan(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [
            ("tie", 1, 2.0),
            ("tie", 2, 2.0),
            ("tie", 3, 1.0),
            ("nulls", 1, None),
            ("mixed", 1, None),
            ("mixed", 2, -1.0),
            ("nan", 1, nan),
            ("nan", 2, 9.0),
            ("nan", 3, nan),
            ("zero", 1, 0.0),
            ("zero", 2, -0.0),
            (None, 1, 5.0),
        ],
        SCHEMA,
    )
    got = {(r["k"], r["p"]) for r in arg_max_per_group(df, ["k"], "v").collect()}
    assert got == {
        ("tie", 1),
        ("tie", 2),
        ("mixed", 2),
        ("nan", 1),
        ("nan", 3),
        ("zero", 1),
        ("zero", 2),
        (None, 1),
    }
    # The same answer as the maximum attached to each row and compared with it.
    compared = with_group_max(df, ["k"], "v", "m").filter(F.col("v") == F.col("m"))
    assert {(r["k"], r["p"]) for r in compared.collect()} == got

    one = arg_max_per_group(df, ["k"], "v", ties=False, tie_break=["p"])
    assert {(r["k"], r["p"]) for r in one.collect()} == {
        ("tie", 1),
        ("nulls", 1),
        ("mixed", 2),
        ("nan", 1),
        ("zero", 1),
        (None, 1),
    }


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    data = [
        (rng.choice("aaaaaabc"), rng.randrange(40), rng.choice([None, *map(float, range(6))]))
        for _ in range(600)
    ]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    best = {}
    for k, _, v in data:
        if v is not None:
            best[k] = max(best.get(k, -math.inf), v)
    expected = sorted((r for r in data if r[2] is not None and r[2] == best[r[0]]), key=str)
    assert rows(arg_max_per_group(df, ["k"], "v")) == expected
    single = {}
    for k, p, v in data:
        if v is not None and v == best[k]:
            single[k] = min(single.get(k, p), p)
    got = arg_max_per_group(df, ["k"], "v", ties=False, tie_break=["p"])
    assert {r["k"]: r["p"] for r in got.collect()} == single


def test_yearly_sums_pattern_is_case_sensitive_and_skips_null_periods(spark):
    df = spark.createDataFrame(
        [("a", 1, "Q01", 1.0), ("a", 1, "Q05", 2.0), ("a", 1, "q01", 4.0), ("a", 1, None, 8.0)],
        "series_id string, year int, period string, value double",
    )
    assert rows(yearly_sums(df)) == [("a", 1, 3.0)]
    assert rows(yearly_sums(df, periods=["Q01"])) == [("a", 1, 1.0)]


def test_latest_delivery_replaces_earlier_ones_as_a_whole(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, 10.0),
            ("a", 2, 11.0),
            ("a", 2, 11.0),
            ("a", None, 12.0),
            ("b", 1, 13.0),
            (None, 1, 14.0),
            (None, 3, 15.0),
            ("c", None, 16.0),
        ],
        "k string, t int, v double",
    )
    expected = [("a", 2, 11.0), ("a", 2, 11.0), ("b", 1, 13.0), (None, 3, 15.0)]
    latest = latest_per_key(df, ["k"], "t")
    assert rows(latest) == expected
    assert latest.columns == df.columns
    assert "Window" not in latest._jdf.queryExecution().executedPlan().toString()


def test_top_n(spark):
    df = spark.range(50).withColumn("v", F.col("id") % 7)
    assert [r["id"] for r in top_n(df, 3, F.desc("v"), "id").collect()] == [6, 13, 20]


def test_sort_puts_the_rows_down_once_before_it_samples_them(spark):
    df = spark.range(500).withColumn("v", F.col("id") % 7).repartition(3)
    ordered = sort_rows(df, F.desc("v"), "id")
    expected = sorted(((i, i % 7) for i in range(500)), key=lambda r: (-r[1], r[0]))
    assert [tuple(r) for r in ordered.collect()] == expected
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    assert plan.index("rangepartitioning") < plan.index("REBALANCE_PARTITIONS_BY_NONE")


def test_a_value_that_many_rows_have_is_sorted_by_several_tasks(spark):
    name, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "16")
    spark.conf.set(coalesce, "false")
    try:
        df = spark.range(90_000).selectExpr("if(id % 3 = 0, 7, id) AS v", "id AS w").repartition(4)
        ordered = sort_rows(df, F.desc("v"))
        sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2 * 90_000 / 16
        values = [r["v"] for r in ordered.collect()]
        assert values == sorted(values, reverse=True)
    finally:
        spark.conf.set(name, before)
        spark.conf.unset(coalesce)


def test_group_maximum_of_a_hot_group_takes_no_window(spark):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, null, id % 100) AS k", "cast(id AS double) AS v", "id AS `a.b`")
    best = with_group_max(df, ["k"], "v", "m")
    assert best.columns == ["k", "v", "a.b", "m"]
    assert "Window" not in best._jdf.queryExecution().executedPlan().toString()
    tops = {r["k"]: r["m"] for r in best.select("k", "m").distinct().collect()}
    assert tops == {r["k"]: r["m"] for r in df.groupBy("k").agg(F.max("v").alias("m")).collect()} and len(tops) == 101
    assert best.count() == 30_000
