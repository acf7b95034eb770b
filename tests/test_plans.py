"""What the physical plans must look like, whatever the size of the tables."""

import os

import pytest
from pyspark.sql import functions as F

from orebelt import enrich_by_year, extract_links, mirror
from orebelt.plans import products, workload
from orebelt.plans.queries import QUERIES

SF_DIR = os.environ.get("OREBELT_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "t")
    workload.observations(spark, SF_DIR).sortWithinPartitions("series_id").write.parquet(path)
    return spark.read.parquet(path)


def test_best_rows_are_cut_before_the_shuffle(stored):
    for ties in (True, False):
        lines = plan(products.best_year(stored, ties=ties)).splitlines()
        steps = [
            step
            for line in lines
            for step in ("WindowGroupLimit", "Exchange hashpartitioning", "HashAggregate")
            if step in line
        ]
        assert steps == [
            "WindowGroupLimit",
            "Exchange hashpartitioning",
            "WindowGroupLimit",
            "HashAggregate",
            "Exchange hashpartitioning",
            "HashAggregate",
        ]


def test_filters_and_columns_reach_the_scan_of_stored_silver(spark, stored):
    population = spark.createDataFrame([(1996, 1)], "year int, population bigint")
    wanted = products.series_with_population(stored, population, "SER00000003", "Q01")
    scan = next(line for line in plan(wanted).splitlines() if "FileScan parquet" in line)
    assert "EqualTo(series_id,SER00000003)" in scan and "EqualTo(period,Q01)" in scan
    assert "footnote_codes" not in scan.split("ReadSchema")[1]

    best = plan(products.best_year(stored))
    assert "StringStartsWith(period,Q)" in best
    assert "footnote_codes" not in best.split("ReadSchema")[1]


def test_rules_reach_the_scan(spark, stored):
    kept = products.expect_or_drop(stored, products.OBSERVATION_RULES)
    assert "IsNotNull(year), IsNotNull(value)" in plan(kept)


def test_observations_are_not_shuffled_for_the_population(spark, stored):
    population = workload.known_population(spark, SF_DIR)
    for unique in (True, False):
        text = plan(enrich_by_year(stored, population, unique=unique))
        observations = text.split("BroadcastHashJoin")[1].split("BroadcastExchange")[0]
        assert "Exchange" not in observations


def test_links_need_no_shuffle(spark):
    pages = workload.table(spark, SF_DIR, "pages")
    assert "Exchange" not in plan(extract_links(pages, "html", "/", attribute="href"))


def test_names_are_combined_before_the_mirror_join(spark):
    source = workload.source_listing(spark, SF_DIR)
    target = spark.createDataFrame([("a", "x")], "name string, content string")
    _, actions = mirror(source, target, "name")
    text = plan(actions)
    join = text.index("FullOuter")
    assert "partial_sum" in text[join:]


def test_latest_snapshot_reads_names_only_to_find_it(spark):
    text = plan(QUERIES["latest_snapshot"](spark, SF_DIR))
    assert "ReadSchema: struct<o_orderstatus:string,o_orderdate:timestamp_ntz>" in text


def test_row_count_reads_no_column(spark):
    count = workload.table(spark, SF_DIR, "lineitem").agg(F.count("*"))
    assert "ReadSchema: struct<>" in plan(count)
