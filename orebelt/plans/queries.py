"""Every operator and data product as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.functions import (
    compact_stamp,
    explode_records,
    flatten_struct,
    iso_stamp,
    snapshot_name,
    standardize_names,
    typed,
    with_lineage,
    with_prefix,
)
from orebelt.operators import (
    append_audit,
    arg_max_per_group,
    dq_report,
    enrich_by_year,
    envelope_schema,
    expect_or_drop,
    latest_snapshot,
    mirror,
    name_difference,
    observe_rules,
    observed_report,
    orphans,
    pack_records,
    parse_payload,
    payload_keys,
    read_audit,
    row_count,
    sort_rows,
    sync_stats,
    top_n,
    with_group_max,
    wrap_envelope,
    yearly_sums,
)
from orebelt.plans import products
from orebelt.plans import workload as w
from orebelt.session import literal_rows, new_scratch, stage
from orebelt.sinks import (
    materialize,
    preview,
    table_comment,
    table_properties,
    write_delimited,
    write_documents,
)
from orebelt.sources import (
    file_inventory,
    file_layouts,
    inventory_by_folder,
    latest_file,
    read_delimited,
    read_json_documents,
    read_records,
)
from orebelt.sources.files import layout_log
from orebelt.streaming import (
    append_stream,
    read_appended,
    read_files_stream,
    read_table_stream,
    rows_added,
)

Query = Callable[[SparkSession, str], DataFrame]

RAW = list(products.RAW_OBSERVATION.names)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
LANDING_KEY = "landing/"


# Silver and quality


def silver_observations(spark: SparkSession, sf: str) -> DataFrame:
    return w.observations(spark, sf)


def dq_observations(spark: SparkSession, sf: str) -> DataFrame:
    typed_rows = products.typed_observations(w.raw_observations(spark, sf))
    return dq_report(typed_rows, products.OBSERVATION_RULES)


def _typed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The population records of all orders, typed without passing through documents."""
    records = w.population_records(spark, sf)
    return records.select(
        typed(F.col("Year"), "int").alias("year"),
        typed(F.col("Population"), "bigint").alias("population"),
    )


def dq_population(spark: SparkSession, sf: str) -> DataFrame:
    return dq_report(_typed_orders(spark, sf), products.POPULATION_RULES)


def dq_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of two datasets filed under one run; filing one again does not count it twice."""
    target = new_scratch(spark, "audit")
    population = stage(dq_population(spark, sf), "report")
    append_audit(dq_observations(spark, sf), target, "run-1", "silver_observations")
    append_audit(population, target, "run-1", "silver_population")
    append_audit(population, target, "run-1", "silver_population")
    return read_audit(spark, target)


def dq_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Rule counts taken from the rows of a stream as they pass."""
    work = new_scratch(spark, "dq-stream")
    landed = read_files_stream(
        spark, w.landing(spark, sf), products.RAW_OBSERVATION, glob=w.LANDED_FILES
    )
    counted = observe_rules(
        products.typed_observations(landed), "rules", products.OBSERVATION_RULES
    )
    run = append_stream(counted, f"{work}/out", f"{work}/progress")
    return observed_report(spark, run.observed, "rules", products.OBSERVATION_RULES)


# Aggregates and ranking


def population_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = products.population_summary(w.yearly_population(spark, sf), *w.KNOWN_YEARS)
    return _rounded(stats)


def _rounded(stats: DataFrame) -> DataFrame:
    return stats.select(
        F.round("mean_population", 4).alias("mean_population"),
        F.round("stddev_population", 4).alias("stddev_population"),
        "start_year",
        "end_year",
        "year_count",
    )


def order_value_stats(spark: SparkSession, sf: str) -> DataFrame:
    """The same summary over every typed record instead of one per year."""
    rows = products.expect_or_drop(_typed_orders(spark, sf), products.POPULATION_RULES)
    return _rounded(products.population_summary(rows, *w.KNOWN_YEARS))


def yearly_sums_query(spark: SparkSession, sf: str) -> DataFrame:
    return yearly_sums(w.observations(spark, sf))


def series_max_attached(spark: SparkSession, sf: str) -> DataFrame:
    sums = yearly_sums(w.observations(spark, sf))
    return with_group_max(sums, ["series_id"], "total_value", "max_value")


def best_year(spark: SparkSession, sf: str) -> DataFrame:
    return sort_rows(products.best_year(w.observations(spark, sf)), "series_id", "year")


def best_year_raw(spark: SparkSession, sf: str) -> DataFrame:
    return sort_rows(products.best_year_raw(w.raw_observations(spark, sf)), "series_id", "year")


def best_year_single(spark: SparkSession, sf: str) -> DataFrame:
    return sort_rows(products.best_year(w.observations(spark, sf), ties=False), "series_id")


def _orders_per_year(spark: SparkSession, sf: str) -> DataFrame:
    orders = w.table(spark, sf, "orders")
    return orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("orders")
    )


def best_year_ties(spark: SparkSession, sf: str) -> DataFrame:
    return arg_max_per_group(_orders_per_year(spark, sf), ["o_custkey"], "orders")


def best_year_of_ties(spark: SparkSession, sf: str) -> DataFrame:
    return arg_max_per_group(
        _orders_per_year(spark, sf), ["o_custkey"], "orders", ties=False, tie_break=["year"]
    )


def best_day_per_user(spark: SparkSession, sf: str) -> DataFrame:
    daily = (
        w.table(spark, sf, "events")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(F.count("*").alias("events"))
    )
    best = arg_max_per_group(daily, ["user_id"], "events")
    return best.select("user_id", F.col("day").cast("string").alias("day"), "events")


def best_year_top10(spark: SparkSession, sf: str) -> DataFrame:
    best = products.best_year(w.observations(spark, sf))
    return top_n(best, 10, F.desc("value"), "series_id", "year")


def table_row_count(spark: SparkSession, sf: str) -> DataFrame:
    counts = [
        row_count(w.table(spark, sf, name)).select(F.lit(name).alias("table_name"), "row_count")
        for name in TABLES
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionAll(count)
    return result


def preview_100(spark: SparkSession, sf: str) -> DataFrame:
    line = w.table(spark, sf, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return preview(line.select(*order), 100, *order)


# Joins


def series_population_left(spark: SparkSession, sf: str) -> DataFrame:
    joined = products.series_with_population(
        w.observations(spark, sf), w.known_population(spark, sf), w.SERIES, w.PERIOD, unique=True
    )
    return sort_rows(joined, "year", "value")


def series_population_inner(spark: SparkSession, sf: str) -> DataFrame:
    population = stage(w.known_population(spark, sf), "population")
    return products.series_with_population_raw(
        w.raw_observations(spark, sf), population, w.SERIES, w.PERIOD
    )


def series_population_desc(spark: SparkSession, sf: str) -> DataFrame:
    joined = products.series_with_population(
        w.observations(spark, sf), w.known_population(spark, sf), w.SERIES, w.PERIOD, unique=True
    )
    return sort_rows(joined, F.desc("year"), "value")


def observations_population_left(spark: SparkSession, sf: str) -> DataFrame:
    """Every series and period, not one."""
    rows = w.observations(spark, sf).select("series_id", "year", "period", "value")
    return enrich_by_year(rows, w.known_population(spark, sf), unique=True)


def observations_population_inner(spark: SparkSession, sf: str) -> DataFrame:
    rows = w.observations(spark, sf).select("series_id", "year", "period", "value")
    population = stage(w.known_population(spark, sf), "population")
    return enrich_by_year(rows, population, how="inner")


# Payloads and documents

EVENT_RECORD = (
    "struct<`Event ID`: bigint, `User ID`: bigint, `Event Type`: string, `Event Value`: double>"
)


def _event_fields() -> list[Column]:
    return [
        F.col("event_id").alias("Event ID"),
        F.col("user_id").alias("User ID"),
        F.col("event_type").alias("Event Type"),
        F.col("value").alias("Event Value"),
    ]


def payload_record_count(spark: SparkSession, sf: str) -> DataFrame:
    """Events per type, counted from the lengths of their payloads' record arrays."""
    events = w.table(spark, sf, "events")
    packed = pack_records(events, _event_fields(), by=["event_type"])
    payloads = packed.select(
        "event_type", F.to_json(F.struct(F.col("records").alias("data"))).alias("body")
    )
    parsed = parse_payload(payloads, "body", f"data array<{EVENT_RECORD}>", records="data")
    return parsed.groupBy("event_type").agg(F.sum("record_count").alias("record_count"))


def payload_keys_query(spark: SparkSession, sf: str) -> DataFrame:
    events = w.table(spark, sf, "events")
    return events.select("event_id", F.array_join(payload_keys("props"), ",").alias("keys"))


def payload_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties and fields out of one nested record, under clean names."""
    events = w.table(spark, sf, "events")
    nested = parse_payload(events, "props", "k bigint").select(
        F.struct(*_event_fields(), F.col("payload.k").alias("Prop-K")).alias("record")
    )
    return standardize_names(flatten_struct(nested, "record"))


def population_silver(spark: SparkSession, sf: str) -> DataFrame:
    folder = w.record_snapshots(spark, sf)
    bronze = products.bronze_population(spark, folder, w.POPULATION_DOCUMENT)
    return products.silver_population(bronze).select(
        "nation_id", "nation", "year", "population", "_source_file"
    )


def population_silver_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same with each document read by several tasks."""
    latest = latest_file(spark, w.record_snapshots(spark, sf))
    records = read_records(spark, latest, w.POPULATION_DOCUMENT, "data.data")
    records = records.withColumn("_source_file", F.lit(latest.rsplit("/", 1)[-1]))
    return expect_or_drop(products.typed_records(records), products.POPULATION_RULES)


def population_silver_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots that hold the year as a JSON number with a fraction part and the population as such a text."""
    folder = w.number_snapshots(spark, sf)
    bronze = products.bronze_population(spark, folder, w.NUMBER_DOCUMENT)
    return products.silver_population(bronze).select("nation_id", "nation", "year", "population", "_source_file")


def population_record_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Records per snapshot, as its envelopes state them and as they are."""
    folder = w.record_snapshots(spark, sf)
    documents = with_lineage(
        read_json_documents(spark, f"{folder}/*.json", w.POPULATION_DOCUMENT)
    )
    return documents.groupBy(
        F.regexp_extract("_source_file", r"([^/]+\.json)/", 1).alias("snapshot")
    ).agg(
        F.sum("metadata.record_count").alias("stated"),
        F.sum(F.size("data.data")).alias("found"),
    )


def envelope_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """All events into envelopes, written as JSON lines, read back and taken apart again."""
    path = new_scratch(spark, "envelopes")
    events = w.table(spark, sf, "events")
    stamp = compact_stamp(F.col("ts")).alias("Stamp")
    fetched = iso_stamp(F.col("ts")).alias("Fetched")
    name = snapshot_name("events", F.col("ts")).alias("Snapshot")
    packed = pack_records(events, [*_event_fields(), stamp, fetched, name])
    record = EVENT_RECORD[:-1] + ", Stamp: string, Fetched: string, Snapshot: string>"
    documents = wrap_envelope(packed, "records", w.SOURCE_URL, F.lit("2025-01-02T00:00:00"))
    write_documents(documents, path)
    stored = read_json_documents(spark, path, envelope_schema(record), multi_line=False)
    whole = (F.col("metadata.record_count") == F.size("data.data")).alias("count_matches")
    rows = explode_records(
        stored.select("data", whole), "data.data", keep=["count_matches"]
    )
    return standardize_names(flatten_struct(rows, "record"))


def latest_snapshot_query(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of the greatest snapshot name; names of open orders are not snapshots."""
    orders = w.table(spark, sf, "orders")
    suffix = F.when(F.col("o_orderstatus") == "O", ".txt").otherwise(".json")
    name = F.concat(
        F.lit("orders_"), F.date_format("o_orderdate", "yyyyMMdd_HHmmss"), suffix
    )
    named = orders.select("o_orderkey", "o_orderstatus", name.alias("snapshot"))
    return latest_snapshot(named, "snapshot")


# Files and streams


def ingest_batch(spark: SparkSession, sf: str) -> DataFrame:
    landed = read_delimited(
        spark, w.landing(spark, sf), products.RAW_OBSERVATION, glob=w.LANDED_FILES
    )
    return landed.select(*RAW, "batch")


def header_trim(spark: SparkSession, sf: str) -> DataFrame:
    """Columns found by the header alone."""
    landed = read_delimited(spark, w.landing(spark, sf), glob=w.LANDED_FILES)
    return landed.drop("batch")


def lineage_columns(spark: SparkSession, sf: str) -> DataFrame:
    landed = read_delimited(
        spark, w.landing(spark, sf), products.RAW_OBSERVATION, glob=w.LANDED_FILES
    )
    return with_lineage(landed).select(
        "series_id",
        "value",
        F.regexp_extract("_source_file", "(batch=[0-9]+)/part-", 1).alias("source"),
        F.col("_ingestion_time").isNotNull().alias("has_time"),
    )


def ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    work = new_scratch(spark, "ingest")
    products.bronze_observations(
        spark, w.landing(spark, sf), f"{work}/out", f"{work}/progress", glob=w.LANDED_FILES
    )
    return read_appended(spark, f"{work}/out", products.RAW_OBSERVATION)


def ingest_stream_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs over one checkpoint: a first batch, nothing new, a second batch."""
    work = new_scratch(spark, "rerun")
    runs = []
    for run, new_batch in ((1, 1), (2, None), (3, 2)):
        if new_batch:
            w.land_batch(spark, sf, f"{work}/landing", new_batch)
        done = products.bronze_observations(
            spark,
            f"{work}/landing",
            f"{work}/out",
            f"{work}/progress",
            schema=products.RAW_OBSERVATION,
        )
        rows = read_appended(spark, f"{work}/out", products.RAW_OBSERVATION)
        stored = row_count(rows).first()["row_count"]
        runs.append((run, rows_added(done), stored))
    return literal_rows(
        spark, runs, {"run": "int", "rows_added": "bigint", "rows_stored": "bigint"}
    )


def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """A column that first appears in the second batch is NULL in the rows of the first."""
    work = new_scratch(spark, "evolution")
    for batch in (1, 2):
        w.land_batch(spark, sf, f"{work}/landing", batch, note=batch == 2)
        run = products.bronze_observations(
            spark,
            f"{work}/landing",
            f"{work}/out",
            f"{work}/progress",
            glob=w.LANDED_FILES,
        )
    return read_appended(spark, f"{work}/out", run.schema).select(*RAW, "note", "batch")


def ingest_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """Files with their columns in another order, and with one that the newest file lacks, by batch."""
    landed = read_delimited(spark, w.mixed_landing(spark, sf), glob=w.LANDED_FILES)
    return landed.select(*RAW, "note", "batch")


def ingest_layouts_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same files through a stream."""
    work = new_scratch(spark, "layouts")
    run = products.bronze_observations(
        spark, w.mixed_landing(spark, sf), f"{work}/out", f"{work}/progress", glob=w.LANDED_FILES
    )
    return read_appended(spark, f"{work}/out", run.schema).select(*RAW, "note", "batch")


def layouts_by_load(spark: SparkSession, sf: str) -> DataFrame:
    """Four loads over one checkpoint: a batch, one with a column more, nothing new, one with the columns reversed."""
    work = new_scratch(spark, "loads")
    rows = w.shipped_observations(spark, sf).withColumn("batch", w.mixed_batch())
    loads = {1: RAW, 2: [*RAW, "note"], 4: [*reversed(RAW)]}
    done = []
    for load in range(1, 5):
        if load in loads:
            own = rows.filter(F.col("batch") == min(load, 3)).select(*loads[load])
            write_delimited(w.padded(own), f"{work}/landing/batch={load}")
        run = products.bronze_observations(
            spark, f"{work}/landing", f"{work}/out", f"{work}/progress", glob=w.LANDED_FILES
        )
        layouts = file_layouts(
            spark, f"{work}/landing", glob=w.LANDED_FILES, log=layout_log(f"{work}/progress_schema")
        )
        stored = read_appended(spark, f"{work}/out", run.schema)
        noted = stored.agg(F.count("note") if "note" in stored.columns else F.lit(0)).first()[0]
        done.append((load, rows_added(run), len(layouts.headers), noted))
    columns = {"load": "int", "rows_added": "bigint", "layouts": "int", "noted": "bigint"}
    return literal_rows(spark, done, columns)


def silver_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze table by stream, silver by a stream over that table, read as a batch."""
    work = new_scratch(spark, "silver")
    bronze = "bronze_" + work[-12:]
    products.bronze_observations(
        spark,
        w.landing(spark, sf),
        f"{work}/bronze",
        f"{work}/progress/bronze",
        glob=w.LANDED_FILES,
        schema=products.RAW_OBSERVATION,
        table=bronze,
    )
    silver = products.silver_observations(read_table_stream(spark, bronze))
    append_stream(silver, f"{work}/silver", f"{work}/progress/silver")
    return read_appended(spark, f"{work}/silver", silver.schema).select(*RAW)


def file_inventory_query(spark: SparkSession, sf: str) -> DataFrame:
    inventory = file_inventory(spark, w.shipment_files(spark, sf), glob="part-*")
    return inventory_by_folder(inventory).select("folder", "bytes", "size_label")


# Listing and mirror


def extract_links_query(spark: SparkSession, sf: str) -> DataFrame:
    return w.listed_links(spark, sf, "page_id")


def extract_links_first5(spark: SparkSession, sf: str) -> DataFrame:
    return top_n(w.listed_links(spark, sf).distinct(), 5, "name")


def _mirror(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return mirror(w.source_listing(spark, sf), w.target_listing(spark, sf), "name")


def sync_actions(spark: SparkSession, sf: str) -> DataFrame:
    _, actions = _mirror(spark, sf)
    key = with_prefix(LANDING_KEY, F.col("name")).alias("key")
    return actions.select(key, "action", "entries")


def sync_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return orphans(w.target_listing(spark, sf), w.source_listing(spark, sf), "name")


def sync_orphan_names(spark: SparkSession, sf: str) -> DataFrame:
    return name_difference(w.target_listing(spark, sf), w.source_listing(spark, sf), "name")


def sync_next_state(spark: SparkSession, sf: str) -> DataFrame:
    state, _ = _mirror(spark, sf)
    return state


def sync_stats_query(spark: SparkSession, sf: str) -> DataFrame:
    _, actions = _mirror(spark, sf)
    return sync_stats(actions)


def sync_landing(spark: SparkSession, sf: str) -> DataFrame:
    """The whole sync from listing pages, with the fetched names as a table of their own."""
    pages = w.table(spark, sf, "pages").filter(F.col("url").startswith("https:"))
    fetches = w.source_listing(spark, sf).filter("fetched").select("name", "content").distinct()
    _, actions = products.sync_landing(
        pages, fetches, w.target_listing(spark, sf), prefix="/", attribute="href"
    )
    return actions


def _sync_after_deletes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    outcomes = w.delete_outcomes(spark, sf)
    return mirror(w.source_listing(spark, sf), w.target_listing(spark, sf), "name", deletions=outcomes)


def sync_delete_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Outcomes of a sync in which some deletes failed, or were not tried: those are errors."""
    _, actions = _sync_after_deletes(spark, sf)
    return actions


def sync_delete_state(spark: SparkSession, sf: str) -> DataFrame:
    """The target after it: what could not be deleted is still there."""
    state, _ = _sync_after_deletes(spark, sf)
    return state


def sync_delete_stats(spark: SparkSession, sf: str) -> DataFrame:
    _, actions = _sync_after_deletes(spark, sf)
    return sync_stats(actions)


# Stored datasets


def materialize_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Stored twice under one name; the second content is what remains."""
    work = new_scratch(spark, "roundtrip")
    name = "roundtrip_" + work[-12:]
    sums = yearly_sums(w.observations(spark, sf), pattern="A%")
    materialize(sums, name, path=f"{work}/t")
    return materialize(w.observations(spark, sf), name, path=f"{work}/t", sort_by=["series_id"])


def dataset_properties(spark: SparkSession, sf: str) -> DataFrame:
    """Row count, quality level and comment of every stored data product."""
    rows = None
    tables = w.refreshed(spark, sf)
    for dataset in (d.name for d in products.DATASETS):
        name = tables[dataset]
        quality = table_properties(spark, name).filter("key = 'quality'").first()["value"]
        stored = spark.read.table(name)
        # How many documents hold the bronze population depends on how the orders were split.
        counted = (
            stored.agg(F.sum("metadata.record_count").alias("row_count"))
            if dataset == "bronze_population"
            else row_count(stored)
        )
        row = counted.select(
            F.lit(dataset).alias("dataset"),
            F.lit(quality).alias("quality"),
            F.lit(table_comment(spark, name)).alias("description"),
            "row_count",
        )
        rows = row if rows is None else rows.unionAll(row)
    return rows


def _product(spark: SparkSession, sf: str, dataset: str) -> DataFrame:
    return spark.read.table(w.refreshed(spark, sf)[dataset])


def gold_best_year(spark: SparkSession, sf: str) -> DataFrame:
    return _product(spark, sf, "gold_best_year").orderBy("series_id", "year")


def gold_population_mean_stddev(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_product(spark, sf, "gold_population_mean_stddev"))


def gold_population_series(spark: SparkSession, sf: str) -> DataFrame:
    return _product(spark, sf, "gold_population_series").orderBy("year", "value")


def refresh_audit(spark: SparkSession, sf: str) -> DataFrame:
    return read_audit(spark, w.refreshed(spark, sf)["audit"])


def refresh_audit_retry(spark: SparkSession, sf: str) -> DataFrame:
    """The audit after a run that was repeated under its name with nothing new."""
    return read_audit(spark, w.refreshed_twice(spark, sf)["audit"])


def refresh_evolving(spark: SparkSession, sf: str) -> DataFrame:
    """The bronze table after a second batch with a column of its own: NULL in the rows of the first."""
    return spark.read.table(w.refreshed_twice(spark, sf)["bronze_observations"]).select(*RAW, "note", "batch")


# The questions as SQL text over the stored tables


def sql_population_stats(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """
        SELECT round(avg(population), 4) AS mean_population,
               round(stddev(population), 4) AS stddev_population,
               min(year) AS start_year, max(year) AS end_year, count(*) AS year_count
        FROM {population} WHERE year BETWEEN {first} AND {last}
        """,
        population=_product(spark, sf, "silver_population"),
        first=w.KNOWN_YEARS[0],
        last=w.KNOWN_YEARS[1],
    )


def sql_best_year(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """
        WITH sums AS (
          SELECT series_id, year, sum(value) AS total_value FROM {observations}
          WHERE period LIKE 'Q%' GROUP BY series_id, year),
        ranked AS (
          SELECT *, rank() OVER (PARTITION BY series_id ORDER BY total_value DESC) AS place
          FROM sums WHERE total_value IS NOT NULL)
        SELECT series_id, year, total_value AS value FROM ranked WHERE place = 1
        ORDER BY series_id, year
        """,
        observations=_product(spark, sf, "silver_observations"),
    )


def sql_series_population(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """
        SELECT o.series_id, o.year, o.period, o.value, p.population
        FROM {observations} o LEFT JOIN {population} p ON o.year = p.year
        WHERE o.series_id = {series} AND o.period = {period}
        ORDER BY o.year DESC
        """,
        observations=_product(spark, sf, "silver_observations"),
        population=_product(spark, sf, "silver_population"),
        series=w.SERIES,
        period=w.PERIOD,
    )


QUERIES: dict[str, Query] = {
    "silver_observations": silver_observations,
    "dq_report": dq_observations,
    "dq_population": dq_population,
    "dq_audit": dq_audit,
    "dq_stream": dq_stream,
    "population_stats": population_stats,
    "order_value_stats": order_value_stats,
    "yearly_sums": yearly_sums_query,
    "series_max_attached": series_max_attached,
    "best_year": best_year,
    "best_year_raw": best_year_raw,
    "best_year_ties": best_year_ties,
    "best_year_of_ties": best_year_of_ties,
    "best_day_per_user": best_day_per_user,
    "best_year_single": best_year_single,
    "best_year_top10": best_year_top10,
    "series_population_left": series_population_left,
    "series_population_inner": series_population_inner,
    "series_population_desc": series_population_desc,
    "observations_population_left": observations_population_left,
    "observations_population_inner": observations_population_inner,
    "payload_record_count": payload_record_count,
    "payload_keys": payload_keys_query,
    "payload_flatten": payload_flatten,
    "population_silver": population_silver,
    "population_silver_split": population_silver_split,
    "population_silver_numbers": population_silver_numbers,
    "population_record_counts": population_record_counts,
    "envelope_roundtrip": envelope_roundtrip,
    "latest_snapshot": latest_snapshot_query,
    "ingest_batch": ingest_batch,
    "ingest_layouts": ingest_layouts,
    "header_trim": header_trim,
    "lineage_columns": lineage_columns,
    "ingest_stream": ingest_stream,
    "ingest_layouts_stream": ingest_layouts_stream,
    "ingest_stream_rerun": ingest_stream_rerun,
    "schema_evolution": schema_evolution,
    "layouts_by_load": layouts_by_load,
    "silver_stream": silver_stream,
    "file_inventory": file_inventory_query,
    "extract_links": extract_links_query,
    "extract_links_first5": extract_links_first5,
    "sync_actions": sync_actions,
    "sync_orphans": sync_orphans,
    "sync_orphan_names": sync_orphan_names,
    "sync_next_state": sync_next_state,
    "sync_stats": sync_stats_query,
    "sync_landing": sync_landing,
    "sync_delete_outcomes": sync_delete_outcomes,
    "sync_delete_state": sync_delete_state,
    "sync_delete_stats": sync_delete_stats,
    "materialize_roundtrip": materialize_roundtrip,
    "dataset_properties": dataset_properties,
    "gold_best_year": gold_best_year,
    "gold_population_mean_stddev": gold_population_mean_stddev,
    "gold_population_series": gold_population_series,
    "refresh_audit": refresh_audit,
    "refresh_audit_retry": refresh_audit_retry,
    "refresh_evolving": refresh_evolving,
    "sql_population_stats": sql_population_stats,
    "sql_best_year": sql_best_year,
    "sql_series_population": sql_series_population,
    "table_row_count": table_row_count,
    "preview_100": preview_100,
}
