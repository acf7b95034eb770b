"""The composed data products: bronze -> silver -> gold over observations and a population.

Each product is a function of frames, so it can be run on stored tables, files or streams.
``refresh`` runs all of them over stored tables in their fixed order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebelt.functions.columns import (
    cast_columns,
    explode_records,
    flatten_struct,
    standardize_names,
    trim_strings,
    typed,
    with_lineage,
)
from orebelt.functions.text import iso_stamp
from orebelt.operators.aggregate import summary_stats, yearly_sums
from orebelt.operators.joins import enrich_by_year
from orebelt.operators.mirror import extract_links, mirror, refuse_empty
from orebelt.operators.payload import wrap_envelope
from orebelt.operators.quality import (
    LOAD,
    append_audit,
    begin_load,
    dq_report,
    expect_or_drop,
    file_run,
    loaded_between,
    observe_rules,
    observed_report,
    run_window,
)
from orebelt.operators.ranking import arg_max_per_group
from orebelt.sinks.tables import annotate, materialize, register_files
from orebelt.sources.files import latest_file, read_json_documents
from orebelt.streaming.ingest import Run, append_stream, load_files, read_table_stream

# Rules, columns and the range of years of the datasets.
OBSERVATION_RULES = {"valid_year": "year IS NOT NULL", "valid_value": "value IS NOT NULL"}
POPULATION_RULES = {"valid_year": "year IS NOT NULL", "valid_population": "population > 0"}

RAW_OBSERVATION = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("series_id", "year", "period", "value", "footnote_codes")
    ]
)
POPULATION_RECORD = (
    "struct<`Nation ID`: string, Nation: string, Year: string, Population: string>"
)
POPULATION_COLUMNS = ("nation_id", "nation", "year", "population")
SUMMARY_YEARS = (2013, 2018)


# Bronze


def bronze_observations(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    *,
    glob: str | None = None,
    schema: T.StructType | None = None,
    table: str | None = None,
    max_files: int | None = None,
    load: int | None = None,
) -> Run:
    """Append the landed text files that no earlier run has seen, as strings with lineage.

    Without a schema it is inferred from all headers and remembered next to the checkpoint. ``load`` is a
    number that the rows carry as ``_load``, see ``begin_load``.
    """

    def lineage(raw: DataFrame) -> DataFrame:
        rows = with_lineage(raw)
        return rows if load is None else rows.withColumn(LOAD, F.lit(load).cast("bigint"))

    return load_files(
        spark, landing, target, checkpoint, schema=schema, glob=glob, max_files=max_files, table=table, transform=lineage
    )


def bronze_population(
    spark: SparkSession, folder: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """The latest snapshot in ``folder``, nested as delivered."""
    latest = latest_file(spark, folder)
    return (
        read_json_documents(spark, latest, schema)
        .withColumn("_source_file", F.lit(latest.rsplit("/", 1)[-1]))
        .withColumn("_ingestion_timestamp", F.current_timestamp())
    )


def population_snapshot(
    records: DataFrame, source_url: str, fetched_at: Column, *, array: str = "records"
) -> DataFrame:
    """Fetched records in their envelope, ready for ``write_documents``."""
    return wrap_envelope(records, array, source_url, iso_stamp(fetched_at))


# Landing


def sync_landing(
    pages: DataFrame,
    fetches: DataFrame,
    target: DataFrame,
    *,
    prefix: str,
    html: str = "html",
    attribute: str = "HREF",
    deletions: DataFrame | None = None,
    allow_empty_source: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Mirror what the listing pages name into the target: ``(next_target, actions)``.

    ``fetches`` has one row per name that was fetched: ``name`` and the target's other columns. A
    listed name without a row there failed to load. ``deletions`` has the outcome of deletes, ``name`` and
    ``deleted``, once they have been tried; see ``mirror``.
    """
    names = extract_links(pages, html, prefix, attribute=attribute)
    if not allow_empty_source:
        refuse_empty(names)
    listed = names.groupBy("name").agg(F.count("*").alias("listed"))
    source = listed.join(fetches.withColumn("fetched", F.lit(True)), "name", "left")
    return mirror(source, target, "name", listed="listed", deletions=deletions, allow_empty_source=True)


# Silver


def typed_observations(bronze: DataFrame) -> DataFrame:
    """Trimmed and typed, before any rule; columns beyond the known ones are left out."""
    lineage = [c for c in ("_source_file", "_ingestion_time", LOAD) if c in bronze.columns]
    known = bronze.select(*RAW_OBSERVATION.names, *lineage)
    trimmed = trim_strings(known, "series_id", "period", "footnote_codes")
    return cast_columns(trimmed, {"year": "smallint", "value": "double"})


def silver_observations(bronze: DataFrame) -> DataFrame:
    return expect_or_drop(typed_observations(bronze), OBSERVATION_RULES)


def typed_population(bronze: DataFrame) -> DataFrame:
    """One typed row per record of the documents; a document without records gives none."""
    lineage = [c for c in ("_source_file", "_ingestion_timestamp") if c in bronze.columns]
    return typed_records(explode_records(bronze, "data.data", keep=lineage))


def typed_records(records: DataFrame) -> DataFrame:
    """The same from records next to their lineage, see ``read_records`` for large documents."""
    lineage = [c for c in records.columns if c != "record"]
    named = standardize_names(flatten_struct(records, "record")).select(*POPULATION_COLUMNS, *lineage)
    trimmed = trim_strings(named, "nation_id", "nation", "_source_file")
    return cast_columns(trimmed, {"year": "int", "population": "bigint"})


def silver_population(bronze: DataFrame) -> DataFrame:
    return expect_or_drop(typed_population(bronze), POPULATION_RULES)


# Gold


def population_summary(
    population: DataFrame, start: int = SUMMARY_YEARS[0], end: int = SUMMARY_YEARS[1]
) -> DataFrame:
    return summary_stats(population, "population", "year", start, end)


def best_year(
    observations: DataFrame, *, ties: bool = True, periods: Sequence[str] | None = None
) -> DataFrame:
    """Year(s) with the greatest sum of quarterly values, per series.

    Without ties the lowest of the best years is taken. Sort when reading, not here.
    """
    sums = yearly_sums(observations, periods=periods)
    best = arg_max_per_group(sums, ["series_id"], "total_value", ties=ties, tie_break=["year"])
    return best.select("series_id", "year", F.col("total_value").alias("value"))


def best_year_raw(raw: DataFrame) -> DataFrame:
    """Best year straight from untrimmed text, without rules: unknown years are a group."""
    sums = yearly_sums(
        raw,
        keys=[F.trim("series_id").alias("series_id"), typed(F.col("year"), "int").alias("year")],
        measure=typed(F.col("value"), "double"),
        period=F.trim("period"),
    )
    best = arg_max_per_group(sums, ["series_id"], "total_value")
    return best.select("series_id", "year", F.col("total_value").alias("value"))


def series_with_population(
    observations: DataFrame,
    population: DataFrame,
    series_id: str,
    period: str,
    *,
    how: str = "left",
    unique: bool = False,
) -> DataFrame:
    """One series and period next to the population of its years."""
    wanted = observations.filter((F.col("series_id") == series_id) & (F.col("period") == period))
    return enrich_by_year(
        wanted.select("series_id", "year", "period", "value"), population, how=how, unique=unique
    )


def series_with_population_raw(
    raw: DataFrame, population: DataFrame, series_id: str, period: str
) -> DataFrame:
    """The same as an inner join on untrimmed text; the text columns come out as they are."""
    wanted = raw.alias("b").filter(
        (F.trim("b.series_id") == series_id) & (F.trim("b.period") == period)
    )
    keyed = wanted.select(
        "b.series_id", "b.year", "b.period", "b.value", typed(F.col("b.year"), "int").alias("_year")
    )
    return enrich_by_year(keyed, population, year="_year", how="inner").drop("_year")


# All of them


@dataclass(frozen=True)
class Dataset:
    name: str
    quality: str
    comment: str


DATASETS = (
    Dataset("bronze_observations", "bronze", "Raw observation text with lineage"),
    Dataset("bronze_population", "bronze", "Latest population snapshot as delivered"),
    Dataset("silver_population", "silver", "Population by year, trimmed and typed"),
    Dataset("silver_observations", "silver", "Observations, trimmed and typed"),
    Dataset("gold_population_mean_stddev", "gold", "Mean and deviation of the population"),
    Dataset("gold_best_year", "gold", "Best year of each series by quarterly sum"),
    Dataset("gold_population_series", "gold", "One series and quarter with population"),
)


def refresh(
    spark: SparkSession,
    *,
    landing: str,
    snapshots: str,
    store: str,
    namespace: str,
    series_id: str,
    period: str,
    years: tuple[int, int],
    glob: str | None = None,
    population_schema: T.StructType | str | None = None,
    max_files: int | None = None,
    run_id: str | None = None,
) -> dict[str, str]:
    """Bring all datasets up to date; returns ``dataset -> table name``.

    The observation tables only take in what has newly landed; everything else is recomputed
    from the stored tables. ``store`` is a shared folder for table files and checkpoints, and
    ``namespace`` a prefix for the table names; use the same two on every run. A column that comes up
    in a later file is added to the bronze table, NULL in earlier rows.

    Every call is a load with a number of its own, which its observations carry. All that reads the observations
    after they have been stored, audit and gold, reads those up to this load, so it agrees with itself
    whatever is appended meanwhile. With a ``run_id`` the rule counts of the run go to ``store/audit``: of
    the observations they are counted as these pass. Only where a load before broke off, or the run is repeated,
    they are counted again over the stored rows of the loads that the run accounts for.
    """
    described = {d.name: d for d in DATASETS}
    tables = {name: f"{namespace}_{name}" for name in described}

    def keep(name: str, df: DataFrame, **layout) -> DataFrame:
        d = described[name]
        return materialize(
            df, tables[name], d.comment, {"quality": d.quality}, path=f"{store}/{name}", **layout
        )

    runs = f"{store}/_progress/runs"
    load = begin_load(spark, runs)
    bronze = bronze_observations(
        spark,
        landing,
        f"{store}/bronze_observations",
        f"{store}/_progress/bronze_observations",
        glob=glob,
        max_files=max_files,
        load=load,
    )
    register_files(spark, tables["bronze_observations"], f"{store}/bronze_observations", bronze.schema)
    snapshot = keep("bronze_population", bronze_population(spark, snapshots, population_schema))
    population = keep("silver_population", silver_population(snapshot))

    incoming = typed_observations(read_table_stream(spark, tables["bronze_observations"]))
    passing = append_stream(
        expect_or_drop(observe_rules(incoming, "rules", OBSERVATION_RULES), OBSERVATION_RULES),
        f"{store}/silver_observations",
        f"{store}/_progress/silver_observations",
        table=tables["silver_observations"],
    )
    observations = loaded_between(spark.read.table(tables["silver_observations"]), 0, load)
    if run_id is not None:
        audit = f"{store}/audit"
        after, upto = run_window(spark, runs, run_id, load)
        if (after, upto) == (load - 1, load):
            report = observed_report(spark, passing.observed, "rules", OBSERVATION_RULES)
        else:
            raw = spark.read.table(tables["bronze_observations"])
            report = dq_report(typed_observations(loaded_between(raw, after, upto)), OBSERVATION_RULES)
        append_audit(report, audit, run_id, "silver_observations")
        file_run(spark, runs, run_id, after, upto)
        recomputed = dq_report(typed_population(snapshot), POPULATION_RULES)
        append_audit(recomputed, audit, run_id, "silver_population")

    keep("gold_population_mean_stddev", population_summary(population, *years))
    keep("gold_best_year", best_year(observations), sort_by=["series_id", "year"])
    keep(
        "gold_population_series",
        series_with_population(observations, population, series_id, period, unique=True),
        sort_by=["year"],
    )
    for name in ("bronze_observations", "silver_observations"):
        annotate(spark, tables[name], described[name].comment, {"quality": described[name].quality})
    return tables
