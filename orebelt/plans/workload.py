"""The driver's tables in the shape of a landing area: padded text, listings, snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.operators.mirror import extract_links
from orebelt.operators.payload import envelope_schema, pack_records
from orebelt.plans import products
from orebelt.session import new_scratch, path_exists, scratch_root, stage
from orebelt.sinks.tables import write_delimited, write_documents

LANDED_FILES = "part-*.csv"
SOURCE_URL = "https://example.org/population"
POPULATION_DOCUMENT = envelope_schema(products.POPULATION_RECORD)
# One document is parsed by one task: some megabytes each.
RECORDS_PER_DOCUMENT = 50_000
SERIES, PERIOD = "SER00000003", "Q01"
KNOWN_YEARS = (1996, 1999)
NEW_SINCE = 1999

# Widths of the padded header and values.
SERIES_WIDTH, VALUE_WIDTH = 17, 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem as a padded text observation; some years and values are malformed."""
    return shipped_observations(spark, sf_dir).select(*products.RAW_OBSERVATION.names)


def shipped_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the landing ``batch`` of the shipment and a ``note`` that came up later."""
    line = table(spark, sf_dir, "lineitem")
    number, shipped = F.col("l_linenumber"), F.col("l_shipdate")
    blank_year = (number == 5) & (F.col("l_quantity") == 50)
    quantity = F.col("l_quantity").cast("int").cast("string")
    series = F.concat(F.lit("SER"), F.lpad(F.col("l_suppkey").cast("string"), 8, "0"))
    return line.select(
        F.rpad(series, SERIES_WIDTH, " ").alias("series_id"),
        F.when(blank_year, F.lit("    ")).otherwise(F.year(shipped).cast("string")).alias("year"),
        F.when(number == 6, F.lit("A01"))
        .otherwise(F.concat(F.lit("Q0"), F.quarter(shipped).cast("string")))
        .alias("period"),
        F.when(number == 7, F.lpad(F.lit("-"), VALUE_WIDTH, " "))
        .otherwise(F.lpad(quantity, VALUE_WIDTH, " "))
        .alias("value"),
        F.when(F.col("l_returnflag") == "R", F.lit("  R ")).alias("footnote_codes"),
        F.col("l_linestatus").alias("note"),
        F.when(F.year(shipped) < NEW_SINCE, F.lit(1)).otherwise(F.lit(2)).alias("batch"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver observations straight from the tables."""
    return products.silver_observations(raw_observations(spark, sf_dir))


def _orders(spark: SparkSession, sf_dir: str, status: str | None) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders if status is None else orders.filter(F.col("o_orderstatus") == status)


def yearly_population(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """``(year, population)``, one row per order year."""
    orders = _orders(spark, sf_dir, status)
    return orders.groupBy(F.year("o_orderdate").alias("year")).agg(
        (F.count("*") * 1000).alias("population")
    )


def known_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly population where it is known, so that some observations stay unmatched."""
    return yearly_population(spark, sf_dir).filter(F.col("year").between(*KNOWN_YEARS))


def population_records(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """Every order as a population record in text, with blank years and zero or no values."""
    orders = _orders(spark, sf_dir, status)
    priority = F.col("o_orderpriority")
    return orders.select(
        F.format_string(" %s ", F.lpad(F.col("o_custkey").cast("string"), 7, "0")).alias("Nation ID"),
        F.format_string(" Customer %s ", F.col("o_custkey").cast("string")).alias("Nation"),
        F.when((priority == "5-LOW") & (F.col("o_orderstatus") == "P"), F.lit(" "))
        .otherwise(F.year("o_orderdate").cast("string"))
        .alias("Year"),
        F.when(priority == "1-URGENT", F.lit("0"))
        .when(priority == "2-HIGH", F.lit(None).cast("string"))
        .otherwise(F.floor("o_totalprice").cast("string"))
        .alias("Population"),
    )


# Files below the shared folder

_prepared: dict[tuple[str, ...], str] = {}


def prepared(
    spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], object]
) -> str:
    """Path of files that several queries read; written on first use in an application."""
    key = (spark.conf.get("spark.app.id", ""), scratch_root(spark), sf_dir, label)
    path = _prepared.get(key)
    if path is None or not path_exists(spark, path):
        path = new_scratch(spark, label)
        write(path)
        _prepared[key] = path
    return path


def padded(raw: DataFrame) -> DataFrame:
    """The raw columns under padded names, as the text files carry them in their header."""
    return raw.withColumnsRenamed(
        {"series_id": "series_id".ljust(SERIES_WIDTH), "value": "value".rjust(VALUE_WIDTH)}
    )


def land_batch(
    spark: SparkSession, sf_dir: str, folder: str, batch: int, *, note: bool = False
) -> None:
    """Land one batch as text files in ``folder/batch=N``, optionally with the later column."""
    rows = shipped_observations(spark, sf_dir).filter(F.col("batch") == batch)
    columns = [*products.RAW_OBSERVATION.names, *(["note"] if note else [])]
    write_delimited(padded(rows.select(*columns)), f"{folder}/batch={batch}")


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Both batches, next to files that the name filter has to leave out."""

    def write(path: str) -> None:
        for batch in (1, 2):
            land_batch(spark, sf_dir, path, batch)
        series = table(spark, sf_dir, "supplier").select("s_name")
        series.write.mode("append").text(f"{path}/batch=1")

    return prepared(spark, sf_dir, "landing", write)


def mixed_landing(spark: SparkSession, sf_dir: str) -> str:
    """Three batches: as they should be but with a ``note``, in another order, and without the note.

    Rows are dealt out by line number, the note being that of the first batch.
    """

    def write(path: str) -> None:
        rows = shipped_observations(spark, sf_dir).withColumn("batch", mixed_batch())
        columns = products.RAW_OBSERVATION.names
        for batch, names in ((1, [*columns, "note"]), (2, [*reversed(columns)]), (3, columns)):
            own = padded(rows.filter(F.col("batch") == batch).select(*names))
            write_delimited(own, f"{path}/batch={batch}")

    return prepared(spark, sf_dir, "mixed-landing", write)


def mixed_batch() -> Column:
    """Batch 1 to 3 of an observation, told by its period's last digit."""
    return F.when(F.col("period") == "Q01", 1).when(F.col("period") == "Q02", 2).otherwise(3)


SNAPSHOTS = (("20250101_000000", "F"), ("20250102_000000", None))


def _write_snapshot(records: DataFrame, folder: str, stamp: str) -> None:
    fields = [F.col(f"`{name}`") for name in ("Nation ID", "Nation", "Year", "Population")]
    packed = pack_records(records, fields, size=RECORDS_PER_DOCUMENT)
    fetched = F.to_timestamp(F.lit(stamp), "yyyyMMdd_HHmmss")
    documents = products.population_snapshot(packed, SOURCE_URL, fetched)
    write_documents(documents, f"{folder}/census_{stamp}.json", one_per_file=True)


def record_snapshots(spark: SparkSession, sf_dir: str) -> str:
    """A stale and a current snapshot with a record per order, named by time."""

    def write(path: str) -> None:
        for stamp, status in SNAPSHOTS:
            _write_snapshot(population_records(spark, sf_dir, status), path, stamp)

    return prepared(spark, sf_dir, "records", write)


NUMBER_DOCUMENT = envelope_schema(
    "struct<`Nation ID`: string, Nation: string, Year: double, Population: string>"
)


def number_snapshots(spark: SparkSession, sf_dir: str) -> str:
    """The same with the year as a JSON number like ``2013.0`` and the population as a text like it."""

    def write(path: str) -> None:
        for stamp, status in SNAPSHOTS:
            records = population_records(spark, sf_dir, status)
            year = F.trim("Year").try_cast("double")
            numbers = records.withColumns({"Year": year, "Population": F.concat("Population", F.lit(".0"))})
            _write_snapshot(numbers, path, stamp)

    return prepared(spark, sf_dir, "number-records", write)


def yearly_snapshots(spark: SparkSession, sf_dir: str) -> str:
    """The same with one record per year."""

    def write(path: str) -> None:
        for stamp, status in SNAPSHOTS:
            yearly = yearly_population(spark, sf_dir, status)
            records = stage(yearly, "yearly").select(
                F.lit(" 01 ").alias("Nation ID"),
                F.lit(" All ").alias("Nation"),
                F.col("year").cast("string").alias("Year"),
                F.col("population").cast("string").alias("Population"),
            )
            _write_snapshot(records, path, stamp)

    return prepared(spark, sf_dir, "snapshots", write)


def shipment_files(spark: SparkSession, sf_dir: str) -> str:
    """One line of text per lineitem, in a folder per ship year; each task writes its own files."""

    def write(path: str) -> None:
        line = table(spark, sf_dir, "lineitem")
        (
            line.select(
                F.concat_ws(
                    "|",
                    *[
                        F.col(c).cast("string")
                        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
                    ],
                    "l_returnflag",
                    "l_linestatus",
                ).alias("line"),
                F.year("l_shipdate").alias("year"),
            )
            .write.partitionBy("year")
            .text(path)
        )

    return prepared(spark, sf_dir, "shipments", write)


def _namespace(path: str) -> str:
    return "t" + path.rsplit("-", 1)[-1][:12]


def _refresh(spark: SparkSession, sf_dir: str, store: str, landed: str, run_id: str) -> None:
    products.refresh(
        spark,
        landing=landed,
        snapshots=yearly_snapshots(spark, sf_dir),
        store=store,
        namespace=_namespace(store),
        series_id=SERIES,
        period=PERIOD,
        years=KNOWN_YEARS,
        glob=LANDED_FILES,
        population_schema=POPULATION_DOCUMENT,
        run_id=run_id,
    )


def _stored_at(path: str) -> dict[str, str]:
    tables = {d.name: f"{_namespace(path)}_{d.name}" for d in products.DATASETS}
    return {**tables, "audit": f"{path}/audit"}


def refreshed(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Table names of all data products, stored once, and the path of their ``audit``."""
    write = lambda path: _refresh(spark, sf_dir, path, landing(spark, sf_dir), "run-1")
    return _stored_at(prepared(spark, sf_dir, "store", write))


def refreshed_twice(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The same by one run for each batch, the second one, with a ``note``, being repeated."""

    def write(path: str) -> None:
        for run_id, batch in (("run-1", 1), ("run-2", 2), ("run-2", None)):
            if batch:
                land_batch(spark, sf_dir, f"{path}/landing", batch, note=batch == 2)
            _refresh(spark, sf_dir, path, f"{path}/landing", run_id)

    return _stored_at(prepared(spark, sf_dir, "store-twice", write))


# Listings


def listed_links(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Every link of every page, as ``(keep..., name)``."""
    pages = table(spark, sf_dir, "pages")
    return extract_links(pages, "html", "/", attribute="href", keep=keep)


def stored_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(name, secure)`` for every link, taken from the pages once for both listings."""

    def write(path: str) -> None:
        links = listed_links(spark, sf_dir, "url")
        links.select("name", F.col("url").startswith("https:").alias("secure")).write.parquet(path)

    path = prepared(spark, sf_dir, "links", write)
    return spark.read.schema("name string, secure boolean").parquet(path)


def source_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names linked from the https pages; names of other than small ASCII letters fail to load."""
    return (
        stored_links(spark, sf_dir)
        .filter("secure")
        .select(
            "name",
            F.col("name").rlike("^[a-z]+$").alias("fetched"),
            F.concat(F.lit("new:"), F.col("name")).alias("content"),
        )
    )


def target_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names linked from the other pages: what an earlier sync has stored."""
    names = stored_links(spark, sf_dir).filter("NOT secure").select("name").distinct()
    return names.withColumn("content", F.concat(F.lit("old:"), F.col("name")))


def delete_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the deletes of stored names went, by the length of the name: one in three fails, one in three is not tried.

    Those of names with a vowel in front were tried twice, the first time without success.
    """
    names = target_listing(spark, sf_dir).select("name", (F.length("name") % 3).alias("kind")).filter("kind < 2")
    tries = F.when(F.col("name").rlike("^[aeiou]"), F.array(F.lit(False), F.col("kind") == 0)).otherwise(
        F.array(F.when(F.col("kind") == 0, True))
    )
    return names.select("name", F.explode(tries).alias("deleted"))
