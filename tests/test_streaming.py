import pytest
from observations import COLUMNS, ROWS, write_padded
from pyspark.sql import functions as F

from orebelt import (
    append_stream,
    file_layouts,
    load_files,
    observe_rules,
    observed_report,
    read_appended,
    read_files_stream,
    read_table_stream,
    rows_added,
)
from orebelt.plans import products


def paths(tmp_path):
    return str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "progress")


def test_incremental_load_with_a_column_that_comes_up_later(spark, tmp_path):
    landing, out, progress = paths(tmp_path)

    def run():
        query = products.bronze_observations(spark, landing, out, progress, glob="*.csv")
        return rows_added(query), read_appended(spark, out)

    write_padded(tmp_path / "landing" / "batch=1" / "a.csv", ROWS[:7])
    (tmp_path / "landing" / "batch=1" / "readme.txt").write_text("not data")
    added, stored = run()
    assert (added, stored.count()) == (7, 7)

    added, stored = run()
    assert (added, stored.count()) == (0, 7)

    write_padded(tmp_path / "landing" / "batch=2" / "b.csv", ROWS[7:], note="late")
    added, stored = run()
    assert (added, stored.count()) == (5, 12)
    notes = {r["batch"]: r["notes"] for r in stored.groupBy("batch").agg(F.count("note").alias("notes")).collect()}
    assert notes == {1: 0, 2: 5}

    # Rewritten in place: a path that has been read is not read again.
    write_padded(tmp_path / "landing" / "batch=1" / "a.csv", ROWS)
    added, stored = run()
    assert (added, stored.count()) == (0, 12)


def test_stream_equals_batch(spark, tmp_path):
    landing, out, progress = paths(tmp_path)
    write_padded(tmp_path / "landing" / "a.csv", ROWS)
    products.bronze_observations(spark, landing, out, progress, table="stream_bronze")
    bronze = spark.read.table("stream_bronze")
    assert bronze.columns == [*COLUMNS, "_source_file", "_ingestion_time"]
    silver = products.silver_observations(read_table_stream(spark, "stream_bronze"))
    append_stream(silver, f"{out}_silver", f"{progress}_silver", table="stream_silver")
    stored = spark.read.table("stream_silver")
    assert stored.schema.simpleString() == (
        "struct<series_id:string,year:smallint,period:string,value:double,footnote_codes:string,"
        "_source_file:string,_ingestion_time:timestamp>"
    )
    batch = products.silver_observations(bronze)
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, batch.collect()), key=str)


def test_a_backlog_is_cut_into_micro_batches(spark, tmp_path):
    landing, out, progress = paths(tmp_path)
    for n, row in enumerate(ROWS[:6]):
        write_padded(tmp_path / "landing" / f"{n}.csv", [row])
    stream = read_files_stream(spark, landing, products.RAW_OBSERVATION, max_files=2)
    run = append_stream(stream, out, progress)
    assert (rows_added(run), run.micro_batches) == (6, 3)


def test_counts_of_more_micro_batches_than_a_query_remembers(spark, tmp_path):
    name = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    landing, out, progress = paths(tmp_path)
    for n, row in enumerate(ROWS):
        write_padded(tmp_path / "landing" / f"{n}.csv", [row])
    spark.conf.set(name, "3")
    try:
        stream = read_files_stream(spark, landing, products.RAW_OBSERVATION, max_files=1)
        counted = observe_rules(products.typed_observations(stream), "rules", products.OBSERVATION_RULES)
        run = append_stream(counted, out, progress)
    finally:
        spark.conf.set(name, before)
    assert (rows_added(run), run.micro_batches) == (12, 12)
    report = observed_report(spark, run.observed, "rules", products.OBSERVATION_RULES)
    assert sorted(map(tuple, report.collect())) == [("valid_value", 10, 2), ("valid_year", 11, 1)]


def test_a_layout_that_lands_unannounced_is_an_error(spark, tmp_path):
    landing, out, progress = paths(tmp_path)
    write_padded(tmp_path / "landing" / "a.csv", ROWS)
    stream = read_files_stream(spark, landing, products.RAW_OBSERVATION)
    lines = (tmp_path / "landing" / "a.csv").read_text().splitlines()
    swapped = ["\t".join([*line.split("\t")[1::-1], *line.split("\t")[2:]]) for line in lines]
    (tmp_path / "landing" / "b.csv").write_text("\n".join(swapped) + "\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        append_stream(stream, out, progress)


def swap_columns(source, target):
    """The same file with its first two columns in the other order."""
    swapped = ["\t".join([*line.split("\t")[1::-1], *line.split("\t")[2:]]) for line in source.read_text().splitlines()]
    target.write_text("\n".join(swapped) + "\n")


def test_layouts_that_land_during_a_run_are_taken_in(spark, tmp_path):
    landing, out, progress = paths(tmp_path)
    write_padded(tmp_path / "landing" / "a.csv", ROWS[:5])
    landed = []

    def land(raw):
        """Called after the headers have been looked at, and before files are listed for the stream."""
        if len(landed) == 0:
            write_padded(tmp_path / "landing" / "b.csv", ROWS[5:7], note="late")
        if len(landed) == 1:
            swap_columns(tmp_path / "landing" / "a.csv", tmp_path / "landing" / "c.csv")
        landed.append(raw.columns)
        return raw.drop("_metadata")

    run = load_files(spark, landing, out, progress, max_files=1, transform=land)
    assert rows_added(run) == 12
    stored = read_appended(spark, out, run.schema)
    assert stored.columns == [*COLUMNS, "note"]
    assert stored.filter("note = 'late'").count() == 2
    first = lambda rows: sorted((r["series_id"].strip(), r["year"]) for r in rows)
    assert first(stored.collect()) == sorted((r[0], r[1]) for r in [*ROWS[:7], *ROWS[:5]])
    assert rows_added(load_files(spark, landing, out, progress, transform=lambda raw: raw.drop("_metadata"))) == 0


def test_another_failure_is_not_tried_again(spark, tmp_path):
    landing, out, progress = paths(tmp_path)
    write_padded(tmp_path / "landing" / "a.csv", ROWS)
    tries = []

    def broken(raw):
        tries.append(raw)
        return raw.withColumn("year", F.raise_error(F.lit("boom")))

    with pytest.raises(Exception, match="boom"):
        load_files(spark, landing, out, progress, transform=broken)
    assert len(tries) == 1


def bytes_read(spark):
    return spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file").getLong("bytesRead")


def test_a_load_opens_new_files_only(spark, tmp_path):
    landing, out, progress = paths(tmp_path)
    many = [(f"S{i}", "1995", "Q01", "1.0", "x" * 60) for i in range(40_000)]
    write_padded(tmp_path / "landing" / "batch=1" / "a.csv", many)
    size = (tmp_path / "landing" / "batch=1" / "a.csv").stat().st_size

    def load():
        before = bytes_read(spark)
        run = products.bronze_observations(spark, landing, out, progress)
        return rows_added(run), bytes_read(spark) - before

    rows, read = load()
    assert rows == 40_000 and read < 1.5 * size  # once, and not a second time for the header
    write_padded(tmp_path / "landing" / "batch=2" / "b.csv", many[:1000], note="late")
    small = (tmp_path / "landing" / "batch=2" / "b.csv").stat().st_size
    rows, read = load()
    assert rows == 1000 and read < 10 * small < size / 3
    rows, read = load()
    assert rows == 0 and read < size / 10


def test_heads_alone_are_read(spark, tmp_path):
    folder, log = tmp_path / "landing", str(tmp_path / "log")
    folder.mkdir()
    (folder / "a.csv").write_text("x\ty\n" + "1\t2\n" * 1_000_000)
    (folder / "b c.csv").write_text("\n \n\ufeffy\tx\r\n1\t2\r\n")
    (folder / "empty.csv").write_text("")
    (folder / "long.csv").write_text("\t".join(f"c{i}" for i in range(5000)))
    import gzip

    (folder / "z.csv.gz").write_bytes(gzip.compress(b"x\ty\n" + b"3\t4\n" * 100_000))
    before = bytes_read(spark)
    found = file_layouts(spark, str(folder), log=log)
    assert bytes_read(spark) - before < 200_000
    headers = {r["file"].rsplit("/", 1)[-1]: r["header"] for r in found.files.collect()}
    assert headers["a.csv"] == headers["z.csv.gz"] == "x\ty"
    assert "empty.csv" not in headers and headers["long.csv"].endswith("\tc4999")
    assert headers["b%20c.csv"] == "\ufeffy\tx"
    assert len(found.headers) == 3
    (folder / "a.csv").write_text("gone\n")
    (folder / "d.csv").write_text("new\n")
    again = file_layouts(spark, str(folder), log=log)
    assert sorted(set(again.headers) - set(found.headers)) == ["new"]
