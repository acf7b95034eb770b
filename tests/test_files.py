import os
import time

import pytest
from observations import COLUMNS, ROWS, write_padded
from pyspark.errors import SparkRuntimeException
from pyspark.sql import types as T

from orebelt import (
    annotate,
    file_inventory,
    infer_raw_schema,
    inventory_by_folder,
    latest_file,
    materialize,
    preview,
    read_delimited,
    remembered_columns,
    remove_old_contents,
    table_comment,
    table_properties,
    with_lineage,
    write_delimited,
)
from orebelt.session import new_scratch, scratch_root, stage
from orebelt.sources.files import file_layouts


def test_written_text_keeps_its_padding(spark, tmp_path):
    df = spark.createDataFrame(
        [("a  ", "   1", None), ("b  ", "   -", " R ")], ["series_id  ", "  value", "footnote_codes"]
    )
    path = str(tmp_path / "out")
    write_delimited(df, path)
    text = "".join(
        open(os.path.join(path, name)).read()
        for name in sorted(os.listdir(path))
        if name.startswith("part-")
    )
    assert "series_id  \t  value\tfootnote_codes\n" in text
    assert "a  \t   1\t\n" in text
    back = read_delimited(spark, path)
    assert back.columns == ["series_id", "value", "footnote_codes"]
    assert sorted(map(tuple, back.collect())) == [("a  ", "   1", None), ("b  ", "   -", " R ")]


def test_encoding(spark, tmp_path):
    (tmp_path / "f.txt").write_bytes("a\tb\né\tß\n".encode("latin-1"))
    row = read_delimited(spark, str(tmp_path), encoding="ISO-8859-1").first()
    assert tuple(row) == ("é", "ß")


def test_lineage(spark, tmp_path):
    write_padded(tmp_path / "pr.data.0.Current", ROWS)
    path = with_lineage(read_delimited(spark, str(tmp_path)))
    row = path.first()
    assert path.columns == [*COLUMNS, "_source_file", "_ingestion_time"]
    assert row["_source_file"].endswith("/pr.data.0.Current")
    assert row["_ingestion_time"] is not None
    name = with_lineage(read_delimited(spark, str(tmp_path)), file_part="file_name").first()
    assert name["_source_file"] == "pr.data.0.Current"


def test_schema_is_remembered_and_grows_at_the_end(spark, tmp_path):
    remember = str(tmp_path / "schema")
    data = tmp_path / "data"
    write_padded(data / "batch=1" / "f.csv", ROWS)
    first = infer_raw_schema(spark, str(data), glob="*.csv", remember=remember)
    assert first.names == COLUMNS
    assert {f.dataType.simpleString() for f in first} == {"string"}
    write_padded(data / "batch=2" / "f.csv", ROWS, note="n")
    later = time.time() + 5
    os.utime(data / "batch=2" / "f.csv", (later, later))
    grown = infer_raw_schema(spark, str(data), glob="*.csv", remember=remember)
    assert grown.names == [*COLUMNS, "note"]
    write_padded(data / "batch=3" / "f.csv", ROWS)
    os.utime(data / "batch=3" / "f.csv", (later + 5, later + 5))
    assert infer_raw_schema(spark, str(data), glob="*.csv", remember=remember) == grown
    assert remembered_columns(spark, remember) == (2, [*COLUMNS, "note"])
    assert remembered_columns(spark, f"{remember}-none") == (0, [])
    with pytest.raises(FileNotFoundError):
        infer_raw_schema(spark, str(data), glob="*.none")


def test_inventory(spark, tmp_path):
    for folder, name, size in (("a", "x.txt", 1000), ("a", "y.txt", 234), ("b", "z.bin", 5)):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(b"0" * size)
    files = file_inventory(spark, str(tmp_path))
    got = sorted((r["name"], r["bytes"]) for r in files.collect())
    assert got == [("x.txt", 1000), ("y.txt", 234), ("z.bin", 5)]
    assert sorted(map(tuple, inventory_by_folder(files).collect())) == [
        ("a", 2, 1234, "1,234"),
        ("b", 1, 5, "5"),
    ]
    assert file_inventory(spark, str(tmp_path), glob="*.bin").count() == 1
    plan = files.select("name", "bytes")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_latest_file_may_be_a_file_or_a_folder(spark, tmp_path):
    (tmp_path / "p_20250101.json").write_text("{}")
    (tmp_path / "p_20250103.json").mkdir()
    (tmp_path / "p_20250103.json" / "part-0.txt").write_text("{}")
    (tmp_path / "p_20250102.json").write_text("{}")
    (tmp_path / "z.txt").write_text("")
    assert latest_file(spark, str(tmp_path)).endswith("/p_20250103.json")

    spark.range(1).write.json(str(tmp_path / "p_20250104.json"))
    (tmp_path / "archive").mkdir()
    (tmp_path / "archive" / "p_20250199.json").write_text("{}")
    for root in (str(tmp_path), f"{tmp_path}/", f"file://{tmp_path}"):
        assert latest_file(spark, root).endswith("/p_20250104.json")
    with pytest.raises(FileNotFoundError):
        latest_file(spark, str(tmp_path), ".xml")


def test_materialize_replaces_and_describes(spark, tmp_path):
    path = str(tmp_path / "t")
    materialize(spark.range(5), "described", "it's a test", {"quality": "silver"}, path=path)
    table = materialize(
        spark.range(3).selectExpr("id", "id % 2 AS odd"),
        "described",
        "second",
        {"quality": "gold", "steward": "o'brien"},
        path=path,
        partition_by=["odd"],
        sort_by=["id"],
    )
    assert table.count() == 3
    assert table.filter("odd = 1").count() == 1
    assert table_comment(spark, "described") == "second"
    properties = {r["key"]: r["value"] for r in table_properties(spark, "described").collect()}
    assert properties["quality"] == "gold" and properties["steward"] == "o'brien"
    annotate(spark, "described", "it's third")
    assert table_comment(spark, "described") == "it's third"


def test_a_failed_refresh_leaves_the_previous_content(spark, tmp_path):
    path = str(tmp_path / "t")
    materialize(spark.range(5), "kept", path=path)
    with pytest.raises(Exception, match="boom"):
        materialize(spark.range(3).selectExpr("raise_error('boom') AS id"), "kept", path=path)
    assert spark.read.table("kept").count() == 5
    doubled = spark.read.table("kept").selectExpr("id * 2 AS id")
    assert sorted(r["id"] for r in materialize(doubled, "kept", path=path).collect()) == [
        0, 2, 4, 6, 8,
    ]


def test_empty_partitioned_content_replaces_and_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(4).selectExpr("id", "id % 2 AS odd")
    materialize(rows, "emptied", path=path, partition_by=["odd"])
    table = materialize(rows.limit(0), "emptied", path=path, partition_by=["odd"])
    assert table.count() == 0 and table.columns == ["id", "odd"]
    assert materialize(rows, "emptied", path=path, partition_by=["odd"]).filter("odd = 1").count() == 2


@pytest.mark.parametrize("partition_by", [[], ["odd"]])
def test_a_switch_that_breaks_off_leaves_a_readable_table(spark, tmp_path, monkeypatch, partition_by):
    from orebelt.sinks import tables

    path, name = str(tmp_path / "t"), f"broken_{len(partition_by)}"
    rows = spark.range(4).selectExpr("id", "id % 2 AS odd")
    materialize(rows, name, path=path, partition_by=partition_by)
    with monkeypatch.context() as broken:
        broken.setattr(tables, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError, match="gone"):
            materialize(rows.limit(1), name, path=path, partition_by=partition_by)
    assert spark.read.table(name).count() == 4
    with monkeypatch.context() as broken:
        broken.setattr(tables, "_create", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError, match="gone"):
            materialize(rows.selectExpr("id", "odd", "1 AS more"), name, path=path, partition_by=partition_by)
    assert spark.read.table(name).count() == 4
    assert materialize(rows.limit(2), name, path=path, partition_by=partition_by).count() == 2
    assert len(remove_old_contents(spark, name, path)) >= 2
    assert spark.read.table(name).count() == 2


def test_readers_never_miss_a_table_while_its_columns_change(spark, tmp_path):
    import threading

    path, name = str(tmp_path / "t"), "switched"
    materialize(spark.range(7), name, "first", {"quality": "gold"}, path=path)
    ended, seen, failed = threading.Event(), [], []

    def read():
        while not ended.is_set():
            try:
                seen.append(spark.read.table(name).count())
            except Exception as error:  # noqa: BLE001
                failed.append(error)

    readers = [threading.Thread(target=read) for _ in range(2)]
    for reader in readers:
        reader.start()
    try:
        for i in range(8):
            rows = spark.range(7).selectExpr("id", f"id % 2 AS c{i}", "id % 3 AS part")
            materialize(rows, name, path=path, partition_by=["part"] if i % 3 == 1 else [])
    finally:
        ended.set()
        for reader in readers:
            reader.join()
    assert not failed, failed[:1]
    assert len(seen) > 3 and set(seen) == {7}
    assert spark.read.table(name).columns[1] == "c7"
    # What was said of it stays, and what is no longer shown goes.
    assert table_comment(spark, name) == "first"
    assert table_properties(spark, name).filter("key = 'quality'").first()["value"] == "gold"
    assert len(remove_old_contents(spark, name, path)) == 8
    assert spark.read.table(name).count() == 7
    assert len([t for t in spark.catalog.listTables() if t.name.startswith(name)]) == 2


def test_a_table_of_the_warehouse_becomes_one_with_a_path(spark, tmp_path):
    materialize(spark.range(3), "moved")
    assert materialize(spark.range(4), "moved", "now here", path=str(tmp_path / "t")).count() == 4
    assert table_comment(spark, "moved") == "now here"
    assert remove_old_contents(spark, "moved", str(tmp_path / "t")) == []


def test_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\ty \tz\n1\t 2\t3\n")
    (tmp_path / "b.csv").write_text("y\tx\n5\t\"4\t4\"\n")
    (tmp_path / "c.csv").write_text("")
    df = read_delimited(spark, str(tmp_path))
    assert sorted(df.columns) == ["x", "y", "z"]
    assert sorted(map(tuple, df.select("x", "y", "z").collect())) == [("1", " 2", "3"), ("4\t4", "5", None)]
    names = sorted(r[0].rsplit("/", 1)[-1] for r in with_lineage(read_delimited(spark, str(tmp_path), metadata=True)).select("_source_file").collect())
    assert names == ["a.csv", "b.csv"]
    (tmp_path / "d.csv").write_text("x\tx \n1\t2\n")
    with pytest.raises(ValueError, match="twice"):
        read_delimited(spark, str(tmp_path))


def test_files_of_several_layouts_are_taken_apart_once_a_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\ty\tz\n1\t2\n1\t2\t3\t4\n\t\"5\t5\"\t\n")
    (tmp_path / "b.csv").write_text("z\tx\n6\t7\n\"8\"\n")
    df = read_delimited(spark, str(tmp_path)).select("x", "y", "z")
    rows = [("1", "2", None), ("1", "2", "3"), (None, "5\t5", None), ("7", None, "6"), (None, None, "8")]
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, rows))
    # One parse per layout, not one for each of its columns.
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 2


@pytest.mark.parametrize("names", [["x"], ["y"], ["none"], ["x", "y", "none"]])
def test_no_column_of_a_file_of_unknown_layout_is_read(spark, tmp_path, names):
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "b.csv").write_text("y\tx\n2\t3\n")
    known = file_layouts(spark, str(tmp_path))
    (tmp_path / "c.csv").write_text("y\n4\n")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    with pytest.raises(SparkRuntimeException, match="not known yet"):
        read_delimited(spark, str(tmp_path), schema, layouts=known).collect()


def test_materialize_in_the_warehouse(spark):
    materialize(spark.range(5), "managed", properties={"quality": "bronze"})
    assert materialize(spark.range(2), "managed").count() == 2


def test_preview(spark):
    assert [r["id"] for r in preview(spark.range(1000), 3, "id").collect()] == [0, 1, 2]
    assert preview(spark.range(1000)).count() == 100


def test_scratch_is_the_shared_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_scratch(spark, "x") != new_scratch(spark, "x")
    staged = stage(spark.range(3), "x")
    assert scratch_root(spark) + "/x-" in staged.inputFiles()[0]


class _Cluster:
    """Just the settings of a session on a cluster."""

    class conf:
        @staticmethod
        def get(name, default=None):
            return {"spark.master": "yarn"}.get(name, default)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(_Cluster)
