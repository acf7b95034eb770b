import json

from pyspark.sql import functions as F

from orebelt import (
    envelope_schema,
    explode_records,
    latest_name,
    latest_snapshot,
    pack_records,
    parse_payload,
    payload_keys,
    read_json_documents,
    wrap_envelope,
)
from orebelt.sinks import write_documents

RECORD = "struct<`Nation ID`: string, n: bigint>"


def test_parse_counts_records_and_survives_bad_text(spark):
    df = spark.createDataFrame(
        [('{"data": [{"n": 1}, {"n": 2}]}',), ('{"data": []}',), ("{}",), ("oops",), (None,)],
        "body string",
    )
    parsed = parse_payload(df, "body", "data array<struct<n: bigint>>", records="data")
    assert [r["record_count"] for r in parsed.collect()] == [2, 0, None, None, None]
    assert "records" not in parse_payload(df, "body", "data array<struct<n: bigint>>").columns


def test_keys(spark):
    df = spark.createDataFrame([('{"data": 1, "source": 2}',), ("[1]",)], "body string")
    assert [r[0] for r in df.select(payload_keys("body")).collect()] == [["data", "source"], None]


def test_envelope_text(spark):
    df = spark.sql(
        "SELECT array(named_struct('Nation ID', 'x', 'n', 1L), named_struct('Nation ID', null, 'n', 2L)) r"
    )
    wrapped = wrap_envelope(df, "r", "https://example.org", F.lit("2025-01-02T00:00:00"))
    assert json.loads(wrapped.first()["document"]) == {
        "metadata": {
            "source_url": "https://example.org",
            "fetched_at": "2025-01-02T00:00:00",
            "record_count": 2,
        },
        "data": {"data": [{"Nation ID": "x", "n": 1}, {"Nation ID": None, "n": 2}]},
    }


def test_packed_documents_are_bounded_even_for_one_hot_value(spark, tmp_path):
    source = str(tmp_path / "rows")
    spark.range(1000).selectExpr("if(id % 10 = 0, id, 7) AS k", "id AS n").write.parquet(source)
    rows = spark.read.parquet(source)
    fields = [F.lit("x").alias("Nation ID"), F.col("n")]
    packed = pack_records(rows, fields, by=["k"], size=64)
    sizes = [r[0] for r in packed.select(F.size("records")).collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 64

    documents = wrap_envelope(packed, "records", "u", F.lit("t"))
    schema = envelope_schema(RECORD)
    for one_per_file in (False, True):
        path = str(tmp_path / f"documents-{one_per_file}")
        write_documents(documents, path, one_per_file=one_per_file)
        back = read_json_documents(spark, path, schema, multi_line=one_per_file)
        assert back.filter("metadata.record_count <> size(data.data)").count() == 0
        numbers = explode_records(back, "data.data").select("record.n")
        assert sorted(r["n"] for r in numbers.collect()) == list(range(1000))


def test_latest_snapshot(spark):
    df = spark.createDataFrame(
        [("p_20250101.json", 1), ("p_20250102.json", 2), ("p_20250102.json", 3), ("q.txt", 4)],
        "name string, n int",
    )
    assert sorted(r["n"] for r in latest_snapshot(df, "name").collect()) == [2, 3]
    assert latest_snapshot(df, "name", ".xml").count() == 0
    assert latest_name(df, "name", ".xml").first()["latest"] is None
