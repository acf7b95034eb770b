"""Documents read by several tasks, against the same documents read whole."""

import json

import pytest
from pyspark.sql import functions as F

from orebelt import explode_records, read_json_documents, read_records
from orebelt.sources.documents import array_start

SCHEMA = "metadata struct<source_url: string, record_count: bigint>, data struct<data: array<struct<`Nation ID`: string, Year: string, note: string, tags: array<string>>>>"


def document(n, **more):
    data = [
        {"Nation ID": f"{i:07d}", "Year": str(2000 + i % 20), "note": ['a "q" b', "x }, y [", "é\\", None][i % 4], "tags": ["t"] * (i % 3)}
        for i in range(n)
    ]
    return {"metadata": {"source_url": "https://example.org/{[x", "record_count": n}, "data": {"data": data, **more}}


def both(spark, path):
    keep = ["metadata"]
    whole = explode_records(read_json_documents(spark, path, SCHEMA), "data.data", keep=keep)
    return read_records(spark, path, SCHEMA, "data.data", keep=keep), whole


def same(one, two):
    assert one.columns == two.columns
    key = lambda df: sorted(map(str, df.collect()))
    rows = key(one)
    assert rows == key(two)
    return len(rows)


FORMS = {"compact": {"separators": (",", ":")}, "spaced": {}, "indented": {"indent": 2}}


@pytest.mark.parametrize("form", sorted(FORMS))
def test_a_document_is_read_by_several_tasks(spark, tmp_path, form):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a b.json").write_text(json.dumps(document(5000), **FORMS[form]), encoding="utf-8")
    (tmp_path / "d" / "c.json").write_text(json.dumps(document(300), **FORMS[form], ensure_ascii=False), encoding="utf-8")
    name = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(name, "40000")
    try:
        cut, whole = both(spark, str(tmp_path / "d"))
        assert cut.rdd.getNumPartitions() >= 8
        used = cut.groupBy(F.spark_partition_id()).count().count()
        assert used >= 8 and same(cut, whole) == 5300
    finally:
        spark.conf.unset(name)


@pytest.mark.parametrize("size", [3, 7, 50, 333])
def test_cuts_at_any_byte(spark, tmp_path, size, monkeypatch):
    monkeypatch.setattr("orebelt.sources.documents.EDGE_BYTES", size)
    (tmp_path / "a.json").write_text(json.dumps(document(40), indent=1, ensure_ascii=False), encoding="utf-8")
    name = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(name, str(size * 10))
    try:
        assert same(*both(spark, str(tmp_path))) == 40
    finally:
        spark.conf.unset(name)


def test_documents_that_are_read_whole(spark, tmp_path):
    import gzip

    forms = {
        "none": document(0),
        "one": document(1),
        "more behind": document(9, total=3, source=[{"name": "x"}]),
        "no array": {"metadata": {"record_count": 0}, "data": {"data": None}},
        "nothing": {"metadata": None},
    }
    for name, form in forms.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(form))
    (tmp_path / "z.json.gz").write_bytes(gzip.compress(json.dumps(document(6)).encode()))
    assert same(*both(spark, str(tmp_path))) == 16


def test_a_separator_within_a_record_is_an_error(spark, tmp_path):
    whole = document(4)
    whole["data"]["data"][2]["note"] = 'x"}, {"y'
    whole["data"]["data"][1]["note"] = "}, {"
    (tmp_path / "a.json").write_text(json.dumps(whole))
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        read_records(spark, str(tmp_path), SCHEMA, "data.data").collect()


@pytest.mark.parametrize("behind", [2, 3, 5])
def test_records_of_an_array_behind_are_an_error(spark, tmp_path, behind):
    whole = document(9, source=[{"Nation ID": "x"}] * behind)
    (tmp_path / "a.json").write_text(json.dumps(whole))
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        read_records(spark, str(tmp_path), SCHEMA, "data.data").collect()


def test_where_an_array_starts():
    text = '{"a": [{"data": [1]}], "x": {"data": {"y": "]{"}, "da\\"ta": 3}, "data": {"b": 1, "data": [{"k": 2}]}}'
    assert text[array_start(text, ["data", "data"]) :] == '{"k": 2}]}}'
    assert array_start(text, ["a"]) == text.index("[") + 1
    assert array_start(text, ["data"]) is None and array_start(text[:40], ["data", "data"]) is None
