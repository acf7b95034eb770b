import pytest
from pyspark.sql import functions as F

from orebelt import (
    cast_columns,
    clean_column_names,
    compact_stamp,
    explode_records,
    flatten_struct,
    iso_stamp,
    link_names,
    snake_case,
    snapshot_name,
    standardize_names,
    thousands,
    trim_strings,
    with_prefix,
)


def test_names_are_stripped_even_with_dots_inside(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["series_id        ", "       value", " a.b "])
    assert clean_column_names(df).columns == ["series_id", "value", "a.b"]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("Nation ID", "nation_id"),
        ("Population", "population"),
        (" recordCount ", "record_count"),
        ("a--b", "a_b"),
    ],
)
def test_snake_case(name, expected):
    assert snake_case(name) == expected


def test_standardized_names_must_not_clash(spark):
    df = spark.createDataFrame([(1, 2)], ["Nation ID", "nation_id"])
    with pytest.raises(ValueError, match="nation_id"):
        standardize_names(df)
    kept = spark.createDataFrame([(1, 2)], ["Nation ID", "_source_file"])
    assert standardize_names(kept).columns == ["nation_id", "_source_file"]


def test_trim_takes_spaces_only_and_strings_only(spark):
    df = spark.createDataFrame([(" a ", "\tb ", 1)], "x string, `y z` string, n int")
    assert tuple(trim_strings(df).first()) == ("a", "\tb", 1)
    assert tuple(trim_strings(df, "x").first()) == ("a", "\tb ", 1)


def test_cast_trims_and_gives_null_for_malformed_text(spark):
    rows = [(" 1995 ", "  1.5"), ("-", "-"), ("", ""), ("99999", None)]
    df = spark.createDataFrame(rows, "year string, value string")
    out = cast_columns(df, {"year": "smallint", "value": "double"})
    assert out.schema.simpleString() == "struct<year:smallint,value:double>"
    assert [tuple(r) for r in out.collect()] == [
        (1995, 1.5),
        (None, None),
        (None, None),
        (None, None),
    ]
    with pytest.raises(ValueError, match="nope"):
        cast_columns(df, {"nope": "int"})


def test_explode_drops_empty_arrays_and_flatten_keeps_the_order(spark):
    df = spark.sql(
        "SELECT 1 AS id, array(named_struct('A b', 1, 'c', 2)) AS d "
        "UNION ALL SELECT 2, array() UNION ALL SELECT 3, NULL"
    )
    records = explode_records(df, "d", keep=["id"])
    assert records.columns == ["record", "id"]
    flat = flatten_struct(records, "record")
    assert flat.columns == ["A b", "c", "id"]
    assert [tuple(r) for r in flat.collect()] == [(1, 2, 1)]


def test_text_helpers(spark):
    row = spark.sql("SELECT timestamp'2025-01-31 23:59:58' AS ts, 1234567L AS n, 'f' AS name").select(
        compact_stamp(F.col("ts")),
        iso_stamp(F.col("ts")),
        snapshot_name("head_counts", F.col("ts")),
        thousands(F.col("n")),
        with_prefix("a/b/", F.col("name")),
    )
    assert tuple(row.first()) == (
        "20250131_235958",
        "2025-01-31T23:59:58.000000",
        "head_counts_20250131_235958.json",
        "1,234,567",
        "a/b/f",
    )


def test_link_prefix_is_literal_and_case_sensitive(spark):
    html = '<A HREF="/pub/x.y/a">a</A> <A HREF="/pub/xzy/b">b</A> <a href="/pub/x.y/c">c</a>'
    df = spark.createDataFrame([(html,), (None,)], "html string")
    found = df.select(link_names(F.col("html"), "/pub/x.y/")).collect()
    assert [r[0] for r in found] == [["a"], None]
    lower = df.select(link_names(F.col("html"), "/pub/x.y/", "href")).first()[0]
    assert lower == ["c"]


def test_a_fraction_is_no_whole_number_in_any_form(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('123.0', 123.0D, 123.0BD), ('123.5', 123.5D, 123.5BD), ('-7', -7D, -7BD), "
        "('1e99', 1e99D, 99999999999999999999BD), (NULL, NULL, NULL), ('x', double('NaN'), 0BD), ('y', double('Infinity'), 0.1BD) "
        "AS t(text, number, exact)"
    )
    got = [tuple(r) for r in cast_columns(df, {"text": "int", "number": "int", "exact": "int"}).collect()]
    assert got == [(123, 123, 123), (None, None, None), (-7, -7, -7), (None, None, None), (None, None, None), (None, None, 0), (None, None, None)]
