import os

import fixtures as f
import pytest

import corpus_pipeline
from orebelt.llm import pieces, sql
from orebelt.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("OREBELT_SF_DIR", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
model = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no piece model")


@tables
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_against_sql(spark, name):
    import oracle

    names, kinds, rows = oracle.spark_rows(QUERIES[name](spark, SF_DIR))
    duck_names, duck_kinds, duck_rows = oracle.duck_rows(oracle.connect(SF_DIR), ORACLE_SQL[name])
    assert (names, kinds, rows) == (duck_names, duck_kinds, duck_rows)


@tables
@model
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_covers_its_table(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    source, key = ("pages", "page_id") if name.startswith("op6") else ("documents", "doc_id")
    ids = {r[0] for r in spark.read.parquet(f"{SF_DIR}/{source}.parquet").select(key).collect()}
    got = [r[0] for r in df.select(key).collect()]
    assert set(got) <= ids if name.startswith("op9") else sorted(got) == sorted(ids)


@model
def test_stages_on_planted_documents(spark, tmp_path):
    clean = {i: f.prose(i, 120) for i in range(20)}
    item, passage = f.prose(500, 25), f.prose(600, 130)
    texts = dict(clean)
    texts[30] = clean[3]  # a copy
    texts[31] = clean[4].replace(" ", "  ", 5)  # a near copy
    texts[32] = f.prose(32, 60) + " idiot idiot moron scum " + f.prose(33, 60)  # toxic
    texts[34] = f.prose(34, 80) + " " + item + " " + f.prose(35, 80)  # leaking
    for i in (36, 37):
        texts[i] = f.prose(i, 90) + " " + passage + " " + f.prose(i + 50, 90)  # a shared passage
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()] + [(90, None, None, None, None), (91, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {*clean, 36, 37, 90, 91}
    assert all(got[i].text == t for i, t in clean.items())
    assert passage not in got[36].text and got[36].text.startswith(f.prose(36, 90)[:80])
    assert got[90].text == got[91].text == "" and got[90].n_pieces == 0


@model
def test_odd_documents_pass_all_stages(spark, tmp_path):
    """Clashing columns, repeated rows and ids, lost ids, a very long text."""
    long = f.prose(1, 100_000)
    rows = [
        (1, f.prose(2, 100)),
        (2, f.prose(3, 100)),
        (2, f.prose(3, 100)),  # the same row again
        (3, f.prose(4, 100)),
        (3, f.prose(5, 100)),  # the same id with another text
        (None, f.prose(6, 100)),
        (None, None),
        (4, long),
        (5, ""),
        (6, None),
        (-7, f.prose(2, 100)),  # a copy of 1, with a smaller id
    ]
    docs = f.table(spark, [(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    f.table(spark, [], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    f.table(spark, [], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, kept, str(tmp_path))
        assert kept.schema.simpleString() == docs.schema.simpleString()
    got = [(r.doc_id, r.text) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted((i for i, _ in got), key=str) == sorted([2, 3, 4, 5, 6, -7, None, None], key=str)
    assert (4, long) in got and (None, f.prose(6, 100)) in got and (5, "") in got and (6, "") in got
    assert sum(i == 3 and t in (f.prose(4, 100), f.prose(5, 100)) for i, t in got) == 1


def test_passages_of_over_50_words_go(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    sizes = (51, 52, 55)
    shared = {n: f.prose(700 + n, n) for n in (*sizes, 12, 30, 50)} | {510: " ".join("abcdefghijklmnopq" * 3)}
    assert all(len(p) < 400 for p in shared.values())
    rows = []
    for n, passage in shared.items():
        for i in (0, 1):
            text = f"{f.prose(2000 + 2 * n + i, 80)} {passage} {f.prose(4000 + 2 * n + i, 80)}"
            rows.append((2 * n + i, text, "en", "s", len(text)))
    got = {r.doc_id: r for r in corpus_pipeline.suffix_dedup(spark, spark.createDataFrame(rows, schema), "").collect()}
    assert len(got) == len(rows)
    for id, text, *_ in rows:
        gone = id // 2 in (*sizes, 510)
        assert got[id].text == (text.replace(shared[id // 2], "") if gone else text), id
        assert got[id].n_chars == len(got[id].text)


def test_stages_keep_the_columns(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5)], schema)
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for empty in (False, True):
        for _, step in corpus_pipeline.STAGES[:-1]:
            out = step(spark, docs.limit(0) if empty else docs, str(tmp_path))
            assert out.schema.simpleString() == docs.schema.simpleString()
            assert out.count() == (0 if empty else 1)


def test_sql_is_given_for_what_sql_can_say():
    assert ORACLE_SQL["op4_warc"] == sql.WARC and corpus_pipeline.ORACLE_SQL is None
