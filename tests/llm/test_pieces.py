import os

import fixtures as f
import pytest

from orebelt.llm import pieces as p

pytestmark = pytest.mark.skipif(not os.path.exists(p.MODEL), reason="no piece model")

TEXTS = [
    "Hello world",
    " two  blanks and a tail ",
    "tab\tand\nline\r\n",
    "é ü ß ñ 日本語 Привет",
    "▁literal ▁ sign",
    "\U0001f600 emoji ‍",
    "",
    None,
    " ",
    "a" * 3000,
    f.prose(1, 500),
    "\x00\x01control\x7f",
]


@pytest.fixture(scope="module")
def table():
    return p.load_pieces()


def brute(text, table):
    """Best path over the whole text, later edges winning only if better."""
    if not text:
        return []
    edges = dict(zip(table.spelling, zip(table.id.tolist(), table.score.tolist())))
    data = " " + text
    best = [(0, [])] + [None] * len(data)
    for a in range(len(data)):
        if best[a] is None:
            continue
        for b in range(a + 1, min(len(data), a + 16) + 1):
            if " " in data[a + 1 : b]:
                break
            own = data[a:b].encode()
            if own in edges and "▁" not in data[a:b]:
                come = best[a][0] + edges[own][1], best[a][1] + [edges[own][0]]
            elif b == a + 1:
                come = best[a][0] + table.byte_score * len(own), best[a][1] + [int(table.byte_id[x]) for x in own]
            else:
                continue
            if best[b] is None or come[0] > best[b][0]:
                best[b] = come
    return best[-1][1]


def test_round_trip_and_best_path(spark, table):
    coded = p.encode(f.documents(spark, TEXTS), table)
    got = {r.doc_id: r for r in p.decode(coded, table).collect()}
    at_once = {r.doc_id: r for r in p.encode(f.documents(spark, TEXTS), table, decoded=True).collect()}
    for i, text in enumerate(TEXTS):
        assert got[i] == at_once[i]
        assert got[i].text == (text or "")
        assert got[i].ids == brute(text, table), text


def test_pieces_are_those_of_the_model(spark, table):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=p.MODEL)
    for r in p.decode(p.encode(f.documents(spark, TEXTS), table), table).collect():
        assert model.decode(r.ids) == r.text


def test_relational_words_are_the_same(spark, table):
    words = [" " + w for w in f.prose(2, 60).split()] + ["Hello", "日本", " ", " representation", None, ""]
    vocabulary = f.table(spark, [(w,) for w in words + words[:3]], "word string")
    got = {r.word: r.ids for r in p.encode_words(spark, vocabulary, table).collect()}
    expected = {w: brute(w[1:], table) if w[0] == " " else brute(w, table)[1:] for w in words if w}
    expected[" "] = got[" "]
    for word, ids in got.items():
        if word.startswith(" ") and word != " ":
            assert ids == expected[word]
    assert "日本" in got and len(got[" "]) == 1


def test_odd_rows(spark, table):
    docs = f.documents(spark, [(1, "x y"), (1, "x y"), (None, "x"), (None, None)])
    got = p.decode(p.encode(docs, table), table).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, ""), (0, "x"), (1, "x y"), (1, "x y")]
    assert p.decode(p.encode(docs.limit(0), table), table).count() == 0
    none = spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")
    assert p.decode(none, table).collect()[0].text == ""
