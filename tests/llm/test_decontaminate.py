import math
import random
import re
from collections import Counter

import fixtures as f
import numpy as np
import pyarrow as pa

from orebelt.llm import decontaminate as d
from orebelt.llm.text import chunks


def items_of(spark, texts):
    return f.table(spark, [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)], "item_id bigint, text string")


COMMON = "the of and to in is it that was for".split()


def sentence(seed, words):
    pick = random.Random(seed)
    return " ".join(w if pick.random() < 0.6 else pick.choice(COMMON) for w in f.prose(seed, words).split())


ITEMS = [sentence(i, 12 + 3 * i) for i in range(30)]


def test_planted_items(spark):
    words = ITEMS[7].split()
    texts = [
        "",
        None,
        sentence(900, 400),
        sentence(901, 200) + " " + ITEMS[3].upper() + ", " + sentence(902, 90),
        ITEMS[4].replace(" ", "\n"),
        sentence(903, 61) + " " + ITEMS[29] + ". " + ITEMS[5],
        " ".join(words[: len(words) // 2]),  # half of a question
        sentence(904, 50) + " " + " ".join(words[:20] + ["other"] + words[21:]) + " " + sentence(905, 50),
        " ".join(sorted(ITEMS[8].split())),  # the same words, but neither question nor answer
        "".join(sentence(1000 + i, 100) + " " for i in range(60)) + ITEMS[1],
    ]
    docs = f.documents(spark, texts)
    got = {(r.doc_id, r.item_id) for r in d.find_leaks(docs, items_of(spark, ITEMS)).collect()}
    assert got == {(3, 3), (4, 4), (5, 29), (5, 5), (7, 7), (9, 1)}
    kept = d.drop_leaking(docs, items_of(spark, ITEMS))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 6, 8]


def test_spans_and_scores(spark):
    text = sentence(801, 30) + " é " + ITEMS[10] + " " + sentence(802, 30)
    (row,) = d.find_leaks(f.documents(spark, [text]), items_of(spark, ITEMS)).collect()
    assert ITEMS[10] in text.encode()[row.start_byte : row.end_byte].decode()
    assert row.question_overlap == row.answer_overlap == 1.0 and row.share > 0.99


def test_search_against_plain_bm25():
    """Skipping blocks loses no item above its bound and adds none."""
    pick = random.Random(2)
    texts = [" ".join(pick.choice(COMMON + f.prose(i % 5, 20).split()) for _ in range(pick.randint(1, 25))) for i in range(60)]
    docs = [" ".join(pick.choices(texts, k=3)) if i % 2 else f.prose(i % 5, 300) for i in range(40)] + ["", "the"]
    index = d.Index([*range(60)], texts, 0.3)
    words = [re.findall(r"\w+", t) for t in texts]
    df = Counter(w for t in words for w in set(t))
    mean = sum(map(len, words)) / len(words)

    def weight(w, item):
        tf = item.count(w)
        idf = math.log1p((len(words) - df[w] + 0.5) / (df[w] + 0.5))
        return idf * tf * (d.K1 + 1) / (tf + d.K1 * (1 - d.B + d.B * len(item) / mean))

    expected = set()
    for t, doc in enumerate(docs):
        tokens = re.findall(r"\w+", doc)
        cells = math.ceil(len(tokens) / index.stride)
        for c in range(cells):
            passage = set(tokens[c * index.stride : (c + 2) * index.stride])
            for i, item in enumerate(words):
                own = sum(weight(w, item) for w in set(item))
                score = sum(weight(w, item) for w in set(item) & passage)
                if score >= 0.3 * own - 1e-9:
                    expected.add((t, c * index.stride, i, round(score, 6)))
    got = set()
    for chunk in chunks(pa.array(docs)):
        found = d.terms(chunk)
        for t, a, _, i, s in index.search(found):
            got.add((chunk.first + t, a - int(found.bounds[t]), i, round(s, 6)))
    assert got == expected and len(got) > 100
    assert isinstance(index.block_most.weight, np.ndarray)


def test_slices_find_the_same(spark, monkeypatch):
    texts = [ITEMS[i] + " " + f.prose(i, 30) for i in range(30)]
    items = items_of(spark, ITEMS + [f.prose(5000, 700), None, "", "..."])
    docs = f.documents(spark, [*texts, f.prose(5000, 700)])
    whole = {(r.doc_id, r.item_id) for r in d.find_leaks(docs, items).collect()}
    monkeypatch.setattr(d, "SLICE_BYTES", 900)
    assert {(r.doc_id, r.item_id) for r in d.find_leaks(docs, items).collect()} == whole == {(i, i) for i in range(31)}


def test_odd_rows(spark):
    docs = f.documents(spark, [(1, ITEMS[2]), (1, ITEMS[2]), (None, ITEMS[2]), (None, None)])
    got = d.find_leaks(docs, items_of(spark, [(2, ITEMS[2]), (2, ITEMS[2]), (None, ITEMS[2])])).collect()
    assert Counter((r.doc_id, r.item_id) for r in got) == {(1, 2): 4, (1, None): 2, (None, 2): 2, (None, None): 1}
    assert d.find_leaks(docs, items_of(spark, []).limit(0)).count() == 0
    assert d.find_leaks(docs.limit(0), items_of(spark, ITEMS)).count() == 0
    assert d.drop_leaking(docs.limit(0), items_of(spark, ITEMS)).count() == 0


def test_scores_do_not_depend_on_slices(spark, monkeypatch):
    items = items_of(spark, ITEMS + [f.prose(5000, 700), f.prose(5001, 900), ITEMS[3], None, "", "..."])
    texts = [sentence(700 + i, 20) + " " + ITEMS[i] + " " + f.prose(i, 30) for i in range(30)]
    docs = f.documents(spark, [*texts, f.prose(5000, 700), f.prose(1, 100_000) + ITEMS[2]])

    def found():
        leaks = d.find_leaks(docs, items).select("doc_id", "item_id", "score", "share", "start_byte", "end_byte")
        return sorted(map(tuple, leaks.collect()))

    whole = found()
    assert len(whole) >= 32
    for size in (4000, 900, 100):
        monkeypatch.setattr(d, "SLICE_BYTES", size)
        assert found() == whole
