"""Every order of the filters against a walk over the documents themselves."""

from collections import Counter
from itertools import permutations

import fixtures as f

from orebelt.llm.filter_audit import COUNTS, audit_filters

SPACES = " \t\n\x0b\x0c\r"


def words(text):
    for c in SPACES:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def fails(doc, docs):
    id, text = doc[0], doc[1] or ""
    own = words(text)
    return {
        "A": len(own) < 100,
        "B": 100 * len(set(own)) < 80 * len(own),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": id is not None and any(o[0] is not None and o[0] < id and (o[1] or "") == text for o in docs),
    }


def walked(docs, labels):
    good = {l[0] for l in labels if l[1] == 1 and l[0] is not None}
    toxic = {l[0] for l in labels if l[2] == 1 and l[0] is not None}
    failing = [fails(d, docs) for d in docs]
    parts = {d[2] or "" for d in docs}
    found, removed_by = {}, Counter()
    for part in parts:
        own = [(d, x) for d, x in zip(docs, failing) if (d[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [d for d, x in left if x[letter]]
                left = [(d, x) for d, x in left if not x[letter]]
                all_failing = sum(x[letter] for _, x in own)
                found[part, order, step] = (
                    len(left),
                    len(gone),
                    all_failing - len(gone),
                    sum(x[letter] and sum(x.values()) == 1 for _, x in own),
                    sum(d[0] in good for d in gone),
                    sum(d[0] in toxic for d in gone),
                )
                removed_by[part, letter] += len(gone)
    return {(*k, *v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


def check(spark, docs, labels):
    table = f.table(spark, docs, "doc_id bigint, text string, lang string")
    marks = f.table(spark, labels, "doc_id bigint, quality int, toxic int")
    got = audit_filters(table, marks)
    assert got.columns == ["part", "filter_order", "step", *COUNTS, "shapley"]
    rows = f.rows(got)
    assert set(rows) == walked(docs, labels)
    assert len(rows) == 600 * len({d[2] or "" for d in docs})


LONG = f.prose(5, 150)


def test_all_orders(spark):
    texts = [
        LONG,
        LONG.upper(),
        LONG + " #",
        "one two " * 80,
        "ONE TWO|" * 80,
        "a b\x0bc " * 60,
        "\U0001f600" * 10 + "A",
        "",
        "   ",
        None,
        f.prose(6, 99),
        f.prose(7, 100),
        "a " * 80 + f.prose(8, 20),
    ]
    docs = [(i * 3 % 13 + 20 * j, t, "en" if (i + j) % 3 else "de") for i, t in enumerate(texts) for j in range(2)]
    labels = [(d[0], d[0] % 2, d[0] % 3 % 2) for d in docs if d[0] % 4]
    check(spark, docs, labels)


def test_repeated_and_lost_ids_null_parts_and_labels(spark):
    docs = [(1, LONG, "en"), (1, LONG, "en"), (2, LONG, None), (2, "", ""), (None, LONG, "en"), (None, None, None), (3, None, "en")]
    check(spark, docs, [(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1)])


def test_very_long_text(spark):
    docs = [(1, f.prose(1, 100_000), "en"), (2, "A" * 300_000, "en")]
    check(spark, docs, [])


def test_empty_table(spark):
    docs = f.table(spark, [], "doc_id bigint, text string, lang string")
    labels = f.table(spark, [], "doc_id bigint, quality int, toxic int")
    assert audit_filters(docs, labels).count() == 0
