import random
import re

import fixtures as f
import pytest

from orebelt.llm import near_dedup as nd
from orebelt.llm.components import connected_components


def shingle_set(text):
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(texts):
    sets = [shingle_set(t) for t in texts]
    parent = [*range(len(texts))]

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def edited(pick, text, edits):
    words = text.split()
    for _ in range(edits):
        words[pick.randrange(len(words))] = f.prose(pick.randrange(10**6), 1)
    return " ".join(words)


def corpus():
    pick = random.Random(8)
    texts = []
    for g in range(12):
        base = f.prose(g, pick.choice([6, 20, 80, 200]))
        texts += [edited(pick, base, pick.randint(0, max(1, len(base.split()) // 12))) for _ in range(pick.randint(1, 9))]
    texts += ["", None, " \t\n", "a", "A", "a b c d", "A  b\tc d", "a b c d e", "Ä b c d e", "ä b c d e", "x " * 5000]
    pick.shuffle(texts)
    return texts


def check(spark, texts):
    got = {r.doc_id: r for r in nd.near_duplicates(f.documents(spark, texts)).collect()}
    for i, (size, component) in enumerate(brute(texts)):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (size, component, component == i), i


def test_against_brute_force(spark):
    check(spark, corpus())


def test_large_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 6)
    monkeypatch.setattr(nd, "MEMBERS_PER_TASK", 8)
    pick = random.Random(9)
    base = f.prose(1, 100)
    chain = [base]
    for _ in range(20):  # neighbours are near, the ends are not
        chain.append(edited(pick, chain[-1], 2))
    check(spark, [edited(pick, base, pick.randint(0, 7)) for _ in range(40)] + chain)


def test_boilerplate_without_links(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 6)
    monkeypatch.setattr(nd, "MEMBERS_PER_TASK", 8)
    monkeypatch.setattr(nd, "CELL", 5)
    held = []

    def link_blocks(rows, p, *, residual):
        if residual:
            held.append(rows.count())
        return whole(rows, p, residual=residual)

    whole = nd._link_blocks
    monkeypatch.setattr(nd, "_link_blocks", link_blocks)
    passage = f.prose(1, 60)
    texts = [f"{passage} {f.prose(100 + i, 40)}" for i in range(90)]
    check(spark, texts)
    (rows,) = held
    assert rows < 4 * len(texts)
    check(spark, texts + [texts[7] + " end", texts[60] + " end", "start " + texts[61]] + [f"{passage} {f.prose(300 + i, 9)}" for i in range(20)])


def test_repeated_and_lost_ids(spark):
    one, two = f.prose(1, 30), f.prose(2, 30)
    docs = f.documents(spark, [(4, one), (4, one), (7, one), (7, two), (9, two), (None, one), (None, None)])
    got = f.rows(nd.near_duplicates(docs), "doc_id", "component_id", "kept")
    assert [r for r in got if r[0] is not None] == [(4, 4, True), (4, 4, True), (7, 4, False), (7, 4, False), (9, 4, False)]
    assert [r for r in got if r[0] is None] == [(None, None, True)] * 2
    kept = nd.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 4]


def test_empty_table(spark):
    docs = f.documents(spark, []).limit(0)
    assert nd.near_duplicates(docs).count() == 0
    assert nd.drop_near_duplicates(docs).count() == 0


def test_odd_sketches_estimate_high_similarities():
    import math

    import numpy as np

    p = nd.Sketching()
    sketcher = nd.Sketcher(p)
    pick = np.random.default_rng(1)
    for similarity in (0.75, 0.85, 0.95):
        estimates = []
        for _ in range(30):
            common = round(400 * similarity)
            rest = (400 - common) // 2
            values = pick.integers(0, 2**63, common + 2 * rest, dtype=np.uint64)
            a, b = values[: common + rest], np.r_[values[:common], values[common + rest :]]
            one, two = (sketcher.odd_sketch(sketcher.samples(x)) for x in (a, b))
            differ = int(np.bitwise_count(one ^ two).sum())
            estimates.append(1 + p.sketch_bits / (4 * p.samples) * math.log(1 - 2 * differ / p.sketch_bits))
        assert np.mean(estimates) == pytest.approx(similarity, abs=0.03)


def test_components(spark):
    pick = random.Random(3)
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(200 + pick.randrange(20), 200 + pick.randrange(20)) for _ in range(12)] + [(5, 5)]
    got = dict(f.rows(connected_components(spark.createDataFrame(edges, "u bigint, v bigint"))))
    parent = {x: x for e in edges if e[0] != e[1] for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    assert got == {x: root(x) for x in parent}
