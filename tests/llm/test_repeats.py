import random
import re
from collections import Counter

import fixtures as f
import numpy as np
import pytest

from orebelt.llm import blocks, repeats


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int(np.count_nonzero(np.diff(np.r_[0, gone.astype(np.int8)]) == 1))
        yield len(d), int(gone.sum()), spans, bytes(np.frombuffer(d, np.uint8)[~gone])


def check(spark, texts, length=80):
    got = {r.doc_id: tuple(r)[1:] for r in repeats.remove_repeats(f.documents(spark, texts), length=length).collect()}
    for i, expected in enumerate(brute(texts, length)):
        assert (*got[i][:3], bytes(got[i][3])) == expected, i


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(blocks.in_blocks, "__defaults__", (1500,))
    monkeypatch.setattr(repeats, "RANGE_BYTES", 2000)


def test_shared_passages_anywhere(spark, small_blocks):
    pick = random.Random(5)
    passages = [f.prose(100 + i, n) for i, n in enumerate((8, 14, 15, 16, 17, 18, 20, 30, 60))]
    texts = []
    for i in range(70):
        parts = [f.prose(i, pick.randint(0, 30))]
        for _ in range(pick.randint(0, 3)):
            whole = pick.choice(passages)
            a = pick.randint(0, len(whole) // 3)
            parts += [whole[a : pick.randint(a, len(whole))] if pick.random() < 0.5 else whole, f.prose(1000 + pick.randint(0, 9999), pick.randint(0, 12))]
        texts.append(" ".join(parts))
    check(spark, texts)


def test_text_without_triggers_and_copies(spark, small_blocks):
    one = f.prose(1, 60)
    check(spark, ["a" * 500, "ab" * 200, "a" * 79, "a" * 80, "", None, one, one, "x" + one, one[:100] + "y" + one[101:], "é" * 90, "日本" * 50, " " * 300])


def test_hot_passage_is_counted_window_by_window(spark, small_blocks, monkeypatch):
    monkeypatch.setattr(blocks, "MOST", 3)
    hot = f.prose(2, 40)
    texts = [f.prose(10 + i, i % 7) + hot[i % 3 :] + f.prose(90 + i, i % 5) for i in range(40)]
    texts += [hot[:120] + f.prose(300, 20), f.prose(301, 9) + hot[60:], hot[30:115]]
    check(spark, texts)


def test_windows_at_the_bound(spark):
    one = f.prose(3, 40)
    check(spark, [f.prose(4, 5) + one[:80] + f.prose(5, 5), f.prose(6, 5) + one[:80] + f.prose(7, 5), one[1:80], f.prose(8, 3) + one[100:179]])


def test_repeated_rows_lost_ids_and_empty_table(spark):
    text = f.prose(9, 120)
    docs = f.documents(spark, [(1, text), (1, text), (None, text + "z"), (None, None)])
    got = repeats.remove_repeats(docs).collect()
    assert sorted((r.n_bytes - r.n_removed) for r in got) == [0, 0, 0, 1]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0
    cut = repeats.with_repeats_removed(docs.withColumn("n_chars", docs.doc_id))
    assert cut.columns == [*docs.columns, "n_chars"]
    assert sorted(r.text for r in cut.collect()) == ["", "", "", "z"]


def test_cut_characters_go_as_a_whole(spark):
    shared = "é" + f.prose(11, 90)
    texts = ["è" + shared[1:], shared, "x"]
    docs = f.documents(spark, texts)
    assert all("�" not in r.text for r in repeats.with_repeats_removed(docs).collect())


def test_short_length_is_refused(spark):
    with pytest.raises(ValueError):
        repeats.remove_repeats(f.documents(spark, ["a"]), length=20)


def brute_passages(texts, length, size):
    """What is left of each text without repeated strings and without passages of ``size`` words that stand twice."""
    places = [[m.span() for m in re.finditer(r"[^ \t\n]+", t)] for t in texts]
    split = [t.split() for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    strings = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t, at, w in zip(texts, places, split):
        gone = [False] * len(t)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                a, b = at[i][0], at[i + size - 1][1]
                gone[a:b] = [True] * (b - a)
        for i in range(len(t) - length + 1):
            if strings[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        yield "".join(c for c, g in zip(t, gone) if not g)


@pytest.mark.parametrize("most", [127, 3])
def test_passages_by_words(spark, small_blocks, monkeypatch, most):
    monkeypatch.setattr(blocks, "MOST", most)
    pick = random.Random(6)
    shared = [f.prose(200 + i, n) for i, n in enumerate((8, 10, 11, 12, 12, 13, 16, 25, 40))] + [" ".join("abcdefghijklmno")]
    texts = ["a " * 40, "", "b"]
    for i in range(60):
        parts = [f.prose(i, pick.randint(0, 20))]
        for _ in range(pick.randint(0, 3)):
            parts += [pick.choice(shared).replace(" ", pick.choice([" ", " ", "  "])), f.prose(2000 + pick.randint(0, 9999), pick.randint(0, 12))]
        texts.append(pick.choice([" ", "\n"]).join(parts))
    got = {r.doc_id: r.text for r in repeats.with_repeats_removed(f.documents(spark, texts), length=150, words=12).collect()}
    for i, left in enumerate(brute_passages(texts, 150, 12)):
        assert got[i] == left, i


def test_passages_are_told_and_left_in_place(spark, small_blocks):
    shared = [f.prose(300 + i, n) for i, n in enumerate((11, 12, 12, 14, 30))]
    texts = [" ".join([f.prose(i, 5), shared[i % 5], f.prose(100 + i, 7), shared[i % 3], f.prose(200 + i, i % 4)]) for i in range(15)]
    texts += ["", None, "a " * 30, f.prose(400, 100_000)]
    found = repeats.remove_repeats(f.documents(spark, texts), length=120, words=12, keep_passages=True)
    got = {r.doc_id: r for r in found.collect()}
    plain = [t or "" for t in texts]
    for i, expected in enumerate(brute(texts[:-1], 120)):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) == expected, i
    for i, left in enumerate(brute_passages(plain[:-1], 1 << 30, 12)):
        assert got[i].n_passage_bytes == len(plain[i]) - len(left), i
        assert (got[i].n_passages > 0) == (got[i].n_passage_bytes > 0)
    assert got[len(texts) - 1].n_passage_bytes == 0
