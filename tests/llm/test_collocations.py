"""Phrases against plain counting of all of them."""

import re
from collections import Counter

import fixtures as f
import pytest

from orebelt.llm import collocations as c

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, least, top):
    counts, total = {}, Counter()
    for _, text, lang in docs:
        own = counts.setdefault(lang if lang is not None else "und", Counter())
        low = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang if lang is not None else "und"] += len(words)
            for size in (1, 2, 3):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    rows = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        drop = {p[i : i + 2] for p, a in candidates.items() if len(p) == 3 for i in (0, 1) if 100 * a >= 50 * own[p[i : i + 2]]}
        found = []
        for p, a in candidates.items():
            if p not in drop:
                cuts = [(1000000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -s))
    return sorted(rows, key=repr)


def check(spark, docs, *, least=10, top=2000, split=3, **more):
    table = f.table(spark, docs, "doc_id bigint, text string, lang string").repartition(split)
    got = c.collocations(table, least=least, top=top, **more)
    assert got.columns == COLUMNS
    rows = f.rows(got)
    assert rows == brute(docs, least, top)
    return rows


def corpus(n, seed=0):
    """Few words and set phrases, so that every length has phrases about the threshold."""
    pick = __import__("random").Random(seed)
    words = f.prose(seed + 1, 60).split()
    phrases = [" ".join(pick.choice(words) for _ in range(pick.randint(2, 5))) for _ in range(40)]
    ends = [" ", "  ", "\t", ". ", ", ", "\n", "! ", "; ", " "]
    for i in range(n):
        parts = (pick.choice(phrases if pick.random() < 0.6 else words) + pick.choice(ends) for _ in range(pick.randint(1, 120)))
        yield i, "".join(parts).title() if i % 5 == 0 else "".join(parts), ("en", "de", None, "und")[i % 4]


@pytest.mark.parametrize("shards", [1, 2, 3])
def test_counts_scores_and_ranks(spark, shards):
    rows = check(spark, list(corpus(120)), shards=shards, block_bytes=2000, range_bytes=9000)
    assert len({len(r[2].split()) for r in rows}) == 2 and len(rows) > 100


def test_whatever_the_blocks(spark):
    docs = list(corpus(40, 3))
    check(spark, docs, least=4, block_bytes=1, range_bytes=1 << 30, split=2)
    check(spark, docs, least=4, split=1)


def test_phrases_that_reach_the_threshold_in_the_last_scan(spark):
    docs = [(i, "a b c. d e", "en") for i in range(9)] + [(9, f.prose(2, 3000) + " a b c, a b", "en")]
    rows = check(spark, docs, block_bytes=500, range_bytes=5000, split=5)
    assert {r[2]: r[3] for r in rows} == {"a b c": 10}


def test_rank_cut_and_ties(spark):
    docs = [(i, "x y. y x. p q. Q P! é z. z é", "en") for i in range(10)]
    rows = check(spark, docs, top=4)
    assert [r[2] for r in rows] == ["p q", "q p", "x y", "y x"]


def test_odd_rows(spark):
    docs = [(None, "a b " * 30, None), (1, None, "en"), (2, "", "en"), (3, " ,.;", "en"), (3, "a b", "und"), (3, "a b", "und")]
    check(spark, docs + [(4, "\U0001f600 \xa0é " * 20, "x\ty\n"), (5, "One Two Three " * 12, "")])


def test_very_long_text(spark):
    check(spark, [(1, "a b c d " * 30_000 + f.prose(3, 20_000), "en"), (2, "a" * 300_000, "en")])


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, l, r = 3_000_000_000_000, 10_000_000_000_001, 9_000_000_000_007
    row = spark.range(1).select(F.lit(a).alias("a"), F.lit(l).alias("l"), F.lit(r).alias("r")).select(c._score("a", "l", "r"))
    assert row.first()[0] == 1000000 * a * a // (l * r)


def test_empty_table(spark):
    assert c.collocations(f.table(spark, [], "doc_id bigint, text string, lang string")).count() == 0
    assert c.collocations(f.table(spark, [(1, None, None)], "doc_id bigint, text string, lang string")).count() == 0
