"""Quotas against the rule seat by seat, and what the mix takes of every document."""

from fractions import Fraction

import fixtures as f
import pytest
from pyspark.sql import functions as F

from orebelt.llm.mix import BLOCK_WORDS, apportion, mix_sources, numbered, words_taken


def seat_by_seat(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats if any(votes.values()) else 0):
        best = min((p for p in votes if votes[p]), key=lambda p: (-votes[p] / (2 * won[p] + 1), p))
        won[best] += 1
    return won


def test_apportionment_seat_by_seat(spark):
    groups = {
        0: ({0: 53.0, 1: 24.0, 2: 23.0}, 7),
        1: ({i: 1.0 for i in range(9)}, 5),
        2: ({0: 1000.0, **{i: 1.0 for i in range(1, 40)}}, 100),
        3: ({i: float(i * i) for i in range(30)}, 333),
        4: ({0: 0.0, 1: 0.0}, 0),
        5: ({0: 3.0, 1: 0.0}, 11),
    }
    rows = [(g, p, v) for g, (votes, _) in groups.items() for p, v in votes.items()]
    parts = spark.createDataFrame(rows, "group int, part bigint, votes double")
    seats = spark.createDataFrame([(g, n) for g, (_, n) in groups.items()], "group int, seats bigint")
    got = {(r.group, r.part): r.quota for r in apportion(parts, seats).collect()}
    assert got == {(g, p): n for g, (votes, seats) in groups.items() for p, n in seat_by_seat(votes, seats).items()}


def test_numbers_in_global_order(spark):
    df = spark.createDataFrame([(x * 7919 % 1000, None if x % 10 else "s") for x in range(1000)], "x int, s string")
    got = numbered(df.repartition(7), [F.col("s").asc_nulls_last(), F.col("x").desc()], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1000))
    assert [(r.s is None, -r.x) for r in got] == sorted((r.s is None, -r.x) for r in got)


def targets(sizes):
    """By the rule: what is above twice the size stops there, the rest is shared anew."""
    weight = {s: Fraction((5, 2, 1)[i % 3]) for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    total, stopped = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        free = [s for s in sizes if s not in stopped]
        level = (total - sum(2 * sizes[s] for s in stopped)) / (sum(weight[s] for s in free) or 1)
        above = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not above:
            return {s: 2 * sizes[s] if s in stopped else weight[s] * level for s in sizes}
        stopped |= above


def taken_of(spark, docs):
    table = f.table(spark, docs, "doc_id bigint, text string, source string")
    mixed = mix_sources(table)
    taken = words_taken(F.col("size"), F.col("passes"), F.col("spans"))
    return mixed.withColumn("taken", taken).collect()


def check(spark, docs):
    got = taken_of(spark, docs)
    assert len(got) == len(docs)
    sizes, took = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        took[r.source] = took.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 2 * r["size"]
        assert all(0 <= s.start < s.end <= r["size"] for s in r.spans)
    wanted = targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(wanted[r.source]))
    for s in sizes:
        assert abs(took[s] - wanted[s]) <= 3 * BLOCK_WORDS * max(1, sizes[s] / 60_000)
    return got


def test_targets_quotas_and_documents(spark):
    sizes = {"a": 30, "b": 3, "c": 400, "d": 90, "é": 5, "z": 700, None: 11, "A": 60}
    docs = [(1000 * i + j, f.prose(j, 40 + 7 * (j % 9)), s) for i, (s, n) in enumerate(sizes.items()) for j in range(n)]
    one, two = check(spark, docs), taken_of(spark, docs[::-1])
    assert sorted(map(repr, one)) == sorted(map(repr, two))


def test_one_source_and_long_texts(spark):
    check(spark, [(i, "word " * n, "s") for i, n in enumerate([100_000, 1, 0, 70_000, 15])])


def test_odd_rows(spark):
    docs = [(None, "a b", "x"), (None, None, None), (1, "", "x"), (1, "a\tb\x0bc", None), (1, "a\tb\x0bc", None), (2, " ", "y")]
    got = taken_of(spark, docs)
    assert sorted((r.source or "", r["size"]) for r in got) == [("", 0), ("", 3), ("", 3), ("x", 0), ("x", 2), ("y", 0)]
    assert {r.target for r in got if r.source == "y"} == {0.0}


def test_empty_tables(spark):
    empty = f.table(spark, [], "doc_id bigint, text string, source string")
    assert mix_sources(empty).count() == 0
    assert [r["size"] for r in taken_of(spark, [(1, None, "a"), (2, "", None)])] == [0, 0]


def test_no_python_in_the_plan(spark):
    docs = f.table(spark, [(1, "a b c", "x")], "doc_id bigint, text string, source string")
    plan = mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert not [step for step in ("Python", "InPandas", "InArrow", "Cartesian", "NestedLoop") if step in plan]
