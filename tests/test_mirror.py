import random

import pytest

from orebelt import extract_links, mirror, sync_stats
from orebelt.plans import products

SOURCE = "name string, fetched boolean, content string"
TARGET = "name string, content string"


def pairs(df):
    return sorted(map(tuple, df.collect()))


def test_listing(spark):
    html = (
        '<A HREF="/pub/x/a">a</A> <A HREF="/pub/x/b">b</A> '
        '<A HREF="/pub/x/c">c</A> <A HREF="/other/z">z</A>'
    )
    pages = spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")
    links = extract_links(pages, "html", "/pub/x/", keep=("page_id",))
    assert [tuple(r) for r in links.collect()] == [(1, "a"), (1, "b"), (1, "c")]


def test_worked_example_and_second_run(spark):
    source = spark.createDataFrame(
        [("a", True, "a2"), ("b", False, None), ("c", True, "c1")], SOURCE
    )
    target = spark.createDataFrame([("a", "a1"), ("b", "b1"), ("d", "d1")], TARGET)
    state, actions = mirror(source, target, "name")
    assert pairs(actions) == [
        ("a", "uploaded", 1),
        ("b", "error", 1),
        ("c", "uploaded", 1),
        ("d", "deleted", 1),
    ]
    assert tuple(sync_stats(actions).first()) == (2, 1, 1)
    after = [("a", "a2"), ("b", "b1"), ("c", "c1")]
    assert pairs(state) == after
    again, second = mirror(source, state, "name")
    assert pairs(again) == after
    assert tuple(sync_stats(second).first()) == (2, 0, 1)


def test_empty_listing_is_refused_unless_allowed(spark):
    source = spark.createDataFrame([], SOURCE)
    target = spark.createDataFrame([("a", "a1")], TARGET)
    with pytest.raises(ValueError, match="empty"):
        mirror(source, target, "name")
    state, actions = mirror(source, target, "name", allow_empty_source=True)
    assert pairs(state) == []
    assert pairs(actions) == [("a", "deleted", 1)]


def test_unknown_outcome_counts_as_failed(spark):
    source = spark.createDataFrame([("a", None, "a2")], SOURCE)
    target = spark.createDataFrame([("a", "a1")], TARGET)
    state, actions = mirror(source, target, "name")
    assert pairs(state) == [("a", "a1")]
    assert pairs(actions) == [("a", "error", 1)]


def test_target_with_no_column_but_the_key(spark):
    source = spark.createDataFrame([("a", True), ("b", False)], "name string, fetched boolean")
    target = spark.createDataFrame([("b",), ("c",)], "name string")
    state, actions = mirror(source, target, "name")
    assert pairs(state) == [("a",), ("b",)]
    assert pairs(actions) == [("a", "uploaded", 1), ("b", "error", 1), ("c", "deleted", 1)]


def test_sync_from_listing_pages(spark):
    html = '<a HREF="/d/a"> <a HREF="/d/a"> <a HREF="/d/b"> <a HREF="/e/z">'
    pages = spark.createDataFrame([(html,), ('<a HREF="/d/c">',)], "html string")
    fetches = spark.createDataFrame([("a", "a2"), ("c", "c2"), ("z", "z2")], TARGET)
    target = spark.createDataFrame([("b", "b1"), ("d", "d1")], TARGET)
    state, actions = products.sync_landing(pages, fetches, target, prefix="/d/")
    assert pairs(state) == [("a", "a2"), ("b", "b1"), ("c", "c2")]
    assert pairs(actions) == [
        ("a", "uploaded", 2),
        ("b", "error", 1),
        ("c", "uploaded", 1),
        ("d", "deleted", 1),
    ]
    with pytest.raises(ValueError, match="empty"):
        products.sync_landing(pages, fetches, target, prefix="/nothing/")


def one_by_one(source, target):
    """The sync as a loop over the listing."""
    state, counts = dict(target), {"uploaded": 0, "deleted": 0, "errors": 0}
    for name, ok, content in source:
        if ok:
            state[name] = max(content, state[name]) if (name, True) in counts else content
            counts[(name, True)] = 1
            counts["uploaded"] += 1
        else:
            counts["errors"] += 1
    for name in target.keys() - {s[0] for s in source}:
        del state[name]
        counts["deleted"] += 1
    return sorted(state.items()), (counts["uploaded"], counts["deleted"], counts["errors"])


@pytest.mark.parametrize("seed", range(3))
def test_against_a_loop_with_names_listed_many_times(spark, seed):
    rng = random.Random(seed)
    names = ["hot"] * 10 + [f"n{i}" for i in range(20)]
    listed = [rng.choice(names) for _ in range(60)]
    source = [(n, rng.random() < 0.7, f"new-{n}") for n in listed]
    target = {f"n{i}": f"old-{i}" for i in range(10, 30)}
    state, actions = mirror(
        spark.createDataFrame(source, SOURCE).repartition(4),
        spark.createDataFrame(list(target.items()), TARGET),
        "name",
    )
    expected_state, expected_counts = one_by_one(source, target)
    assert pairs(state) == expected_state
    assert tuple(sync_stats(actions).first()) == expected_counts


def test_a_target_entry_that_stands_twice(spark):
    source = spark.createDataFrame([("a", True, "new")], "name string, fetched boolean, content string")
    same = spark.createDataFrame([("d", "old"), ("d", "old")], "name string, content string")
    state, actions = mirror(source, same, "name")
    assert sorted(map(tuple, actions.collect())) == [("a", "uploaded", 1), ("d", "deleted", 1)]
    assert [tuple(r) for r in state.collect()] == [("a", "new")]
    two = spark.createDataFrame([("d", "old"), ("d", "older")], "name string, content string")
    with pytest.raises(Exception, match="two target entries"):
        mirror(source, two, "name")[1].collect()


def test_failed_deletes_stay_and_are_tried_again(spark):
    source = spark.createDataFrame([("a", True, "a2"), ("b", False, None)], SOURCE)
    target = spark.createDataFrame([(n, n + "1") for n in "abdefg"], TARGET)
    outcomes = spark.createDataFrame(
        [("d", True), ("e", False), ("e", None), ("f", False), ("f", True), ("b", True), ("unknown", True)],
        "name string, deleted boolean",
    )
    state, actions = mirror(source, target, "name", deletions=outcomes)
    assert pairs(actions) == [
        ("a", "uploaded", 1),
        ("b", "error", 1),
        ("d", "deleted", 1),
        ("e", "error", 1),
        ("f", "deleted", 1),
        ("g", "error", 1),  # never tried
    ]
    assert tuple(sync_stats(actions).first()) == (1, 2, 3)
    assert pairs(state) == [("a", "a2"), ("b", "b1"), ("e", "e1"), ("g", "g1")]
    again, actions = mirror(source, state, "name", deletions=spark.createDataFrame([("e", True), ("g", True)], outcomes.schema))
    assert pairs(actions.filter("action = 'deleted'")) == [("e", "deleted", 1), ("g", "deleted", 1)]
    assert pairs(again) == [("a", "a2"), ("b", "b1")]


def test_a_failed_delete_of_an_entry_that_is_only_a_key(spark):
    source = spark.createDataFrame([("a", True)], "name string, fetched boolean")
    target = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    outcomes = spark.createDataFrame([("b", True)], "name string, deleted boolean")
    state, _ = mirror(source, target, "name", deletions=outcomes)
    assert pairs(state) == [("a",), ("c",)]


def test_sync_from_listing_pages_with_failed_deletes(spark):
    pages = spark.createDataFrame([('<A HREF="/p/a">a</A>',)], "html string")
    fetches = spark.createDataFrame([("a", "a2")], "name string, content string")
    target = spark.createDataFrame([("x", "x1"), ("y", "y1")], TARGET)
    outcomes = spark.createDataFrame([("x", True), ("y", False)], "name string, deleted boolean")
    state, actions = products.sync_landing(pages, fetches, target, prefix="/p/", deletions=outcomes)
    assert pairs(state) == [("a", "a2"), ("y", "y1")]
    assert pairs(actions) == [("a", "uploaded", 1), ("x", "deleted", 1), ("y", "error", 1)]
