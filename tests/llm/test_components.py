"""Components against a plain walk over the graph."""

import random

import numpy as np
import pytest

from orebelt.llm import components


def walked(edges):
    near = {}
    for u, v in edges:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    found = {}
    for start in sorted(near):
        if start not in found:
            left = [start]
            while left:
                node = left.pop()
                if node not in found:
                    found[node] = start
                    left += near[node]
    return {node: c for node, c in found.items() if near[node] - {node}}


def graph(kind, pick):
    if kind == "path":
        order = pick.sample(range(1000), 120)
        return list(zip(order, order[1:]))
    if kind == "ordered path":
        return [(i, i + 1) for i in range(200)]
    if kind == "least is a hub":
        return [(0, i) for i in range(1, 300)]
    if kind == "greatest is a hub":
        return [(500, i) for i in range(300)]
    if kind == "trees":
        return [(i, pick.randrange(max(0, i - 40), i)) for i in range(1, 300) if i % 50]
    return [(pick.randrange(400), pick.randrange(400)) for _ in range(250)]


KINDS = ["path", "ordered path", "least is a hub", "greatest is a hub", "trees", "random"]


@pytest.mark.parametrize("rows", [3, 1 << 20])
@pytest.mark.parametrize("kind", KINDS)
def test_against_a_walk(spark, monkeypatch, kind, rows):
    monkeypatch.setattr(components, "ROWS_AT_ONCE", rows)
    edges = graph(kind, random.Random(7))
    edges += edges[:5] + [(v, u) for u, v in edges[5:9]]
    df = spark.createDataFrame(edges, "u bigint, v bigint").repartition(5)
    found = components.connected_components(df).collect()
    assert {r.node: r.component for r in found} == walked(edges)
    assert len(found) == len(walked(edges))


def test_no_edges(spark):
    assert components.connected_components(spark.createDataFrame([(1, 1)], "u bigint, v bigint").filter("u > 1")).count() == 0
    assert components.connected_components(spark.createDataFrame([(1, 1)], "u bigint, v bigint")).count() == 0


def test_stars():
    u, v = components.stars(np.array([5, 4, 9, 9]), np.array([4, 2, 8, 8]))
    assert (u.tolist(), v.tolist()) == ([4, 5, 9], [2, 2, 8])
