"""Connected components of an edge table, by closing pieces of it in tasks and shortening what is left.

Edges point from a node to a lesser one. A round first joins what meets in a task: all edges of a part of
the table become stars around the least node that they reach there, once where the edges lie and once
brought together by the node that they start from. Then every edge that ends at a node that has an edge
itself is led on to where that ends. A round that changes nothing has left stars only.

A node with very many edges is no task of its own: as a start of edges it has one row for each part of the table
after the first step, and as an end it is met in a join whose other side is stored, which adaptive execution can
split or send around. Every round is written to the shared folder; the driver sees one flag of it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebelt.llm.text import tidy
from orebelt.session import stage

ROWS_AT_ONCE = 1 << 20


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node of the edges that is not the least it reaches, the node and that least one, in order."""
    nodes, place = np.unique(np.r_[u, v], return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]
    led = np.flatnonzero(root < np.arange(len(nodes)))
    return nodes[led], nodes[root[led]]


def _parts(batches: Iterable[pa.RecordBatch], whole: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges, a bounded number at a time; with ``whole``, all that start at a node at once, as they come in order."""
    us, vs, held = [], [], 0
    for batch in batches:
        us.append(batch["u"].to_numpy())
        vs.append(batch["v"].to_numpy())
        held += batch.num_rows
        if held >= ROWS_AT_ONCE:
            u, v = np.concatenate(us), np.concatenate(vs)
            end = int(np.searchsorted(u, u[-1])) if whole else len(u)
            if end:
                yield u[:end], v[:end]
            us, vs, held = [u[end:]], [v[end:]], len(u) - end
    if held:
        yield np.concatenate(us), np.concatenate(vs)


@tidy
def _where_they_lie(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for u, v in _parts(batches, False):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in stars(u, v)], names=["u", "v"])


@tidy
def _by_start(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for u, v in _parts(batches, True):
        before = np.unique(np.stack([u, v]), axis=1)
        after = np.stack(stars(u, v))
        changed = before.shape != after.shape or bool((before != after).any())
        yield pa.RecordBatch.from_arrays(
            [pa.array(after[0]), pa.array(after[1]), pa.array(np.full(after.shape[1], changed))], names=["u", "v", "changed"]
        )


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(u, v)``; the component is its least node."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    while True:
        near = edges.select("u", "v").mapInArrow(_where_they_lie, "u bigint, v bigint")
        met = near.repartition("u").sortWithinPartitions("u")
        met = stage(met.mapInArrow(_by_start, "u bigint, v bigint, changed boolean"), "stars")
        ends = stage(met.groupBy(F.col("u").alias("end")).agg(F.min("v").alias("on")), "ends")
        led = met.join(ends, met["v"] == ends["end"], "left")
        changed = F.col("changed") | F.col("on").isNotNull()
        edges = stage(led.select("u", F.coalesce("on", "v").alias("v"), changed.alias("changed")), "edges")
        if not edges.agg(F.max("changed")).first()[0]:
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
