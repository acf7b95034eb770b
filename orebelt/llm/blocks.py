"""Counting keys over a whole corpus for blocks of texts that stay where they are.

Texts are dealt into blocks of some megabytes. A block asks for the counts of its distinct keys:
sorted 64-bit hashes, each with a 32-bit check and the number of times the block has it, cut into
key ranges. One task per range adds up the same key of all blocks and answers each in its order,
so a key that half of the corpus has is one entry per block. An answer is a byte: the count, where
``MOST`` stands for that and more, and for one place of every key that it leads the others.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebelt.llm.text import U

BLOCK_BYTES = 4 << 20
MOST = 127
LEADS = 128


def total_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(text).cast("bigint"))).first()[0] or 0


def in_blocks(docs: DataFrame, size: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs(id, text)`` with a ``block`` number, dealt out by it once; ``size`` is their total."""
    count = max(1, math.ceil(size / block_bytes))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(count))
    return docs.withColumn("block", block).repartition("block")


def in_order(group: pa.Table) -> pa.Table:
    """The rows of a block in the same order each time, whatever order the shuffle delivers."""
    return group.sort_by([("id", "ascending"), ("text", "ascending")])


class Keys(NamedTuple):
    """Hashes with their checks, one of each per key."""

    hash: np.ndarray
    check: np.ndarray

    @staticmethod
    def join(parts: list["Keys"]) -> "Keys":
        if not parts:
            return Keys(np.zeros(0, U), np.zeros(0, np.uint32))
        return Keys(np.concatenate([p.hash for p in parts]), np.concatenate([p.check for p in parts]))


class Distinct(NamedTuple):
    keys: Keys
    times: np.ndarray
    first: np.ndarray  # for each distinct key, the first that was asked for
    inverse: np.ndarray  # for each key asked for, its place among the distinct ones


def distinct(keys: Keys) -> Distinct:
    order = np.argsort(keys.hash)
    h, c = keys.hash[order], keys.check[order]
    new, differ = np.ones(len(h), bool), c[1:] != c[:-1]
    new[1:] = h[1:] != h[:-1]
    if (differ & ~new[1:]).any():  # one hash with two checks
        order = np.lexsort((keys.check, keys.hash))
        h, c = keys.hash[order], keys.check[order]
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    inverse = np.empty(len(h), np.int64)
    inverse[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    # The sort may leave equal keys in any order.
    first = np.minimum.reduceat(order, at) if len(at) else at
    return Distinct(Keys(h[at], c[at]), np.diff(np.r_[at, len(h)]), first, inverse)


def range_cuts(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` equal ranges of hashes begins in a sorted array, and its end."""
    bounds = np.array([(i << 64) // parts for i in range(1, parts)], U)
    return np.r_[0, np.searchsorted(hashes, bounds), len(hashes)]


def requests(own: Distinct, parts: int) -> list[tuple[int, bytes]]:
    """``(range, payload)`` for the ranges that the block has keys in."""
    times = np.minimum(own.times, MOST).astype(np.uint8)
    cuts = range_cuts(own.keys.hash, parts)
    return [
        (i, own.keys.hash[a:b].tobytes() + own.keys.check[a:b].tobytes() + times[a:b].tobytes())
        for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
        if a < b
    ]


def answers(payloads: list[bytes]) -> list[bytes]:
    """Per payload the counts over all payloads of one range; the first that has a key leads."""
    sizes = [len(p) // 13 for p in payloads]
    h = np.concatenate([np.frombuffer(p, U, n) for p, n in zip(payloads, sizes)])
    c = np.concatenate([np.frombuffer(p, np.uint32, n, 8 * n) for p, n in zip(payloads, sizes)])
    times = np.concatenate([np.frombuffer(p, np.uint8, n, 12 * n) for p, n in zip(payloads, sizes)])
    own = distinct(Keys(h, c))
    sums = np.bincount(own.inverse, times, len(own.times))
    count = np.minimum(sums, MOST).astype(np.uint8)[own.inverse]
    count[own.first] |= LEADS
    ends = np.cumsum(sizes)
    return [count[e - n : e].tobytes() for e, n in zip(ends, sizes)]


def counts(own: Distinct, replies: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each key asked for its count, and whether it is the one that leads."""
    answer = np.frombuffer(b"".join(replies[i] for i in sorted(replies)), np.uint8)
    leads = np.zeros(len(own.inverse), bool)
    leads[own.first] = answer >= LEADS
    return (answer & MOST)[own.inverse], leads
