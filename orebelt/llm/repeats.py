"""Removal of byte strings that occur more than once, by prefix-free parsing.

A rolling hash over 16 bytes sets triggers, about one in 40 positions, which cut every text into
phrases in the same way wherever the same bytes stand. Each string of ``length`` bytes (a window)
belongs to the first trigger in it, so that a window is a suffix of the phrase before the trigger
and a prefix of the parse that starts there, and equal windows have equal halves.

1. Parse: all windows that begin in one phrase, as one string with its hash. Where that string
   occurs again, all of them do. Counted over the corpus, as are the first bytes of each parse.
2. What is left are windows at the edges of repeats. They meet by the first bytes of their parse,
   with one place for each string that has been found twice there; then the suffix array of the
   phrases (by their reversed bytes) and that of the parses give for each suffix length the runs
   of equal halves, and both together the classes of equal windows. No hash decides here.
3. Parses that 127 places or more share are not brought together: their windows are counted one by
   one, as are those without a trigger near their start.

Passages of so many ``words`` are looked for along with these, if wanted, whatever bytes they take
and whatever white space is between the words. About one in six places of half that length is
counted; a passage in which each of them occurs again is then counted itself.

Blocks of texts ask for counts (see ``blocks``), hence the texts are shuffled once, and no group
grows with the number of copies. Keys have 96 bits.

Defined cases: a null text is empty; a text below ``length`` bytes, or of fewer words than a passage, loses
nothing; a very long text is parsed as a whole; repeated rows are copies of each other, and of equal strings
(ties) all go; null ids are kept; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orebelt.llm import blocks
from orebelt.llm.blocks import Keys
from orebelt.llm.text import Chunk, Rolling, U, chunks, constants, expand, mix, tidy
from orebelt.llm.text import words as words_of

LENGTH = 400
TRIGGER_BYTES = 16
PHRASE_BYTES = 40
RANGE_BYTES = 8 << 20  # text bytes per key range
COUNTS = ["n_bytes", "n_removed", "n_spans", "n_passage_bytes", "n_passages"]
ANCHOR_WORDS = 6  # one in so many places of a text is an anchor

_one, _two = Rolling(31), Rolling(33)
_salt = constants(8, 35)


class Parse(NamedTuple):
    """The triggers of a chunk that have windows, and the windows that have no trigger."""

    trigger: np.ndarray
    first: np.ndarray  # first and last window start that belongs to the trigger
    last: np.ndarray
    lone: np.ndarray  # starts of windows without a trigger near their start
    whole: Keys  # all windows of a trigger as one string
    near: Keys  # the parse as far as every window reaches that starts up to `short` before
    far: Keys  # the same for windows that start further before; for `has_far` only
    has_far: np.ndarray
    lone_keys: Keys
    sums: tuple[np.ndarray, np.ndarray]


def reaches(length: int) -> tuple[int, int]:
    """How far before its trigger a window may start to be near, and to have a trigger at all."""
    return length // 5, length * 16 // 25


def _keys(sums, start: np.ndarray, end: np.ndarray, salt: int, extra: np.ndarray | int = 0) -> Keys:
    one = mix(_one.ranges(sums[0], start, end) * _salt[salt] + extra)
    two = mix(_two.ranges(sums[1], start, end) * _salt[salt] + extra)
    return Keys(one, (two >> U(32)).astype(np.uint32))


def window_keys(sums, start: np.ndarray, length: int) -> Keys:
    return _keys(sums, start, start + length, 0)


def parse(chunk: Chunk, length: int) -> Parse:
    short, reach = reaches(length)
    data, starts, n = chunk.data, chunk.starts, len(chunk.data)
    sums = _one.sums(data), _two.sums(data)
    at = np.arange(max(0, n - TRIGGER_BYTES + 1))
    rolled = mix(_one.ranges(sums[0], at, at + TRIGGER_BYTES))
    trigger = np.flatnonzero(rolled < U((1 << 64) // PHRASE_BYTES))
    text = np.searchsorted(starts, trigger, side="right") - 1
    inside = trigger + TRIGGER_BYTES <= starts[text + 1]
    trigger, text = trigger[inside], text[inside]

    before = np.r_[-1, trigger[:-1]] + 1
    first = np.maximum(np.maximum(before, starts[text]), trigger - reach)
    last = np.minimum(trigger, starts[text + 1] - length)
    some = first <= last
    trigger, first, last = trigger[some], first[some], last[some]

    covered = np.zeros(n + 1, np.int32)
    covered[first] += 1
    covered[last + 1] -= 1
    alone = np.cumsum(covered[:n]) == 0
    valid = np.zeros(n + 1, np.int32)
    has = np.diff(starts) >= length
    np.add.at(valid, starts[:-1][has], 1)
    np.add.at(valid, starts[1:][has] - length + 1, -1)
    lone = np.flatnonzero(alone & (np.cumsum(valid[:n]) > 0))

    place = (trigger - first).astype(U) * _salt[4] + (last - first).astype(U) * _salt[5]
    is_near = last >= trigger - short
    has_far = first < trigger - short
    reach_near = np.where(is_near, trigger + length - short, trigger)
    return Parse(
        trigger,
        first,
        last,
        lone,
        _keys(sums, first, last + length, 1, place),
        _keys(sums, trigger, reach_near, 2),
        _keys(sums, trigger[has_far], trigger[has_far] + length - reach, 3),
        has_far,
        window_keys(sums, lone, length),
        sums,
    )


class Passages(NamedTuple):
    """The words of a chunk, and the anchors that tell which passages may occur again."""

    size: int
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # words that a passage starts with
    anchor: np.ndarray
    keys: Keys  # of the anchors
    sums: tuple[np.ndarray, np.ndarray]

    @property
    def half(self) -> int:
        return (self.size + 1) // 2

    def passage_keys(self, first: np.ndarray) -> Keys:
        return _keys(self.sums, first, first + self.size, 6)

    def wanted(self, count: np.ndarray) -> np.ndarray:
        """Passages without an anchor that stands nowhere else; ``count`` is that of the anchors."""
        alone = np.zeros(len(self.start) + 1, np.int64)
        alone[self.anchor[count < 2] + 1] = 1
        alone = np.cumsum(alone)
        return self.first[alone[self.first + self.size - self.half + 1] == alone[self.first]]


def passages(chunk: Chunk, sums, size: int) -> Passages:
    found = words_of(chunk)
    n = len(found.start)
    over = []
    for rolling, own in zip((_one, _two), sums):
        total = np.zeros(n + 1, U)
        np.cumsum(mix(rolling.ranges(own, found.start, found.end)) * rolling.power[:n], out=total[1:])
        over.append(total)

    def places(length: int) -> np.ndarray:
        at = np.arange(max(0, n - length + 1))
        return at[found.text[at] == found.text[at + length - 1]]

    half = places((size + 1) // 2)
    keys = _keys(over, half, half + (size + 1) // 2, 7)
    some = keys.check < (1 << 32) // ANCHOR_WORDS  # not by the hash, which deals them to the ranges
    keys = Keys(keys.hash[some], keys.check[some])
    return Passages(size, found.start, found.end, places(size), half[some], keys, tuple(over))


class Edges(NamedTuple):
    """Windows of triggers that their whole strings don't settle, for these or for others."""

    trigger: np.ndarray
    first: np.ndarray
    last: np.ndarray
    keys: Keys
    count: np.ndarray


def _edges(p: Parse, whole, near, far, leads, length: int) -> Edges:
    """Triggers whose parse begins like that of another with other windows, equal ones once."""
    short, _ = reaches(length)
    once = (whole < 2) | leads
    edge = p.trigger - short
    a = once & ((near > whole) | (near == blocks.MOST)) & (p.last >= edge)
    far_at = np.flatnonzero(p.has_far)
    b = once[far_at] & ((far > whole[far_at]) | (far == blocks.MOST))
    at = far_at[b]
    return Edges(
        np.r_[p.trigger[a], p.trigger[at]],
        np.r_[np.maximum(p.first, edge)[a], p.first[at]],
        np.r_[p.last[a], np.minimum(p.last, edge - 1)[at]],
        Keys.join([Keys(p.near.hash[a], p.near.check[a]), Keys(p.far.hash[b], p.far.check[b])]),
        np.r_[near[a], far[b]],
    )


class Block(NamedTuple):
    """What a block knows of its texts once the first counts are there."""

    parsed: list[tuple[Chunk, Parse, Passages | None]]
    asked: blocks.Distinct


def _asked(p: Parse, q: Passages | None) -> list[Keys]:
    return [p.whole, p.near, p.far, p.lone_keys] + ([q.keys] if q else [])


def _read(group: pa.Table, length: int, words: int | None) -> Block:
    parsed = []
    for chunk in chunks(group["text"]):
        p = parse(chunk, length)
        parsed.append((chunk, p, passages(chunk, p.sums, words) if words else None))
    keys = Keys.join([k for _, p, q in parsed for k in _asked(p, q)])
    return Block(parsed, blocks.distinct(keys))


class Settled(NamedTuple):
    """What the first counts say of a chunk, and what is counted next."""

    chunk: Chunk
    parse: Parse
    counts: list[np.ndarray]
    edges: Edges
    hot: np.ndarray  # windows of hot edges
    passages: Passages | None
    wanted: np.ndarray  # passages that may occur again

    def next_keys(self, length: int) -> list[Keys]:
        own = [window_keys(self.parse.sums, self.hot, length)]
        return own + ([self.passages.passage_keys(self.wanted)] if self.passages else [])


def _settle(block: Block, replies: dict[int, bytes], length: int) -> Iterator[Settled]:
    (count, leads), at = blocks.counts(block.asked, replies), 0
    for chunk, p, q in block.parsed:
        parts, lead = [], leads[at : at + len(p.whole.hash)]
        for keys in _asked(p, q):
            parts.append(count[at : at + len(keys.hash)])
            at += len(keys.hash)
        e = _edges(p, *parts[:3], lead, length)
        far = e.count == blocks.MOST
        hot = expand(e.first[far], e.last[far] - e.first[far] + 1)
        yield Settled(chunk, p, parts, e, hot, q, q.wanted(parts[4]) if q else np.zeros(0, np.int64))


def equal_windows(
    key: np.ndarray, phrase: list[bytes], parse_: list[bytes], low: np.ndarray, length: int
) -> dict[int, np.ndarray]:
    """For each place, how far before its trigger the windows start that have an equal one.

    Place ``i`` has the windows that start ``low[i]`` to ``len(phrase[i])`` bytes before the trigger,
    and meets the places with the same ``key``.
    """
    n = len(phrase)
    high = np.array([len(x) for x in phrase])
    group = np.unique(key, return_inverse=True)[1]

    def order(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix order within the groups, and the bytes each shares with the one before it."""
        at = np.array(sorted(range(n), key=lambda i: (group[i], texts[i])))
        size = np.array([len(texts[i]) for i in at])
        cells = np.frombuffer(b"".join(texts[i].ljust(width, b"\0") for i in at), np.uint8).reshape(n, width)
        differ = np.ones((n, width + 1), bool)
        differ[1:, :width] = cells[1:] != cells[:-1]
        differ[0] = True
        shared = differ.argmax(axis=1)
        shared[1:] = np.minimum(shared[1:], np.minimum(size[1:], size[:-1]))
        shared[1:][group[at][1:] != group[at][:-1]] = -1
        shared[0] = -1
        return at, shared

    width = max(1, int(high.max()))
    by_phrase, phrase_shared = order([x[::-1] for x in phrase], width)
    by_parse, parse_shared = order(parse_, length)
    left, right = np.empty(n, np.int64), np.empty(n, np.int64)
    found: dict[int, list[int]] = {}
    for d in range(int(low.min()), int(high.max()) + 1):
        own = np.flatnonzero((low <= d) & (d <= high))
        if len(own) < 2:
            continue
        left[by_phrase] = np.cumsum(phrase_shared < d)
        right[by_parse] = np.cumsum(parse_shared < length - d)
        _, inverse, times = np.unique(left[own] * (n + 1) + right[own], return_inverse=True, return_counts=True)
        for i in own[times[inverse] > 1].tolist():
            found.setdefault(i, []).append(d)
    return {i: np.array(ds) for i, ds in found.items()}


# Rows between the blocks and the ranges: kind 0 keys or their counts, 1 an edge and its answer.
MESSAGE = "range bigint, block bigint, kind int, slot int, low int, key binary, phrase binary, payload binary"
NAMES = [part.split()[0] for part in MESSAGE.split(", ")]
KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _messages(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(NAMES)
    return pa.table([pa.array(c, k) for c, k in zip(columns, KINDS)], names=NAMES)


def _covered(mask: np.ndarray) -> tuple[int, int]:
    """How many bytes are marked, and in how many runs."""
    runs = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(len(mask) > 0 and mask[0])
    return int(np.count_nonzero(mask)), runs


def _replies(table: pa.Table, kind: int) -> dict[int, bytes]:
    found = table.select(["range", "kind", "payload"]).to_pylist()
    return {r["range"]: r["payload"] for r in found if r["kind"] == kind}


def remove_repeats(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    words: int | None = None,
    keep_passages: bool = False,
) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept, n_passage_bytes, n_passages)``: per row what is left of its text.

    Every byte goes that a string of ``length`` bytes covers which also starts anywhere else, in
    the same text or another, as the texts were given; none spans two texts. With ``words``, so do
    the passages of that many words that stand anywhere else, too; ``keep_passages`` leaves them in place.
    Their bytes, and the runs that they make up, are counted either way.
    """
    found = _cut(docs, id, text, length, words, [], keep_passages).withColumnRenamed("id", id)
    return found.select(id, *COUNTS[:3], "kept", *COUNTS[3:])


def _cut(
    docs: DataFrame,
    id: str,
    text: str,
    length: int,
    words: int | None,
    carry: Sequence[str],
    keep_passages: bool = False,
) -> DataFrame:
    """The same with the whole characters of what is left, and more columns as ``carried_0`` and so on."""
    if length < 5 * TRIGGER_BYTES:
        raise ValueError(f"length is at least {5 * TRIGGER_BYTES}")
    along = [f"carried_{i}" for i in range(len(carry))]
    docs = docs.select(
        F.col(id).cast("bigint").alias("id"),
        F.coalesce(text, F.lit("")).alias("text"),
        *[F.col(c).alias(a) for c, a in zip(carry, along)],
    )
    size = blocks.total_bytes(docs, "text")
    parts = max(1, math.ceil(size / RANGE_BYTES))
    dealt = blocks.in_blocks(docs, size)

    @tidy
    def ask(key: tuple, group: pa.Table) -> pa.Table:
        own = _read(blocks.in_order(group), length, words)
        return _messages(
            [(i, key[0].as_py(), 0, None, None, None, None, p) for i, p in blocks.requests(own.asked, parts)]
        )

    @tidy
    def count(key: tuple, group: pa.Table) -> pa.Table:
        return _count(key[0].as_py(), group, 2)

    def _count(part: int, group: pa.Table, kind: int) -> pa.Table:
        if not len(group):
            return _messages([])
        group = group.sort_by("block")  # so that the same key leads whenever this runs again
        own = blocks.answers(group["payload"].to_pylist())
        return _messages(
            [(part, b, kind, None, None, None, None, p) for b, p in zip(group["block"].to_pylist(), own)]
        )

    @tidy
    def ask_edges(key: tuple, group: pa.Table, replies: pa.Table) -> pa.Table:
        number, rows, hot, slot = key[0].as_py(), [], [], 0
        own = _read(blocks.in_order(group), length, words)
        for s in _settle(own, _replies(replies, 2), length):
            data, e = s.chunk.data.tobytes(), s.edges
            cold = e.count < blocks.MOST
            hot += s.next_keys(length)
            where = ((e.keys.hash >> U(32)) * U(parts) >> U(32)).astype(np.int64)
            for i in np.flatnonzero(cold).tolist():
                t, a, b = int(e.trigger[i]), int(e.first[i]), int(e.last[i])
                name = e.keys.hash[i].tobytes() + e.keys.check[i].tobytes()
                end = min(t + length, b + length)
                rows.append((int(where[i]), number, 1, slot + i, t - b, name, data[a:t], data[t:end]))
            slot += len(cold)
        asked = blocks.distinct(Keys.join(hot))
        rows += [(i, number, 0, None, None, None, None, p) for i, p in blocks.requests(asked, parts)]
        return _messages(rows)

    @tidy
    def match_edges(key: tuple, group: pa.Table) -> pa.Table:
        part = key[0].as_py()
        kind = group["kind"].to_numpy()
        counted = _count(part, group.filter(pa.array(kind == 0)), 3)
        edges = group.filter(pa.array(kind == 1))
        if not len(edges):
            return counted
        names = np.frombuffer(b"".join(edges["key"].to_pylist()), [("hash", U), ("check", np.uint32)])
        phrase, low = edges["phrase"].to_pylist(), edges["low"].to_numpy()
        found = equal_windows(names, phrase, edges["payload"].to_pylist(), low, length)
        number, slot = edges["block"].to_pylist(), edges["slot"].to_pylist()
        rows = [
            (part, number[i], 1, slot[i], None, None, None, ds.astype(np.uint16).tobytes())
            for i, ds in found.items()
        ]
        return pa.concat_tables([counted, _messages(rows)])

    @tidy
    def cut(key: tuple, group: pa.Table, replies: pa.Table) -> pa.Table:
        group = blocks.in_order(group)
        own = _read(group, length, words)
        matched = {
            r["slot"]: np.frombuffer(r["payload"], np.uint16).astype(np.int64)
            for r in replies.select(["kind", "slot", "payload"]).to_pylist()
            if r["kind"] == 1
        }
        settled = list(_settle(own, _replies(replies, 2), length))
        hot = Keys.join([k for s in settled for k in s.next_keys(length)])
        again, _ = blocks.counts(blocks.distinct(hot), _replies(replies, 3))
        slot = at = 0
        counts, kept = [], []
        for chunk, p, (whole, _, _, lone, *_), e, rest, q, wanted in settled:
            n = len(chunk.data)
            step, inside = np.zeros(n + 1, np.int32), np.zeros(n + 1, np.int32)
            twice = whole >= 2
            np.add.at(step, p.first[twice], 1)
            np.add.at(step, p.last[twice] + length, -1)
            singles = [p.lone[lone >= 2]]
            far = e.count == blocks.MOST
            singles.append(rest[again[at : at + len(rest)] >= 2])
            at += len(rest)
            if q:
                shared = wanted[again[at : at + len(wanted)] >= 2]
                at += len(wanted)
                np.add.at(inside, q.start[shared], 1)
                np.add.at(inside, q.end[shared + q.size - 1], -1)
            singles += [e.trigger[i] - matched[slot + i] for i in np.flatnonzero(~far).tolist() if slot + i in matched]
            slot += len(far)
            start = np.concatenate(singles).astype(np.int64)
            np.add.at(step, start, 1)
            np.add.at(step, start + length, -1)
            gone, shared = np.cumsum(step[:n]) > 0, np.cumsum(inside[:n]) > 0
            if not keep_passages:
                gone |= shared
            for a, b in zip(chunk.starts, chunk.starts[1:]):
                mask = gone[a:b]
                counts.append((int(b - a), *_covered(mask), *_covered(shared[a:b])))
                kept.append(chunk.data[a:b][~mask].tobytes() if counts[-1][1] else chunk.data[a:b].tobytes())
        return pa.table(
            [
                group["id"],
                *(group[a] for a in along),
                *(pa.array([c[i] for c in counts], pa.int64()) for i in range(len(COUNTS))),
                pa.array(kept, pa.binary()),
                pa.array([k.decode(errors="ignore") for k in kept], pa.string()),
            ],
            names=["id", *along, *COUNTS, "kept", "text"],
        )

    by_block = dealt.groupBy("block")
    counted = by_block.applyInArrow(ask, MESSAGE).groupBy("range").applyInArrow(count, MESSAGE)
    edges = by_block.cogroup(counted.groupBy("block")).applyInArrow(ask_edges, MESSAGE)
    matched = edges.groupBy("range").applyInArrow(match_edges, MESSAGE)
    replies = counted.unionByName(matched)
    schema = StructType([docs.schema["id"], *(docs.schema[a] for a in along)])
    for name in COUNTS:
        schema = schema.add(name, "long")
    return by_block.cogroup(replies.groupBy("block")).applyInArrow(
        cut, schema.add("kept", "binary").add("text", "string")
    )


def with_repeats_removed(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    size: str | None = "n_chars",
    length: int = LENGTH,
    words: int | None = None,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, without repeats in their texts.

    A character that has lost some of its bytes goes as a whole. ``size`` names the column with the
    number of characters, if there is one.
    """
    others = [c for c in docs.columns if c not in (id, text)]
    rest = _cut(docs, id, text, length, words, others)
    columns = {id: F.col("id"), text: F.col("text")} | {c: F.col(f"carried_{i}") for i, c in enumerate(others)}
    if size in columns:
        columns[size] = F.length("text")
    return rest.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in docs.schema])
