"""Stupid-backoff scores of every text under the n-grams of all other texts.

A word scores by the longest of trigram, bigram and word that also stands in another text: the count of
the n-gram over that of its context, times ``ALPHA`` for every step back; counts are those of the whole
corpus less those of the text itself, which would otherwise know all of its own n-grams. A word that no
other text has scores ``ALPHA`` to the third over the number of words. Natural logarithms are summed per
text.

The count tables are cut by ranges of the n-gram hash. Blocks of texts explode their n-grams, ask each
range for the distinct ones, and get back the counts in the same order, so the n-grams of the corpus are
shuffled once per block and not once per occurrence, and the most frequent one is an entry per block.
Trigrams are only looked up where both of their bigrams are known from other texts, as they can't
have a count otherwise. A range has about as many n-grams at every size of the corpus.

Words are runs of characters other than white space, A-Z in lower case; an n-gram is known by 56 bits.

Defined cases: null and empty texts, and texts without words, have a score of 0 over 0 words; a very long
text is scored as a whole; there are no ties to break, as nothing is ranked; repeated rows are other texts to
each other; null ids are kept; an empty table gives an empty result. Only the
named columns are read.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebelt.llm import blocks
from orebelt.llm.text import U, chunks, constants, mix, words, tidy

ALPHA = 0.4
BLOCK_BYTES = 8 << 20
GRAMS_AT_ONCE = 1 << 17
RANGE_BYTES = 16 << 20  # text bytes per range of the count tables
KNOWN_BITS = ~U(255)  # the last byte of every key is 0, and takes no space in the shuffle
TOTAL = U(0)  # the key under which the number of all words is counted

_at = constants(3, 81)


class Grams(NamedTuple):
    """The words of a block, and the n-grams that end at each; 0 where the text has just begun."""

    one: np.ndarray
    two: np.ndarray
    three: np.ndarray
    text: np.ndarray
    place: np.ndarray  # of the word in its text
    count: np.ndarray  # words per text


def explode(column: pa.Array) -> Grams:
    """The n-grams of all texts, in their order."""
    hashes, counts = [], []
    for chunk in chunks(column):
        found = words(chunk)
        hashes.append(found.hash)
        counts.append(np.diff(found.bounds))
    h = np.concatenate(hashes) if hashes else np.zeros(0, U)
    count = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(h)) - np.repeat(np.cumsum(count) - count, count)
    one, two, three = mix(h * _at[0]), np.zeros(len(h), U), np.zeros(len(h), U)
    two[1:] = mix(h[1:] * _at[0] + mix(h[:-1] * _at[1]))
    three[2:] = mix(h[2:] * _at[0] + mix(h[1:-1] * _at[1]) + mix(h[:-2] * _at[2]))
    one, two, three = (x & KNOWN_BITS for x in (one, two, three))
    two[place < 1] = 0
    three[place < 2] = 0
    return Grams(one, two, three, text, place, count)


class Asked(NamedTuple):
    keys: np.ndarray  # sorted and distinct
    times: np.ndarray
    inverse: np.ndarray


def ask(keys: np.ndarray, words_: int | None = None) -> Asked:
    """Distinct keys; with ``words_`` also the total, as that many of them."""
    own, inverse, times = np.unique(keys, return_inverse=True, return_counts=True)
    if words_ is not None:
        own, times, inverse = np.r_[TOTAL, own], np.r_[words_, times], inverse + 1
    return Asked(own, times, inverse)


def _planes(values: np.ndarray) -> bytes:
    """First bytes of all numbers, then the second ones: small numbers then compress in the shuffle."""
    return values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()


def _numbers(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    cells = np.frombuffer(data, np.uint8).reshape(width, len(data) // width)
    return np.ascontiguousarray(cells.T).reshape(-1).view(kind)


def requests(asked: Asked, parts: int) -> list[tuple[int, bytes, bytes]]:
    """``(range, keys, times)`` for the ranges with keys; keys as steps from one to the next."""
    cuts = blocks.range_cuts(asked.keys, parts)
    return [
        (i, _planes(np.diff(asked.keys[a:b], prepend=U(0))), _planes(asked.times[a:b].astype(np.uint32)))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
        if a < b
    ]


def answers(keys: list[bytes], times: list[bytes]) -> list[bytes]:
    """Per request how much more often all requests of one range have its keys.

    A bit per key tells whether others have it, and only then there is a number.
    """
    own = [np.cumsum(_numbers(k, U), dtype=U) for k in keys]
    sizes = np.cumsum([len(k) for k in own])
    _, inverse = np.unique(np.concatenate(own), return_inverse=True)
    mine = np.concatenate([_numbers(t, np.uint32) for t in times]).astype(np.int64)
    # Counts above 2 ** 53 would not be exact.
    more = np.bincount(inverse, mine)[inverse].astype(np.int64) - mine
    parts = [more[b - len(k) : b] for k, b in zip(own, sizes)]
    return [np.packbits(p > 0).tobytes() + _planes(p[p > 0]) for p in parts]


def counts(asked: Asked, replies: dict[int, bytes], parts: int) -> np.ndarray:
    """Counts of the distinct keys over the corpus, from the replies by range."""
    total = asked.times.astype(np.int64)
    cuts = blocks.range_cuts(asked.keys, parts)
    for i, reply in replies.items():
        a, b = cuts[i], cuts[i + 1]
        bits = (b - a + 7) // 8
        has = np.unpackbits(np.frombuffer(reply, np.uint8, bits), count=b - a).astype(bool)
        total[a:b][has] += _numbers(reply[bits:], np.int64)
    return total


def _elsewhere(text: np.ndarray, inverse: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Counts of n-grams in other texts; ``text`` is in order, and some texts are taken at a time."""
    found, a = total[inverse], 0
    while a < len(text):
        b = int(np.searchsorted(text, text[min(a + GRAMS_AT_ONCE, len(text)) - 1], side="right"))
        pairs = (text[a:b] - text[a]) * len(total) + inverse[a:b]
        _, pair, own = np.unique(pairs, return_inverse=True, return_counts=True)
        found[a:b] -= own[pair]
        a = b
    return found


class Known(NamedTuple):
    """Counts in other texts of the n-grams that end at each word, as far as they have been asked for."""

    one: np.ndarray
    two: np.ndarray
    words: int
    wanted: np.ndarray  # words whose trigram may be known


def first_asked(g: Grams) -> Asked:
    return ask(np.r_[g.one, g.two[g.place >= 1]], len(g.one))


def known(g: Grams, replies: dict[int, bytes], parts: int) -> Known:
    asked = first_asked(g)
    total = counts(asked, replies, parts)
    later, n = g.place >= 1, len(g.one)
    one, two = _elsewhere(g.text, asked.inverse[:n], total), np.zeros(n, np.int64)
    two[later] = _elsewhere(g.text[later], asked.inverse[n:], total)
    before = np.r_[0, two[:-1]] if len(two) else two
    return Known(one, two, int(total[0]), np.flatnonzero((g.place >= 2) & (two > 0) & (before > 0)))


def scores(g: Grams, k: Known, three: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Log score per text, and how many of its words have a score by each order, from 0 (unseen) to 3."""
    before_one, before_two = np.r_[0, k.one[:-1]], np.r_[0, k.two[:-1]]
    others = k.words - g.count[g.text]
    has_three = three > 0
    has_two = ~has_three & (k.two > 0)
    has_one = ~has_three & ~has_two & (k.one > 0)
    order = np.select([has_three, has_two, has_one], [3, 2, 1], 0)
    # The steps back are counted from the longest n-gram that the word ends.
    longest = np.minimum(g.place + 1, 3)
    over = np.select([has_three, has_two, has_one], [three, k.two, k.one], 1)
    under = np.select([has_three, has_two], [before_two, before_one], np.maximum(others, 1))
    value = np.log(over / under) + (longest - order) * math.log(alpha)
    total = np.bincount(g.text, value, len(g.count))
    return total, np.bincount(g.text * 4 + order, minlength=4 * len(g.count)).reshape(-1, 4)


MESSAGE = "range bigint, block bigint, kind int, key binary, payload binary"
NAMES = [part.split()[0] for part in MESSAGE.split(", ")]
KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]


def _messages(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(NAMES)
    return pa.table([pa.array(c, k) for c, k in zip(columns, KINDS)], names=NAMES)


def _replies(table: pa.Table, kind: int) -> dict[int, bytes]:
    rows = table.select(["range", "kind", "payload"]).to_pylist()
    return {r["range"]: r["payload"] for r in rows if r["kind"] == kind}


def score_texts(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", alpha: float = ALPHA
) -> DataFrame:
    """``(id, n_words, log_score, mean_log_score, n_trigram, n_bigram, n_unigram, n_unseen)`` per row."""
    docs = docs.select(F.col(id).cast("bigint").alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    size = blocks.total_bytes(docs, "text")
    parts = max(1, math.ceil(size / RANGE_BYTES))
    dealt = blocks.in_blocks(docs, size, BLOCK_BYTES)

    @tidy
    def ask_first(key: tuple, group: pa.Table) -> pa.Table:
        g = explode(blocks.in_order(group)["text"])
        return _messages([(i, key[0].as_py(), 0, k, t) for i, k, t in requests(first_asked(g), parts)])

    def count(kind: int):
        @tidy
        def run(key: tuple, group: pa.Table) -> pa.Table:
            own = answers(group["key"].to_pylist(), group["payload"].to_pylist())
            part = key[0].as_py()
            return _messages([(part, b, kind, None, p) for b, p in zip(group["block"].to_pylist(), own)])

        return run

    @tidy
    def ask_trigrams(key: tuple, group: pa.Table, replies: pa.Table) -> pa.Table:
        g = explode(blocks.in_order(group)["text"])
        asked = ask(g.three[known(g, _replies(replies, 1), parts).wanted])
        return _messages([(i, key[0].as_py(), 0, k, t) for i, k, t in requests(asked, parts)])

    @tidy
    def score(key: tuple, group: pa.Table, replies: pa.Table) -> pa.Table:
        group = blocks.in_order(group)
        g = explode(group["text"])
        k = known(g, _replies(replies, 1), parts)
        asked = ask(g.three[k.wanted])
        three = np.zeros(len(g.one), np.int64)
        three[k.wanted] = _elsewhere(g.text[k.wanted], asked.inverse, counts(asked, _replies(replies, 2), parts))
        total, by_order = scores(g, k, three, alpha)
        return pa.table(
            [group["id"], pa.array(g.count, pa.int64()), pa.array(total, pa.float64())]
            + [pa.array(by_order[:, i], pa.int64()) for i in (3, 2, 1, 0)],
            names=["id", "n_words", "log_score", "n_trigram", "n_bigram", "n_unigram", "n_unseen"],
        )

    by_block = dealt.groupBy("block")
    first = by_block.applyInArrow(ask_first, MESSAGE).groupBy("range").applyInArrow(count(1), MESSAGE)
    trigrams = by_block.cogroup(first.groupBy("block")).applyInArrow(ask_trigrams, MESSAGE)
    second = trigrams.groupBy("range").applyInArrow(count(2), MESSAGE)
    scored = by_block.cogroup(first.unionByName(second).groupBy("block")).applyInArrow(
        score,
        "id bigint, n_words bigint, log_score double, n_trigram bigint, n_bigram bigint, n_unigram bigint, n_unseen bigint",
    )
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return scored.select(
        F.col("id").alias(id), "n_words", "log_score", mean.alias("mean_log_score"), "n_trigram", "n_bigram", "n_unigram", "n_unseen"
    )
