"""Phrase collocations by dynamic itemset counting over cyclic scans of shards.

1. Texts become blocks: the words of some megabytes of text in one language as numbers into a word
   list of their own, with a mark where a piece ends. Blocks are dealt to a few shards.
2. Each step scans one shard, round and round, and counts phrases of all lengths that are active.
   Words are active from the first step. A phrase is activated after the step in which both phrases
   that it is made of (without its last word, without its first) have reached the threshold, and
   counted from the next step on for one full cycle: every shard once, whichever it starts with. So
   long phrases are counted while shorter ones still are, and the scans end with the last cycle.
3. What a block holds meets the counts of the whole corpus by ranges of keys: a block sends its
   distinct words, or pairs, with their counts, one row per range; the range adds them to its own
   counts, and tells the block which of them were active when the step began. A phrase that half of
   the corpus has is one entry per block.
4. An active phrase has a number, its range and place in it. A pair is the numbers of two words, three
   words are the number of a pair and that of a word, so keys are exact, and short when sorted.
5. Scores, the drop rule and the best of each language are joins, minima and a rank on the phrases
   that reached the threshold. Products are decimals of 38 digits.

The least count, the number of shards and how many phrases are returned are parameters; nothing is
dropped before it has been counted in full. There may be 2 ** 30 words and 2 ** 34 pairs of the least count and
more per language; beyond that the job ends with an error.

Defined cases: a null text is an empty one, a null language is ``und``; empty texts, and pieces without
words, hold nothing; a very long text is one block; rows that repeat an id, or a text, count each time;
equal scores are ordered by count, then by the bytes of the phrase; an empty table gives an empty
result. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebelt.llm.text import LOWER, U, chunks, mix, runs, text_bytes, tidy
from orebelt.session import stage

LEAST = 10
TOP = 2000
SHARDS = 2
NO_LANGUAGE = "und"
BLOCK_BYTES = 16 << 20
RANGE_BYTES = 8 << 20
WORD_BITS, PAIR_BITS = 30, 34
RANKED_PARTS = 16

CUTS = np.zeros(256, bool)
CUTS[[*map(ord, ".,;:!?"), *range(10, 14)]] = True
BLANKS = np.zeros(256, bool)
BLANKS[[9, 32]] = True

BLOCK = "block bigint, shard int, lang string, words binary, tokens binary"
ASK = "lang string, part int, block bigint, keys binary, times binary, start binary"
REPLY = "block bigint, level int, part int, ids binary, since binary"
STATE = "level int, lang string, part int, active binary, rest binary, counts binary, start binary, since binary, latest int, total bigint"


def pack(values: np.ndarray) -> bytes:
    """An array of numbers, byte by byte of their positions, compressed."""
    raw = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    raw = pa.decompress(data[8:], n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).reshape(-1)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=U(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, U), dtype=U)


def pack_words(words: list[bytes]) -> bytes:
    """No word holds a line feed."""
    raw = b"\n".join(words)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_words(data: bytes) -> list[bytes]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return raw.split(b"\n") if raw else []


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [pa.field(*(f.split()[0], kinds[f.split()[1]])) for f in schema.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=pa.schema(fields))


class _Block:
    """Words of one language as they come, until they are a block."""

    def __init__(self):
        self.words: list[pa.Array] = []
        self.joined: list[np.ndarray] = []
        self.size = 0

    def add(self, texts: pa.Array) -> None:
        for chunk in chunks(texts):
            data = LOWER[chunk.data]
            cut = CUTS[data]
            inside = ~(cut | BLANKS[data])
            start, end = runs(chunk, inside)
            ends = np.r_[0, np.cumsum(end - start)].astype(np.int32)
            buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[inside].tobytes())]
            self.words.append(pa.Array.from_buffers(pa.binary(), len(start), buffers))
            piece = np.cumsum(cut)[start] if len(start) else start
            text = np.searchsorted(chunk.starts, start, side="right")
            joined = np.zeros(len(start), bool)
            joined[1:] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
            self.joined.append(joined)
            self.size += len(data)

    def encoded(self) -> tuple[bytes, bytes]:
        """The word list, most frequent first, and the text as places in it from 1, 0 before each piece."""
        coded = pa.concat_arrays(self.words).dictionary_encode()
        ids = coded.indices.to_numpy()
        order = np.argsort(-np.bincount(ids, minlength=len(coded.dictionary)), kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(1, len(order) + 1)
        breaks = np.cumsum(~np.concatenate(self.joined))
        tokens = np.zeros(len(ids) + (breaks[-1] if len(ids) else 0), np.uint32)
        tokens[np.arange(len(ids)) + breaks] = place[ids]
        return pack_words(coded.dictionary.take(pa.array(order)).to_pylist()), pack(tokens)


def blocks_of(docs: DataFrame, *, block_bytes: int, shards: int) -> DataFrame:
    """The texts of ``docs(lang, text)`` in blocks, a task's rows in order."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, open_blocks = TaskContext.get().partitionId(), 0, {}

        def done(lang: str) -> pa.RecordBatch:
            nonlocal made
            words, tokens = open_blocks.pop(lang).encoded()
            row = ((task << 24) + made, (task + made) % shards, lang, words, tokens)
            made += 1
            return _table(BLOCK, [row]).to_batches()[0]

        for batch in batches:
            for lang in pc.unique(batch["lang"]).to_pylist():
                texts = batch["text"].filter(pc.equal(batch["lang"], lang))
                step = max(1, math.ceil(len(texts) * block_bytes / max(1, text_bytes(texts)[1][-1])))
                for i in range(0, len(texts), step):
                    own = open_blocks.setdefault(lang, _Block())
                    own.add(texts.slice(i, step))
                    if own.size >= block_bytes:
                        yield done(lang)
            while sum(b.size for b in open_blocks.values()) > 2 * block_bytes:
                yield done(max(open_blocks, key=lambda lang: open_blocks[lang].size))
        for lang in list(open_blocks):
            yield done(lang)

    return docs.mapInArrow(run, BLOCK)


class Counting:
    """What the tasks of a step do; ``step`` is its number, ``parts`` the number of key ranges."""

    def __init__(self, step: int, parts: int, *, shards: int, least: int):
        self.step, self.parts, self.shards, self.least = step, parts, shards, least

    def counted(self, start: np.ndarray) -> np.ndarray:
        """Whether a phrase that was activated after the step ``start`` is counted in this one."""
        return start.astype(np.int64) + self.shards >= self.step

    def _by_part(self, part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        for at in np.split(order, cuts) if len(order) else []:
            yield int(part[at[0]]), at

    def word_parts(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(crc32, words), U, len(words)) % U(self.parts)

    def ask_words(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = unpack_words(row["words"])
                times = np.zeros(0, np.uint32)
                if self.step < self.shards:
                    times = np.bincount(unpack(row["tokens"], np.uint32), minlength=len(words) + 1)[1:].astype(np.uint32)
                found = [
                    (row["lang"], part, row["block"], pack_words([words[i] for i in at]), pack(times[at] if len(times) else times), None)
                    for part, at in self._by_part(self.word_parts(words))
                ]
                yield from _table(ASK, found).to_batches()

    def merge_words(self, key: tuple, asks: pa.Table, state: pa.Table) -> pa.Table:
        """The words of a range with their counts, active ones first, in the order of their activation."""
        asks = asks.sort_by("block")
        words, counts, since = [], [], np.zeros(0, np.uint8)
        for old in state.to_pylist():
            words += unpack_words(old["active"]) + unpack_words(old["rest"])
            counts.append(unpack(old["counts"], np.int64))
            since = unpack(old["since"], np.uint8)
        for keys, times in zip(asks["keys"].to_pylist(), asks["times"].to_pylist()):
            words += unpack_words(keys)
            counts.append(unpack(times, np.uint32).astype(np.int64))
        coded = pa.array(words, pa.binary()).dictionary_encode()
        sums = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(sums, coded.indices.to_numpy(), np.concatenate(counts))
        old = np.arange(len(since))
        new = np.flatnonzero(sums >= self.least)
        new = new[new >= len(old)]
        rest = np.flatnonzero(sums < self.least)
        own = coded.dictionary.to_pylist()
        since = np.r_[since, np.full(len(new), self.step, np.uint8)].astype(np.uint8)
        order = np.r_[old, new, rest].astype(np.int64)
        return _table(STATE, [(
            1, key[0].as_py(), key[1].as_py(), pack_words([own[i] for i in order[: len(since)]]), pack_words([own[i] for i in rest]),
            pack(sums[order]), None, pack(since), int(since.max()) if len(since) else -1, int(sums.sum()),
        )])

    def _numbers(self, place: np.ndarray, part: int, bits: int) -> np.ndarray:
        ids = place.astype(U) * U(self.parts) + U(part + 1)
        if len(ids) and int(ids.max()) >> bits:
            raise OverflowError(f"more than 2 ** {bits} phrases of the least count in one language")
        return ids

    def answer_words(self, key: tuple, asks: pa.Table, state: pa.Table) -> pa.Table:
        """Per block the numbers of the words asked for, 0 where they are not active, and since when they are."""
        part, rows = key[1].as_py(), asks.select(["block", "keys"]).to_pylist()
        asked = [unpack_words(r["keys"]) for r in rows]
        active = [w for old in state["active"].to_pylist() for w in unpack_words(old)]
        steps = [unpack(old, np.uint8) for old in state["since"].to_pylist()]
        place = pc.index_in(pa.array([w for own in asked for w in own], pa.binary()), value_set=pa.array(active, pa.binary()))
        place = pc.fill_null(place, -1).to_numpy()
        ids, since = np.zeros(len(place), U), np.zeros(len(place), np.uint8)
        ids[place >= 0] = self._numbers(place[place >= 0], part, WORD_BITS)
        if steps:
            since[place >= 0] = steps[0][place[place >= 0]]
        ends = np.cumsum([len(own) for own in asked])
        return _table(REPLY, [
            (r["block"], 1, part, pack(ids[e - len(own) : e]), pack(since[e - len(own) : e]))
            for r, own, e in zip(rows, asked, ends)
        ])

    def _placed(self, replies: list[dict], level: int, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The answers of all ranges, in the order of what was asked."""
        ids, since = np.zeros(len(part), U), np.zeros(len(part), np.uint8)
        got = {r["part"]: r for r in replies if r["level"] == level}
        for p, at in self._by_part(part):
            ids[at], since[at] = unpack(got[p]["ids"], U), unpack(got[p]["since"], np.uint8)
        return ids, since

    def _pairs(self, row: dict, replies: list[dict]) -> tuple[np.ndarray, ...]:
        """Number of each word of a block, and where pairs of active words are, with their key and start."""
        words = unpack_words(row["words"])
        ids, since = self._placed(replies, 1, self.word_parts(words))
        tokens = unpack(row["tokens"], np.uint32)
        number, when = np.r_[U(0), ids][tokens], np.r_[np.uint8(0), since][tokens]
        at = np.flatnonzero((number[:-1] > 0) & (number[1:] > 0))
        return number, at, number[at] << U(WORD_BITS) | number[at + 1], np.maximum(when[at], when[at + 1])

    def _ask(self, row: dict, keys: np.ndarray, times: np.ndarray, start: np.ndarray) -> list[tuple]:
        return [
            (row["lang"], part, row["block"], pack_sorted(keys[at]), pack(times[at].astype(np.uint32)), pack(start[at]))
            for part, at in self._by_part(mix(keys) % U(self.parts))
        ]

    def ask_pairs(self, replied: bool, key: tuple, own: pa.Table, replies: pa.Table) -> pa.Table:
        """The distinct pairs of a block, with their count where they are counted in this step."""
        row = own.to_pylist()[0]
        _, _, pairs, start = self._pairs(row, replies.to_pylist())
        keys, first, times = np.unique(pairs, return_index=True, return_counts=True)
        start = start[first]
        times[~self.counted(start)] = 0
        keep = times >= (0 if replied else 1)
        return _table(ASK, self._ask(row, keys[keep], times[keep], start[keep]))

    def ask_triples(self, key: tuple, own: pa.Table, replies: pa.Table) -> pa.Table:
        """The distinct phrases of three words of a block that are counted in this step."""
        row, replies = own.to_pylist()[0], replies.to_pylist()
        number, at, pairs, _ = self._pairs(row, replies)
        keys, inverse = np.unique(pairs, return_inverse=True)
        ids, since = (x[inverse] for x in self._placed(replies, 2, mix(keys) % U(self.parts)))
        both = np.flatnonzero((np.diff(at) == 1) & (ids[:-1] > 0) & (ids[1:] > 0))
        start = np.maximum(since[both], since[both + 1])
        both, start = both[self.counted(start)], start[self.counted(start)]
        triples = ids[both] << U(WORD_BITS) | number[at[both] + 2]
        keys, first, times = np.unique(triples, return_index=True, return_counts=True)
        return _table(ASK, self._ask(row, keys, times, start[first]))

    def merge_phrases(self, level: int, key: tuple, asks: pa.Table, state: pa.Table) -> pa.Table:
        """The phrases of a range with their counts, active ones first, in the order of their activation.

        Others are kept until their cycle is full.
        """
        keys, counts, start, since = [], [], [], np.zeros(0, np.uint8)
        for old in state.to_pylist():
            keys += [unpack(old["active"], U), unpack_sorted(old["rest"])]
            counts.append(unpack(old["counts"], np.int64))
            start.append(unpack(old["start"], np.uint8))
            since = unpack(old["since"], np.uint8)
        for row in asks.select(["keys", "times", "start"]).to_pylist():
            own, times = unpack_sorted(row["keys"]), unpack(row["times"], np.uint32)
            keys.append(own[times > 0])
            counts.append(times[times > 0].astype(np.int64))
            start.append(unpack(row["start"], np.uint8)[times > 0])
        own, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        sums = np.zeros(len(own), np.int64)
        np.add.at(sums, inverse, np.concatenate(counts))
        start = np.concatenate(start)[first]
        old = inverse[: len(since)]
        fresh = np.ones(len(own), bool)
        fresh[old] = False
        new = np.flatnonzero(fresh & (sums >= self.least))
        rest = np.flatnonzero(fresh & (sums < self.least) & (start.astype(np.int64) + self.shards > self.step))
        since = np.r_[since, np.full(len(new), self.step, np.uint8)].astype(np.uint8)
        order = np.r_[old, new, rest].astype(np.int64)
        return _table(STATE, [(
            level, key[0].as_py(), key[1].as_py(), pack(own[order[: len(since)]]), pack_sorted(own[rest]), pack(sums[order]),
            pack(start[order]), pack(since), int(since.max()) if len(since) else -1, 0,
        )])

    def answer_pairs(self, key: tuple, asks: pa.Table, state: pa.Table) -> pa.Table:
        part, rows, found = key[1].as_py(), asks.select(["block", "keys"]).to_pylist(), []
        active = np.concatenate([unpack(old, U) for old in state["active"].to_pylist()] or [np.zeros(0, U)])
        steps = np.concatenate([unpack(old, np.uint8) for old in state["since"].to_pylist()] or [np.zeros(0, np.uint8)])
        order = np.argsort(active)
        ordered = active[order]
        for row in rows:
            own = unpack_sorted(row["keys"])
            ids, since = np.zeros(len(own), U), np.zeros(len(own), np.uint8)
            place = np.searchsorted(ordered, own)
            hit = np.flatnonzero(place < len(ordered))
            hit = hit[ordered[place[hit]] == own[hit]]
            ids[hit], since[hit] = self._numbers(order[place[hit]], part, PAIR_BITS), steps[order[place[hit]]]
            found.append((row["block"], 2, part, pack(ids), pack(since)))
        return _table(REPLY, found)


def _meet(asks: DataFrame, state: DataFrame, run, schema: str) -> DataFrame:
    """``run`` for every range that the blocks of the step ask, or that has counts already."""

    @tidy
    def of_range(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return run(key, left, right)

    return asks.groupBy("lang", "part").cogroup(state.groupBy("lang", "part")).applyInArrow(of_range, schema)


def _at_blocks(own: DataFrame, replies: DataFrame, run) -> DataFrame:
    @tidy
    def of_block(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return run(key, left, right)

    return own.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(of_block, ASK)


def count_phrases(
    docs: DataFrame, *, least: int, shards: int, block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES
) -> tuple[dict[int, DataFrame], int]:
    """The counts of each length, as rows of ``STATE`` per range, and the number of ranges."""
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    parts = max(1, math.ceil(size / range_bytes))
    blocks = stage(blocks_of(docs, block_bytes=block_bytes, shards=shards), "text-blocks")
    nothing = blocks.sparkSession.createDataFrame([], STATE)
    state, latest, step = {1: nothing, 2: nothing, 3: nothing}, {1: -1, 2: -1, 3: -1}, 0
    # Words are counted in the first cycle, longer phrases for a cycle from the last activation on.
    while step < shards or any(latest[level] >= 0 and latest[level] + shards >= step for level in (1, 2)):
        now = Counting(step, parts, shards=shards, least=least)
        own = blocks.filter(F.col("shard") == step % shards)
        asks = own.mapInArrow(tidy(now.ask_words), ASK)
        made = []
        if step < shards:
            made.append(_meet(asks, state[1], now.merge_words, STATE))
        if latest[1] >= 0:
            words = _meet(asks, state[1], now.answer_words, REPLY)
            replied = latest[2] >= 0
            pairs = _at_blocks(own, words, partial(now.ask_pairs, replied))
            if latest[1] + shards >= step:
                made.append(_meet(pairs, state[2], partial(now.merge_phrases, 2), STATE))
            if replied:
                both = words.unionByName(_meet(pairs, state[2], now.answer_pairs, REPLY))
                triples = _at_blocks(own, both, now.ask_triples)
                made.append(_meet(triples, state[3], partial(now.merge_phrases, 3), STATE))
        whole = made[0]
        for more in made[1:]:
            whole = whole.unionByName(more)
        whole = stage(whole, "phrase-counts")
        for level, last in whole.groupBy("level").agg(F.max("latest")).collect():
            latest[level], state[level] = last, whole.filter(F.col("level") == level)
        step += 1
    return state, parts


def _active_words(state: DataFrame, parts: int) -> DataFrame:
    """``(lang, id, word, f)``."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = unpack_words(row["active"])
                n = len(words)
                ids = np.arange(n, dtype=np.int64) * parts + row["part"] + 1
                counts = unpack(row["counts"], np.int64)[:n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * n, pa.string()), pa.array(ids), pa.array(words, pa.binary()), pa.array(counts)],
                    names=["lang", "id", "word", "f"],
                )

    found = state.mapInArrow(run, "lang string, id bigint, word binary, f bigint")
    return found.withColumn("word", F.col("word").cast("string"))


def _active_phrases(state: DataFrame, parts: int) -> DataFrame:
    """``(lang, id, left, right, a)``: the number of the phrase without its last word, and that of the word."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = unpack(row["active"], U)
                n = len(keys)
                ids = np.arange(n, dtype=np.int64) * parts + row["part"] + 1
                left, right = (keys >> U(WORD_BITS)).astype(np.int64), (keys & U((1 << WORD_BITS) - 1)).astype(np.int64)
                counts = unpack(row["counts"], np.int64)[:n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * n, pa.string()), *map(pa.array, (ids, left, right, counts))],
                    names=["lang", "id", "left", "right", "a"],
                )

    return state.mapInArrow(run, "lang string, id bigint, left bigint, right bigint, a bigint")


def _score(a: str, left: str, right: str) -> Column:
    exact = lambda c: f"cast({c} AS decimal(19,0))"
    return F.expr(f"cast(1000000 * ({exact(a)} * {exact(a)}) div ({exact(left)} * {exact(right)}) AS bigint)")


def collocations(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    shards: int = SHARDS,
    block_bytes: int = BLOCK_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of two or three words per language.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its weakest cut, ``n`` all words of the
    language; the score is ``floor(1000000 a a / (l r))``. A phrase goes if a longer one that has it makes up
    half of its count.
    """
    docs = docs.select(
        F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    state, parts = count_phrases(docs, least=least, shards=shards, block_bytes=block_bytes, range_bytes=range_bytes)
    totals = state[1].groupBy("lang").agg(F.sum("total").alias("n"))
    words = _active_words(state[1], parts)
    named = lambda side, to: words.select("lang", F.col("id").alias(side), F.col("word").alias(to), F.col("f").alias(f"f_{to}"))
    pairs = _active_phrases(state[2], parts).join(named("left", "x"), ["lang", "left"]).join(named("right", "y"), ["lang", "right"])
    pairs = stage(pairs, "pairs")
    first = pairs.select("lang", F.col("id").alias("left"), "x", "y", "f_x", F.col("a").alias("f_xy"), F.col("right").alias("middle"))
    second = pairs.select(
        "lang", F.col("id").alias("after"), F.col("left").alias("middle"), F.col("right"), F.col("y").alias("z"),
        F.col("f_y").alias("f_z"), F.col("a").alias("f_yz"),
    )
    triples = _active_phrases(state[3], parts).select("lang", "left", "right", "a")
    triples = stage(triples.join(first, ["lang", "left"]).join(second, ["lang", "middle", "right"]), "triples")

    inside = triples.select("lang", F.col("left").alias("id"), "a").union(triples.select("lang", F.col("after").alias("id"), "a"))
    longest = inside.groupBy("lang", "id").agg(F.max("a").alias("longer"))
    kept = pairs.join(longest, ["lang", "id"], "left").filter("longer IS NULL OR longer < a - longer")
    two = kept.select(
        "lang", F.concat_ws(" ", "x", "y").alias("phrase"), "a", F.col("f_x").alias("l"), F.col("f_y").alias("r"),
        _score("a", "f_x", "f_y").alias("score"),
    )
    cuts = F.struct(_score("a", "f_x", "f_yz").alias("score"), F.col("f_x").alias("l"), F.col("f_yz").alias("r"))
    later = F.struct(_score("a", "f_xy", "f_z").alias("score"), F.col("f_xy").alias("l"), F.col("f_z").alias("r"))
    cut = F.when(later["score"] < cuts["score"], later).otherwise(cuts)
    three = triples.select("lang", F.concat_ws(" ", "x", "y", "z").alias("phrase"), "a", cut.alias("cut"))
    three = three.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    best = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    # What the first of so many parts of a language leaves is bounded, however many tasks there were.
    both = two.unionByName(three).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS)))
    some = both.withColumn("rank", best("lang", "part")).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", best("lang")).filter(F.col("rank") <= top)
    ranked = ranked.join(totals, "lang").withColumn("rank", F.col("rank").cast("bigint"))
    return ranked.select(F.col("lang").alias(lang), "rank", "phrase", "a", "l", "r", "n", "score")
