"""Benchmark passages in training texts: BM25 with block-max WAND, then question and answer overlap.

The test items are the indexed side, every passage of every text is a query. Passages are windows of
twice as many words as the longest item, a window every half, so each item lies whole in one. An item
scores against a passage by the BM25 weights of their common terms, and is retrieved at a share of
the score that it has against itself.

Because the bound is known beforehand, pivoting and skipping become set operations on all passages
of a chunk at a time. Postings lie in blocks of items with the largest weight of each term. Terms that
many items have are never looked up for a bound: with what they can add at most, a block is skipped
unless the largest weights of the other terms reach the least bound in it; a passage without such a
block is skipped as a whole. What is left is scored exactly, so all and only the items above their
bound are found.

A found item is confirmed if the passage has enough of the word 3-grams of its question, the first two
thirds of the item, and of its answer, the rest.

The items go to the tasks as numpy arrays. They are cut into slices of ``SLICE_BYTES`` of text and by
length, and every slice is searched for in turn, so no broadcast is larger, whatever the benchmark. What
BM25 knows of the items is counted over all of them first, so scores are the same however they are cut.

Defined cases: null or empty texts and items have no words and no hits; a very long text is searched window
by window; equal items are all found, and of passages that do equally well (ties) the first is told;
rows that repeat are each searched; null ids are kept; an empty table, or benchmark, finds nothing. Only the
named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebelt.llm.text import Chunk, Rolling, U, chunks, constants, expand, lower, mix, runs, tidy
from orebelt.session import stage

SLICE_BYTES = 8 << 20
SHORT_ITEM = 64  # words up to which items share a window size
BLOCK_ITEMS = 8
K1, B = 1.2, 0.75
FREQUENT = 1 / 16  # share of the items from which a term is frequent
RETRIEVED = 0.6
CONFIRMED = 0.6
GRAM = 3
ROWS_AT_ONCE = 512

INSIDE = np.zeros(256, bool)
INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_rolling = Rolling(61)
_gram = constants(GRAM, 63)


class Terms(NamedTuple):
    hash: np.ndarray
    bounds: np.ndarray  # the terms of text i are bounds[i]:bounds[i + 1]
    start: np.ndarray
    end: np.ndarray


def terms(chunk: Chunk) -> Terms:
    """Runs of letters and digits, without regard to case."""
    data = lower(chunk.data)
    start, end = runs(chunk, INSIDE[data])
    hashed = mix(_rolling.ranges(_rolling.sums(data), start, end))
    return Terms(hashed, np.searchsorted(start, chunk.starts), start, end)


def grams(hashes: np.ndarray) -> np.ndarray:
    """Distinct hashes of the word 3-grams; of the single words if there are fewer than three."""
    if len(hashes) < GRAM:
        return np.unique(hashes)
    n = len(hashes) - GRAM + 1
    return np.unique(mix(sum(hashes[i : n + i] * _gram[i] for i in range(GRAM))))


class Postings(NamedTuple):
    """For term ``t`` the rows ``first[t]:first[t + 1]``: items or blocks, and weights."""

    first: np.ndarray
    of: np.ndarray
    weight: np.ndarray

    def look_up(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = self.first[term + 1] - self.first[term]
        owner, at = np.repeat(np.arange(len(term)), size), expand(self.first[term], size)
        return owner, self.of[at], self.weight[at]


class Statistics(NamedTuple):
    """What BM25 has to know of all items, for the terms of some of them."""

    items: int
    mean: float  # words of an item
    stride: int  # words of the longest item of like lengths
    terms: np.ndarray  # in order
    df: np.ndarray

    def of(self, terms: np.ndarray) -> np.ndarray:
        return self.df[np.searchsorted(self.terms, terms)]


class Index:
    """Inverted index of a slice of items; without ``corpus`` the slice is all there is."""

    def __init__(self, ids: list, texts: list[str], retrieved: float, corpus: Statistics | None = None):
        column = pa.array(texts, pa.string())
        words = [np.zeros(0, U)] * len(texts)
        for chunk in chunks(column):
            found = terms(chunk)
            for i, (a, b) in enumerate(zip(found.bounds, found.bounds[1:])):
                words[chunk.first + i] = found.hash[a:b]
        self.ids, self.words = ids, words
        self.stride = corpus.stride if corpus else max(len(w) for w in words)
        size = np.array([len(w) for w in words], float)
        per = [np.unique(w, return_counts=True) for w in words]
        item = np.repeat(np.arange(len(words)), [len(h) for h, _ in per])
        self.terms, term, df = np.unique(np.concatenate([h for h, _ in per]), return_inverse=True, return_counts=True)
        tf = np.concatenate([c for _, c in per])
        count, mean = (corpus.items, corpus.mean) if corpus else (len(words), size.mean())
        df = corpus.of(self.terms) if corpus else df
        idf = np.log1p((count - df + 0.5) / (df + 0.5))
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[item] / mean))
        own = np.bincount(item, weight, len(words))
        self.bound = own * retrieved
        # Items with like bounds share a block, so that the least of them skips much.
        rank = np.empty(len(words), np.int64)
        rank[np.argsort(self.bound, kind="stable")] = np.arange(len(words))
        self.block = rank // BLOCK_ITEMS
        self.blocks = int(self.block.max()) + 1
        self.frequent = df > max(1, FREQUENT * count)
        self.postings = self._postings(term, item, weight, len(self.terms))
        rare = ~self.frequent[term]
        best, slot = np.unique(term[rare] * self.blocks + self.block[item[rare]], return_inverse=True)
        most = np.zeros(len(best))
        np.maximum.at(most, slot, weight[rare])
        self.block_most = self._postings(best // self.blocks, best % self.blocks, most, len(self.terms))
        self.term_most = np.zeros(len(self.terms))
        np.maximum.at(self.term_most, term, weight)
        common = np.bincount(item[~rare], weight[~rare], len(words))
        self.block_common = np.zeros(self.blocks)
        np.maximum.at(self.block_common, self.block, common)
        self.block_bound = np.full(self.blocks, np.inf)
        np.minimum.at(self.block_bound, self.block, self.bound)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.terms >> U(44)).astype(np.int64)] = True

    @staticmethod
    def _postings(term: np.ndarray, of: np.ndarray, weight: np.ndarray, count: int) -> Postings:
        order = np.argsort(term, kind="stable")
        first = np.searchsorted(term[order], np.arange(count + 1))
        return Postings(first, of[order], weight[order])

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of hashes that are terms, and which."""
        some = np.flatnonzero(self.sieve[(hashes >> U(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, hashes[some]), len(self.terms) - 1)
        hit = self.terms[at] == hashes[some]
        return some[hit], at[hit]

    def search(self, found: Terms) -> list[tuple[int, int, int, int, float]]:
        """``(text, first word, end word, item, score)`` of all pairs above the item's bound."""
        count = np.diff(found.bounds)
        cells = -(-count // self.stride)  # half windows of each text
        first_cell = np.r_[0, np.cumsum(cells)]
        position, term = self.known(found.hash)
        text = np.searchsorted(found.bounds, position, side="right") - 1
        cell = first_cell[text] + (position - found.bounds[text]) // self.stride
        # Window w has the cells w and w + 1 of its text.
        second = cell > first_cell[text]
        pairs = np.unique(np.r_[cell, cell[second] - 1] * len(self.terms) + np.r_[term, term[second]])
        window, term = pairs // len(self.terms), pairs % len(self.terms)

        frequent = self.frequent[term]
        windows = int(first_cell[-1])
        common = np.bincount(window[frequent], self.term_most[term[frequent]], windows)
        owner, block, most = self.block_most.look_up(term[~frequent])
        key = window[~frequent][owner] * self.blocks + block
        alive, slot = np.unique(key, return_inverse=True)
        reach = np.bincount(slot, most, len(alive)) + np.minimum(self.block_common[alive % self.blocks], common[alive // self.blocks])
        alive = alive[reach >= self.block_bound[alive % self.blocks] - 1e-9]
        # Blocks whose frequent terms reach the bound alone.
        easy = np.flatnonzero(self.block_common >= self.block_bound - 1e-9)
        if len(easy):
            rich = np.flatnonzero(common >= self.block_bound[easy].min() - 1e-9)
            more = (rich[:, None] * self.blocks + easy[None]).ravel()
            alive = np.unique(np.r_[alive, more])
        if not len(alive):
            return []

        mine = np.isin(window, alive // self.blocks)
        owner, item, weight = self.postings.look_up(term[mine])
        at = window[mine][owner]
        inside = np.isin(at * self.blocks + self.block[item], alive)
        pair, slot = np.unique(at[inside] * len(self.ids) + item[inside], return_inverse=True)
        score = np.bincount(slot, weight[inside], len(pair))
        item = pair % len(self.ids)
        good = score >= self.bound[item] - 1e-9
        hits = []
        for w, i, s in zip((pair[good] // len(self.ids)).tolist(), item[good].tolist(), score[good].tolist()):
            t = int(np.searchsorted(first_cell, w, side="right")) - 1
            a = int(found.bounds[t]) + (w - int(first_cell[t])) * self.stride
            hits.append((t, a, min(a + 2 * self.stride, int(found.bounds[t + 1])), i, s))
        return hits

    def overlaps(self, item: int, passage: np.ndarray) -> tuple[float, float]:
        """Shares of the question's and the answer's 3-grams that the passage has."""
        own, have = self.words[item], grams(passage)
        if len(passage) >= GRAM:
            have = np.union1d(have, np.unique(passage))
        cut = math.ceil(len(own) * 2 / 3)
        shares = []
        for part in (own[:cut], own[cut:]):
            wanted = grams(part)
            shares.append(float(np.isin(wanted, have).mean()) if len(wanted) else 1.0)
        return shares[0], shares[1]


class Hit(NamedTuple):
    row: int
    item_id: int
    score: float
    share: float
    question: float
    answer: float
    start: int  # bytes of the text
    end: int


def hits(index: Index, column: pa.Array, confirmed: float) -> Iterator[Hit]:
    """Confirmed hits of a column of texts: the best passage of each text and item."""
    for chunk in chunks(column):
        found = terms(chunk)
        best: dict[tuple[int, int], Hit] = {}
        for text, a, b, item, score in index.search(found):
            question, answer = index.overlaps(item, found.hash[a:b])
            if min(question, answer) < confirmed:
                continue
            old = best.get((text, item))
            if old is None or (question + answer, score) > (old.question + old.answer, old.score):
                base = int(chunk.starts[text])
                best[text, item] = Hit(
                    chunk.first + text,
                    index.ids[item],
                    score,
                    score / index.bound[item] * RETRIEVED,
                    question,
                    answer,
                    int(found.start[a]) - base,
                    int(found.end[b - 1]) - base,
                )
        yield from best.values()


ITEM_TERM = "length int, part bigint, term bigint, items int, words bigint"


@tidy
def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct term of an item; the first one stands for the item and has its number of words."""
    for batch in batches:
        for chunk in chunks(batch["text"]):
            found = terms(chunk)
            size = np.diff(found.bounds)
            own = [np.unique(found.hash[a:b]) for a, b in zip(found.bounds, found.bounds[1:])]
            count = np.array([len(t) for t in own], np.int64)
            item = np.repeat(np.arange(len(own)), count)
            first = np.zeros(len(item), bool)
            first[(np.cumsum(count) - count)[count > 0]] = True
            at = pa.array(item + chunk.first)
            term = np.concatenate(own) if own else np.zeros(0, U)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["length"].take(at),
                    batch["part"].take(at),
                    pa.array(term.view(np.int64)),
                    pa.array(first.astype(np.int32)),
                    pa.array(np.where(first, size[item], 0)),
                ],
                names=[part.split()[0] for part in ITEM_TERM.split(", ")],
            )


def indexes(
    items: DataFrame, *, id: str = "item_id", text: str = "text", retrieved: float = RETRIEVED
) -> Iterator[Index]:
    """Indexes of the items, each of some megabytes of text at most and of like lengths.

    Document frequencies, the number of items and their mean length are those of all items, and windows
    those of all items of like lengths, so a score does not depend on how the items are cut. The driver
    holds one slice, and what is known of its terms, at a time.
    """
    rows = items.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text")).filter("text is not null")
    size = F.octet_length("text")
    # A word has a byte and a separator at least.
    length = F.greatest(F.lit(0), F.ceil(F.log2(size / (12.0 * SHORT_ITEM)))).cast("int")
    rows = rows.withColumn("length", F.coalesce(length, F.lit(0)))
    per = rows.groupBy("length").agg(F.sum(size.cast("bigint")).alias("bytes")).collect()
    parts = {r.length: max(1, math.ceil(r.bytes / SLICE_BYTES)) for r in sorted(per)}
    if not parts:
        return
    of_length = F.element_at(F.create_map(*[F.lit(x) for pair in parts.items() for x in pair]), F.col("length"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id", "text"), of_length))
    found = stage(rows.select("length", "part", "text").mapInArrow(_item_terms, ITEM_TERM), "item-terms")
    counts = stage(found.groupBy("term").agg(F.sum(F.lit(1)).alias("df")), "term-counts")
    longest = found.groupBy("length").agg(F.sum("items").alias("items"), F.sum("words").alias("words"), F.max("words").alias("longest"))
    about = {r.length: r for r in longest.collect()}
    count = sum(r["items"] for r in about.values())
    for length in sorted(about):
        for part in range(parts[length]):
            here = (F.col("length") == length) & (F.col("part") == part)
            own = rows.filter(here).select("id", "text").orderBy("id", "text").collect()
            own = [r for r in own if len(terms(next(chunks(pa.array([r.text])))).hash)]
            if not own:
                continue
            known = found.filter(here).select("term").distinct().join(counts, "term").toArrow()
            term, df = known["term"].to_numpy().view(U), known["df"].to_numpy()
            order = np.argsort(term)
            mean = sum(r["words"] for r in about.values()) / count
            corpus = Statistics(count, mean, about[length]["longest"], term[order], df[order])
            yield Index([r.id for r in own], [r.text for r in own], retrieved, corpus)


LEAK = (
    "id bigint, item_id bigint, score double, share double, question_overlap double, "
    "answer_overlap double, start_byte bigint, end_byte bigint"
)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    retrieved: float = RETRIEVED,
    confirmed: float = CONFIRMED,
) -> DataFrame:
    """A row per text and test item that it holds, with the best passage and its scores.

    ``share`` is the score as a part of what the item has against itself.
    """
    docs = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    found = None
    for index in indexes(items, id=item_id, text=item_text, retrieved=retrieved):

        @tidy
        def run(batches: Iterable[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [*hits(index, batch["text"], confirmed)]
                columns = [*zip(*rows)] or [()] * 8
                kinds = [pa.int64()] + [pa.float64()] * 4 + [pa.int64()] * 2
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].take(pa.array(columns[0], pa.int64()))]
                    + [pa.array(c, k) for c, k in zip(columns[1:], kinds)],
                    names=[part.split()[0] for part in LEAK.split(", ")],
                )

        own = docs.mapInArrow(run, LEAK)
        found = own if found is None else found.unionByName(own)
    if found is None:
        found = docs.sparkSession.createDataFrame([], LEAK)
    return found.withColumnRenamed("id", id).withColumnRenamed("item_id", item_id)


def drop_leaking(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    retrieved: float = RETRIEVED,
    confirmed: float = CONFIRMED,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text holds no test item."""
    for index in indexes(items, id=item_id, text=item_text, retrieved=retrieved):

        @tidy
        def run(batches: Iterable[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, ROWS_AT_ONCE):
                    part = batch.slice(a, ROWS_AT_ONCE)
                    keep = np.ones(part.num_rows, bool)
                    keep[[h.row for h in hits(index, part[text], confirmed)]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
