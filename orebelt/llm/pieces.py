"""SentencePiece encoding and decoding over a lattice of pieces.

A text is cut into words, each with the blank before it; the first word gets one, too. For the distinct
words of a chunk of texts, all substrings up to the length of the longest piece are spelt out and
joined to the piece table. The matches are the edges of a lattice per word, from which a Viterbi fold
over the start positions picks the path of the greatest total score; of equal paths the one whose last
piece is longer, at each position. A character without a piece is spelt in byte pieces. Decoding puts
the pieces together and takes the first blank away: it gives back every text exactly.

``encode`` and ``decode`` do this where the texts are read, the relations being numpy arrays: the join
is by hash in the sorted piece table, the fold goes through all words of a chunk at once. ``encode_words``
is the same in DataFrame operations for a table of words; over a corpus, bringing its rows back to the
texts would take more shuffle than the texts (see README).

Scores are those of the model. In a model made by merging pairs they are merge ranks, not log
probabilities; there the score of rank r is -ln(r + 2), as in Zipf's law, less ``PIECE_COST``, so that
fewer pieces are better. Scores are added up in millionths, hence exactly. Pieces with a blank inside
are runs of blanks and are not used.

Defined cases: null and empty texts have no pieces and decode to the empty text; a very long text, or
word, is encoded as a whole; of equally good paths (ties) the one with the longer last piece holds; a literal U+2581 is
spelt in bytes, so it isn't taken for a blank; null ids are kept, repeated rows each encoded; an empty
table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.llm.blocks import Keys, distinct
from orebelt.llm.text import Chunk, Rolling, U, chunks, expand, mix, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
CHUNK = 1 << 19
ROWS_AT_ONCE = 512
PIECE_COST = 5.0
UNKNOWN_PENALTY = 10.0  # below the least score, for each byte of a character without a piece

_one, _two = Rolling(71), Rolling(73)


class Pieces(NamedTuple):
    """A piece table, its size given by the model; blanks are spaces in ``spelling``."""

    spelling: list[bytes]  # of usable pieces, in the order of their hashes
    id: np.ndarray
    score: np.ndarray
    hash: np.ndarray
    check: np.ndarray
    prefix: np.ndarray  # hashes of all their beginnings
    byte_id: np.ndarray  # id of the byte piece of each byte
    byte_score: int
    all_bytes: bytes  # spelling of every id, one after the other
    all_start: np.ndarray

    @property
    def sieve(self) -> "Sieve":
        tables = []
        for hashes in (self.hash, self.prefix):
            found = np.zeros(1 << 20, bool)
            found[(hashes >> U(44)).astype(np.int64)] = True
            tables.append(found)
        return Sieve(*tables)


class Sieve(NamedTuple):
    """By the first bits of a hash, whether a piece or the beginning of one may have it."""

    whole: np.ndarray
    prefix: np.ndarray


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Keys:
    one, two = _one.sums(data), _two.sums(data)
    check = (mix(_two.ranges(two, start, end)) >> U(32)).astype(np.uint32)
    return Keys(_one.ranges(one, start, end), check)


def load_pieces(path: str = MODEL) -> Pieces:
    """The piece table of a model file with byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    count = model.get_piece_size()
    byte_id, usable, scores, spellings = np.full(256, -1), [], [], []
    for i in range(count):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_id[int(piece[3:5], 16)] = i
            spellings.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            spellings.append(b"")
        else:
            spellings.append(piece.replace(BLANK, " ").encode())
            if " " not in piece and BLANK not in piece[1:]:
                usable.append(i)
                scores.append(model.get_score(i))
    if (byte_id < 0).any():
        raise ValueError(f"{path} has no byte pieces")
    score = np.array(scores)
    if np.array_equal(score, score.round()) and score.min() < -count / 2:  # merge ranks
        score = -np.log(2 - score) - PIECE_COST
    score = np.round(score * 1e6).astype(np.int64)
    sizes = [len(spellings[i]) for i in usable]
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(spellings[i] for i in usable), np.uint8)
    keys = _hashes(data, ends - sizes, ends)
    begins = np.repeat(ends - sizes, sizes)
    prefixes = np.unique(_one.ranges(_one.sums(data), begins, np.arange(1, len(data) + 1)))
    order = np.argsort(keys.hash)
    return Pieces(
        [spellings[usable[i]] for i in order],
        np.array(usable)[order],
        score[order],
        keys.hash[order],
        keys.check[order],
        prefixes,
        byte_id,
        int(score.min() - UNKNOWN_PENALTY * 1e6),
        b"".join(spellings),
        np.r_[0, np.cumsum([len(s) for s in spellings])],
    )


class Words(NamedTuple):
    data: np.ndarray  # bytes of the texts, each with a blank before it
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray  # the words of text i are bounds[i]:bounds[i + 1]


def words(chunk: Chunk) -> Words:
    """Words with the blank before them; control characters, which no piece has, stand alone."""
    size = np.diff(chunk.starts)
    some = size > 0
    starts = chunk.starts[:-1] + np.cumsum(some) - some
    data = np.full(len(chunk.data) + int(some.sum()), 32, np.uint8)
    data[expand(starts + some, size)] = chunk.data
    begins = data == 32
    control = data < 32
    begins |= control
    begins[1:] |= control[:-1]
    begins[starts[some]] = True
    start = np.flatnonzero(begins)
    return Words(data, start, np.r_[start[1:], len(data)] if len(start) else start, np.searchsorted(start, np.r_[starts, len(data)]))


class Lattice(NamedTuple):
    """Edges of the words ``start[i]:end[i]``, by their start within the word."""

    start: np.ndarray
    length: np.ndarray
    score: np.ndarray
    id: np.ndarray


def lattice(data: np.ndarray, start: np.ndarray, end: np.ndarray, pieces: Pieces, sieve: Sieve) -> Lattice:
    """Substrings joined to the pieces, and bytes of characters that have no piece of their own."""
    one, two = _one.sums(data), _two.sums(data)
    at = expand(start, end - start)
    first_byte = (data[at] & 0xC0) != 0x80
    spelt = np.zeros(len(data) + 1, bool)  # characters with a piece
    width = np.ones(256, np.int64)
    width[0xC0:0xE0], width[0xE0:0xF0], width[0xF0:] = 2, 3, 4
    starts, lengths, scores, ids = [], [], [], []
    alive, stop, length = at[first_byte], np.repeat(end, end - start)[first_byte], 0
    while len(alive):
        length += 1
        hashed = _one.ranges(one, alive, alive + length)
        slot = (hashed >> U(44)).astype(np.int64)
        # Only what may begin a piece is spelt out further.
        begins = sieve.prefix[slot]
        some = np.flatnonzero(begins & sieve.whole[slot])
        fits, hashed = alive[some], hashed[some]
        place = np.minimum(np.searchsorted(pieces.hash, hashed), len(pieces.hash) - 1)
        hit = pieces.hash[place] == hashed
        fits, place = fits[hit], place[hit]
        check = (mix(_two.ranges(two, fits, fits + length)) >> U(32)).astype(np.uint32)
        hit = pieces.check[place] == check
        fits, place = fits[hit], place[hit]
        starts.append(fits)
        lengths.append(np.full(len(fits), length))
        scores.append(pieces.score[place])
        ids.append(pieces.id[place])
        spelt[fits[width[data[fits]] == length]] = True
        begins &= alive + length < stop
        alive, stop = alive[begins], stop[begins]
    heads = at[first_byte & ~spelt[at]]
    size = np.minimum(width[data[heads]], len(data) - heads)
    rest = expand(heads, size)
    starts.append(rest)
    lengths.append(np.ones(len(rest), np.int64))
    scores.append(np.full(len(rest), pieces.byte_score))
    ids.append(pieces.byte_id[data[rest]])
    return Lattice(*(np.concatenate(x) for x in (starts, lengths, scores, ids)))


def best_paths(data: np.ndarray, start: np.ndarray, end: np.ndarray, pieces: Pieces, sieve: Sieve) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of the best path of each word, one after the other, and where each word's begin.

    The words lie one after the other in ``data``.
    """
    edges = lattice(data, start, end, pieces, sieve)
    word = np.repeat(np.arange(len(start)), end - start)[edges.start]
    offset = edges.start - start[word]
    # By start within the word; edges come by length, and a stable sort leaves them so.
    narrow = offset.astype(np.uint16) if len(offset) and offset.max() < 1 << 16 else offset
    order = np.argsort(narrow, kind="stable")
    offset = offset[order]
    goal, begin = (edges.start + edges.length)[order] + word[order], edges.start[order] + word[order]
    score, edge_id, length = edges.score[order], edges.id[order], edges.length[order]
    # Each word has a node more than it has bytes.
    best = np.full(len(data) + len(start), -(1 << 62))
    back, taken = np.zeros(len(best), np.int64), np.zeros(len(best), np.int64)
    node = start + np.arange(len(start))
    best[node] = 0
    groups = np.flatnonzero(np.diff(np.r_[-1, offset, -1]))
    for a, b in zip(groups, groups[1:]):
        reach = best[begin[a:b]] + score[a:b]
        better = reach > best[goal[a:b]]
        to = goal[a:b][better]
        best[to], back[to], taken[to] = reach[better], length[a:b][better], edge_id[a:b][better]
    here, owners, ids, steps = end + np.arange(len(end)), [], [], []
    alive = np.flatnonzero(here > node)
    step = 0
    while len(alive):
        at = here[alive]
        owners.append(alive)
        ids.append(taken[at])
        steps.append(np.full(len(alive), -step))
        here[alive] = at - back[at]
        alive = alive[here[alive] > node[alive]]
        step += 1
    if not owners:
        return np.zeros(0, np.int64), np.zeros(len(start) + 1, np.int64)
    owner, ids, steps = np.concatenate(owners), np.concatenate(ids), np.concatenate(steps)
    # Pieces were found last to first: each word's go to its places from the end.
    count = np.bincount(owner, minlength=len(start))
    first = np.r_[0, np.cumsum(count)]
    found = np.empty(len(ids), np.int64)
    found[first[owner + 1] - 1 + steps] = ids
    return found, first


def encode_chunk(chunk: Chunk, pieces: Pieces, sieve: Sieve) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a chunk, and where those of each begin."""
    found = words(chunk)
    own = distinct(_hashes(found.data, found.start, found.end))
    size = (found.end - found.start)[own.first]
    spelt = found.data[expand(found.start[own.first], size)]
    ends = np.cumsum(size)
    ids, first = best_paths(spelt, ends - size, ends, pieces, sieve)
    count = np.diff(first)[own.inverse]
    all_ids = ids[expand(first[:-1][own.inverse], count)]
    return all_ids, np.r_[0, np.cumsum(count)][found.bounds]


def spell(ids: np.ndarray, bounds: np.ndarray, pieces: Pieces) -> list[str]:
    """The texts of lists of ids that lie one after the other."""
    size = np.diff(pieces.all_start)[ids]
    spelling = np.frombuffer(pieces.all_bytes, np.uint8)
    data = spelling[expand(pieces.all_start[ids], size)].tobytes()
    at = np.r_[0, np.cumsum(size)][bounds].tolist()
    # The blank before the first word was not in the text.
    return [data[i + (i < j and data[i] == 32) : j].decode() for i, j in zip(at, at[1:])]


def encode(
    docs: DataFrame, pieces: Pieces, *, id: str = "doc_id", text: str = "text", decoded: bool = False
) -> DataFrame:
    """``(id, ids)`` per row: the piece ids of the text; ``decoded`` adds the ``text`` they give back."""
    names = ["id", "ids", *["text"][:decoded]]

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = pieces.sieve
        for batch in batches:
            for chunk in chunks(batch["text"], CHUNK):
                ids, bounds = encode_chunk(chunk, pieces, sieve)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                columns = [batch["id"].slice(chunk.first, chunk.count), lists]
                if decoded:
                    columns.append(pa.array(spell(ids, bounds, pieces), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    own = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    schema = "id bigint, ids array<int>" + (", text string" if decoded else "")
    return own.mapInArrow(run, schema).withColumnRenamed("id", id)


def decode(encoded: DataFrame, pieces: Pieces, *, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(id, ids, text)`` per row of ``encoded``."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(a, ROWS_AT_ONCE)
                lists = part["ids"].fill_null([]) if part["ids"].null_count else part["ids"]
                bounds = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]
                texts = spell(lists.flatten().to_numpy(), bounds, pieces)
                yield pa.RecordBatch.from_arrays(
                    [part["id"], part["ids"], pa.array(texts, pa.string())], names=["id", "ids", "text"]
                )

    own = encoded.select(F.col(id).alias("id"), F.col(ids).alias("ids"))
    return own.mapInArrow(run, "id bigint, ids array<int>, text string").withColumnRenamed("id", id)


def piece_table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    """``(piece, id, score)``, blanks as spaces."""
    rows = zip([s.decode() for s in pieces.spelling], pieces.id.tolist(), pieces.score.tolist())
    return spark.createDataFrame([*rows], "piece string, id int, score bigint")


def encode_words(spark: SparkSession, vocabulary: DataFrame, pieces: Pieces, *, word: str = "word") -> DataFrame:
    """``(word, ids)`` of the distinct words that are spelt in pieces throughout, relationally.

    Substrings are exploded and equi-joined to the piece table, which is as small as its model; edges are
    grouped by word, and a higher-order fold keeps the best path to each position. A word starts with its
    blank.
    """
    table = piece_table(spark, pieces)
    longest = max(len(s.decode()) for s in pieces.spelling)
    words = vocabulary.select(F.col(word).alias("word")).filter("word <> ''").distinct()
    n = F.length("word")
    spans = words.select("word", F.explode(F.sequence(F.lit(0), n - 1)).alias("start"))
    spans = spans.select(
        "word",
        "start",
        F.explode(F.sequence(F.col("start") + 1, F.least(n, F.col("start") + longest))).alias("end"),
    )
    part = F.substring(F.col("word"), F.col("start") + 1, F.col("end") - F.col("start"))
    edges = spans.withColumn("piece", part).join(F.broadcast(table), "piece")
    grouped = edges.groupBy("word").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "id", "score"))).alias("edges")
    )
    state = "struct<score bigint, ids array<int>>"
    nothing = F.lit(None).cast(state)
    origin = F.struct(F.lit(0).cast("bigint").alias("score"), F.array().cast("array<int>").alias("ids"))
    begin = F.concat(F.array(origin), F.array_repeat(nothing, n))

    def step(nodes, edge):
        before = F.element_at(nodes, edge["start"] + 1)
        reach = before["score"] + edge["score"]

        def better(node, i):
            come = F.struct(reach.alias("score"), F.concat(before["ids"], F.array(edge["id"])).alias("ids"))
            wins = before.isNotNull() & (node.isNull() | (reach > node["score"]))
            return F.when((i == edge["end"]) & wins, come).otherwise(node)

        return F.transform(nodes, better)

    folded = grouped.select("word", F.aggregate("edges", begin, step).alias("nodes"))
    end = F.element_at("nodes", -1)
    return folded.select(F.col("word").alias(word), end["ids"].alias("ids")).filter("ids is not null")
