"""Toxicity scores from weak supervision.

1. Many voters: lexicon voters fire on a word, pattern voters on a word stem of 4 to 6 letters,
   each in four forms: where it stands at all, twice, three times, or is one word in 128. A short
   list is fixed, the others are those that labelled training rows have far more often in toxic
   texts.
2. A generative label model over a bounded sample of training rows, labelled and not: a hidden label
   per text, for every voter how often it fires on either label, the label given by hand being one
   more voter and the silence of all others another; a voter that doesn't fire abstains. It is
   fitted by expectation maximisation. Voters that still fire together once the
   hidden label is known are correlated, and share their evidence between them.
3. A logistic regression on the votes is trained on the posterior labels, and scores every text.

Texts are scored where they are read, without a shuffle. What the driver holds is the votes of the
sample (``SAMPLE`` labelled and as many other rows) and the weights of ``VOTERS`` voters.

Defined cases: null and empty texts have no votes and get the score of a text without any; of a very long
text all words vote; voters that are equally good (ties) are taken in order of their names, equal scores get
equal predictions; repeated rows are each scored; null
labels count as none; of several labels for an id the largest counts; rows with null ids are scored
but never trained on; without labelled toxic rows the fixed words vote alone; an empty table gives an
empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebelt.llm.text import Chunk, Rolling, U, chunks, lower, mix, runs, tidy

SAMPLE = 20_000
VOTERS = 512
STEMS = (4, 5, 6)
THRESHOLD = 0.7
# A mined voter fires on this share of the labelled toxic texts at least, in 4 of them at least.
LEAST_SHARE, LEAST_FIRED = 0.02, 4
LEAST_LOG_ODDS = 2.0
# Fixed lexicon, so that a table without labels can be scored, too.
LEXICON = ["idiot", "moron", "loser", "stupid", "pathetic", "worthless", "scum", "trash", "clown", "disgusting"]

# Forms of a voter: at least so often in a text, or at least once in so many of its words.
FORMS = ("", " x2", " x3", " often")
OFTEN = 128

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_rolling = Rolling(51)


class Tokens(NamedTuple):
    """Words and stems of a chunk: bytes ``start:end`` of ``data``, a word being whole."""

    data: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    whole: np.ndarray


def tokens(chunk: Chunk) -> Tokens:
    """Runs of letters and their stems; a stem is shorter than its word."""
    data = lower(chunk.data)
    start, end = runs(chunk, LETTER[data])
    letter_at = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters
    letter_at = np.r_[letter_at, len(data)]
    first, after = np.searchsorted(letter_at, start), np.searchsorted(letter_at, end)
    starts, ends, whole = [start], [end], [np.ones(len(start), bool)]
    for k in STEMS:
        long = after - first > k
        starts.append(start[long])
        ends.append(letter_at[first[long] + k])
        whole.append(np.zeros(int(long.sum()), bool))
    start, end, whole = np.concatenate(starts), np.concatenate(ends), np.concatenate(whole)
    text = np.searchsorted(chunk.starts, start, side="right") - 1
    hashed = mix(_rolling.ranges(_rolling.sums(data), start, end) + whole.astype(U))
    return Tokens(data, text, start, end, hashed, whole)


def token_hash(token: str) -> int:
    """The hash that ``tokens`` gives to a word, or to a stem written as ``stem*``."""
    whole, data = not token.endswith("*"), np.frombuffer(token.rstrip("*").encode(), np.uint8)
    value = _rolling.ranges(_rolling.sums(data), np.array([0]), np.array([len(data)]))
    return int(mix(value + U(whole))[0])


def forms(times: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """For each form, which tokens have it that stand ``times`` in texts of ``size`` words."""
    return [times >= 1, times >= 2, times >= 3, times * OFTEN >= size]


class Model(NamedTuple):
    voters: list[str]
    weights: np.ndarray
    bias: float

    def scores(self, votes: "Votes", chunk: Chunk) -> np.ndarray:
        text, voter = votes.fired(chunk)
        odds = self.bias + np.bincount(text, self.weights[voter], chunk.count)
        return 1 / (1 + np.exp(-odds.clip(-30, 30)))


class Votes:
    """Which voters fire on the texts of a chunk."""

    def __init__(self, voters: list[str]):
        parts = [next((v.removesuffix(f), i) for i, f in reversed([*enumerate(FORMS)]) if v.endswith(f)) for v in voters]
        names = sorted({token for token, _ in parts})
        hashes = np.array([token_hash(t) for t in names], U)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        place = {names[j]: k for k, j in enumerate(order)}
        self.voter = np.full((len(names), len(FORMS)), -1)
        for i, (token, form) in enumerate(parts):
            self.voter[place[token], form] = i
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.hashes >> U(44)).astype(np.int64)] = True

    def fired(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of text and voter, by text."""
        found = tokens(chunk)
        size = np.bincount(found.text[found.whole], minlength=chunk.count)
        some = np.flatnonzero(self.sieve[(found.hash >> U(44)).astype(np.int64)])
        hashed, text = found.hash[some], found.text[some]
        at = np.minimum(np.searchsorted(self.hashes, hashed), len(self.hashes) - 1)
        hit = self.hashes[at] == hashed
        pairs, times = np.unique(text[hit] * len(self.hashes) + at[hit], return_counts=True)
        text, token = pairs // len(self.hashes), pairs % len(self.hashes)
        texts, fired = [], []
        for form, has in enumerate(forms(times, size[text])):
            voter = self.voter[token, form]
            has = has & (voter >= 0)
            texts.append(text[has])
            fired.append(voter[has])
        text, voter = np.concatenate(texts), np.concatenate(fired)
        order = np.argsort(text, kind="stable")
        return text[order], voter[order]


def held_out(id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sampled(rows: DataFrame, id: str, bound: int) -> DataFrame:
    """About ``bound`` of the rows at most, picked by a hash of the id."""
    share = min(1.0, bound / max(1, rows.count()))
    return rows.filter(F.pmod(F.xxhash64(F.col(id), F.lit("sample")), F.lit(1 << 31)) < int(share * (1 << 31)))


def training_sample(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """``(text, label)`` of about ``bound`` labelled rows and as many others, none of them held out."""
    own = docs.filter(F.col("id").isNotNull() & ~held_out(F.col("id")))
    known = labels.filter("label is not null and id is not null").filter(~held_out(F.col("id")))
    known = _sampled(known.groupBy("id").agg(F.max("label").alias("label")), "id", bound)
    other = _sampled(own.select("id"), "id", bound).distinct().withColumn("extra", F.lit(True))
    # Both sides are bounded by the sample, so they are sent to the texts and not the texts to them.
    joined = own.join(F.broadcast(known), "id", "left").join(F.broadcast(other), "id", "left")
    return joined.filter("label is not null or extra").select("text", "label")


def mine_voters(sample: DataFrame, voters: int = VOTERS) -> list[str]:
    """Words and stems that labelled toxic texts have far more often than others."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.array(batch["label"].to_pylist(), np.int64)
            for chunk in chunks(batch["text"]):
                own = tokens(chunk)
                size = np.bincount(own.text[own.whole], minlength=chunk.count)
                hashes, at, name = np.unique(own.hash, return_index=True, return_inverse=True)
                count = max(1, len(hashes))
                pairs, times = np.unique(own.text * count + name, return_counts=True)
                text, name = pairs // count, pairs % count
                toxic = label[chunk.first + text] == 1
                data = own.data.tobytes()
                words = [
                    data[a:b].decode(errors="replace") + ("" if w else "*")
                    for a, b, w in zip(own.start[at].tolist(), own.end[at].tolist(), own.whole[at].tolist())
                ]
                for form, has in zip(FORMS, forms(times, size[text])):
                    yes = np.bincount(name[has & toxic], minlength=len(hashes))
                    no = np.bincount(name[has & ~toxic], minlength=len(hashes))
                    some = np.flatnonzero(yes + no)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([words[i] + form for i in some.tolist()], pa.string()),
                            pa.array(yes[some], pa.int64()),
                            pa.array(no[some], pa.int64()),
                        ],
                        names=["voter", "yes", "no"],
                    )

    known = sample.filter("label is not null")
    totals = known.agg(
        F.coalesce(F.sum(F.col("label")), F.lit(0)).alias("yes"), F.count("*").alias("n")
    ).first()
    if not totals.yes:
        return list(LEXICON)
    counted = known.mapInArrow(run, "voter string, yes bigint, no bigint").groupBy("voter")
    counted = counted.agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    odds = F.log((F.col("yes") + 0.5) / (totals.yes + 1)) - F.log((F.col("no") + 0.5) / (totals.n - totals.yes + 1))
    least = max(LEAST_FIRED, LEAST_SHARE * totals.yes)
    best = (
        counted.withColumn("odds", odds)
        .filter((F.col("yes") >= least) & (F.col("odds") >= LEAST_LOG_ODDS))
        .orderBy((F.col("odds") * F.sqrt("yes")).desc(), "voter")
        .limit(voters)
    )
    return sorted({*LEXICON, *(row.voter for row in best.collect())})


class Ballots(NamedTuple):
    """Equal votes and labels are one row; most texts have no vote at all."""

    votes: np.ndarray  # 0/1
    label: np.ndarray  # -1 for none
    times: np.ndarray


def sample_votes(sample: DataFrame, voters: list[str]) -> Ballots:
    """The votes on the texts of the sample."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = Votes(voters)
        for batch in batches:
            for chunk in chunks(batch["text"]):
                text, voter = votes.fired(chunk)
                ends = np.searchsorted(text, np.arange(chunk.count + 1))
                lists = [voter[a:b].tolist() for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch["label"].slice(chunk.first, chunk.count), pa.array(lists, pa.list_(pa.int32()))],
                    names=["label", "votes"],
                )

    rows = sample.mapInArrow(run, "label int, votes array<int>").groupBy("label", "votes").count().collect()
    rows = sorted((-1 if r.label is None else r.label, sorted(r.votes), r["count"]) for r in rows)
    matrix = np.zeros((len(rows), len(voters)), np.float32)
    for i, (_, votes, _) in enumerate(rows):
        matrix[i, votes] = 1
    return Ballots(matrix, np.array([r[0] for r in rows], np.int64), np.array([r[2] for r in rows], float))


def label_model(ballots: Ballots, *, rounds: int = 30, hand_accuracy: float = 0.95) -> tuple[np.ndarray, np.ndarray]:
    """Posterior probability of the hidden label per ballot, and the share of each voter's evidence.

    Every voter has two rates of firing, one per hidden label, fitted by expectation maximisation
    from a start that the labels given by hand and the numbers of votes set. The correlation of two
    voters is that of what the rates leave unexplained; a voter's evidence is divided by one plus the
    squares of its correlations.
    """
    votes, label, times = ballots
    silent = ~votes.any(axis=1)
    votes = np.concatenate([votes, silent[:, None].astype(votes.dtype)], axis=1)
    known = label >= 0
    hand = np.where(known, np.where(label == 1, 1.0, -1.0), 0.0) * np.log(hand_accuracy / (1 - hand_accuracy))
    post = np.where(known, np.where(label == 1, hand_accuracy, 1 - hand_accuracy), np.where(silent, 0.05, 0.5))
    share = np.ones(votes.shape[1])
    for step in range(rounds):
        yes, no = (times * post).sum(), (times * (1 - post)).sum()
        fire_yes = (votes.T @ (times * post) + 0.5) / (yes + 1)
        fire_no = (votes.T @ (times * (1 - post)) + 0.05) / (no + 1)
        prior = np.log((yes + 1) / (no + 1))
        odds = prior + hand + votes @ (share * np.log(fire_yes / fire_no))
        post = 1 / (1 + np.exp(-odds.clip(-30, 30)))
        if step in (2, rounds // 2):
            left = votes - post[:, None] * fire_yes - (1 - post)[:, None] * fire_no
            left *= np.sqrt(times)[:, None]
            cover = left.T @ left
            spread = np.sqrt(np.diag(cover)).clip(1e-9)
            share = 1 / ((cover / spread[:, None] / spread[None]) ** 2).sum(axis=1)
    return post, share[:-1]


def train_classifier(
    ballots: Ballots, target: np.ndarray, *, ridge: float = 0.3, rounds: int = 20
) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps; the bias is not shrunk."""
    votes, _, times = ballots
    x = np.concatenate([votes, np.ones((len(votes), 1), np.float32)], axis=1).astype(np.float64)
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        slope = x.T @ (times * (p - target)) + shrink * w
        curve = (x * (times * (p * (1 - p)).clip(1e-6))[:, None]).T @ x + np.diag(shrink)
        change = np.linalg.solve(curve, slope)
        w -= change
        if np.abs(change).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, voters: int = VOTERS) -> Model:
    """Fit on ``docs(id, text)`` and ``labels(id, label)``; held-out rows are left alone."""
    rows = training_sample(docs, labels, sample)
    names = mine_voters(rows, voters)
    ballots = sample_votes(rows, names)
    if not (ballots.label == 1).any() or not (ballots.label == 0).any():
        return Model(names, np.full(len(names), 4.0), -4.0)
    post, _ = label_model(ballots)
    return Model(names, *train_classifier(ballots, post))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(id, score)`` of ``docs(id, text)``."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = Votes(model.voters)
        for batch in batches:
            for chunk in chunks(batch["text"]):
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].slice(chunk.first, chunk.count), pa.array(model.scores(votes, chunk))],
                    names=["id", "score"],
                )

    return docs.mapInArrow(run, "id bigint, score double")


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    voters: int = VOTERS,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``threshold``."""
    own, known = _inputs(docs, labels, id, text, label)
    model = fit(own, known, sample=sample, voters=voters)

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = Votes(model.voters)
        for batch in batches:
            for chunk in chunks(batch[text]):
                keep = model.scores(votes, chunk) < threshold
                yield batch.slice(chunk.first, chunk.count).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def _inputs(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str) -> tuple[DataFrame, DataFrame]:
    return (
        docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text")),
        labels.select(F.col(id).cast("bigint").alias("id"), F.col(label).cast("int").alias("label")),
    )


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    voters: int = VOTERS,
) -> DataFrame:
    """``(id, held_out, score, predicted)`` per row of ``docs``; ``labels`` has ids and 0/1 labels."""
    docs, known = _inputs(docs, labels, id, text, label)
    scored = score(docs, fit(docs, known, sample=sample, voters=voters))
    return scored.select(
        F.col("id").alias(id),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
