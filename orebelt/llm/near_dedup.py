"""Near duplicates: MinHash bands for candidates, odd sketches to sift them, full sets to decide.

1. Every text becomes the set of its distinct 5-word shingles, its MinHash samples in bands, and
   an odd sketch: the samples toggle bits of a parity bitmap, and the number of bits in which two
   bitmaps differ estimates a high similarity closely.
2. Texts with equal sets form a class with one representative, so copies cost nothing further.
3. Representatives that share a band are linked to the least of them, which splits them into
   groups of candidates without any pair of a group being written out.
4. Groups are cut into blocks of some hundred sets. A block links its members, and the hubs of
   their group, wherever the sketches allow it and the full sets confirm it; pairs that are
   connected already are not looked at again.
5. In groups of several blocks, members that share a band but are not connected yet are held
   against each other: of each band those outside its largest component against all that have it,
   first by size and sketch alone, in cells of some thousand, and a pair only where it shares its
   first band. The sets of those that remain are fetched in blocks to confirm the links.

A link is certain once confirmed. One at the threshold is missed with probability
``(1 - similarity ** rows) ** bands``, 5e-6 at 0.75, and a sketch that strays by five deviations.

Defined cases: null and empty texts, and texts without words, have no shingle and are linked with
nothing; fewer than five words are one shingle; a very long text has the set of all its shingles; of equal
texts and sets (ties) the smallest id stands for the others; rows that repeat an id are one document that has
the links of each of them; a row without an id has no component and is kept; an empty table gives
an empty result. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebelt.llm.components import connected_components
from orebelt.llm.text import U, chunks, constants, mix, shingles, words, tidy
from orebelt.session import stage

BLOCK = 512
MEMBERS_PER_TASK = 256
ROWS_AT_ONCE = 4096
CELL = 4096  # members of a band on each side of a cell


class Sketching(NamedTuple):
    """Parameters of the candidate search; the decision itself has none but the threshold."""

    size: int = 5  # words of a shingle
    similarity: tuple[int, int] = (3, 4)  # linked from this share of the union
    bands: int = 32
    rows: int = 4
    sketch_bits: int = 512
    sift: float = 0.5  # estimate below which a pair is not confirmed

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @property
    def most_differing(self) -> float:
        return self.sketch_bits / 2 * -math.expm1(-4 * self.samples * (1 - self.sift) / self.sketch_bits)


class Sketcher:
    """Samples, bands and odd sketch of a set of shingle hashes."""

    def __init__(self, p: Sketching):
        self.p = p
        self.shift, self.factor = constants(p.samples, 21), constants(p.samples, 22)
        self.place, self.band = constants(p.samples, 23), constants(p.bands, 24)
        self.words = constants(p.size, 25)

    def samples(self, own: np.ndarray) -> np.ndarray:
        least = np.full(self.p.samples, np.iinfo(U).max, U)
        for i in range(0, len(own), ROWS_AT_ONCE):
            part = own[i : i + ROWS_AT_ONCE, None]
            np.minimum(least, ((part ^ self.shift) * self.factor).min(axis=0), out=least)
        return least

    def bands(self, samples: np.ndarray) -> np.ndarray:
        rows = (samples * self.place).reshape(self.p.bands, self.p.rows).sum(axis=1, dtype=U)
        return mix(rows + self.band)

    def odd_sketch(self, samples: np.ndarray) -> np.ndarray:
        bit = mix(samples + self.place) % U(self.p.sketch_bits)
        parity = np.bincount(bit.astype(np.int64), minlength=self.p.sketch_bits) & 1
        return np.packbits(parity.astype(np.uint8))

    @staticmethod
    def identity(own: np.ndarray) -> tuple[int, int]:
        """128 bits that do not depend on the order of the set."""
        one, two = mix(own).sum(dtype=U), mix(own ^ U(0x5DEECE66D)).sum(dtype=U)
        return int(one.view(np.int64)), int(two.view(np.int64))


def fingerprints(docs: DataFrame, p: Sketching) -> DataFrame:
    """``(id, n, s1, s2, bands, odd)`` per row of ``docs(id, text)``; bands are null without shingles."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(p)
        for batch in batches:
            for chunk in chunks(batch["text"]):
                n, s1, s2, bands, odd = [], [], [], [], []
                for own in shingles(words(chunk), p.size, sketcher.words):
                    n.append(len(own))
                    a, b = sketcher.identity(own)
                    s1.append(a)
                    s2.append(b)
                    samples = sketcher.samples(own)
                    bands.append(sketcher.bands(samples).view(np.int64) if len(own) else None)
                    odd.append(sketcher.odd_sketch(samples).tobytes() if len(own) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].slice(chunk.first, chunk.count),
                        pa.array(n, pa.int64()),
                        pa.array(s1, pa.int64()),
                        pa.array(s2, pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(odd, pa.binary()),
                    ],
                    names=["id", "n", "s1", "s2", "bands", "odd"],
                )

    return docs.mapInArrow(
        run, "id bigint, n bigint, s1 bigint, s2 bigint, bands array<bigint>, odd binary"
    )


def full_sets(members: DataFrame, p: Sketching) -> DataFrame:
    """The sets of ``members(id, text, s1, s2, comp, blocks, hub, odd)`` whose text is that of s1, s2."""
    schema = "node bigint, comp bigint, blocks int, hub boolean, odd binary, own binary"

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher, done = Sketcher(p), set()
        for batch in batches:
            s1, s2, ids = (batch[c].to_pylist() for c in ("s1", "s2", "id"))
            for chunk in chunks(batch["text"]):
                keep, sets = [], []
                for i, own in enumerate(shingles(words(chunk), p.size, sketcher.words), chunk.first):
                    key = (ids[i], s1[i], s2[i])
                    if key not in done and sketcher.identity(own) == key[1:]:
                        done.add(key)
                        keep.append(i)
                        sets.append(own.tobytes())
                at = pa.array(keep, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch[c].take(at) for c in ("id", "comp", "blocks", "hub", "odd")]
                    + [pa.array(sets, pa.binary())],
                    names=["node", "comp", "blocks", "hub", "odd", "own"],
                )

    return members.mapInArrow(run, schema)


def _sift(
    odd: np.ndarray, size: np.ndarray, label: np.ndarray, left: np.ndarray, right: np.ndarray, p: Sketching
) -> tuple[np.ndarray, np.ndarray]:
    """For each pair how far its sketches differ, and whether it may be a link between two labels."""
    part, whole = p.similarity
    differ = np.bitwise_count(odd[left][:, None] ^ odd[right][None]).sum(axis=2, dtype=np.int64)
    small = np.minimum(size[left][:, None], size[right][None])
    large = np.maximum(size[left][:, None], size[right][None])
    good = (differ <= p.most_differing) & (whole * small >= part * large)
    return differ, good & (label[left][:, None] != label[right][None])


class Linker:
    """Confirms links between the sets of one block, least differing sketches first."""

    def __init__(self, rows: pa.Table, p: Sketching):
        self.p = p
        self.sets = [np.frombuffer(v.as_buffer(), U) for v in rows["own"].combine_chunks()]
        self.size = np.array([len(s) for s in self.sets])
        odd = rows["odd"].combine_chunks()
        self.odd = np.frombuffer(b"".join(odd.to_pylist()), U).reshape(len(odd), -1)

    def linked(self, i: int, j: int) -> bool:
        a, b = self.sets[i], self.sets[j]
        if len(a) > len(b):
            a, b = b, a
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        common = int(np.count_nonzero(b[at] == a))
        part, whole = self.p.similarity
        return whole * common >= part * (len(a) + len(b) - common)

    def links(self, left: np.ndarray, right: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
        """Links that join what ``label`` has apart, between the rows ``left`` and ``right``."""
        parent = {int(x): int(x) for x in np.unique(label)}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        pairs = []
        for a in range(0, len(left), 64):
            own = left[a : a + 64]
            differ, good = _sift(self.odd, self.size, label, own, right, self.p)
            i, j = np.nonzero(good)
            pairs.append(np.stack([differ[i, j], own[i], right[j]], axis=1))
        found = []
        pairs = np.concatenate(pairs) if pairs else np.zeros((0, 3), np.int64)
        for _, i, j in pairs[np.argsort(pairs[:, 0], kind="stable")].tolist():
            x, y = root(int(label[i])), root(int(label[j]))
            if x != y and self.linked(i, j):
                parent[x] = y
                found.append((i, j))
        return found


def _link_blocks(rows: DataFrame, p: Sketching, *, residual: bool) -> DataFrame:
    """Links ``(u, v)`` within the blocks ``(comp, block)``, a task taking many small ones.

    In ``residual`` blocks rows marked ``minor`` are held against the others of their block, and
    ``label`` has what is connected already.
    """

    @tidy
    def run(group: pa.Table) -> pa.Table:
        comp, block = (group[c].to_numpy() for c in ("comp", "block"))
        order = np.lexsort((block, comp))
        cuts = np.flatnonzero((np.diff(comp[order]) != 0) | (np.diff(block[order]) != 0)) + 1
        us, vs = [], []
        for at in np.split(order, cuts):
            if len(at) < 2:
                continue
            part = group.take(pa.array(at))
            node = part["node"].to_numpy()
            linker = Linker(part, p)
            label = part["label"].to_numpy() if residual else np.unique(node, return_inverse=True)[1]
            everyone = np.arange(len(node))
            left = np.flatnonzero(part["minor"].to_numpy(zero_copy_only=False)) if residual else everyone
            right = np.flatnonzero(~part["minor"].to_numpy(zero_copy_only=False)) if residual else everyone
            for i, j in linker.links(left, right, label):
                us.append(node[i])
                vs.append(node[j])
        return pa.table([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return rows.groupBy("task").applyInArrow(run, "u bigint, v bigint")


def _residual_members(cells: DataFrame, p: Sketching) -> DataFrame:
    """Members of the cells ``(comp, block)`` that may have a link there, in blocks of their own.

    Rows marked ``minor`` are held against the others; of two that are both outside the largest
    component (``lesser``), only the less against the greater.
    """

    @tidy
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in ("comp", "block", "minor", "node")])
        comp, block, node, label, size, place = (
            group[c].to_numpy() for c in ("comp", "block", "node", "label", "n", "place")
        )
        minor, lesser = (group[c].to_numpy(zero_copy_only=False) for c in ("minor", "lesser"))
        odd = np.frombuffer(b"".join(group["odd"].to_pylist()), U).reshape(len(group), -1)
        bands = group["bands"].combine_chunks().flatten().to_numpy().reshape(len(group), -1)
        cuts = np.flatnonzero((np.diff(comp) != 0) | (np.diff(block) != 0)) + 1
        found = []
        for at in np.split(np.arange(len(group)), cuts):
            left, right = at[minor[at]], at[~minor[at]]
            number = int(block[at[0]]) << 20
            for a in range(0, len(left), BLOCK // 2):
                own = left[a : a + BLOCK // 2]
                good = np.zeros((len(own), len(right)), bool)
                for b in range(0, len(own), 64):
                    good[b : b + 64] = _sift(odd, size, label, own[b : b + 64], right, p)[1]
                good &= ~lesser[right][None] | (node[own][:, None] < node[right][None])
                for k in range(int(place[at[0]])):
                    if not good.any():
                        break
                    good &= bands[own, k][:, None] != bands[right, k][None]
                hit = np.flatnonzero(good.any(axis=0))
                for b in range(0, len(hit), BLOCK // 2):
                    some = hit[b : b + BLOCK // 2]
                    found += [(i, number) for i in (own[good[:, some].any(axis=1)], right[some])]
                    number += 1
        rows = np.concatenate([i for i, _ in found]) if found else np.zeros(0, np.int64)
        numbers = np.repeat([n for _, n in found], [len(i) for i, _ in found]).astype(np.int64)
        return pa.table(
            {"comp": comp[rows], "block": numbers, "node": node[rows], "label": label[rows], "minor": minor[rows]}
        )

    return cells.groupBy("task").applyInArrow(run, "comp bigint, block bigint, node bigint, label bigint, minor boolean")


def _more_links(large: DataFrame, sets: DataFrame, p: Sketching) -> DataFrame:
    """Links between the members ``large(node, label, n, odd, bands)`` that share a band and differ in label."""
    keys = large.select("node", "label", F.posexplode("bands").alias("place", "comp"))
    per = keys.groupBy("comp", "label").agg(F.count("*").alias("n"))
    mixed = per.groupBy("comp").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"))
    mixed = mixed.filter("n > top.n").select(
        "comp",
        F.col("top.label").alias("main"),
        F.ceil((F.col("n") - F.col("top.n")) / CELL).alias("down"),
        F.ceil(F.col("n") / CELL).alias("across"),
    )
    met = keys.join(mixed, "comp").withColumn("lesser", F.col("label") != F.col("main"))
    row, column = F.pmod(F.xxhash64("node"), F.col("down")), F.pmod(F.xxhash64("node"), F.col("across"))
    to = lambda size: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(size) - 1))
    left = met.filter("lesser").withColumns({"minor": F.lit(True), "row": row, "column": to("across")})
    right = met.withColumns({"minor": F.lit(False), "row": to("down"), "column": column})
    cells = left.unionByName(right).withColumn("block", F.col("row") * F.col("across") + F.col("column"))
    cells = stage(cells.select("comp", "block", "node", "place", "minor", "lesser"), "band-cells")
    cells = _in_tasks(cells.join(large, "node"), cells.count())
    found = stage(_residual_members(cells, p), "residual-members")
    rows = _in_tasks(found.join(sets.select("node", "odd", "own"), "node"), found.count())
    return stage(_link_blocks(rows, p, residual=True), "more-links")


def _in_tasks(rows: DataFrame, count: int) -> DataFrame:
    return rows.withColumn("task", F.pmod(F.xxhash64("comp", "block"), F.lit(max(1, count // MEMBERS_PER_TASK))))


def _candidates(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges to the least member of each shared band, and how many others share a member's bands."""
    keys = reps.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("n")).filter("n > 1")
    met = stage(
        keys.join(shared, "key").groupBy("node", "least").agg(F.sum("n").alias("met")), "band-edges"
    )
    degree = met.groupBy("node").agg(F.sum("met").alias("met"))
    return met.filter("node <> least").select(F.col("node").alias("u"), F.col("least").alias("v")), degree


def _same_id(prints: DataFrame, reps: DataFrame) -> DataFrame:
    """Links between the classes of rows that repeat an id with another text."""
    each = prints.filter("n > 0 and id is not null").select("id", "s1", "s2", "n").distinct()
    again = each.groupBy("id").agg(F.count("*").alias("texts")).filter("texts > 1")
    node = each.join(again, "id").join(reps.select("s1", "s2", "n", "node"), ["s1", "s2", "n"])
    # The id is a node itself only if it represents one of its classes; it serves as a hub either way.
    return node.filter("node <> id").select(F.col("id").alias("u"), F.col("node").alias("v"))


def near_duplicates(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", sketching: Sketching = Sketching()
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` per row; ids are integers.

    ``component_id`` is the smallest id that a chain of links reaches; the row that has it is kept.
    """
    p = sketching
    docs = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    prints = stage(fingerprints(docs, p), "shingle-prints")
    classes = prints.filter("n > 0 and id is not null").groupBy("s1", "s2", "n")
    reps = stage(
        classes.agg(F.min("id").alias("node"), F.first("bands").alias("bands"), F.first("odd").alias("odd")),
        "set-classes",
    )
    edges, degree = _candidates(reps)
    groups = stage(connected_components(edges).withColumnRenamed("component", "comp"), "candidate-groups")

    # The hubs of a group: its least member and the one that shares bands with most others.
    sizes = (
        groups.join(degree, "node")
        .groupBy("comp")
        .agg(F.count("*").alias("size"), F.max(F.struct("met", "node")).alias("top"))
        .select("comp", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"), F.col("top.node").alias("top"))
    )
    wanted = (
        groups.join(sizes, "comp")
        .withColumn("hub", (F.col("node") == F.col("comp")) | (F.col("node") == F.col("top")))
        .join(reps.select("node", "s1", "s2", "odd"), "node")
        .select(F.col("node").alias("id"), "comp", "blocks", "hub", "s1", "s2", "odd")
    )
    members = docs.filter("id is not null").join(wanted, "id")
    sets = stage(full_sets(members, p), "shingle-sets")

    home = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = sets.filter("not hub or blocks = 1").withColumn("block", home)
    placed = placed.unionByName(sets.filter("hub and blocks > 1").withColumn("block", every))
    count = sets.count()
    links = stage(_link_blocks(_in_tasks(placed, count), p, residual=False), "links")

    large = sets.filter("blocks > 1")
    if not large.isEmpty():
        label = stage(connected_components(links).withColumnRenamed("component", "label"), "labels")
        large = large.select("node").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        large = stage(large.join(reps.select("node", "n", "odd", "bands"), "node"), "large-groups")
        # What is connected already goes on as stars around the labels.
        known = label.select(F.col("node").alias("u"), F.col("label").alias("v"))
        links = known.unionByName(_more_links(large, sets, p))

    component = connected_components(links.unionByName(_same_id(prints, reps)))
    of_class = reps.select("s1", "s2", "n", "node").join(component, "node", "left")
    of_class = of_class.select("s1", "s2", "n", F.coalesce("component", "node").alias("component"))
    found = prints.select("id", "n", "s1", "s2").join(of_class, ["s1", "s2", "n"], "left")
    least = F.when(F.col("n") > 0, F.least("component", "id")).otherwise(F.col("id"))
    return found.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), least).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(id) == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", sketching: Sketching = Sketching()
) -> DataFrame:
    """One row of each group of near duplicates, with all its columns; rows without an id stay."""
    found = near_duplicates(docs, id=id, text=text, sketching=sketching)
    kept = found.filter(F.col("kept") & F.col(id).isNotNull()).select(id).distinct()
    # Rows that repeat an id are one document.
    first = docs.filter(F.col(id).isNotNull()).join(kept, id, "left_semi").dropDuplicates([id])
    return first.unionByName(docs.filter(F.col(id).isNull()))
