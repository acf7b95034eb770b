"""Mixing sources to target weights: Sainte-Laguë apportionment of equal blocks of words.

1. Sources get targets by weight; a target stops at so many times the size of its source, and the
   excess goes to the others by weight until none is above.
2. The mix is cut into equal blocks of words. Each source gets blocks by the highest quotients
   ``target / (2 k + 1)``, which makes its quota an integer, and the same rule divides a quota among
   the shards of its source.
3. A shard is some documents of a source in an order drawn from the seed, its words cut into blocks of
   the same size. A quota of all its blocks is a whole pass; of the rest, the mix takes that many
   blocks in a row, around the end, from one drawn from the seed. So documents are taken whole but for
   the two where such a run begins and ends.

Seats are not handed out one by one: a divisor method gives a part at least its share of the seats less
half a seat for every part that it outweighs, so all below that is given at once, and only the quotients
around it, about five per part, are ranked. Numbers in a global order come from sorted ranges whose sizes
are added up, never from one task. Built-in functions only.

Defined cases: a null or empty text has no words and nothing of it is taken; a null source is a source of
its own, the last one; sources without words have the target 0; rows that repeat an id are documents of
their own, and those that are equal in id and size are interchangeable; null ids are drawn like others;
very long texts are cut like others; equal quotients go to the source, or shard, that comes first; an
empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebelt.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)  # words of the mix, of all words there are
MOST = 2  # a document is taken so many times at most
BLOCK_WORDS = 16
# A shard has about so many words, or documents where they are short.
SHARD_WORDS, SHARD_ROWS = 1 << 16, 256
SEED = "mix"


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with numbers from 0 in the given order.

    Ranges of rows are sorted by one task each; of each range, only the number of its rows is compared
    with the others. There are no more ranges than shuffle partitions.
    """
    ranges = stage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_rows"))
    sizes = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    numbers = ranges.withColumn("_inside", inside).join(F.broadcast(sizes), "_range")
    return numbers.withColumn(name, F.col("_before") + F.col("_inside") - 1).drop("_range", "_before", "_inside")


def apportion(parts: DataFrame, seats: DataFrame) -> DataFrame:
    """``parts(group, part, votes)`` with their ``quota`` of the ``seats(group, seats)`` of their group.

    Seats go to the highest ``votes / (2 k + 1)``; equal ones to the least part.
    """
    per = parts.groupBy("group").agg(F.sum("votes").alias("_votes"), F.count("*").alias("_parts"))
    of_group = per.join(seats, "group")
    share = F.col("votes") / F.col("_votes")
    due, slack = share * F.col("seats"), share * F.col("_parts") / 2 + F.lit(1.5)
    least = F.greatest(F.floor(due - slack), F.lit(0).cast("bigint"))
    most = F.greatest(F.ceil(due + slack), F.lit(1).cast("bigint"))
    parts = parts.join(of_group, "group")
    parts = parts.withColumn("_least", F.when(F.col("_votes") > 0, least).otherwise(0)).withColumn("_most", most)

    some = parts.filter("votes > 0").select(
        "group", "part", "votes", F.explode(F.sequence("_least", F.col("_most") - 1)).alias("k")
    )
    quotients = some.select("group", "part", (F.col("votes") / (2 * F.col("k") + 1)).alias("quotient"))
    order = [F.col("group").asc(), F.col("quotient").desc(), F.col("part").asc()]
    ranked = stage(numbered(quotients, order, "place"), "quotients")
    rest = parts.groupBy("group").agg((F.first("seats") - F.sum("_least")).alias("rest"))
    rest = rest.join(ranked.groupBy("group").agg(F.min("place").alias("first")), "group")
    won = ranked.join(rest, "group").filter("place - first < rest").groupBy("group", "part").agg(F.count("*").alias("_won"))
    quota = F.col("_least") + F.coalesce("_won", F.lit(0))
    return parts.join(won, ["group", "part"], "left").select("group", "part", quota.alias("quota"))


def with_targets(sources: DataFrame, *, share: Fraction = SHARE, most: int = MOST) -> DataFrame:
    """``sources(weight, source_size)`` with the ``target`` of each.

    A target is the weight times a common level, ``most`` times the size at most. Stopping a target
    raises the level for the rest, so a step may stop further ones; the last step stops none. What the
    driver sees of a step is two sums.
    """
    weight, cap = F.col("weight").cast("decimal(19,0)"), (most * F.col("source_size")).cast("decimal(19,0)")
    total = Fraction(sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level, stopped = Fraction(0), -1
    while True:
        up, down = F.lit(level.numerator).cast("decimal(19,0)"), F.lit(level.denominator).cast("decimal(19,0)")
        above = (weight * up) >= (cap * down)
        found = sources.agg(
            F.count_if(above).alias("n"),
            F.sum(F.when(above, cap)).alias("capped"),
            F.sum(F.when(~above, F.col("weight"))).alias("free"),
        ).first()
        if found["n"] == stopped or not found["free"]:
            break
        stopped = found["n"]
        level = (total - int(found["capped"] or 0)) / found["free"]
    target = (weight * up).cast("double") / down.cast("double")
    return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(target))


def _drawn(seed: str, *columns: str) -> Column:
    """32 hex digits that depend on the seed and the columns alone."""
    return F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]))


def _number(digits: Column) -> Column:
    return F.conv(F.substring(digits, 1, 8), 16, 10).cast("bigint")


def mix_sources(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: Fraction = SHARE,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """``(id, source, size, source_size, target, passes, spans)`` per row.

    ``passes`` is how often the mix takes the whole text, ``spans`` what it takes beyond that, as at most
    two ranges ``(start, end)`` of words. Sources in order of their code points have the ``weights``, over
    and over, and share ``share`` of all words.
    """
    sizes = stage(
        docs.select(
            F.col(id).cast("bigint").alias("id"),
            F.col(source).alias("source"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        ),
        "mix-sizes",
    )
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sources = numbered(sources, [F.col("source").asc_nulls_last()], "number")
    at = F.pmod("number", F.lit(len(weights))).cast("int") + 1
    sources = stage(sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), at)), "mix-sources")
    shards = F.ceil(F.greatest(F.col("source_size") / SHARD_WORDS, F.col("rows") / SHARD_ROWS))
    sources = with_targets(sources, share=share, most=most).withColumns({"shards": shards, "group": F.lit(0)})
    sources = stage(sources, "mix-targets")

    # A stored column, so that the one group is a key like those of the shards.
    seats = sources.groupBy("group").agg(F.floor(F.sum("target") / block_words + 0.5).alias("seats"))
    votes = sources.select("group", F.col("number").alias("part"), F.col("target").alias("votes"))
    quotas = apportion(votes, seats).select(F.col("part").alias("group"), F.col("quota").alias("seats"))
    quotas = stage(quotas, "source-quotas")

    found = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).drop(sources["source"], "group")
    draw = _drawn(seed, "id", "size")
    found = found.withColumns({"draw": draw, "shard": F.pmod(_number(draw), F.col("shards"))})
    words = found.filter("size > 0")
    of_shard = words.groupBy("number", "shard").agg(F.sum("size").alias("shard_size"))
    of_shard = stage(of_shard, "mix-shards")
    of_shards = of_shard.select(
        F.col("number").alias("group"), F.col("shard").alias("part"), F.col("shard_size").cast("double").alias("votes")
    )
    given = apportion(of_shards, quotas).select(F.col("group").alias("number"), F.col("part").alias("shard"), "quota")
    shard = of_shard.join(given, ["number", "shard"]).withColumn(
        "blocks", F.greatest(F.floor(F.col("shard_size") / block_words + 0.5), F.lit(1).cast("bigint"))
    )
    quota = F.least("quota", most * F.col("blocks"))
    first = F.pmod(_number(_drawn(seed, "number", "shard")), F.col("blocks"))
    shard = shard.select(
        "number", "shard", "shard_size", "blocks", F.expr(f"least(quota, {most} * blocks) div blocks").alias("passes"),
        F.pmod(quota, F.col("blocks")).alias("more"), first.alias("first"),
    )

    # The last block ends with the shard, so it may be half a block shorter or longer.
    place = lambda block: F.when(block >= F.col("blocks"), F.col("shard_size")).otherwise(block * block_words)
    until = F.col("first") + F.col("more")
    runs = shard.select(
        "number", "shard", "passes",
        place(F.col("first")).alias("run_start"),
        place(until).alias("run_end"),
        F.when(until > F.col("blocks"), place(until - F.col("blocks"))).otherwise(0).alias("around"),
    )
    along = Window.partitionBy("number", "shard").orderBy("draw", "id", "size")
    placed = words.withColumn("start", F.sum("size").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    placed = placed.join(runs, ["number", "shard"])
    inside = lambda word: F.greatest(F.least(word - F.col("start"), F.col("size")), F.lit(0).cast("bigint"))
    spans = F.array(
        F.struct(F.lit(0).cast("bigint").alias("start"), inside(F.col("around")).alias("end")),
        F.struct(inside(F.col("run_start")).alias("start"), inside(F.col("run_end")).alias("end")),
    )
    columns = ["id", "source", "size", "source_size", "target"]
    taken = placed.select(*columns, "passes", F.filter(spans, lambda s: s["start"] < s["end"]).alias("spans"))
    nothing = found.filter("size = 0").select(
        *columns, F.lit(0).cast("bigint").alias("passes"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
    )
    return taken.unionByName(nothing).withColumnRenamed("id", id).withColumnRenamed("source", source)


def words_taken(size: Column, passes: Column, spans: Column) -> Column:
    """How many words a row of ``mix_sources`` takes, repeats counted."""
    none = F.lit(0).cast("bigint")
    return passes * size + F.aggregate(spans, none, lambda sum, s: sum + s["end"] - s["start"])
