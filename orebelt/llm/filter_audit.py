"""What filters remove in every order: masks of failures, folded over all orders by higher-order functions.

1. Every document gets a mask with a bit for each filter that it fails. Rows of equal part and mask
   become one cell with its counts, so what follows does not grow with the documents.
2. Each cell folds across the array of all orders: ``transform`` takes an order, ``aggregate`` walks its
   filters while the cell is still there, and every step gives a struct of the cell's counts. Five
   filters make 120 orders and 600 structs.
3. The structs of a part are merged by sums, element by element.

Defined cases: a null text is an empty one; a null part is the empty string; a text without words has no
repeated words; a label table that names a document twice marks it if any row does; rows that repeat an
id are documents of their own, of which none is an earlier copy of the other; a row without an id is
never a copy, no copy of it is, and it has no label; very long texts are counted as a whole; equal texts are ties that
only the ids break; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
COPY = "E"  # the filter that looks at other documents


def failures(text: Column) -> dict[str, Column]:
    """The filters that look at a text alone, as conditions for failing them."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals.cast("bigint") > 10 * F.length(text),
        "D": F.regexp_like(text, F.lit(r"[#$%&*|]")),
    }


def _bits(conditions: Mapping[str, Column], letters: str) -> Column:
    return sum((c.cast("int") * (1 << letters.index(name)) for name, c in conditions.items()), F.lit(0))


def failure_cells(
    docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents of a part that fail the same filters, and their labels.

    Copies are told by aggregates alone: the rows of a text are counted by part, mask and label together
    with their least id, and only those counts meet, so a text that a third of the rows have is a few rows.
    """
    own = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id).cast("bigint").alias("id"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.sha2(own, 256).alias("copy_of"),
        _bits(failures(own), "ABCD").alias("mask"),
    )
    rows = rows.groupBy("id", "part", "copy_of", "mask").agg(F.count("*").alias("n"))
    marks = labels.groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    rows = rows.join(marks, "id", "left").select("id", "part", "copy_of", "mask", "n", zero("good"), zero("toxic"))

    lost = F.col("id").isNull()
    alike = rows.groupBy("copy_of", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(lost, F.col("n")).otherwise(0)).alias("lost"),
        F.min(F.when(~lost, F.struct("id", "n"))).alias("least"),
    )
    first = F.min("least.id").over(Window.partitionBy("copy_of"))
    alike = alike.withColumn("first", F.col("lost") + F.when(F.col("least.id") == first, F.col("least.n")).otherwise(0))
    copies = F.col("n") - F.col("first")
    kinds = F.array(
        F.struct("mask", F.col("first").alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), copies.alias("n")),
    )
    cells = alike.select("part", "good", "toxic", F.inline(kinds)).filter("n > 0")
    return cells.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )


def _folded(letters: str) -> Column:
    """The steps of all orders for the cell of a row, one struct after the other."""
    one = lambda name: F.struct(F.lit(name).alias("letter"), F.lit(1 << letters.index(name)).alias("bit"))
    orders = F.array(
        *[F.struct(F.lit("".join(o)).alias("name"), F.array(*map(one, o)).alias("filters")) for o in permutations(letters)]
    )
    counts = ",".join(f"{c}:bigint" for c in COUNTS)
    nothing = F.array().cast(f"array<struct<order:string,step:int,letter:string,{counts}>>")

    def along(order: Column) -> Column:
        def walk(state: Column, each: Column) -> Column:
            there, fails = state["there"], F.col("mask").bitwiseAND(each["bit"]) != 0
            weighted = lambda hit, weight, name: F.when(hit, F.col(weight)).otherwise(0).alias(name)
            made = F.struct(
                order["name"].alias("order"),
                (F.size(state["made"]) + 1).alias("step"),
                each["letter"].alias("letter"),
                weighted(there & ~fails, "n", "kept"),
                weighted(there & fails, "n", "removed"),
                weighted(~there & fails, "n", "redundant"),
                weighted(F.col("mask") == each["bit"], "n", "unique_fails"),
                weighted(there & fails, "good", "good_lost"),
                weighted(there & fails, "toxic", "toxic_lost"),
            )
            return F.struct((there & ~fails).alias("there"), F.array_append(state["made"], made).alias("made"))

        start = F.struct(F.lit(True).alias("there"), nothing.alias("made"))
        return F.aggregate(order["filters"], start, walk, lambda state: state["made"])

    return F.flatten(F.transform(orders, along))


def fold_orders(cells: DataFrame, letters: str) -> DataFrame:
    """Per part, order and step the counts of ``cells(part, mask, n, good, toxic)``; bit ``i`` is ``letters[i]``.

    ``shapley`` is what a filter removes, summed over all orders at whatever step it stands.
    """
    made = cells.select("part", F.inline(_folded(letters)))
    sums = made.groupBy("part", "order", "step", "letter").agg(*[F.sum(c).alias(c) for c in COUNTS])
    # A part has each filter once per order: 120 rows for five filters.
    of_filter = Window.partitionBy("part", "letter")
    return sums.withColumn("shapley", F.sum("removed").over(of_filter)).select(
        "part", F.col("order").alias("filter_order"), "step", *COUNTS, "shapley"
    )


def audit_filters(
    docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """``(part, filter_order, step, ...)``: what the five filters do to each part, in every order.

    A: under 100 words; B: under 80 % of the words differ; C: over 10 % capitals; D: one of ``#$%&*|``;
    E: the text of a smaller id, wherever that stands and whether or not it is removed.
    """
    return fold_orders(failure_cells(docs, labels, id=id, text=text, part=part), "ABCD" + COPY)
