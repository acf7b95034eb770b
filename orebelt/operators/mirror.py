"""Keep a target listing identical to a source listing, as joins over the two sets of names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebelt.functions.text import link_names

UPLOADED, ERROR, DELETED = "uploaded", "error", "deleted"


def extract_links(
    pages: DataFrame, html: str, prefix: str, *, attribute: str = "HREF", keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row ``(keep..., name)`` per link under ``prefix``; duplicates stay, as listed."""
    names = link_names(F.col(html), prefix, attribute)
    return pages.select(*keep, F.explode(names).alias("name"))


def refuse_empty(listing: DataFrame) -> None:
    """Stop a sync that would delete every target entry; stops reading at the first listed name."""
    if listing.isEmpty():
        raise ValueError("the source listing is empty; syncing it would delete every target entry")


def mirror(
    source: DataFrame,
    target: DataFrame,
    key: str,
    *,
    fetched: str = "fetched",
    listed: str | None = None,
    deletions: DataFrame | None = None,
    deleted: str = "deleted",
    allow_empty_source: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Plan one sync run: ``(next_target, actions)``.

    ``source`` has one row per listed name: the key, the boolean ``fetched`` and the target's
    remaining columns. ``target`` is a set: a row that stands there twice counts once, and two
    entries of one key are an error. Every fetched name replaces its
    target entry, a name whose fetch failed keeps the entry it has, and an entry that is no
    longer listed goes away.

    A name listed several times counts once per listing entry in ``actions`` and is stored once:
    duplicates are summed up on the map side before the join, so it does not matter how often a
    name occurs. ``listed`` names a column that says how many entries a row stands for. Carry
    references or sizes rather than file bytes, as rows pass a shuffle; both results run the join,
    so ``stage`` a source that is costly to compute.

    Without ``deletions`` every entry that is no longer listed counts as deleted: that is the plan. Once
    it has been carried out, ``deletions`` tells how: the key and the boolean ``deleted`` of each entry that was
    tried, any number of times. An entry that no row says to be gone stays in the target, counts as an error, and is
    planned again by the next run; outcomes of entries that are still listed say nothing.

    An empty listing would delete the whole target, so it is an error unless allowed.
    """
    if not allow_empty_source:
        refuse_empty(source)
    payload = [name for name in target.columns if name != key]
    entries = F.lit(1).cast("bigint") if listed is None else F.col(listed).cast("bigint")
    loaded = F.coalesce(F.col(fetched), F.lit(False))
    # Counts and distinct entries are hash aggregates; only what differs per name is compared.
    named = source.groupBy(key).agg(
        F.sum(F.when(loaded, entries).otherwise(0)).alias("_fetched"),
        F.sum(F.when(loaded, 0).otherwise(entries)).alias("_failed"),
    )
    fresh = source.filter(loaded).select(key, *payload).distinct()
    fresh = fresh.groupBy(key).agg(F.max(F.struct(*payload)).alias("_new"))
    stored = target.select(key, *payload).distinct().groupBy(key).agg(
        F.max(F.struct(*payload)).alias("_old"), F.count("*").alias("_copies")
    )
    message = F.concat(F.lit(f"two target entries with {key} "), F.col(key).cast("string"))
    one = F.when(F.col("_copies") > 1, F.raise_error(message)).otherwise(F.col(key))
    stored = stored.select(one.alias(key), "_old")
    both = named.join(fresh, key, "left").join(stored, key, "full_outer")
    unlisted = F.col("_fetched").isNull()
    gone = F.lit(True)
    if deletions is not None:
        tried = deletions.groupBy(key).agg(F.bool_or(deleted).alias("_deleted"))
        both = both.join(tried, key, "left")
        gone = F.coalesce(F.col("_deleted"), F.lit(False))
    once = lambda hit: F.when(hit, F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    outcomes = F.array(
        F.struct(F.lit(UPLOADED).alias("action"), F.col("_fetched").alias("entries")),
        F.struct(
            F.lit(ERROR).alias("action"), F.coalesce("_failed", once(unlisted & ~gone)).alias("entries")
        ),
        F.struct(F.lit(DELETED).alias("action"), once(unlisted & gone).alias("entries")),
    )
    actions = both.select(key, F.inline(outcomes)).filter(F.col("entries") > 0)

    kept = F.when(F.col("_fetched") > 0, F.col("_new")).when(~unlisted | ~gone, F.col("_old"))
    next_target = (
        both.select(key, kept.alias("_entry")).filter(F.col("_entry").isNotNull()).select(key, "_entry.*")
    )
    return next_target.select(*target.columns), actions


def sync_stats(actions: DataFrame) -> DataFrame:
    """One row ``(uploaded, deleted, errors)``."""

    def total(action: str):
        return F.coalesce(F.sum(F.when(F.col("action") == action, F.col("entries"))), F.lit(0))

    return actions.agg(
        total(UPLOADED).alias("uploaded"), total(DELETED).alias("deleted"), total(ERROR).alias("errors")
    )
