"""Named row rules: drop what fails, count what passed, keep an audit trail.

A rule is SQL text over the frame's columns, e.g. ``{"valid_year": "year IS NOT NULL"}``. A rule
that comes out NULL counts as failed.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.functions.columns import quoted
from orebelt.session import literal_rows, path_exists

Rules = Mapping[str, str]


def expect_or_drop(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep the rows that satisfy every rule.

    The rules go into the filter as they are written: a filter drops NULL like false, and a bare
    predicate can still be pushed into the scan.
    """
    return df.filter(reduce(and_, map(F.expr, rules.values()), F.lit(True)))


def _counters(rules: Rules) -> list[Column]:
    passed = [
        F.count_if(F.coalesce(F.expr(rule), F.lit(False))).alias(f"passed_{name}")
        for name, rule in rules.items()
    ]
    return [F.count(F.lit(1)).alias("total"), *passed]


def dq_report(df: DataFrame, rules: Rules) -> DataFrame:
    """``(rule, passed, dropped)`` for every rule, all from one pass and one partial aggregate.

    Rules are counted independently of each other, so ``passed + dropped`` is always the total.
    """
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(quoted(f"passed_{name}")).alias("passed"),
            (F.col("total") - F.col(quoted(f"passed_{name}"))).alias("dropped"),
        )
        for name in rules
    ]
    return df.agg(*_counters(rules)).select(F.inline(F.array(*rows)))


def observe_rules(df: DataFrame, name: str, rules: Rules) -> DataFrame:
    """Count the rules while the rows flow by, with no pass of its own.

    Put it before ``expect_or_drop``; read the counts with ``observed_report`` once the stream
    has drained.
    """
    return df.observe(name, *_counters(rules))


def observed_report(
    spark: SparkSession, observed: Mapping[str, Mapping[str, int]], name: str, rules: Rules
) -> DataFrame:
    """The same rows as ``dq_report``, from what a run has ``observed`` (see ``append_stream``)."""
    seen = observed.get(name, {})
    total = seen.get("total", 0)
    rows = [(rule, seen.get(f"passed_{rule}", 0)) for rule in rules]
    return literal_rows(
        spark,
        [(rule, passed, total - passed) for rule, passed in rows],
        {"rule": "string", "passed": "bigint", "dropped": "bigint"},
    )


def append_audit(report: DataFrame, target: str, run_id: str, dataset: str) -> None:
    """File a report under its run and dataset.

    A repeated call for the same run replaces the run's rows, so a retried job counts once.
    """
    (
        report.select(
            "rule", "passed", "dropped", F.lit(run_id).alias("run_id"), F.lit(dataset).alias("dataset")
        )
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id", "dataset")
        .parquet(target)
    )


def read_audit(spark: SparkSession, target: str) -> DataFrame:
    schema = "rule string, passed bigint, dropped bigint, run_id string, dataset string"
    return spark.read.schema(schema).parquet(target).select(
        "run_id", "dataset", "rule", "passed", "dropped"
    )


LOAD = "_load"
RUN = "run_id string, after bigint, upto bigint, load bigint"


def _runs(spark: SparkSession, location: str) -> DataFrame | None:
    return spark.read.schema(RUN).json(location) if path_exists(spark, location) else None


def _note(spark: SparkSession, location: str, **values: str | int | None) -> None:
    kinds = dict(field.split() for field in RUN.split(", "))
    literal_rows(spark, [tuple(map(values.get, kinds))], kinds).write.mode("append").json(location)


def begin_load(spark: SparkSession, location: str) -> int:
    """The number of a load that begins, one more than that of the last; noted before it takes any row in."""
    runs = _runs(spark, location)
    last = None if runs is None else runs.agg(F.max("load")).first()[0]
    load = 1 if last is None else last + 1
    _note(spark, location, load=load)
    return load


def run_window(spark: SparkSession, location: str, run_id: str, load: int) -> tuple[int, int]:
    """The loads ``(after, upto]`` that a run accounts for; ``load`` is the one that it has made.

    A run starts where the last other one that has been filed ended, so what a failed run took in is
    counted by its retry or by the next one. A run that is filed again keeps its start, and its end
    too if another has followed. Numbers of loads tell the order, no clock.
    """
    mine = F.col("run_id") == run_id
    row = (
        _runs(spark, location)
        .agg(
            F.count_if(mine).alias("filed"),
            F.min(F.when(mine, F.col("after"))).alias("after"),
            F.max(F.when(mine, F.col("upto"))).alias("upto"),
            F.max(F.when(~mine, F.col("upto"))).alias("others"),
        )
        .first()
    )
    if not row.filed:
        return row.others or 0, load
    followed = row.others is not None and row.others > row.upto
    return row.after, row.upto if followed else load


def file_run(spark: SparkSession, location: str, run_id: str, after: int, upto: int) -> None:
    """Remember the loads of a run whose counts have been filed."""
    _note(spark, location, run_id=run_id, after=after, upto=upto)


def loaded_between(df: DataFrame, after: int, upto: int) -> DataFrame:
    """Rows of the loads ``(after, upto]``; rows without a load are those from before the first."""
    load = F.col(LOAD)
    return df.filter((load > after) & (load <= upto) if after else (load <= upto) | load.isNull())
