"""Incremental loads: streams that drain what is there and stop."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orebelt.sources.files import Layouts, file_layouts, infer_raw_schema, layout_log, read_by_name

POLL_SECONDS = 0.05
ADDED = "rows_added"  # an observation of its own: what a source reads may be lines that are no rows


def read_files_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    sep: str = "\t",
    glob: str | None = None,
    encoding: str = "UTF-8",
    max_files: int | None = None,
    max_bytes: str | None = None,
    metadata: bool = False,
    layouts: Layouts | None = None,
) -> DataFrame:
    """Delimited files as a stream: each run of a checkpoint reads only files it has not seen.

    Columns are matched by name, as in ``read_delimited``. A file is known by its path, so a corrected file has to land in a folder of its own
    (``batch=N/``); rewritten in place it is ignored. ``max_files`` or ``max_bytes`` cut a large
    backlog into several micro-batches, which bounds what a failure repeats. ``layouts`` are the headers
    known so far, see ``file_layouts``; without them every file is opened at its head.
    """
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return read_by_name(
        reader, spark, path, schema, sep=sep, glob=glob, encoding=encoding, metadata=metadata, layouts=layouts
    )


def read_table_stream(spark: SparkSession, name: str) -> DataFrame:
    """A stored table as a stream of the rows appended to it."""
    return spark.readStream.table(name)


@dataclass
class Run:
    """What a drained stream has done: rows and observed counts, added up over its micro-batches."""

    query: StreamingQuery
    schema: T.StructType
    kept: int  # how much of its progress the query keeps
    rows: int = 0
    micro_batches: int = 0
    observed: dict[str, Counter] = field(default_factory=dict)
    last: int | None = None

    def take(self) -> None:
        """Add the progress that has come up since."""
        recent = [p for p in self.query.recentProgress if self.last is None or p.batchId > self.last]
        if recent and (recent[0].batchId > self.last + 1 if self.last is not None else len(recent) >= self.kept):
            raise RuntimeError("micro-batches went by faster than their counts could be read")
        for progress in recent:
            self.last = progress.batchId
            self.micro_batches += progress.numInputRows > 0
            for name, counts in progress.observedMetrics.items():
                self.observed.setdefault(name, Counter()).update(counts.asDict())
        self.rows = self.observed.get(ADDED, Counter())["rows"]

    def wait(self) -> None:
        """Until the query has ended; its micro-batches are counted also where it fails."""
        ended = False
        try:
            while not ended:
                ended = self.query.awaitTermination(POLL_SECONDS)
                self.take()
        except StreamingQueryException:
            self.take()
            raise

    def follow(self, earlier: "Run") -> None:
        """Count what an earlier query of the same run has done, too."""
        self.rows += earlier.rows
        self.micro_batches += earlier.micro_batches
        for name, counts in earlier.observed.items():
            self.observed.setdefault(name, Counter()).update(counts)


def _start(
    df: DataFrame, target: str, checkpoint: str, table: str | None, partition_by: tuple[str, ...]
) -> Run:
    writer = (
        df.observe(ADDED, F.count(F.lit(1)).alias("rows"))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    kept = int(df.sparkSession.conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    return Run(writer.toTable(table) if table else writer.start(), df.schema, kept)


def append_stream(
    df: DataFrame,
    target: str,
    checkpoint: str,
    *,
    table: str | None = None,
    partition_by: tuple[str, ...] = (),
) -> Run:
    """Append everything available to the Parquet files at ``target``, wait, return what was done.

    Each input file is written exactly once: the checkpoint records progress and the sink
    records the files of each finished micro-batch. ``table`` also registers the target in the
    catalog; its columns are then fixed. Leave it out for a source whose columns grow, and read
    the target with ``read_appended`` or register it with ``register_files``.

    Counts are taken from each micro-batch as it ends, so nothing grows with their number.
    """
    run = _start(df, target, checkpoint, table, partition_by)
    run.wait()
    return run


def load_files(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    *,
    schema: T.StructType | None = None,
    sep: str = "\t",
    glob: str | None = None,
    encoding: str = "UTF-8",
    max_files: int | None = None,
    max_bytes: str | None = None,
    table: str | None = None,
    transform: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> Run:
    """Append the delimited files that no earlier run has seen to ``target``, each by its own header.

    Headers and columns are kept next to the checkpoint, and only files that are new there are opened
    for theirs. Without a ``schema`` the columns are all that have come up so far. A file with another
    header that lands while the run is under way fails the micro-batch that holds it before any row of
    that is kept; its header is then taken in, and the run goes on from the micro-batch before. With a
    ``table``, whose columns are fixed, give the ``schema``.
    """
    remember = f"{checkpoint}_schema"
    done: list[Run] = []
    while True:
        layouts = file_layouts(spark, path, glob=glob, encoding=encoding, log=layout_log(remember))
        columns = schema
        if columns is None:
            columns = infer_raw_schema(spark, path, sep=sep, glob=glob, encoding=encoding, remember=remember, layouts=layouts)
        raw = read_files_stream(
            spark, path, columns, sep=sep, glob=glob, encoding=encoding, max_files=max_files, max_bytes=max_bytes,
            metadata=True, layouts=layouts,
        )
        run = _start(transform(raw), target, checkpoint, table, ())
        done.append(run)
        try:
            run.wait()
        except StreamingQueryException:
            # Another try helps only if it was a file whose header has not been looked at.
            again = file_layouts(spark, path, glob=glob, encoding=encoding, log=layout_log(remember))
            if again.files.count() == layouts.files.count():
                raise
            continue
        for earlier in done[:-1]:
            run.follow(earlier)
        return run


def read_appended(
    spark: SparkSession, target: str, schema: T.StructType | None = None
) -> DataFrame:
    """The files of ``append_stream``; columns added later are NULL in earlier rows.

    Without a schema the columns of all files are merged, which opens every file's footer; give
    the schema where it is known.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(target)
    return spark.read.option("mergeSchema", "true").parquet(target)


def rows_added(run: Run) -> int:
    """Rows that a finished run has added; 0 if nothing new had arrived."""
    return run.rows
