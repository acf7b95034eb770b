"""Delimited text, JSON documents and the file inventory."""

from __future__ import annotations

import codecs
import csv
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from orebelt.functions.columns import clean_column_names, quoted
from orebelt.functions.text import thousands
from orebelt.session import list_folder, literal_rows, path_exists

ENTRY_NAME = r"([^/]+)/?$"
REMEMBERED = {"version": "int", "place": "int", "name": "string"}


UNKNOWN_LAYOUT = "a file has landed whose header is not known yet"

# A separator and a quote that no text has: every line is then one column.
WHOLE_LINES = {"sep": "\u0001", "quote": "", "header": "false"}


def _selected(glob: str | None, encoding: str) -> dict[str, str]:
    return {"encoding": encoding} | ({"pathGlobFilter": glob} if glob else {})


LOGGED = "file string, header string, modified bigint"
HEAD_BYTES = 1 << 13
HEADS_AT_ONCE = 16
LONGEST_HEADER = 16 << 20


@dataclass(frozen=True)
class Layouts:
    """Which header each file has, and the distinct headers in the order in which they came up."""

    files: DataFrame
    headers: list[str]


def first_line(spark: SparkSession, file: str, encoding: str = "UTF-8") -> str | None:
    """The first line of a file that is not blank, from as many bytes as that takes; compressed ones are unpacked."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    stream = place.getFileSystem(conf).open(place)
    try:
        source = stream if codec is None else codec.createInputStream(stream)
        decode, text, ended = codecs.getincrementaldecoder(encoding)(), "", False
        while not ended:
            block = bytes(source.readNBytes(HEAD_BYTES))
            ended = len(block) < HEAD_BYTES
            text += decode.decode(block, ended)
            lines = re.split(r"\r\n|\r|\n", text.removeprefix("\ufeff"))
            # The last line may go on in the next block.
            for line in lines if ended else lines[:-1]:
                if line.strip():
                    return line
            if len(text) > LONGEST_HEADER:
                raise ValueError(f"no line ends within the first {LONGEST_HEADER} characters of {file}")
        return None
    finally:
        stream.close()


def file_layouts(
    spark: SparkSession, path: str, *, glob: str | None = None, encoding: str = "UTF-8", log: str | None = None
) -> Layouts:
    """The headers of the files at ``path``; a file is opened once, and only at its head.

    ``log`` is a folder that keeps what is known of files between calls, for one ``path`` and ``glob``: the listing is
    held against it, and only files that it lacks are opened. Listing and heads take no task that reads
    text; the driver opens some files at a time, as it does to list them, and sees paths of new files only.
    A file is known by its path.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listed = reader.load(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.unix_micros("_metadata.file_modification_time").alias("modified"),
    )
    logged = log is not None and path_exists(spark, log)
    if logged:
        listed = listed.join(spark.read.schema(LOGGED).parquet(log).select("file"), "file", "left_anti")
    new = sorted((row.modified, row.file) for row in listed.collect())
    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        heads = list(pool.map(lambda entry: first_line(spark, entry[1], encoding), new))
    if log is None:
        return Layouts(_layout_rows(spark, new, heads), list(dict.fromkeys(h for h in heads if h is not None)))
    if new or not logged:
        _layout_rows(spark, new, heads).coalesce(1).write.mode("append").parquet(log)
    files = spark.read.schema(LOGGED).parquet(log)
    return Layouts(files, distinct_headers(files))


def _layout_rows(spark: SparkSession, entries: list[tuple[int, str]], headers: list[str | None]) -> DataFrame:
    table = pa.table(
        [
            pa.array([file for _, file in entries], pa.string()),
            pa.array(headers, pa.string()),
            pa.array([modified for modified, _ in entries], pa.int64()),
        ],
        names=["file", "header", "modified"],
    )
    return spark.createDataFrame(table)


def header_names(header: str, sep: str) -> list[str]:
    """Column names of a header line, stripped; a name that stands twice is an error."""
    names = [name.strip() for name in next(csv.reader([header], delimiter=sep))]
    if len(set(names)) < len(names):
        raise ValueError(f"a header has the same name twice: {header!r}")
    return names


def distinct_headers(files: DataFrame) -> list[str]:
    """The distinct header lines, in the order in which they came up; as many as there are layouts."""
    first = files.filter("header IS NOT NULL").groupBy("header").agg(F.min(F.struct("modified", "file")).alias("first"))
    return [row.header for row in first.orderBy("first").collect()]


def read_by_name(
    reader: DataFrameReader | DataStreamReader,
    spark: SparkSession,
    path: str,
    schema: T.StructType | None,
    *,
    sep: str,
    glob: str | None,
    encoding: str,
    metadata: bool = False,
    layouts: Layouts | None = None,
) -> DataFrame:
    """The columns of ``schema`` (default: all there are), looked up by name in each file's header.

    A column that a file doesn't have is NULL in its rows. As long as all files have the same header,
    they are read as they are, and a file with another one that ``layouts`` does not know is an error. Otherwise
    lines are read, joined to the header of their file, and taken apart by the layout that it gives;
    the file's hidden ``_metadata`` column gets lost in the join, unless ``metadata`` makes it a visible
    one, which ``with_lineage`` takes away again.
    """
    known = layouts or file_layouts(spark, path, glob=glob, encoding=encoding)
    layouts = known.headers
    found = list(dict.fromkeys(name for header in layouts for name in header_names(header, sep)))
    names = schema.names if schema is not None else found
    text = lambda columns: T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if len(layouts) < 2:
        raw = next(csv.reader(layouts, delimiter=sep)) if layouts else names
        options = {"header": "true", "sep": sep, "enforceSchema": "false", **_selected(glob, encoding)}
        df = reader.options(**options).schema(text(raw)).csv(path)
        df = clean_column_names(df)
        own, more = header_names(layouts[0], sep) if layouts else names, df.columns[len(raw) :]
        return df.select(
            *[F.col(quoted(n)) if n in own else F.lit(None).cast("string").alias(n) for n in names], *map(quoted, more)
        )

    lines = reader.options(**WHOLE_LINES, **_selected(glob, encoding)).schema("line string").csv(path)
    more = [c for c in lines.columns if c != "line"]
    lines = lines.select("line", *map(quoted, more), "_metadata", F.col("_metadata.file_path").alias("_file"))
    of_file = known.files.select(F.col("file").alias("_file"), F.col("header").alias("_header")).distinct()
    joined = lines.join(of_file, "_file", "left").filter(~F.col("line").eqNullSafe(F.col("_header")))
    # One column per layout: a field taken off ``from_csv`` itself would take the line apart once per field.
    rows, fields = [], {name: [] for name in names}
    for place, header in enumerate(layouts):
        own = header_names(header, sep)
        row = F.from_csv("line", ", ".join(f"{quoted(n)} string" for n in own), {"sep": sep})
        rows.append(F.when(F.col("_header") == header, row).alias(f"_row_{place}"))
        for name in set(own).intersection(names):
            fields[name].append(F.col(f"_row_{place}")[name])
    unknown = F.raise_error(F.concat(F.lit(f"{UNKNOWN_LAYOUT}: "), F.col("_file"))).cast("string")
    none = F.when(F.col("_header").isNull(), unknown)
    parsed = joined.select("_file", "_header", "_metadata", *map(quoted, more), *rows)
    return parsed.select(
        *[F.coalesce(*fields[n], none).alias(n) for n in names], *map(quoted, more), *["_metadata"][:metadata]
    )


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    sep: str = "\t",
    glob: str | None = None,
    encoding: str = "UTF-8",
    metadata: bool = False,
    layouts: Layouts | None = None,
) -> DataFrame:
    """Text files with a header row, all columns as strings, padding kept, names stripped.

    ``glob`` selects files by base name. Columns are matched by name; without a schema they are
    those of all headers. A file without a column gives NULL for it. ``metadata=True`` where
    ``with_lineage`` follows and files may differ in layout. ``layouts`` saves looking at the files, see
    ``file_layouts``.
    """
    return read_by_name(
        spark.read, spark, path, schema, sep=sep, glob=glob, encoding=encoding, metadata=metadata, layouts=layouts
    )


def infer_raw_schema(
    spark: SparkSession,
    path: str,
    *,
    sep: str = "\t",
    glob: str | None = None,
    encoding: str = "UTF-8",
    remember: str | None = None,
    layouts: Layouts | None = None,
) -> T.StructType:
    """All-string schema from the headers of all files, names stripped, in order of appearance.

    ``remember`` is a folder that keeps the schema between runs, as a stream needs one: columns
    known from earlier runs keep their place and new ones are added at the end. It also keeps the log
    of ``file_layouts``, so that a run opens only files that are new.
    """
    log = None if remember is None else layout_log(remember)
    found = layouts or file_layouts(spark, path, glob=glob, encoding=encoding, log=log)
    layouts = found.headers
    if not layouts:
        raise FileNotFoundError(f"no file to infer a schema from: {path} (glob {glob})")
    version, known = remembered_columns(spark, remember) if remember else (0, [])
    columns = list(dict.fromkeys([*known, *(n for header in layouts for n in header_names(header, sep))]))
    if remember and columns != known:
        rows = [(version + 1, place, name) for place, name in enumerate(columns)]
        literal_rows(spark, rows, REMEMBERED).write.mode("append").json(remember)
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def layout_log(remember: str) -> str:
    """Where the files known to a remembered schema are logged; Spark does not read it as part of the schema."""
    return f"{remember}/_files"


def remembered_columns(spark: SparkSession, location: str) -> tuple[int, list[str]]:
    """Version and column names kept by ``infer_raw_schema``; ``(0, [])`` before the first run.

    Versions are only ever added, so a run that fails while it adds one leaves the last in place.
    """
    schema = ", ".join(f"{name} {kind}" for name, kind in REMEMBERED.items())
    try:
        rows = spark.read.schema(schema).json(location).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0, []
        raise
    version = max((row["version"] for row in rows), default=0)
    current = sorted((r["place"], r["name"]) for r in rows if r["version"] == version)
    return version, [name for _, name in current]


def read_json_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    multi_line: bool = True,
) -> DataFrame:
    """JSON documents: one per file, over any number of lines, or one per line.

    A schema saves the pass that infers one. Files of one document each are the unit of work, so
    keep documents bounded; ``multi_line=False`` reads splittable files.
    """
    reader = spark.read.option("multiLine", str(multi_line).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def file_inventory(spark: SparkSession, path: str, *, glob: str | None = None) -> DataFrame:
    """``(path, name, bytes, modified)`` of every file below ``path``; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path",
        F.regexp_extract("path", ENTRY_NAME, 1).alias("name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def inventory_by_folder(inventory: DataFrame) -> DataFrame:
    """Files and bytes per folder, with the bytes as ``1,234,567`` too."""
    return (
        inventory.groupBy(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"))
        .agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
        .withColumn("size_label", thousands(F.col("bytes")))
    )


def latest_file(spark: SparkSession, path: str, suffix: str = ".json") -> str:
    """Path of the entry directly below ``path`` with the greatest name ending in ``suffix``.

    The entry is a file, or a folder that Spark wrote under such a name. Only ``path`` is listed.
    """
    entries = {entry.rsplit("/", 1)[-1]: entry for entry in list_folder(spark, path)}
    names = [name for name in entries if name.endswith(suffix)]
    if not names:
        raise FileNotFoundError(f"no snapshot ending in {suffix!r} in {path}")
    return entries[max(names)]
