"""Large JSON documents, each read by several tasks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebelt.functions.columns import explode_records
from orebelt.sources.files import HEADS_AT_ONCE, read_json_documents

EDGE_BYTES = 1 << 16  # of a document, at either end, that are read first
MOST_EDGE_BYTES = 1 << 24

TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]|[^\s{}\[\]:,"]+', re.S)
NEXT_RECORD = re.compile(r"\s*,\s*\{")
IN_ARRAY = object()


@dataclass(frozen=True)
class Outline:
    """What a document has around its records, and what stands between two of them."""

    file: str
    head: str = ""  # up to the bracket of the records
    last: str = ""  # the last record without its first brace
    rest: str = ""  # from the bracket that closes them
    separator: str | None = None  # from the brace that ends a record to the one that begins the next


def array_start(text: str, path: Sequence[str]) -> int | None:
    """Where the array at ``path`` begins, behind its bracket; None if that is not within ``text``."""
    opened: list = []
    key = last = None
    end = 0
    for found in TOKEN.finditer(text):
        if text[end : found.start()].strip():
            return None  # a token that is cut off
        token, end = found.group(), found.end()
        if token == "{":
            opened.append(key)
            key = None
        elif token == "[":
            if [*opened[1:], key] == list(path):
                return end
            opened.append(IN_ARRAY)
            key = None
        elif token in "}]":
            if not opened:
                return None
            opened.pop()
            key = None
        elif token == ",":
            key = None
        elif token == ":":
            key = last
        elif token[0] == '"':
            last = json.loads(token)
    return None


def _edge(spark: SparkSession, file: str, size: int, last: bool) -> Iterator[tuple[str, bool]]:
    """The first, or last, bytes of a file as text, more each time, and whether that is all of it."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    count = EDGE_BYTES
    while True:
        stream = files.open(place)
        try:
            stream.seek(max(0, size - count) if last else 0)
            # A character that the cut has gone through is left out.
            yield bytes(stream.readNBytes(count)).decode(errors="ignore"), count >= size
        finally:
            stream.close()
        if count >= min(size, MOST_EDGE_BYTES):
            return
        count *= 4


def outline(spark: SparkSession, file: str, size: int, path: Sequence[str]) -> Outline:
    """How a document can be cut, from its two ends alone; without a separator it can't."""
    decoder, head, separator = json.JSONDecoder(), None, None
    if re.search(r"\.(gz|bz2|zst|snappy|lz4|deflate)$", file):
        return Outline(file)
    for text, _ in _edge(spark, file, size, False):
        start = array_start(text, path)
        if start is None:
            continue
        try:
            first = start + len(text[start:]) - len(text[start:].lstrip())
            _, end = decoder.raw_decode(text, first)
        except ValueError:
            continue
        found = NEXT_RECORD.match(text, end) if text[first] == "{" else None
        if found:
            head, separator = text[:start], "}" + found.group()
            break
    if separator is None or separator in head:
        return Outline(file)
    for text, _ in _edge(spark, file, size, True):
        at = text.rfind(separator)
        if at < 0:
            continue
        text = text[at + len(separator) :]
        try:
            _, end = decoder.raw_decode("{" + text)
            json.loads(head + text[end - 1 :])
        except ValueError:
            return Outline(file)
        return Outline(file, head, text[: end - 1], text[end - 1 :], separator)
    return Outline(file)


def read_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    records: str,
    *,
    keep: Sequence[str] = (),
    alias: str = "record",
) -> DataFrame:
    """The rows of ``explode_records(read_json_documents(path, schema), records, keep=keep)``, a document by several tasks.

    The array at ``records`` is cut where a record ends and the next begins, in the way in which the first two
    of the document are set apart. A task reads a range of bytes, as of any text. What stands around the records
    is read on the driver, at the two ends of the file, and gives the ``keep`` columns. A document that can't be cut like that
    (fewer than two records, records that are no objects, compressed) is read whole. If the text between two records
    stands elsewhere, too, within a record or between those of an array behind, a piece is no record: the job then
    ends with an error, and ``read_json_documents`` is what reads the file. Documents are UTF-8, one per file.
    """
    kind = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    listed = spark.read.format("binaryFile").load(path).select("_metadata.file_path", "length")
    files = [(r.file_path, r.length) for r in listed.collect()]
    parts = records.split(".")
    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        outlines = list(pool.map(lambda file: outline(spark, *file, parts), files))
    frames = []
    for separator in sorted({o.separator for o in outlines if o.separator}):
        frames.append(_cut(spark, [o for o in outlines if o.separator == separator], kind, parts, keep, alias))
    whole = [unquote(o.file) for o in outlines if o.separator is None]
    if whole or not frames:
        documents = read_json_documents(spark, whole or path, kind)
        frames.append(explode_records(documents, records, keep=keep, alias=alias))
    return reduce(DataFrame.unionByName, frames)


def _cut(
    spark: SparkSession, own: list[Outline], schema: T.StructType, parts: list[str], keep: Sequence[str], alias: str
) -> DataFrame:
    of_array = reduce(lambda kind, name: kind[name].dataType, parts, schema)
    edges = [(o.file, o.head, o.last, o.last + o.rest, o.head + o.rest) for o in own]
    names = ["_file", "_head", "_last", "_end", "_around"]
    about = spark.createDataFrame(pa.table([pa.array(c, pa.string()) for c in zip(*edges)], names=names))
    text = spark.read.option("lineSep", own[0].separator).text([unquote(o.file) for o in own])
    text = text.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"))
    met = text.join(about, "_file")
    first = (F.col("_at") == 0) & F.col("value").startswith(F.col("_head"))
    body = F.when(first, F.substring("value", F.length("_head") + 1, F.length("value")))
    last = F.col("value") == F.col("_end")
    body = body.when(last, F.concat(F.lit("{"), "_last")).otherwise(F.concat(F.lit("{"), "value"))
    ended = F.when(last, "").otherwise("}")
    # In two brackets, so that a piece that closes one is an error.
    found = F.from_json(F.concat(F.lit("[["), body, ended, F.lit("]]")), T.ArrayType(of_array), {"mode": "FAILFAST"})
    around = F.from_json("_around", schema)
    rows = met.select(F.explode(F.flatten(found)).alias(alias), around.alias("_document"))
    return rows.select(alias, *[F.col(f"_document.{c}").alias(c.split(".")[-1]) for c in keep])
