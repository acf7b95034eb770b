"""WARC archives written and read by Spark, with an index merged from sorted capture runs.

``write_archives`` writes one record per row through the text sink: a WARC record is text, and the
two line ends that close it are the sink's separator. The files are whole-file gzip members.
No archive has more than ``ARCHIVE_BYTES`` of records, but for one record that is larger by itself.
``read_runs`` reads the archives back, one capture run per file, sorted by URL key and time.
``merge_runs`` cuts the runs at common bounds, and the pieces at further ones of their own, and merges the
k pieces of each range with a loser tree, which gives capture histories in one global order.

Defined cases: a null payload is empty, a null URL is written empty, null ids stay null (such a row
is a response only where its payload has no row with an id), rows with equal ids and payloads are
the same capture and share their record type; captures of equal key, time, id and type (ties) are in order of their
archive and place; a very long payload is a record like others; an empty table gives no archive and no rows. Line
ends in a URL are removed from its header. Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.session import stage

VERSION = "WARC/1.1"
END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
FIRST_CAPTURE = 1_577_836_800  # 2020-01-01, where the table has no capture time
ARCHIVE_BYTES = 256 << 20
HEAD_BYTES = 4096  # of a record besides its payload, more than it ever takes but for its URL
RECORD_CLASSES = (1 << 16, 1 << 20, 1 << 24)  # bytes of a record up to which so many as fit share an archive
ENTRIES_PER_RANGE = 50_000
SAMPLED_KEYS_PER_RANGE = 32
FIRST_RANGES = 512  # into so many the driver cuts at most; further cuts are made where the pieces are

ENTRY = (
    "urlkey string, captured string, record_id bigint, record_type string, refers_to bigint, "
    "payload_bytes bigint, payload_digest string, record_offset bigint, record_length bigint"
)
NAMES = [part.split()[0] for part in ENTRY.split(", ")]


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hex digits are four base32 digits."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def capture_records(
    pages: DataFrame,
    *,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    revisit_bytes: int = 0,
) -> DataFrame:
    """``(id, url, payload, payload_bytes, payload_digest, first)`` per row.

    ``first`` is the smallest id with the same payload, for payloads of ``revisit_bytes`` and more.
    Only digests and ids are grouped; the join back is one that adaptive execution can split.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(id).cast("bigint").alias("id"), F.col(url).alias("url"), payload.alias("payload")
    ).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": base32_sha1(F.col("payload"))}
    )
    firsts = (
        rows.filter(F.col("payload_bytes") >= revisit_bytes)
        .groupBy("payload_digest")
        .agg(F.min("id").alias("first"))
    )
    return rows.join(firsts, "payload_digest", "left")


def record_text(captured: Column) -> tuple[Column, Column]:
    """Block and whole text of a record, without the line ends that close it; the text reads ``block``."""
    response = F.col("first").isNull() | (F.col("id").eqNullSafe(F.col("first")))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
    )
    block = F.when(response, F.concat(http, F.col("payload"))).otherwise(http)
    name = lambda column: F.concat(F.lit("<urn:capture:"), F.coalesce(column.cast("string"), F.lit("")), F.lit(">"))
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")
    head = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(response, "response").otherwise("revisit")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("id"))),
        F.concat(F.lit("WARC-Date: "), F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(
            ~response,
            F.concat(
                F.lit(
                    "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/"
                    "identical-payload-digest\r\nWARC-Refers-To: "
                ),
                name(F.col("first")),
            ),
        ),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")),
    ]
    return block, F.concat(F.concat_ws("\r\n", *head), F.lit(END), F.col("block"))


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    revisit_bytes: int = 0,
    captured: Column | None = None,
) -> None:
    """Write one record per row of ``pages`` to gzipped archives in the new folder ``path``.

    ``captured`` is the capture time; without one it is derived from the id, a second for each. Records of
    like sizes share archives, as many as fit into ``ARCHIVE_BYTES`` by the largest size of their class.
    """
    records = capture_records(pages, id=id, url=url, html=html, revisit_bytes=revisit_bytes)
    if captured is None:
        seconds = F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce("id", F.lit(0)), F.lit(1_000_000_000))
        captured = F.timestamp_seconds(seconds)
    block, text = record_text(captured)
    records = records.withColumn("block", block)
    size = F.octet_length(F.col(html)).cast("bigint") + F.coalesce(F.octet_length(F.col(url)), F.lit(0))
    largest = (pages.agg(F.max(F.coalesce(size, F.lit(0)))).first()[0] or 0) + HEAD_BYTES
    of_record = F.col("payload_bytes") + F.coalesce(F.octet_length("url"), F.lit(0)) + HEAD_BYTES
    low = -1
    for most in (*RECORD_CLASSES, None):
        own = of_record > low if most is None else (of_record > low) & (of_record <= most)
        count = 1 if most is None else max(1, ARCHIVE_BYTES // most)
        records.filter(own).select(text.alias("record")).write.mode("append").options(
            compression="gzip", lineSep=END, maxRecordsPerFile=count
        ).text(path)
        if most is not None and largest <= most:
            break
        low = most


# Reading


def url_key(url: str) -> str:
    """Sort-friendly form: host parts in reverse, then path and query, without scheme and fragment."""
    found = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^#]*)", url, re.I)
    host, rest = found.groups() if found else ("", url.partition("#")[0])
    host = host.rpartition("@")[2].lower()
    return ",".join(reversed(host.split("."))) + ")" + (rest or "/")


def _number(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:capture:").removesuffix(">")
    return int(digits) if digits else None


def parse_records(content: bytes) -> Iterator[tuple]:
    """Entries of one gzipped archive, in file order; payloads are checked against their digest."""
    unpack, held, start, more = zlib.decompressobj(31), b"", 0, memoryview(content)
    step = 1 << 20

    def fill(need: int) -> None:
        nonlocal held, more
        parts, size = [held], len(held)
        while size < need and len(more):
            parts.append(unpack.decompress(more[:step]))
            size, more = size + len(parts[-1]), more[step:]
        held = b"".join(parts)

    while True:
        fill(1 << 16)
        if not held:
            return
        cut = held.find(b"\r\n\r\n")
        while cut < 0 and len(more):
            fill(len(held) + step)
            cut = held.find(b"\r\n\r\n")
        if cut < 0 or not held.startswith(VERSION.encode()):
            raise ValueError(f"no WARC record at byte {start}")
        lines = held[:cut].decode().split("\r\n")
        head = dict(line.split(": ", 1) for line in lines[1:])
        length = cut + 4 + int(head["Content-Length"])
        fill(length + 4)
        block = held[cut + 4 : length]
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response":
            if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
        yield (
            url_key(head["WARC-Target-URI"]),
            re.sub(r"\D", "", head["WARC-Date"]),
            _number(head["WARC-Record-ID"]),
            head["WARC-Type"],
            _number(head.get("WARC-Refers-To")),
            size,
            digest,
            start,
            length,
        )
        held, start = held[length + 4 :], start + length + 4


def _order(entry: Sequence) -> tuple:
    """URL key, time, id (null first), type, and place: a total order within a file."""
    return (entry[0], entry[1], -1 if entry[2] is None else entry[2], entry[3], entry[7])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """``(run, entries)`` per archive below ``path``: its captures by URL key and time."""
    schema = "run string, entries array<struct<" + ", ".join(
        part.replace(" ", ": ") for part in ENTRY.split(", ")
    ) + ">>"

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                entries = sorted(parse_records(content.as_buffer()), key=_order)
                rows = [dict(zip(NAMES, e)) for e in entries]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.as_py().rpartition("/")[2]]), pa.array([rows], entries_type())],
                    names=["run", "entries"],
                )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(runs, schema)


def entries_type() -> pa.DataType:
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    return pa.list_(pa.struct([(n, kinds[k]) for n, k in (p.split() for p in ENTRY.split(", "))]))


def loser_tree(runs: Sequence[Sequence], order=_order) -> Iterator[tuple[int, object]]:
    """Merge sorted runs: ``(run, entry)`` in order, ties to the earlier run.

    Inner nodes hold the loser of their match and the winner stands above the root, so the next
    entry of the winning run replays one path of the tree.
    """
    k = len(runs)
    if not k:
        return
    at = [0] * k
    heads = [(0, order(run[0]), i) if run else (1, (), i) for i, run in enumerate(runs)]
    losers = [-1] * k

    def replay(i: int) -> int:
        node = (i + k) // 2
        while node:
            if losers[node] < 0:  # first match at this node while the tree is being built
                losers[node] = i
                return -1
            if heads[losers[node]] < heads[i]:
                losers[node], i = i, losers[node]
            node //= 2
        return i

    winner = 0
    for i in range(k):
        winner = replay(i)
    while not heads[winner][0]:
        run = runs[winner]
        yield winner, run[at[winner]]
        at[winner] += 1
        heads[winner] = (
            (0, order(run[at[winner]]), winner) if at[winner] < len(run) else (1, (), winner)
        )
        winner = replay(winner)


def _bounds(keys: list[tuple], parts: int) -> list[tuple]:
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def _cut(rows: list[dict], bounds: list[tuple]) -> list[tuple[int, list[dict]]]:
    """The pieces of a sorted run between the bounds that it has entries in."""
    keys = [_order([r[n] for n in NAMES])[:3] for r in rows]
    ends = [bisect_left(keys, b) for b in bounds] + [len(rows)]
    return [(i, rows[a:b]) for i, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]


KEY = "struct<urlkey: string, captured: string, record_id: bigint>"


def merge_runs(
    runs: DataFrame, *, entries_per_range: int = ENTRIES_PER_RANGE, first_ranges: int = FIRST_RANGES
) -> DataFrame:
    """The captures of all runs in one order: ``(range, position, archive)`` and the entry.

    Bounds are cut by URL key, time and id, so a URL with very many captures spans several ranges. The
    driver takes a sample of keys, whose size is bounded, for ``first_ranges`` at most. Where that makes
    ranges of more than ``entries_per_range``, each has a sample of its own, put in order by a task, and its pieces
    meet their bounds in a join. Each range is merged by one task; ranges follow each other in order.
    """
    runs = stage(runs, "capture-runs")
    total = runs.agg(F.sum(F.size("entries"))).first()[0] or 0
    wanted = max(1, math.ceil(total / entries_per_range))
    ranges = min(wanted, first_ranges)
    key = F.struct("urlkey", "captured", F.coalesce("record_id", F.lit(-1)).alias("record_id"))

    def sampled(entries: DataFrame, count: int) -> DataFrame:
        share = min(1.0, count * SAMPLED_KEYS_PER_RANGE / max(1, total))
        return entries.filter(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int(share * (1 << 40)))

    sample = sampled(runs.select(F.inline("entries")), ranges).select(key.alias("key")).collect() if ranges > 1 else []
    bounds = _bounds(sorted({tuple(row.key) for row in sample}), ranges)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, entries in zip(batch["run"].to_pylist(), batch["entries"]):
                if parts := _cut(entries.as_py(), bounds):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([i << 32 for i, _ in parts], pa.int64()),
                            pa.array([run] * len(parts)),
                            pa.array([rows for _, rows in parts], entries_type()),
                        ],
                        names=["range", "run", "entries"],
                    )

    schema = runs.schema["entries"].simpleString().partition(":")[2]
    pieces = runs.mapInArrow(cut, f"range bigint, run string, entries {schema}")
    if wanted > ranges:
        pieces = _cut_again(stage(pieces, "capture-pieces"), sampled, wanted, entries_per_range, schema, key)

    def merge(group: pa.Table) -> pa.Table:
        pieces = sorted(group.to_pylist(), key=lambda r: r["run"])
        merged = loser_tree([[tuple(e[n] for n in NAMES) for e in p["entries"]] for p in pieces])
        rows = [(pieces[i]["run"], entry) for i, entry in merged]
        columns = list(zip(*[entry for _, entry in rows]))
        kinds = [field.type for field in entries_type().value_type]
        return pa.table(
            [
                pa.array([pieces[0]["range"]] * len(rows), pa.int64()),
                pa.array(range(len(rows)), pa.int64()),
                pa.array([run for run, _ in rows]),
                *[pa.array(c, k) for c, k in zip(columns, kinds)],
            ],
            names=["range", "position", "archive", *NAMES],
        )

    return pieces.groupBy("range").applyInArrow(merge, f"range bigint, position bigint, archive string, {ENTRY}")


def _cut_again(pieces: DataFrame, sampled, wanted: int, entries_per_range: int, schema: str, key: Column) -> DataFrame:
    """Pieces of large ranges cut at bounds of their own; the driver sees none of them."""
    sizes = pieces.groupBy("range").agg(F.sum(F.size("entries")).alias("size"))
    keys = sampled(pieces.select("range", F.inline("entries")), wanted).select("range", key.alias("key"))

    def bounds(group: pa.Table, rest: pa.Table) -> pa.Table:
        parts = math.ceil(rest["size"][0].as_py() / entries_per_range)
        found = sorted({(k["urlkey"], k["captured"], k["record_id"]) for k in group["key"].to_pylist()})
        names = ("urlkey", "captured", "record_id")
        rows = [dict(zip(names, b)) for b in _bounds(found, parts)]
        kind = pa.list_(pa.struct([("urlkey", pa.string()), ("captured", pa.string()), ("record_id", pa.int64())]))
        return pa.table([rest["range"].slice(0, 1), pa.array([rows], kind)], names=["range", "bounds"])

    own = keys.groupBy("range").cogroup(sizes.groupBy("range")).applyInArrow(bounds, f"range bigint, bounds array<{KEY}>")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, run, entries, own in zip(*(batch[c] for c in ("range", "run", "entries", "bounds"))):
                at = [(b["urlkey"], b["captured"], b["record_id"]) for b in own.as_py()]
                parts = _cut(entries.as_py(), at)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([first.as_py() + i for i, _ in parts], pa.int64()),
                        pa.array([run.as_py()] * len(parts)),
                        pa.array([rows for _, rows in parts], entries_type()),
                    ],
                    names=["range", "run", "entries"],
                )

    met = pieces.join(stage(own, "capture-bounds"), "range").select("range", "run", "entries", "bounds")
    return met.mapInArrow(cut, f"range bigint, run string, entries {schema}")
