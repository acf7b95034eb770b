import base64
import gzip
import hashlib
import random
from pathlib import Path

import fixtures as f

from orebelt.llm import warc
from orebelt.session import new_scratch


def pages(spark, rows):
    return f.table(spark, rows, "page_id bigint, url string, html string")


def digest(text: str) -> str:
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


ROWS = [
    (5, "https://b.example.org/x?y#z", "<p>é</p>"),
    (3, "https://a.example.org/", "<p>é</p>"),
    (9, "http://a.example.org/", None),
    (8, "http://a.example.org/\r\nX: y", ""),
    (2, None, "WARC/1.1\r\nContent-Length: 5\r\n\r\nWARC/1.1\r\n\r\n"),
    (4, "nothing", "x" * 300_000),
    (None, "https://c.example.org/", "<p>é</p>"),
    (None, "https://c.example.org/", "only here"),
    (3, "https://a.example.org/", "<p>é</p>"),
]


def test_round_trip(spark):
    folder = new_scratch(spark, "archives")
    warc.write_archives(pages(spark, ROWS), folder)
    got = warc.merge_runs(warc.read_runs(spark, folder), entries_per_range=3).collect()
    assert len(got) == len(ROWS)
    by = sorted((r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got if r.record_id is not None)
    e, long = "<p>é</p>", "x" * 300_000
    assert by == sorted(
        [
            (2, "response", None, len(ROWS[4][2]), digest(ROWS[4][2])),
            (3, "response", None, 9, digest(e)),
            (3, "response", None, 9, digest(e)),
            (4, "response", None, 300_000, digest(long)),
            (5, "revisit", 3, 9, digest(e)),
            (8, "response", None, 0, digest("")),
            (9, "revisit", 8, 0, digest("")),
        ]
    )
    assert sorted((r.record_type, r.refers_to) for r in got if r.record_id is None and r.record_type == "response") == [("response", None)]
    # The histories are in one order over all ranges.
    ordered = sorted(got, key=lambda r: (r.range, r.position))
    keys = [(r.urlkey, r.captured, -1 if r.record_id is None else r.record_id) for r in ordered]
    assert keys == sorted(keys) and len({r.range for r in got}) > 1


def test_offsets_point_at_records(spark):
    folder = new_scratch(spark, "archives")
    warc.write_archives(pages(spark, ROWS), folder)
    for r in warc.merge_runs(warc.read_runs(spark, folder)).collect():
        data = gzip.decompress((Path(folder) / r.archive).read_bytes())
        record = data[r.record_offset : r.record_offset + r.record_length]
        assert record.startswith(b"WARC/1.1\r\n") and data[r.record_offset + r.record_length :].startswith(b"\r\n\r\n")
        assert r.payload_digest.encode() in record


def test_revisits_only_from_a_size(spark):
    folder = new_scratch(spark, "archives")
    warc.write_archives(pages(spark, [(1, "x://a/", "ab"), (2, "x://a/", "ab"), (3, "x://a/", "abcdef"), (4, "x://a/", "abcdef")]), folder, revisit_bytes=5)
    got = f.rows(warc.merge_runs(warc.read_runs(spark, folder)), "record_id", "record_type")
    assert got == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_empty_table(spark):
    folder = new_scratch(spark, "archives")
    warc.write_archives(pages(spark, []).limit(0), folder)
    assert warc.merge_runs(warc.read_runs(spark, folder)).count() == 0


def test_loser_tree():
    pick = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(pick.randint(0, 20) for _ in range(pick.randint(0, 9))) for _ in range(k)]
        got = [*warc.loser_tree(runs, order=lambda x: x)]
        assert [x for _, x in got] == sorted(x for run in runs for x in run)
        assert got == sorted(got, key=lambda pair: (pair[1], pair[0]))


def test_url_key():
    assert warc.url_key("https://www.Example.org/a?b#c") == "org,example,www)/a?b"
    assert warc.url_key("http://example.org") == "org,example)/"


def test_two_levels_of_bounds(spark):
    rows = [(i, f"https://h{i * 37 % 11}.org/{i * 13 % 40}", f"text {i % 60}") for i in range(400)] + [(i, "https://hot.org/", "x") for i in range(400, 700)]
    folder = new_scratch(spark, "archives")
    warc.write_archives(pages(spark, rows).repartition(6), folder)
    whole = warc.merge_runs(warc.read_runs(spark, folder)).drop("range", "position").collect()
    for first in (1, 3, 50):
        got = warc.merge_runs(warc.read_runs(spark, folder), entries_per_range=20, first_ranges=first).collect()
        got.sort(key=lambda r: (r.range, r.position))
        assert len({r.range for r in got}) >= 15
        assert max(r.position for r in got) < 20 * 6
        order = [(r.urlkey, r.captured, r.record_id) for r in got]
        assert order == sorted((r.urlkey, r.captured, r.record_id) for r in whole) and len(got) == 700


def test_archives_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 60_000)
    monkeypatch.setattr(warc, "RECORD_CLASSES", (6_000, 12_000, 30_000))
    sizes = [10] * 50 + [7_000] * 12 + [20_000] * 5 + [100_000] * 2
    rows = [(i, f"https://a.org/{i}", chr(97 + i % 26) * size) for i, size in enumerate(sizes)]
    folder = new_scratch(spark, "archives")
    warc.write_archives(pages(spark, rows).coalesce(1), folder)
    archives = [len(gzip.decompress(p.read_bytes())) for p in Path(folder).glob("*.gz")]
    assert sorted(archives)[:-2] and all(a <= 60_000 for a in sorted(archives)[:-2])
    assert min(sorted(archives)[-2:]) > 100_000  # one record each
    got = warc.merge_runs(warc.read_runs(spark, folder)).collect()
    assert sorted(r.record_id for r in got) == list(range(len(sizes)))
