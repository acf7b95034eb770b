"""The twelve hand-made observations and the population snapshots of FIXTURES.md."""

from __future__ import annotations

import json
from pathlib import Path

COLUMNS = ["series_id", "year", "period", "value", "footnote_codes"]

ROWS = [
    ("A", "1995", "Q01", "1.0", ""),
    ("A", "1995", "Q02", "2.0", ""),
    ("A", "1996", "Q01", "3.0", "R"),
    ("A", "1997", "Q01", "1.0", ""),
    ("A", "1997", "Q05", "1.5", ""),
    ("A", "1998", "A01", "99.0", ""),
    ("A", "1999", "q01", "99.0", ""),
    ("B", "2001", "Q01", "-", ""),
    ("B", "", "Q01", "5.0", ""),
    ("B", "2002", "Q01", "-4.0", ""),
    ("B", "2003", "Q01", "-6.0", ""),
    ("C", "2004", "Q01", "", ""),
]


def write_padded(path: Path, rows, note: str | None = None) -> None:
    """A tab-separated file with padded header and values, written without Spark."""
    header = ["series_id".ljust(17), "year", "period", "value".rjust(12), "footnote_codes"]
    lines = [header + (["note"] if note else [])]
    for series, year, period, value, footnote in rows:
        line = [series.ljust(17), year, period, value.rjust(12) if value else "", footnote]
        lines.append(line + ([note] if note else []))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join("\t".join(line) + "\n" for line in lines))


RECORDS = [
    (" 01000US ", " United States ", year, people)
    for year, people in [
        ("2013", "10"),
        ("2014", "20"),
        ("2015", "30"),
        ("2016", "40"),
        ("2017", "50"),
        ("2018", "60"),
        ("2019", "70"),
        ("2020", "0"),
        (None, "80"),
    ]
]


def write_snapshot(path: Path, records, form: str = "text") -> None:
    """An envelope over several lines; years and populations as text, whole numbers, or with ``.0``."""

    def value(text):
        forms = {"text": str, "numbers": int, "floats": float, "float texts": lambda t: f"{t}.0"}
        return text if text is None else forms[form](text)

    data = [
        {"Nation ID": i, "Nation": n, "Year": value(y), "Population": value(p)}
        for i, n, y, p in records
    ]
    document = {
        "metadata": {
            "source_url": "https://example.org/api",
            "fetched_at": "2025-01-02T00:00:00",
            "record_count": len(data),
        },
        "data": {"data": data},
    }
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(document, indent=2))
