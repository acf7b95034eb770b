"""Small column expressions on names, time stamps and numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def link_names(html: Column, prefix: str, attribute: str = "HREF") -> Column:
    """Array of the names that follow ``prefix`` in the link targets of a listing.

    The match is case-sensitive: pass the attribute as the listing spells it.
    """
    pattern = f'{attribute}="{re.escape(prefix)}([^"]+)"'
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


def compact_stamp(moment: Column) -> Column:
    """``20250131_235959``: sorts by time as text, so it can lead a snapshot name."""
    return F.date_format(moment, "yyyyMMdd_HHmmss")


def iso_stamp(moment: Column) -> Column:
    """``2025-01-31T23:59:59.000000``"""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def snapshot_name(stem: str, moment: Column, suffix: str = ".json") -> Column:
    return F.concat(F.lit(f"{stem}_"), compact_stamp(moment), F.lit(suffix))


def with_prefix(prefix: str, name: Column) -> Column:
    """Storage key of a listed name."""
    return F.concat(F.lit(prefix), name)


def thousands(number: Column) -> Column:
    """``1234567`` -> ``1,234,567``"""
    return F.format_number(number, 0)
