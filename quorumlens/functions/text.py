"""Small text helpers used by ingest and sinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def reported_day(text: Column) -> Column:
    """First YYYY-MM-DD in ``text`` as a date; NULL if there is none or it is no real day."""
    found = F.regexp_extract(text, r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    return F.when(found != "", found.try_cast("date"))


def http_date(text: Column) -> Column:
    """RFC 7231 date header as a timestamp; NULL if unreadable."""
    return F.try_to_timestamp(F.substring(text, 6, 20), F.lit("dd MMM yyyy HH:mm:ss"))


def host_of(text: Column) -> Column:
    """Host part of ``ip:port`` or ``[v6]:port``."""
    return F.regexp_replace(F.regexp_replace(text, r":[^:]*$", ""), r"^[\[\]]+|[\[\]]+$", "")


def normalised_tags(raw: Column) -> Column:
    """Split a multi-valued tag field into trimmed lower-case tags, empty ones kept out."""
    parts = F.split(F.regexp_replace(raw, "\n", ","), ",")
    clean = F.transform(
        parts, lambda t: F.lower(F.regexp_replace(F.trim(t), r'^"+|"+$', ""))
    )
    return F.filter(clean, lambda t: t != "")


def tag_categories(tags: Column) -> Column:
    """Sorted distinct categories of the tags that have one."""
    table = F.create_map(*[F.lit(x) for pair in K.TAG_CATEGORIES.items() for x in pair])
    found = F.transform(tags, lambda t: F.try_element_at(table, t))
    return F.array_sort(F.array_distinct(F.array_compact(found)))


def record_uuid(indicator: Column) -> Column:
    """Deterministic id: the first 128 bits of SHA-256 in UUID layout."""
    return F.regexp_replace(
        F.substring(F.sha2(indicator, 256), 1, 32),
        "^(.{8})(.{4})(.{4})(.{4})(.{12})$",
        "$1-$2-$3-$4-$5",
    )


def joined(values: Column, separator: str = "|") -> Column:
    return F.array_join(values, separator)
