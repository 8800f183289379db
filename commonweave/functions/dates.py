"""Dates as text, page cursors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tolerant_timestamp(text: Column | str) -> Column:
    """The time that an ISO text names, in UTC; null for anything else."""
    t = F.trim(F.col(text) if isinstance(text, str) else text)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(t))


def day(time: Column | str) -> Column:
    """yyyy-MM-dd, or a dash where there is no time."""
    return F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit("—"))


def encode_cursor(page: Column, since: Column) -> Column:
    """Where to go on: the page and the time since which records are wanted, as JSON."""
    return F.to_json(F.struct(page.cast("int").alias("page"), since.cast("long").alias("sinceUnix")))


def decode_cursor(text: Column | str) -> Column:
    """(page, sinceUnix) of a cursor; null for a text that is none."""
    found = F.from_json(text, "page int, sinceUnix long", {"mode": "PERMISSIVE"})
    return F.when(found["page"].isNotNull() & (found["page"] >= 0), found)


def first_time(*times: Column | str) -> Column:
    """The first time that is known, else the epoch."""
    return F.coalesce(*times, F.lit("1970-01-01 00:00:00").cast("timestamp"))
