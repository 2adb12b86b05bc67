"""Months, feed timestamps, durations and step labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["month_of", "previous_month", "closed_month", "is_month_label",
           "feed_timestamp", "quote_month", "duration_text", "step_status"]

# The feed's time format and the month label format.
FEED_TIME = (r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun), +(\d{1,2}) "
             r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec) (\d{4}) "
             r"(\d{1,2}:\d{2}:\d{2}) (?:[+-]\d{2}:?\d{2}|z)$")
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
MONTH_LABEL = r"^\d{4}-\d{2}$"


def month_of(c: Column) -> Column:
    """yyyy-MM of a date or timestamp."""
    return F.date_format(c, "yyyy-MM")


def previous_month(c: Column) -> Column:
    """yyyy-MM of the month before a date or timestamp."""
    return month_of(F.add_months(F.trunc(c, "month"), -1))


def closed_month(day: dt.date) -> str:
    """yyyy-MM of the last month that is over on a day."""
    years, month = divmod(12 * day.year + day.month - 2, 12)
    return f"{years:04d}-{month + 1:02d}"


def is_month_label(c: Column) -> Column:
    return c.rlike(MONTH_LABEL)


def feed_timestamp(c: Column) -> Column:
    """Wall clock of a feed time such as 'Mon, 01 Jun 2026 00:00:01 +0000', as a
    zone-less timestamp; null when the text has another form."""
    # One pass of the pattern; a text of another form has no parts and casts to null.
    text = F.regexp_replace(c, FEED_TIME, "$1\u0001$2\u0001$3\u0001$4")
    part = lambda i: F.split_part(text, F.lit("\u0001"), F.lit(i))      # noqa: E731
    month = F.floor((F.instr(F.lit(MONTHS), F.lower(part(2))) + F.lit(2)) / F.lit(3))
    iso = F.concat(part(3), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"),
                   F.lpad(part(1), 2, "0"), F.lit(" "), part(4))
    return iso.try_cast("timestamp_ntz")


def quote_month(ts: Column) -> Column:
    """A quote taken in a month closes the month before; '' for an unreadable time."""
    return F.coalesce(previous_month(ts), F.lit(""))


def duration_text(seconds: Column) -> Column:
    """hh:mm:ss of a number of seconds."""
    total = F.bround(seconds, 0).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(total / 3600),
                           F.floor(F.pmod(total, F.lit(3600)) / 60), F.pmod(total, F.lit(60)))


def step_status(code: Column) -> Column:
    return F.when(code == 0, "OK").when(code == -1, "TIMEOUT").otherwise("ERRO")
