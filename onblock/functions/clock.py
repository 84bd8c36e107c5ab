"""Minutes, clock labels and calendar parts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of_hhmm(hhmm: Column | str) -> Column:
    """Hour of day of an `hhmm` number; 2400 is hour 0."""
    return (F.floor(_col(hhmm) / 100) % 24).cast("int")


def minute_of_hhmm(hhmm: Column | str) -> Column:
    """Minute of day of an `hhmm` number; 2400 stays 1440."""
    c = _col(hhmm)
    return (F.floor(c / 100) * 60 + c % 100).cast("int")


def hhmm_label(minutes: Column | str) -> Column:
    """Minutes of the day as `hh:mm`."""
    m = F.floor(_col(minutes))
    return F.format_string("%02d:%02d", F.floor(m / 60), m % 60)


def iso_weekday(date: Column | str) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(_col(date)) + 1


def hour_of_clock(text: Column | str) -> Column:
    """Leading hour of `hh:mm` text; unreadable text is hour 0."""
    return F.coalesce(F.split(_col(text), ":").getItem(0).try_cast("int"), F.lit(0))


def local_moment(date: Column | str, minutes: Column | str) -> Column:
    """Event time of a day plus minutes of that day."""
    return F.timestamp_add("MINUTE", _col(minutes), _col(date).cast("timestamp"))
