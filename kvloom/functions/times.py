"""Epoch milliseconds and time stamps, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kvloom.functions.buckets import DAY_MS


def ntz_to_millis(t: Column) -> Column:
    """A zone-less time stamp read as UTC, in epoch ms rounded down."""
    seconds = F.date_part(F.lit("SECOND"), t)
    return (
        F.unix_date(t.cast("date")) * F.lit(DAY_MS).cast("long")
        + F.hour(t) * F.lit(3_600_000).cast("long")
        + F.minute(t) * F.lit(60_000).cast("long")
        + F.floor(seconds * 1000).cast("long")
    )


def utc_text(ts: Column) -> Column:
    """Epoch ms as ``YYYY-MM-DD HH:MM:SS UTC``, for reports."""
    second = (ts - F.pmod(ts, F.lit(1000).cast("long"))) / 1000
    of_day = F.pmod(second.cast("long"), F.lit(86_400).cast("long"))
    day = F.date_from_unix_date(((second.cast("long") - of_day) / 86_400).cast("int"))
    clock = F.format_string(
        "%02d:%02d:%02d",
        F.floor(of_day / 3600),
        F.floor(F.pmod(of_day, F.lit(3600)) / 60),
        F.pmod(of_day, F.lit(60)),
    )
    return F.concat(day.cast("string"), F.lit(" "), clock, F.lit(" UTC"))
