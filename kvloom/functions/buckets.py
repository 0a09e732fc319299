"""Time buckets: epoch milliseconds to the start of the UTC bucket.

Integer arithmetic only. ``date_trunc`` on timestamps would follow the session
time zone, which belongs to the caller.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kvloom.model import check_strategy

DAY_MS = 86_400_000
# --- fixed values: first and last instant with a calendar date (years 1-9999) -
MIN_TS = -62_135_596_800_000
MAX_TS = 253_402_300_799_999
# ----------------------------------------------------------------------------
_WIDTH_MS = {"MINUTES": 60_000, "HOURS": 3_600_000, "DAYS": DAY_MS}
_CALENDAR_UNIT = {"MONTHS": "MM", "YEARS": "YEAR"}


def bucket_start(ts: Column | str, strategy: str) -> Column:
    """Start of the bucket that holds ``ts``, in epoch ms; 0 for INDEFINITE.

    Null for a ``ts`` outside the calendar, except under INDEFINITE.
    """
    check_strategy(strategy)
    ts = F.col(ts) if isinstance(ts, str) else ts
    if strategy == "INDEFINITE":
        return F.lit(0).cast("long")
    if strategy in _WIDTH_MS:
        start = ts - F.pmod(ts, F.lit(_WIDTH_MS[strategy]).cast("long"))
    else:
        day_ms = F.lit(DAY_MS).cast("long")
        # Exact: a multiple of DAY_MS within the calendar is far below 2^53.
        epoch_day = ((ts - F.pmod(ts, day_ms)) / day_ms).cast("int")
        first_day = F.trunc(F.date_from_unix_date(epoch_day), _CALENDAR_UNIT[strategy])
        start = F.unix_date(first_day) * day_ms
    return F.when(ts.between(MIN_TS, MAX_TS), start)


def directory_bucket(partition: Column | str, strategy: str) -> Column:
    """Bucket that names the directory of a row, from the row's own bucket.

    Buckets finer than a month would make one directory per day or less, so
    those rows are kept in the directory of their month.
    """
    check_strategy(strategy)
    partition = F.col(partition) if isinstance(partition, str) else partition
    if strategy in ("MONTHS", "YEARS", "INDEFINITE"):
        return partition
    return bucket_start(partition, "MONTHS")
