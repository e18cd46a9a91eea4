"""Timestamp expressions. Everything stays ``timestamp_ntz`` (wall-clock, no zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _col

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_timestamp(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Text (or an existing timestamp) -> timestamp_ntz; unparseable -> null."""
    col = _col(c)
    if fmt is None:
        return col.try_cast("timestamp_ntz")
    return F.try_to_timestamp(col.cast("string"), F.lit(fmt)).cast("timestamp_ntz")


def format_timestamp(c: ColumnOrName) -> Column:
    """timestamp -> 'yyyy-MM-dd HH:mm:ss', null -> '' (the CSV hand-off format)."""
    return F.coalesce(F.date_format(_col(c), TS_FORMAT), F.lit(""))


def month_start(c: ColumnOrName) -> Column:
    """First instant of the month, as timestamp_ntz (zone-independent)."""
    return F.trunc(_col(c).cast("date"), "month").cast("timestamp_ntz")


def month_name(c: ColumnOrName) -> Column:
    """'January' ... 'December'."""
    return F.date_format(_col(c), "MMMM")


def day_name(c: ColumnOrName) -> Column:
    """'Monday' ... 'Sunday'."""
    return F.date_format(_col(c), "EEEE")


def weekday(c: ColumnOrName) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(_col(c).cast("date"))


def delay_days(delivered: ColumnOrName, estimated: ColumnOrName) -> Column:
    """Calendar days delivered - estimated (positive = late); null if either is null."""
    return F.datediff(_col(delivered).cast("date"), _col(estimated).cast("date"))


# Delivery-delay buckets. The source only states "Very Late" for
# more than 7 days late and names "Very Early"; the other bounds are ours.
DELAY_BUCKETS: tuple[tuple[str, int | None, int | None], ...] = (
    ("Very Early", None, -7),   # days <= -7
    ("Early", -6, -1),
    ("On Time", 0, 0),
    ("Late", 1, 7),
    ("Very Late", 8, None),     # days > 7
)
NOT_DELIVERED = "Not Delivered"


def delay_bucket(days: ColumnOrName) -> Column:
    d = _col(days)
    out = F.lit(NOT_DELIVERED)
    for label, lo, hi in reversed(DELAY_BUCKETS):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (d >= lo)
        if hi is not None:
            cond = cond & (d <= hi)
        out = F.when(d.isNotNull() & cond, F.lit(label)).otherwise(out)
    return out


def on_time_flag(delivered: ColumnOrName, estimated: ColumnOrName) -> Column:
    """1 when delivered and not after the estimate, else 0 (undelivered counts as 0)."""
    d, e = _col(delivered), _col(estimated)
    return F.when(d.isNotNull() & (d <= e), F.lit(1)).otherwise(F.lit(0))
