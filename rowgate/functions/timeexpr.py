"""Time helpers.  All timestamps are TIMESTAMP_NTZ so results do not depend
on the session time zone, and every "now" is an explicit ``as_of`` literal
(one value per pass) instead of ``current_timestamp()``."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowgate.contracts import BATCH_TIME_FORMAT


def ts(value: str | dt.datetime | Column) -> Column:
    """A TIMESTAMP_NTZ literal (constant-folded by Catalyst)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


def plus_hours(col: Column, hours: int | float) -> Column:
    """``col`` plus any number of hours, to the microsecond."""
    return col + F.make_dt_interval(secs=F.lit(Decimal(str(hours)) * 3600).cast("decimal(18,6)"))


def hours_between(start: Column, end: Column, digits: int = 2) -> Column:
    """(end - start) in hours, rounded like ``ROUND(secs / 3600, 2)``."""
    return F.round(F.timestamp_diff("SECOND", start, end) / F.lit(3600.0), digits).cast("double")


def batch_time(batch: Column) -> Column:
    """Parse a ``yyyyMMdd_HHmmss`` batch folder name."""
    return F.to_timestamp_ntz(batch, F.lit(BATCH_TIME_FORMAT))
