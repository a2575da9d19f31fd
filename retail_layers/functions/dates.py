"""Date and time expressions. "Today" is always an argument, never the clock."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAYS_PER_YEAR = 365.25
OFFSET_AFTER_TIME = r":[0-9.: ]*[A-Za-z+\-]"


def as_column(value: Column | date | datetime) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def wall_clock(moment: Column, dtype: T.DataType, zone: str | None) -> Column:
    """What clocks in ``zone`` show at an instant, whatever the session's zone is.

    The way leads over UTC, so the hour that clocks repeat in autumn stays apart. Days,
    timestamps without zone and text are wall clocks already and pass through, as all do
    without a ``zone``: days then follow the session.
    """
    if zone is None or not isinstance(dtype, T.TimestampType):
        return moment
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(moment), _epoch())
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def instant(wall: Column, zone: str) -> Column:
    """The instant at which clocks in ``zone`` show ``wall`` (a timestamp without zone): the
    first of two where they are put back, an hour later where they skip it."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), utc))


def safe_timestamp(value: Column, dtype: T.DataType, zone: str | None = None) -> Column:
    """Timestamp, or NULL for text that is none. Timestamps of either kind pass through.

    Text and days without an offset are read in ``zone``, or in the session's zone without
    one. With a ``zone``, a time of day without a day is NULL and not a time of today.
    """
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return value
    if isinstance(dtype, T.DateType) and zone is not None:
        return instant(value.cast("timestamp_ntz"), zone)
    if isinstance(dtype, T.StringType):
        parsed = F.try_to_timestamp(value)
        return parsed if zone is None else F.when(value.rlike(OFFSET_AFTER_TIME), parsed).otherwise(
            instant(value.try_cast("timestamp_ntz"), zone))
    return value.try_cast("timestamp")


def date_key(moment: Column) -> Column:
    """``yyyyMMdd`` as an int, by arithmetic rather than by formatting and parsing text."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def whole_years(born: Column, as_of: Column | date) -> Column:
    return F.floor(F.datediff(as_column(as_of), born) / F.lit(DAYS_PER_YEAR))


def within_validity(active: Column, start: Column, end: Column, as_of: Column | date) -> Column:
    """Active, started by ``as_of`` and not ended before it; a missing end is open."""
    day = as_column(as_of)
    return active.cast("boolean") & (start <= day) & (end.isNull() | (end >= day))
