"""Calendar expressions and the ``as_of`` clock that replaces CURRENT_DATE / CURRENT_TIMESTAMP.

Events have a UTC clock: dates, hours and labels are computed from the instant, so they are the same
under any session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import WEEKDAYS

AsOf = dt.date | dt.datetime | str | None


_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)


def utc_date(instant: str | Column) -> Column:
    """The UTC date of a timestamp."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86_400).cast("int"))


def utc_hour(instant: str | Column) -> Column:
    """The UTC hour, 0 to 23, of a timestamp."""
    return F.pmod(F.floor(F.unix_seconds(instant) / 3_600), F.lit(24)).cast("int")


def utc_floor(instant: str | Column, seconds: int) -> Column:
    """The timestamp cut to whole UTC hours (3,600 seconds) or days (86,400)."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(instant) / seconds) * seconds)


def _instant(as_of: dt.date | str) -> dt.datetime:
    """In UTC, which is also the zone of values without one; a plain date means midnight."""
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of.strip())
    elif not isinstance(as_of, dt.datetime):
        as_of = dt.datetime.combine(as_of, dt.time())
    return as_of.replace(tzinfo=dt.UTC) if as_of.tzinfo is None else as_of.astimezone(dt.UTC)


def utc_day(as_of: AsOf = None) -> dt.date:
    """The reference date on the driver."""
    return (dt.datetime.now(dt.UTC) if as_of is None else _instant(as_of)).date()


def as_of_date(as_of: AsOf = None) -> Column:
    """The reference date as a literal (foldable, so date filters still prune partitions)."""
    return utc_date(F.current_timestamp()) if as_of is None else F.lit(_instant(as_of).date())


def as_of_timestamp(as_of: AsOf = None) -> Column:
    """The reference instant; a plain date means midnight, UTC."""
    if as_of is None:
        return F.current_timestamp()
    return F.timestamp_micros(F.lit((_instant(as_of) - _EPOCH) // dt.timedelta(microseconds=1)))


def time_parts(created_at: str = "created_at") -> dict[str, Column]:
    """Calendar parts of the event time.  Weekday runs 1 = Sunday ... 7 = Saturday."""
    date = utc_date(created_at)
    return {
        "event_hour": utc_hour(created_at),
        "event_day_of_week": F.dayofweek(date),
        "event_year": F.year(date),
        "event_month": F.month(date),
        "event_day": F.dayofmonth(date),
    }


def day_name(day_of_week: str | Column, label_mode: str = "calendar") -> Column:
    """Weekday label for a 1 = Sunday ... 7 = Saturday number.

    ``label_mode="reference"`` counts labels from 0 = Sunday instead, as the original dashboards do:
    every name is one day late and Saturday (7) has none.
    """
    if label_mode not in ("calendar", "reference"):
        raise ValueError(f"unknown label_mode {label_mode!r}")
    first = 1 if label_mode == "calendar" else 0
    number = F.col(day_of_week) if isinstance(day_of_week, str) else day_of_week
    label = F.lit(None).cast("string")
    for position, name in reversed(list(enumerate(WEEKDAYS))):
        label = F.when(number == position + first, name).otherwise(label)
    return label
