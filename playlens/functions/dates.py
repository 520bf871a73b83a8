"""Days and instants. Zones are always explicit; the clock is never read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SHARD_FORMAT = "%Y%m%d"


def shard_of(day: dt.date) -> str:
    return day.strftime(SHARD_FORMAT)


def export_date(text: Column) -> Column:
    """The export's own ``yyyyMMdd`` text as a date."""
    return F.to_date(text, "yyyyMMdd")


def local_date(instant: Column, zone: str) -> Column:
    """Calendar day of an instant in ``zone``, whatever the session zone is."""
    wall = instant.cast("timestamp_ntz")
    return F.to_date(F.convert_timezone(None, F.lit(zone), wall))


def local_date_from_micros(micros: Column, zone: str) -> Column:
    return local_date(F.timestamp_micros(micros), zone)


def local_date_from_millis(millis: Column, zone: str) -> Column:
    return local_date(F.timestamp_millis(millis), zone)


def utc_micros(wall: Column) -> Column:
    """Epoch micros of a zone-less timestamp that holds UTC wall time."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), wall)
    return F.unix_micros(local.cast("timestamp"))


def day_offset(day: Column, start: Column) -> Column:
    return F.datediff(day, start)
