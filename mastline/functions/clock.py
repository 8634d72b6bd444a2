"""Calendar arithmetic on Unix seconds, independent of the session time zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from mastline.constants import FILE_PREFIX, FILE_SUFFIX

DAY_SECONDS = 86400


def event_datetime(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def event_date(seconds: Column) -> Column:
    """UTC date of Unix seconds as ``yyyy-MM-dd`` text."""
    day = F.floor(seconds / F.lit(DAY_SECONDS)).cast("int")
    return F.date_from_unix_date(day).cast("string")


def event_hour(seconds: Column) -> Column:
    """UTC hour 0-23 of Unix seconds."""
    in_day = F.pmod(seconds, F.lit(DAY_SECONDS))
    return F.floor(in_day / F.lit(3600)).cast("int")


def seconds_of(ts: Column) -> Column:
    """Unix seconds of a zone-less timestamp read as UTC."""
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    return (
        days * DAY_SECONDS
        + F.hour(ts).cast("bigint") * 3600
        + F.minute(ts).cast("bigint") * 60
        + F.second(ts).cast("bigint")
    )


def day_bounds(date: Column, tz: str = "UTC") -> tuple[Column, Column]:
    """First and last second of a calendar day (ISO text) in ``tz``; NULL if unparsable."""
    day = F.try_to_date(date, "yyyy-MM-dd")
    first = F.unix_date(day).cast("bigint") * DAY_SECONDS
    if tz == "UTC":
        return first, first + (DAY_SECONDS - 1)

    def local(seconds: Column) -> Column:
        # Wall-clock seconds to the instant they name in tz.
        return F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(seconds), tz))

    return local(first), local(first + (DAY_SECONDS - 1))


def utc_now() -> str:
    """Stamp for lineage and log rows; one value per job."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def file_name_of(date: Column) -> Column:
    """Daily file name of an ISO date column."""
    return F.concat(F.lit(FILE_PREFIX), F.replace(date, F.lit("-"), F.lit("")), F.lit(FILE_SUFFIX))


def file_name(date: str) -> str:
    return f"{FILE_PREFIX}{date.replace('-', '')}{FILE_SUFFIX}"


def date_in_path(path: Column) -> Column:
    """ISO date named by a daily file path (or a part below a daily folder).

    Plain substring work: this runs once per row at scan time.
    """
    stamp = F.substring_index(path, FILE_PREFIX, -1)
    return F.concat_ws(
        "-", F.substring(stamp, 1, 4), F.substring(stamp, 5, 2), F.substring(stamp, 7, 2)
    )
