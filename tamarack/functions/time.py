"""Epoch numbers and ISO text for clocks without a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def micros(c: Column | str) -> Column:
    """Microseconds since 1970 of a clock reading; no session zone takes part."""
    c = F.col(c) if isinstance(c, str) else c
    day = F.unix_date(c.cast("date")).cast("bigint") * 86_400_000_000
    return day + (F.hour(c) * 3600 + F.minute(c) * 60).cast("bigint") * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")


def seconds(c: Column | str) -> Column:
    return micros(c).cast("double") / 1e6


def iso(epoch_seconds: Column) -> Column:
    """ISO-8601 text of epoch seconds in UTC."""
    s = F.floor(epoch_seconds)
    day = F.date_from_unix_date(F.floor(s / 86_400).cast("int"))
    rest = F.pmod(s, F.lit(86_400))
    clock = F.format_string("T%02d:%02d:%02dZ", F.floor(rest / 3600), F.floor(F.pmod(rest, F.lit(3600)) / 60), F.pmod(rest, F.lit(60)))
    return F.concat(day.cast("string"), clock)


def file_stamp(epoch_seconds: Column) -> Column:
    """``YYYYmmdd-HHMMSS`` in UTC."""
    return F.regexp_replace(F.regexp_replace(iso(epoch_seconds), "[-:Z]", ""), "T", "-")


def between(a: Column, b: Column) -> Column:
    """Seconds from one ISO stamp to another; a malformed stamp is an error."""
    at = lambda x: micros(F.to_timestamp_ntz(F.regexp_replace(x, "Z$", ""), F.lit("yyyy-MM-dd'T'HH:mm:ss")))
    return (at(b) - at(a)).cast("double") / 1e6


def rate(count: Column, secs: Column, digits: int = 3) -> Column:
    """``count / secs`` rounded, null without time."""
    return F.bround(F.try_divide(count, F.nullif(secs, F.lit(0.0))), digits)
