"""Instants and dates. Everything here is independent of the session zone: instants are epoch microseconds
or carry their own zone, days are those of UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000

#: ISO 8601 date, time and zone offset, all mandatory. (fixed format)
ISO_INSTANT = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?(Z|[+-]\d{2}:\d{2})\z"


def event_micros(text: Column) -> Column:
    """Epoch microseconds of ISO 8601 text with its own zone offset; null where that can't be read."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(ISO_INSTANT), F.unix_micros(F.regexp_replace(trimmed, ",", ".").try_cast("timestamp")))


def event_instant(text: Column) -> Column:
    """TIMESTAMP of ISO 8601 text with its own zone offset; null where that can't be read."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(ISO_INSTANT), F.regexp_replace(trimmed, ",", ".").try_cast("timestamp"))


def utc_day(micros: Column) -> Column:
    """Days since 1970-01-01 of an instant in epoch microseconds."""
    # exact integer floor division: subtract the non-negative remainder first
    return ((micros - F.pmod(micros, F.lit(DAY_US))).cast("long") / F.lit(DAY_US)).cast("int")


def date_of(day: Column) -> Column:
    """DATE of a number of days since 1970-01-01."""
    return F.date_from_unix_date(day.cast("int"))


def month_of(micros: Column) -> Column:
    """`YYYY-MM` of an instant in epoch microseconds, in UTC."""
    return F.date_format(date_of(utc_day(micros)), "yyyy-MM")


def midnight(date: Column) -> Column:
    """Epoch microseconds of 00:00 UTC of a DATE."""
    return F.unix_date(date).cast("long") * F.lit(DAY_US)


#: Zone of publication instants of exchange quotes. (fixed value)
QUOTE_OFFSET = "-03:00"
#: A snapshot's instant: 27 characters in UTC with microseconds. (fixed format)
SNAPSHOT_INSTANT = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}Z\z"
#: A reference date in a file name: .D, the last one or two digits of the year, month, day. (fixed format)
FILE_TOKEN = r"\.D(\d{1,2})(\d{2})(\d{2})(?!\d)"


def day_of(text: Column) -> Column:
    """DATE of the first ten characters of ISO text, whatever the session zone; null where that's none."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def instant_literal(iso: str) -> Column:
    """TIMESTAMP of ISO text with its zone, whatever the session zone."""
    return F.lit(iso).cast("timestamp")


def published_instant(text: Column) -> Column:
    """Publication instant of an exchange quote: its local text in its own zone; null where that can't be read."""
    shape = r"\A\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?\z"
    return F.when(text.rlike(shape), F.concat(text, F.lit(QUOTE_OFFSET)).try_cast("timestamp"))


def _file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)\z", 1)


def _one_token(path: Column) -> Column:
    return F.size(F.regexp_extract_all(_file_name(path), F.lit(FILE_TOKEN), F.lit(0))) == 1


def token_month(path: Column) -> Column:
    """`Y-MM` or `YY-MM` that the file name of `path` asserts; null unless it holds exactly one token."""
    name = _file_name(path)
    return F.when(_one_token(path), F.concat(F.regexp_extract(name, FILE_TOKEN, 1), F.lit("-"), F.regexp_extract(name, FILE_TOKEN, 2)))


def ref_date_of_file(path: Column, month: str | Column) -> Column:
    """Reference DATE from the token of a file name.

    Null unless there is exactly one token, it agrees with `month` (the year's last digits, and the month) and names
    a real calendar day. The rest of the year comes from `month`.
    """
    month = F.lit(month) if isinstance(month, str) else month
    agrees = F.endswith(month, token_month(path))
    stated = F.concat(month, F.lit("-"), F.regexp_extract(_file_name(path), FILE_TOKEN, 3))
    return F.when(agrees, F.try_to_date(stated, "yyyy-MM-dd"))


def ref_date_of_instant(text: Column) -> Column:
    """Reference DATE of a snapshot's instant; null unless it has the declared shape and exists."""
    return F.when(text.rlike(SNAPSHOT_INSTANT) & text.try_cast("timestamp").isNotNull(), day_of(text))
