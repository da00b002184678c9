"""Time and text parsing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings once dividers, "T" and offset are written alike: fractions of up to nine digits, with or without
# seconds, with or without an offset, or a date alone.
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm[:ss][.SSSSSSSSS][XXX]", "yyyy-MM-dd")


def parse_timestamp(text: Column) -> Column:
    """Best-effort parse: dates with or without time, then epoch seconds (also with a fraction), milli- or microseconds.

    Dates have dashes or slashes, offsets are Z, UTC, GMT, +hh, +hhmm or +hh:mm. NULL when none fits.
    """
    plain = F.regexp_replace(F.trim(text), r"^(\d{4})/(\d\d)/(\d\d)", "$1-$2-$3")
    plain = F.regexp_replace(plain, r"^(\d{4}-\d\d-\d\d)[Tt]", "$1 ")
    plain = F.regexp_replace(plain, r"(:\d\d(?:\.\d+)?)\s*([+-]\d\d):?(\d\d)$", "$1$2:$3")
    plain = F.regexp_replace(plain, r"(:\d\d(?:\.\d+)?)\s*([+-]\d\d)$", "$1$2:00")
    plain = F.regexp_replace(plain, r"(?i)(:\d\d(?:\.\d+)?)\s*(Z|UTC|GMT)$", "$1Z")
    # bound once: written out for each attempt, the cleaning would outgrow what can be compiled
    return F.transform(F.array(plain), _first_that_fits)[0]


def _first_that_fits(plain: Column) -> Column:
    attempts = [F.try_to_timestamp(plain, F.lit(fmt)) for fmt in TIMESTAMP_FORMATS]
    number = plain.try_cast("bigint")
    seconds = F.when(plain.rlike("^[0-9]{9,11}$"), F.timestamp_seconds(number))
    millis = F.when(plain.rlike("^[0-9]{12,14}$"), F.timestamp_millis(number))
    micros = F.when(plain.rlike("^[0-9]{15,17}$"), F.timestamp_micros(number))
    exact = (plain.try_cast("decimal(29,9)") * 1_000_000).try_cast("bigint")
    fraction = F.when(plain.rlike(r"^[0-9]{9,11}\.[0-9]+$"), F.timestamp_micros(exact))
    return F.coalesce(*attempts, seconds, millis, micros, fraction)


def local_date(ts: Column, zone: str) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def local_date_of_day(day: Column, zone: str) -> Column:
    """A date read as its UTC midnight: west of Greenwich this is the previous day."""
    return local_date(day.cast("timestamp"), zone)


def local_midnight(day: date, zone: str) -> Column:
    """UTC instant at which ``day`` starts in ``zone``; folded to a literal."""
    return F.to_utc_timestamp(F.lit(day).cast("timestamp"), zone)


def first_day_reaching(day: date, zone: str) -> Column:
    """Smallest UTC date whose midnight falls on or after ``day`` in ``zone``.

    Comparing a date column with this literal equals converting every row, and the
    comparison reaches file statistics.
    """
    almost_a_day = F.expr("INTERVAL '23:59:59.999999' HOUR TO SECOND")
    return F.to_date(local_midnight(day, zone) + almost_a_day)


def stamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_seconds(end) - F.unix_seconds(start)
