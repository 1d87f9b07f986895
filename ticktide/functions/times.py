"""Timestamps at five resolutions, kept as integers where a Spark timestamp
cannot hold them (nanoseconds)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MILLIS_PER_DAY = 86_400_000
# Milliseconds per unit, or units per millisecond for the finer ones; fixed values.
COARSE = {"days": MILLIS_PER_DAY, "seconds": 1000, "milliseconds": 1}
FINE = {"microseconds": 1000, "nanoseconds": 1_000_000}


def floor_div(value: Column, divisor: int) -> Column:
    """Integer division rounding down, exact over the whole bigint range."""
    whole = F.lit(divisor).cast("bigint")
    return F.call_function("div", value - F.pmod(value, whole), whole)


def to_millis(value: Column, resolution: Column) -> Column:
    """Integer at a named resolution to epoch milliseconds; null for an unknown name."""
    result = F.lit(None).cast("bigint")
    for name, factor in COARSE.items():
        result = F.when(resolution == name, value * F.lit(factor).cast("bigint")).otherwise(result)
    for name, factor in FINE.items():
        result = F.when(resolution == name, floor_div(value, factor)).otherwise(result)
    return result


def from_millis(millis: Column, resolution: Column) -> Column:
    """Epoch milliseconds to an integer at a named resolution."""
    result = F.lit(None).cast("bigint")
    for name, factor in COARSE.items():
        result = F.when(resolution == name, floor_div(millis, factor)).otherwise(result)
    for name, factor in FINE.items():
        result = F.when(resolution == name, millis * F.lit(factor).cast("bigint")).otherwise(result)
    return result


def detect_resolution(value: Column) -> Column:
    """Resolution from the number of digits: 18+, 15+, 12+, 9+, else days."""
    digits = F.length(F.abs(value).cast("string"))
    return (F.when(digits >= 18, "nanoseconds").when(digits >= 15, "microseconds")
            .when(digits >= 12, "milliseconds").when(digits >= 9, "seconds")
            .otherwise("days"))


def any_to_millis(value: Column) -> Column:
    return to_millis(value, detect_resolution(value))


def event_millis(value: Column) -> Column:
    """Event time of an option item: exactly 19, 13 or 10 digits, else null."""
    digits = F.length(value.cast("string"))
    return (F.when(digits == 19, floor_div(value, 1_000_000)).when(digits == 13, value)
            .when(digits == 10, value * F.lit(1000).cast("bigint")))


def text_to_millis(value: Column) -> Column:
    """ISO date or datetime text; the time of day is kept."""
    return F.unix_millis(value.try_cast("timestamp"))


def date_to_millis(value: Column) -> Column:
    return F.unix_date(value).cast("bigint") * F.lit(MILLIS_PER_DAY).cast("bigint")


def scale_seconds(value: Column, precision: str) -> Column:
    """Seconds to the named precision."""
    factors = {"seconds": 1, "milliseconds": 1000, "microseconds": 1_000_000}
    return value * F.lit(factors[precision]).cast("bigint")


def since_epoch(value: Column, precision: str) -> Column:
    """Timestamp to whole units since the epoch."""
    units = {"seconds": F.unix_seconds, "milliseconds": F.unix_millis,
             "microseconds": F.unix_micros}
    return units[precision](value)


def friendly_delta(earlier_millis: Column, later_millis: Column) -> Column:
    """How long ago, in words."""
    delta = later_millis - earlier_millis
    seconds = floor_div(delta, 1000)
    minutes, hours, days = floor_div(seconds, 60), floor_div(seconds, 3600), floor_div(seconds, 86400)
    return (F.when(seconds < 180, "just now")
            .when(days == 1, "yesterday")
            .when(days > 1, F.concat(days.cast("string"), F.lit(" days ago")))
            .when(hours >= 12, F.concat(hours.cast("string"), F.lit(" hours ago")))
            .when(hours > 0, F.concat(hours.cast("string"), F.lit(" hours "),
                                      F.pmod(minutes, F.lit(60)).cast("string"),
                                      F.lit(" minutes ago")))
            .otherwise(F.concat(minutes.cast("string"), F.lit(" minutes ago"))))


def expiry_from_millis(millis: Column) -> Column:
    return F.to_date(F.timestamp_millis(millis))


def expiry_text(expiry: Column) -> Column:
    return F.date_format(expiry, "yyyyMMdd")


def days_to_expiry(expiry: Column, as_of: Column) -> Column:
    return F.datediff(expiry, as_of)


def years_to_expiry(expiry: Column, as_of: Column) -> Column:
    return F.datediff(expiry, as_of) / F.lit(365.25)


def market_wall_to_utc(day: Column, minutes: Column, zone: Column | str) -> Column:
    """Wall time of a market (day plus minutes, may be negative) to an instant.

    Built from integer micros, so it does not depend on the session zone.
    """
    micros = (F.unix_date(day).cast("bigint") * F.lit(1440) + minutes) * F.lit(60_000_000)
    return F.to_utc_timestamp(F.timestamp_micros(micros), zone)


def market_date(instant: Column, zone: Column | str) -> Column:
    """Local calendar date of an instant in a market's zone."""
    micros = F.unix_micros(F.from_utc_timestamp(instant, zone))
    return F.date_from_unix_date(floor_div(micros, MILLIS_PER_DAY * 1000).cast("int"))


def utc_date(instant: Column) -> Column:
    """UTC calendar date of an instant, whatever the session zone."""
    return F.date_from_unix_date(
        floor_div(F.unix_micros(instant), MILLIS_PER_DAY * 1000).cast("int"))

