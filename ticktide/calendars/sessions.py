"""Session schedules: one row per calendar and session date.

Everything starts from small rule tables and grows only with the number of
calendar days asked for, never with the trades.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ticktide.calendars import registry, rules
from ticktide.functions.times import market_wall_to_utc
from ticktide.session import local_table

EVENTS = ("pre", "market_open", "break_start", "break_end", "market_close", "post")


def as_date(value: date | str) -> date:
    """A date from a date, datetime or ISO text; time of day and zone are dropped."""
    if isinstance(value, str):
        return date.fromisoformat(value[:10])
    return date(value.year, value.month, value.day)


def rule_days(spark: SparkSession, rows: list[tuple], start: date, end: date) -> DataFrame:
    """Observed days of yearly rules between two dates."""
    table = local_table(spark, rows, registry.RULE_DDL)
    festival = registry.RULE_DDL.split(", ").index("festival string")
    expanded = rules.expand(table, start.year, end.year, {row[festival] for row in rows})
    return expanded.where(F.col("day_off").between(F.lit(start), F.lit(end)))


def regular_holidays(spark: SparkSession, names: list[str], start, end) -> DataFrame:
    start, end = as_date(start), as_date(end)
    rows = registry.holiday_rule_rows(registry.resolve(names))
    return rule_days(spark, rows, start, end).select("calendar", "name", F.col("day_off").alias("day"))


def adhoc_holidays(spark: SparkSession, names: list[str]) -> DataFrame:
    return local_table(spark, registry.closed_rows(registry.resolve(names)),
                       "calendar string, day date")


def holidays(spark: SparkSession, names: list[str], start, end,
             extra_closed: DataFrame | None = None) -> DataFrame:
    """All days off: by rule, by list, and from an optional table (calendar, day).
    A day may appear more than once."""
    start, end = as_date(start), as_date(end)
    days = (regular_holidays(spark, names, start, end).select("calendar", "day")
            .unionByName(adhoc_holidays(spark, names)))
    if extra_closed is not None:
        days = days.unionByName(extra_closed.select("calendar", "day"))
    return days.where(F.col("day").between(F.lit(start), F.lit(end)))


def calendar_days(spark: SparkSession, names: list[str], start, end) -> DataFrame:
    """Every day of the range for every calendar, with the calendar's own row."""
    days = F.explode(F.sequence(F.lit(as_date(start)), F.lit(as_date(end))))
    return registry.calendars_table(spark, names).withColumn("day", days)


def valid_days(spark: SparkSession, names: list[str], start, end,
               extra_closed: DataFrame | None = None) -> DataFrame:
    """Session dates: days of the week mask minus holidays."""
    weekday = F.weekday("day")
    open_days = (calendar_days(spark, names, start, end)
                 .where(F.array_contains("week", weekday))
                 .where((weekday != 5) | F.col("saturday_until").isNull()
                        | (F.col("day") < F.col("saturday_until")))
                 .where(F.col("day") > F.col("listed_after")))
    return open_days.join(holidays(spark, names, start, end, extra_closed), ["calendar", "day"],
                          "left_anti")


def times_on(days: DataFrame, times: DataFrame) -> DataFrame:
    """Regular times valid on each day: (calendar, day, event, minutes).

    The rule in force has ``valid_from <= day < valid_to``. The calendar is the
    equality key of the join; the period is a residual predicate.
    """
    valid = (F.col("day") >= F.col("valid_from")) & (F.col("day") < F.col("valid_to"))
    joined = days.join(F.broadcast(times), "calendar").where(valid)
    saturday = ((F.weekday("day") == 5) & (F.col("event") == "market_close") & ~F.col("custom")
                & F.col("saturday_close").isNotNull())
    return joined.withColumn(
        "minutes", F.when(saturday, F.col("saturday_close")).otherwise(F.col("minutes")))


def special_days(spark: SparkSession, names: list[str], start, end) -> DataFrame:
    """Irregular times by rule, weekday and list: (calendar, day, event, minutes)."""
    start, end = as_date(start), as_date(end)
    chosen = registry.resolve(names)
    columns = ["calendar", "event", "minutes", "day"]
    by_rule = rule_days(spark, registry.special_rule_rows(chosen), start, end).select(
        "calendar", "event", "minutes", F.col("day_off").alias("day"))
    listed = local_table(spark, registry.special_date_rows(chosen),
                         "calendar string, event string, minutes int, day date")
    days = by_rule.unionByName(listed)
    weekly = registry.special_weekday_rows(chosen)
    if weekly:
        table = local_table(spark, weekly, "calendar string, event string, minutes int, wd int")
        span = F.explode(F.sequence(F.lit(start), F.lit(end)))
        days = days.unionByName(table.withColumn("day", span)
                                .where(F.weekday("day") == F.col("wd")).select(*columns))
    return days.where(F.col("day").between(F.lit(start), F.lit(end)))


def special_dates(spark: SparkSession, names: list[str], start, end, event: str,
                  filter_holidays: bool = True) -> DataFrame:
    """Special days of one event, by default only those that are session dates."""
    days = (special_days(spark, names, start, end).where(F.col("event") == event)
            .groupBy("calendar", "day", "event").agg(F.min("minutes").alias("minutes")))
    if filter_holidays:
        days = days.join(valid_days(spark, names, start, end).select("calendar", "day"),
                         ["calendar", "day"], "left_semi")
    return days


def sessions(spark: SparkSession, names: list[str], start, end,
             force_special_times: bool | None = True,
             market_times: DataFrame | None = None,
             extra_closed: DataFrame | None = None) -> DataFrame:
    """The schedule in UTC: session_date, the six market events, and the regular
    open and close that special times replaced.

    ``force_special_times`` True applies special opens and closes and clamps the
    other events of those days to them; False only replaces; None ignores them.
    """
    names = [registry.get_calendar(n).name for n in names]
    times = market_times if market_times is not None else registry.market_times_table(spark, names)
    days = valid_days(spark, names, start, end, extra_closed)
    entries = times_on(days, times).select(
        "calendar", "day", "event", F.lit(False).alias("special"), "minutes")
    if force_special_times is not None:
        entries = entries.unionByName(special_days(spark, names, start, end)
                                      .withColumn("special", F.lit(True)))
    # One shuffle: regular and special times of a day meet in the same group. Two
    # special times for one event: the earlier one is kept.
    of = lambda event, special: F.when(
        (F.col("event") == event) & (F.col("special") == special), F.col("minutes"))
    rows = (entries.groupBy("calendar", "day")
            .agg(*[F.max(of(e, False)).alias(e) for e in EVENTS],
                 *[F.min(of(e, True)).alias(f"special_{e}") for e in EVENTS])
            .where(F.col("market_open").isNotNull())
            .join(F.broadcast(registry.calendars_table(spark, names).select("calendar", "zone")),
                  "calendar"))
    instant = lambda minutes: market_wall_to_utc(F.col("day"), minutes, F.col("zone"))
    chosen = {e: F.coalesce(F.col(f"special_{e}"), F.col(e)) for e in EVENTS}
    if force_special_times is True:
        opened, closed = F.col("special_market_open"), F.col("special_market_close")
        chosen = {e: _clamped(c, opened, closed) for e, c in chosen.items()}
    return rows.select(
        "calendar", F.col("day").alias("session_date"),
        *[instant(chosen[e]).alias(e) for e in EVENTS],
        instant(F.col("market_open")).alias("regular_open"),
        instant(F.col("market_close")).alias("regular_close"))


def _clamped(minutes: Column, opened: Column, closed: Column) -> Column:
    """Not before a special open and not after a special close; absent stays absent."""
    return F.when(minutes.isNotNull(), F.least(F.greatest(minutes, opened), closed))


def early_closes(schedule: DataFrame) -> DataFrame:
    return schedule.where(F.col("market_close") < F.col("regular_close"))


def late_opens(schedule: DataFrame) -> DataFrame:
    return schedule.where(F.col("market_open") > F.col("regular_open"))


# --- interruptions --------------------------------------------------------

def with_interruptions(schedule: DataFrame, interruptions: DataFrame) -> DataFrame:
    """A row per session date and interruption, numbered by start; one row with
    nulls where there is none. Interruptions are rows (calendar, session_date,
    start, end), as many as there are."""
    order = Window.partitionBy("calendar", "session_date").orderBy("start", "end")
    numbered = interruptions.select(
        "calendar", "session_date", F.row_number().over(order).alias("interruption"),
        F.col("start").alias("interruption_start"), F.col("end").alias("interruption_end"))
    return schedule.join(numbered, ["calendar", "session_date"], "left")


# --- merging --------------------------------------------------------------

def merge_schedules(schedule: DataFrame, how: str = "outer", calendars: int | None = None) -> DataFrame:
    """One schedule from several calendars, n-ary and with a single shuffle.

    ``calendars`` is how many were asked for; an inner merge needs it, since a
    calendar without any session in the range leaves no row to be counted.

    Outer spans from the first open to the last close of a date, inner keeps
    only dates and hours in which every calendar is open. Breaks are lost.
    """
    if how not in ("outer", "inner"):
        raise ValueError("how must be outer or inner")
    if how == "inner" and calendars is None:
        raise ValueError("an inner merge needs the number of calendars")
    first, last = (F.min, F.max) if how == "outer" else (F.max, F.min)
    merged = schedule.groupBy("session_date").agg(
        first("market_open").alias("market_open"), last("market_close").alias("market_close"),
        F.count_distinct("calendar").alias("_present"))
    if how == "inner":
        merged = merged.where(F.col("_present") == calendars)
    return merged.drop("_present")
