"""Questions about timestamps: the session around, before and after each one.

A dense table with one row per calendar day carries the session on or before
the day and the next one after it. Trades meet it on (calendar, day), which is
an equality join with a small table: no range join, no scan of sessions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ticktide.calendars import registry
from ticktide.calendars.sessions import as_date, calendar_days, sessions
from ticktide.functions import times
from ticktide.operators.lookups import SALTS, asof_backward, salted_lookup
from ticktide.session import BROADCAST_LIMIT_BYTES

_CARRIED = ("session", "pre", "open", "break_start", "break_end", "close", "post", "seconds_before",
            "ordinal")
ROW_BYTES = 320


@dataclass(frozen=True)
class DayTable:
    """Dense days and the exact upper bound of their number, known before any job."""

    frame: DataFrame
    rows: int

    @property
    def fits_broadcast(self) -> bool:
        return self.rows * ROW_BYTES <= BROADCAST_LIMIT_BYTES

    def only(self, calendar: str) -> "DayTable":
        name = registry.get_calendar(calendar).name
        return DayTable(self.frame.where(F.col("calendar") == name), self.rows)


def day_table(spark: SparkSession, names: list[str], start, end, **schedule_options) -> DayTable:
    """Days from ``start`` to ``end``; sessions at both edges are included when
    the range has a margin of some days around the trades."""
    names = [registry.get_calendar(n).name for n in names]
    schedule = sessions(spark, names, start, end, **schedule_options)
    return dense_days(spark, names, schedule, start, end)


_kept: dict[tuple, DayTable] = {}


def shared_day_table(spark: SparkSession, names: tuple[str, ...], start: str, end: str) -> DayTable:
    """A day table kept for the session: every lookup of a market reads the same
    few thousand rows. Lost blocks are computed again from the rules."""
    key = (spark.sparkContext.applicationId, names, start, end)
    if key not in _kept:
        table = day_table(spark, list(names), start, end)
        _kept[key] = DayTable(table.frame.persist(), table.rows)
    return _kept[key]


def dense_days(spark: SparkSession, names: list[str], schedule: DataFrame, start, end) -> DayTable:
    by_date = Window.partitionBy("calendar").orderBy("session_date")
    seconds = F.unix_seconds("market_close") - F.unix_seconds("market_open")
    numbered = schedule.select(
        "calendar", F.col("session_date").alias("day"),
        F.struct(
            F.col("session_date").alias("session"), "pre", F.col("market_open").alias("open"),
            "break_start", "break_end", F.col("market_close").alias("close"), "post",
            F.coalesce(F.sum(seconds).over(by_date.rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0)).alias("seconds_before"),
            F.row_number().over(by_date).alias("ordinal")).alias("row"))
    days = calendar_days(spark, names, start, end).select("calendar", "zone", "day")
    in_order = Window.partitionBy("calendar").orderBy("day")
    carried = (days.join(numbered, ["calendar", "day"], "left")
               .withColumn("at", F.last("row", ignorenulls=True).over(
                   in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
               .withColumn("next", F.first("row", ignorenulls=True).over(
                   in_order.rowsBetween(1, Window.unboundedFollowing))))
    frame = carried.select(
        "calendar", "zone", "day", F.col("row").isNotNull().alias("is_session"),
        *[F.col(f"{side}.{name}").alias(f"{side}_{name}")
          for side in ("at", "next") for name in _CARRIED])
    n_days = as_date(end).toordinal() - as_date(start).toordinal() + 1
    return DayTable(frame, len(names) * n_days)


def attach(trades: DataFrame, table: DayTable, instant: str, calendar: str, by: str = "local",
           prefix: str = "", strict: bool = True) -> DataFrame:
    """Add the day table's columns to every trade.

    A trade on a day that the table does not have is an error; with ``strict``
    False its columns are null and `is_covered` is False. Null times have null
    columns either way.

    ``by="local"`` looks up the market's own date, ``by="utc"`` the UTC date,
    ``by="before"`` the UTC date of the moment just before the timestamp.
    """
    zone = registry.get_calendar(calendar).zone
    day = {"local": lambda: times.market_date(F.col(instant), zone),
           "utc": lambda: times.utc_date(F.col(instant)),
           "before": lambda: times.utc_date(F.col(instant) - F.expr("INTERVAL 1 MICROSECOND")),
           }[by]()
    key = f"{prefix}day"
    days = table.only(calendar).frame.drop("calendar", "zone")
    days = days.select(*[F.col(c).alias(prefix + c) for c in days.columns])
    keyed = trades.withColumn(key, day)
    if table.fits_broadcast:
        joined = keyed.join(F.broadcast(days), [key], "left")
    else:
        joined = salted_lookup(keyed, days, [key], "left", SALTS)
    if not strict:
        return joined
    text = F.concat(F.lit("no calendar day for "), F.col(key).cast("string"))
    missing = F.col(key).isNotNull() & F.col(f"{prefix}is_session").isNull()
    return joined.where(F.when(missing, F.raise_error(text).cast("boolean")).otherwise(True))


# --- inside a session -----------------------------------------------------

def _state(side: str, t: Column, include_close: bool, only_rth: bool, post_counts: bool) -> Column:
    low, high = F.col(f"{side}_open"), F.col(f"{side}_close")
    if not only_rth:
        low = F.coalesce(F.col(f"{side}_pre"), low)
        if post_counts:
            high = F.coalesce(F.col(f"{side}_post"), high)
    pause = (F.col(f"{side}_break_start"), F.col(f"{side}_break_end"))
    if include_close:
        inside = (t > low) & (t <= high)
        resting = (t > pause[0]) & (t <= pause[1])
    else:
        inside = (t >= low) & (t < high)
        resting = (t >= pause[0]) & (t < pause[1])
    return F.coalesce(inside, F.lit(False)) & ~F.coalesce(resting, F.lit(False))


def is_open(t: Column, include_close: bool = False, only_rth: bool = False,
            interrupted: Column | None = None) -> Column:
    """Open at a timestamp, on a row attached by local date, and not interrupted
    (a column of `with_interrupted`).

    Outside regular hours the time between the close and ``post`` counts as
    open. An evening open belongs to the next session date, so both are asked.
    """
    opened = (_state("at", t, include_close, only_rth, True)
              | _state("next", t, include_close, only_rth, True))
    return opened if interrupted is None else opened & ~interrupted


def with_interrupted(trades: DataFrame, interruptions: DataFrame, instant: str, day: str,
                     bucket_seconds: int = 3600) -> DataFrame:
    """Add ``interrupted``: inside any interruption of the session date ``day``.

    The last interruption that began at or before a trade is found by an as-of
    join; it carries the latest end so far, which covers earlier and longer ones.
    """
    began = Window.partitionBy("session_date").orderBy("start")
    halts = interruptions.withColumn("_until", F.unix_micros(F.max("end").over(began))).select(
        F.col("session_date").alias("_halt_day"), F.unix_micros("start").alias("_start"), "_until")
    keyed = trades.withColumns({"_halt_day": F.col(day), "_us": F.unix_micros(instant)})
    found = asof_backward(keyed, halts, ["_halt_day"], "_us", "_start", ["_until"], bucket_seconds * 1_000_000)
    return found.withColumn("interrupted", F.coalesce(F.col("_us") < F.col("_until"), F.lit(False))).select(
        *trades.columns, "interrupted")


def is_covered(t: Column, only_rth: bool = False) -> Column:
    """Whether the day table reaches far enough to answer."""
    low = F.col("at_open") if only_rth else F.coalesce("at_pre", "at_open")
    around = F.col("at_session").isNotNull() & F.col("next_session").isNotNull()
    return around | (
        F.coalesce(t >= low, F.lit(False)) & F.coalesce(t <= F.coalesce("at_post", "at_close"),
                                                        F.lit(False)))


def in_session(t: Column, name: str) -> Column:
    """A column of the session whose regular hours contain the timestamp: its
    date (``session``), ``open``, ``close`` and so on; null outside."""
    inside = lambda side: (t >= F.col(f"{side}_open")) & (t < F.col(f"{side}_close"))
    return F.when(inside("next"), F.col(f"next_{name}")).when(inside("at"), F.col(f"at_{name}"))


def is_regular_hours(t: Column) -> Column:
    """Between open and close, both included, of the session on the UTC date."""
    return F.col("is_session") & F.coalesce(
        t.between(F.col("at_open"), F.col("at_close")), F.lit(False))


def is_session_date() -> Column:
    return F.coalesce(F.col("is_session"), F.lit(False))


def _minutes(later: Column, earlier: Column) -> Column:
    return times.floor_div(F.unix_micros(later) - F.unix_micros(earlier), 60_000_000)


def minutes_until_close(t: Column) -> Column:
    """Minutes to the close of the session on the UTC date; -1 without one."""
    running = F.col("is_session") & (t < F.col("at_close"))
    return F.when(running, _minutes(F.col("at_close"), t)).otherwise(F.lit(-1).cast("bigint"))


def minutes_until_next(t: Column, event: str) -> Column:
    """Minutes to the open or close of the first session after the UTC date."""
    return _minutes(F.col(f"next_{event}"), t)


def trading_day(t: Column) -> dict[str, Column]:
    """Summary of the session on the UTC date; null columns without a session."""
    opened = F.when(F.col("is_session"), F.col("at_open"))
    closed = F.when(F.col("is_session"), F.col("at_close"))
    clock = lambda instant, unit, cycle: F.pmod(
        times.floor_div(F.unix_seconds(instant), unit), F.lit(cycle)).cast("int")
    length = F.unix_seconds(closed) - F.unix_seconds(opened)
    left = lambda mark: F.when(mark.isNotNull(), F.when(t < mark, _minutes(mark, t)).otherwise(0))
    return {
        "open_hour": clock(opened, 3600, 24), "open_minute": clock(opened, 60, 60),
        "close_hour": clock(closed, 3600, 24), "close_minute": clock(closed, 60, 60),
        "hours_in_trading_day": times.floor_div(length, 3600),
        "minutes_in_trading_day": times.floor_div(length, 60),
        "is_session": is_session_date(),
        "minutes_until_open": left(opened), "minutes_until_close": left(closed),
        "days_until_open": F.when(opened.isNotNull(), F.when(
            t < opened, F.datediff(times.utc_date(opened), times.utc_date(t))).otherwise(0)),
        "session_type": F.lit("rth"),
    }


# --- between two timestamps -----------------------------------------------

def sessions_up_to(prefix: str = "") -> Column:
    """Number of session dates up to and including the attached day."""
    return F.coalesce(F.col(f"{prefix}at_ordinal"), F.lit(0))


def trading_days_between(start_prefix: str, end_prefix: str) -> Column:
    """Session dates from the start day to the end day, both included. A row
    costs two lookups however long the range is."""
    first = F.coalesce(F.col(f"{start_prefix}at_ordinal"), F.lit(0)) - F.col(
        f"{start_prefix}is_session").cast("int")
    return sessions_up_to(end_prefix) - first


def seconds_up_to(t: Column, prefix: str = "") -> Column:
    """Trading seconds before a timestamp since the start of the table."""

    def part(side: str) -> Column:
        opened, closed = (F.unix_seconds(F.col(f"{prefix}{side}_{e}")) for e in ("open", "close"))
        gone = F.least(F.unix_seconds(t), closed) - opened
        return F.coalesce(F.greatest(gone, F.lit(0).cast("bigint")), F.lit(0).cast("bigint"))

    before = F.coalesce(F.col(f"{prefix}at_seconds_before"), F.lit(0).cast("bigint"))
    return before + part("at") + part("next")


def trading_minutes_between(start: Column, end: Column, start_prefix: str,
                            end_prefix: str) -> Column:
    """Sum of the overlaps with all sessions, as a difference of two prefix sums."""
    return times.floor_div(seconds_up_to(end, end_prefix) - seconds_up_to(start, start_prefix), 60)
