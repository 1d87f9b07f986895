"""All calendars by name and alias, and their rows as small tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ticktide.calendars import americas, asia_pacific, europe, us
from ticktide.calendars.model import FIRST, LAST, OPENS, Calendar, Rule
from ticktide.session import local_table

CALENDARS: dict[str, Calendar] = {
    c.name: c for c in us.CALENDARS + europe.CALENDARS + asia_pacific.CALENDARS + americas.CALENDARS}
ALIASES: dict[str, str] = {
    alias: c.name for c in CALENDARS.values() for alias in (c.name, *c.aliases)}

_STAY = (0, 0, 0, 0, 0, 0, 0)
# Days to move by weekday, Monday first; None drops the day. Fixed values.
MOVES: dict[str, tuple[int | None, ...]] = {
    "sunday_to_monday": (0, 0, 0, 0, 0, 0, 1),
    "weekend_to_monday": (0, 0, 0, 0, 0, 2, 1),
    "next_monday": (0, 0, 0, 0, 0, 2, 1),
    "nearest_workday": (0, 0, 0, 0, 0, -1, 1),
    "previous_saturday": (-2, -3, 0, 0, 0, 0, -1),
    "next_saturday": (0, 0, 0, 2, 1, 0, 0),
    "next_monday_or_tuesday": (1, 0, 0, 0, 0, 2, 2),
    "previous_friday": (0, 0, 0, 0, 0, -1, -2),
    "previous_workday": (-3, -1, -1, -1, -1, -1, -2),
    "second_day_in_lieu": (-2, -3, -3, -5, 0, 0, 0),
    "third_day_in_lieu": (-1, -2, -3, -3, -5, 0, 0),
    "day_before_if_tue_to_fri": (None, -1, -1, -1, -1, None, None),
    "sunday_plus_1": (0, 0, 0, 0, 0, 0, 1),
    "sunday_plus_2": (0, 0, 0, 0, 0, 0, 2),
    "sunday_plus_3": (0, 0, 0, 0, 0, 0, 3),
    "sunday_minus_1": (0, 0, 0, 0, 0, 0, -1),
    "sunday_minus_2": (0, 0, 0, 0, 0, 0, -2),
    "sunday_minus_3": (0, 0, 0, 0, 0, 0, -3),
}
# Conditions that drop a day for another reason than its own weekday.
CONDITIONS = ("unless_first_friday", "only_first_friday",
              "unless_christmas_or_new_year_on_friday", "if_day_after_third_monday")

RULE_DDL = ("calendar string, event string, minutes int, name string, anchor string, month int, "
            "day int, weekday int, nth int, festival string, shift int, "
            "moves array<int>, condition string, weekdays array<int>, since date, until date, "
            "years array<int>, not_years array<int>, every int")
TIME_DDL = ("calendar string, event string, minutes int, valid_from date, valid_to date, "
            "opens boolean, custom boolean")


def get_calendar(name: str) -> Calendar:
    try:
        return CALENDARS[ALIASES[name]]
    except KeyError:
        raise KeyError(f"no calendar {name!r}; known: {calendar_names()}") from None


def calendar_names() -> list[str]:
    return sorted(ALIASES)


def resolve(names: list[str]) -> list[Calendar]:
    return [get_calendar(name) for name in names]


def rule_row(calendar: str, event: str, minutes: int | None, rule: Rule) -> tuple:
    condition = rule.observe if rule.observe in CONDITIONS else ""
    moves = MOVES[rule.observe] if rule.observe and not condition else _STAY
    return (calendar, event, minutes, rule.name, rule.anchor, rule.month, rule.day, rule.weekday,
            rule.nth, rule.festival, rule.shift, list(moves), condition,
            list(rule.weekdays), rule.since, rule.until, list(rule.years), list(rule.not_years),
            rule.every)


def holiday_rule_rows(calendars: list[Calendar]) -> list[tuple]:
    return [rule_row(c.name, "holiday", None, r) for c in calendars for r in c.holidays]


def special_rule_rows(calendars: list[Calendar]) -> list[tuple]:
    return [rule_row(c.name, s.event, s.minutes, r)
            for c in calendars for s in c.specials for r in s.rules]


def closed_rows(calendars: list[Calendar]) -> list[tuple]:
    return [(c.name, d) for c in calendars for d in c.closed]


def special_date_rows(calendars: list[Calendar]) -> list[tuple]:
    return [(c.name, s.event, s.minutes, d) for c in calendars for s in c.specials for d in s.dates]


def special_weekday_rows(calendars: list[Calendar]) -> list[tuple]:
    return [(c.name, s.event, s.minutes, s.on_weekday)
            for c in calendars for s in c.specials if s.on_weekday is not None]


def time_rows(calendars: list[Calendar]) -> list[tuple]:
    """Regular times with the period each one is valid in; a later row for the
    same event ends the earlier one."""
    rows = []
    for c in calendars:
        for t in c.times:
            later = [o.since for o in c.times if o.event == t.event and o.since > t.since]
            rows.append((c.name, t.event, t.minutes, t.since, min(later, default=LAST),
                         c.opens.get(t.event), False))
    return rows


def calendar_rows(calendars: list[Calendar]) -> list[tuple]:
    return [(c.name, c.zone, list(c.week), c.saturday_until, c.saturday_close, c.listed_after)
            for c in calendars]


CALENDAR_DDL = ("calendar string, zone string, week array<int>, saturday_until date, "
                "saturday_close int, listed_after date")


def calendars_table(spark: SparkSession, names: list[str]) -> DataFrame:
    return local_table(spark, calendar_rows(resolve(names)), CALENDAR_DDL)


def aliases_table(spark: SparkSession) -> DataFrame:
    return local_table(spark, sorted(ALIASES.items()), "alias string, calendar string")


def market_times_table(spark: SparkSession, names: list[str]) -> DataFrame:
    return local_table(spark, time_rows(resolve(names)), TIME_DDL)


def open_close_map(spark: SparkSession) -> DataFrame:
    return local_table(spark, list(OPENS.items()), "event string, opens boolean")


# --- changes to regular times: plain DataFrame patches --------------------

def change_time(times: DataFrame, calendar: str, event: str, minutes: int,
                since: date = FIRST, opens: bool | None = None) -> DataFrame:
    """Replace all regular times of an event by one."""
    return add_time(remove_time(times, calendar, event), calendar, event, minutes, since,
                    OPENS.get(event) if opens is None else opens)


def add_time(times: DataFrame, calendar: str, event: str, minutes: int, since: date = FIRST,
             opens: bool | None = None) -> DataFrame:
    if event.startswith("interruption_"):
        raise ValueError("the interruption_ prefix is reserved")
    row = (calendar, event, minutes, since, LAST, opens, True)
    return times.unionByName(local_table(times.sparkSession, [row], TIME_DDL))


def remove_time(times: DataFrame, calendar: str, event: str) -> DataFrame:
    return times.where(f"NOT (calendar = '{calendar}' AND event = '{event}')")


def discontinue_time(times: DataFrame, calendar: str, event: str, when: date) -> DataFrame:
    """End the validity of an event; ``is_discontinued`` rows have a valid_to before LAST."""

    hit = (F.col("calendar") == calendar) & (F.col("event") == event)
    return times.withColumn("valid_to", F.when(hit, F.least("valid_to", F.lit(when)))
                            .otherwise(F.col("valid_to")))


