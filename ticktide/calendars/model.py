"""Calendars as data: what a market's rows look like, and how to write them.

A rule names a day of every year. It is an anchor day, optionally moved by an
observance, and is dropped when its weekday or date is out of bounds.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date

MON, TUE, WED, THU, FRI, SAT, SUN = range(7)
WORKDAYS = (MON, TUE, WED, THU, FRI)
ANY_DAY = (MON, TUE, WED, THU, FRI, SAT, SUN)

FIRST, LAST = date(1800, 1, 1), date(2200, 12, 31)


@dataclass(frozen=True)
class Rule:
    """One yearly rule. ``anchor`` is one of

    fixed     month/day
    weekday   the n-th ``weekday`` on or after month/day, or with n < 0 on or before it
    festival  a movable day by name: easter, an equinox, qingming or a festival
              of the lunisolar calendar

    ``shift`` moves the anchor by days and ``observe`` names the rule for days off.
    """

    name: str
    anchor: str = "fixed"
    month: int = 1
    day: int = 1
    weekday: int = 0
    nth: int = 0
    festival: str = ""
    shift: int = 0
    observe: str = ""
    weekdays: tuple[int, ...] = ANY_DAY
    since: date = FIRST
    until: date = LAST
    years: tuple[int, ...] = ()
    not_years: tuple[int, ...] = ()
    every: int = 1

    def between(self, since: str | None = None, until: str | None = None) -> "Rule":
        """The same rule with other bounds; a bare year means its first or last day."""
        return replace(self, since=_bound(since, "-01-01", self.since),
                       until=_bound(until, "-12-31", self.until))


def _bound(text: str | None, rest: str, default: date) -> date:
    if text is None:
        return default
    return date.fromisoformat(text + rest if len(text) == 4 else text)


def fixed(name: str, month: int, day: int, observe: str = "", **more) -> Rule:
    return _made(Rule(name, "fixed", month, day, observe=observe), more)


def weekday(name: str, month: int, day: int, which: int, nth: int, **more) -> Rule:
    return _made(Rule(name, "weekday", month, day, which, nth), more)


def easter(name: str, shift: int, **more) -> Rule:
    return _made(Rule(name, "festival", festival="easter", shift=shift), more)


def movable(name: str, festival: str, shift: int = 0, observe: str = "", **more) -> Rule:
    return _made(Rule(name, "festival", festival=festival, shift=shift, observe=observe), more)


def _made(rule: Rule, more: dict) -> Rule:
    since, until = more.pop("since", None), more.pop("until", None)
    return replace(rule, **more).between(since, until)


@dataclass(frozen=True)
class MarketTime:
    """A regular time of day: minutes after local midnight of the session date,
    negative for the evening before."""

    event: str
    minutes: int
    since: date = FIRST


def at(hour: int, minute: int = 0, days: int = 0) -> int:
    return days * 1440 + hour * 60 + minute


@dataclass(frozen=True)
class Special:
    """An irregular open or close: by rules, by weekday or on listed dates."""

    event: str
    minutes: int
    rules: tuple[Rule, ...] = ()
    dates: tuple[date, ...] = ()
    on_weekday: int | None = None


@dataclass(frozen=True)
class Calendar:
    name: str
    aliases: tuple[str, ...]
    zone: str
    times: tuple[MarketTime, ...]
    holidays: tuple[Rule, ...] = ()
    closed: tuple[date, ...] = ()
    specials: tuple[Special, ...] = ()
    week: tuple[int, ...] = WORKDAYS
    # Saturdays were sessions before this date and closed at this minute.
    saturday_until: date | None = None
    saturday_close: int | None = None
    # Sessions exist only after this date.
    listed_after: date = FIRST
    opens: dict[str, bool] = field(default_factory=lambda: dict(OPENS))


# Whether an event opens (true) or closes the market; fixed values.
OPENS = {"market_open": True, "market_close": False, "break_start": False,
         "break_end": True, "pre": True, "post": False}


def dates(*texts: str) -> tuple[date, ...]:
    """ISO dates, any number per string."""
    return tuple(date.fromisoformat(t) for text in texts for t in text.split())


def each_day(first: str, last: str, week: tuple[int, ...] = WORKDAYS) -> tuple[date, ...]:
    """All days of a period whose weekday is in ``week``."""
    a, b = date.fromisoformat(first).toordinal(), date.fromisoformat(last).toordinal()
    return tuple(d for d in map(date.fromordinal, range(a, b + 1)) if d.weekday() in week)
