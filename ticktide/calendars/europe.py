"""European markets."""

from __future__ import annotations

from ticktide.calendars.model import (
    FRI, MON, THU, TUE, WORKDAYS, Calendar, MarketTime, Special, at, dates, easter, fixed, weekday)
from ticktide.calendars.us import (
    COLUMBUS, JUNETEENTH, LABOR, MEMORIAL, MLK, PRESIDENTS, SIFMA_VETERANS, THANKSGIVING, hours)

# Rules and dates below are fixed values.
GOOD_FRIDAY = easter("Good Friday", -2)
EASTER_MONDAY = easter("Easter Monday", 1)
CHRISTMAS = fixed("Christmas", 12, 25)
CHRISTMAS_ON_WORKDAY = fixed("Christmas", 12, 25, weekdays=WORKDAYS)
WEEKEND_CHRISTMAS = fixed("Christmas, in lieu", 12, 27, weekdays=(MON, TUE))
BOXING_DAY = fixed("Boxing Day", 12, 26)
WEEKEND_BOXING_DAY = fixed("Boxing Day, in lieu", 12, 28, weekdays=(MON, TUE))
LAST_FRIDAY_EVES = (fixed("Christmas Eve", 12, 24, "previous_friday"),
                    fixed("New Year's Eve", 12, 31, "previous_friday"))
SHORT_EVES = (Special("market_close", at(12, 30), rules=LAST_FRIDAY_EVES),)
EARLY_MAY = weekday("Early May Bank Holiday", 5, 1, MON, 1)
SPRING_BANK = weekday("Spring Bank Holiday", 5, 31, MON, -1)


def workday(name: str, month: int, day: int):
    return fixed(name, month, day, weekdays=WORKDAYS)


EUREX = Calendar(
    "EUREX", ("EUREX",), "Europe/Berlin", hours(at(9), at(17, 30)),
    (workday("New Year's Day", 1, 1), GOOD_FRIDAY, EASTER_MONDAY, workday("May Day", 5, 1),
     CHRISTMAS_ON_WORKDAY, WEEKEND_CHRISTMAS, BOXING_DAY, WEEKEND_BOXING_DAY), (), SHORT_EVES)

EUREX_BOND = Calendar(
    "EUREX_Bond", ("EUREX_Bond",), "Europe/Berlin",
    hours(at(1, 10), at(22)) + (MarketTime("market_open", at(8), dates("2018-12-10")[0]),),
    (workday("New Year's Day", 1, 1), GOOD_FRIDAY, EASTER_MONDAY, workday("May Day", 5, 1),
     workday("Christmas Eve", 12, 24), CHRISTMAS_ON_WORKDAY, workday("Boxing Day", 12, 26),
     workday("New Year's Eve", 12, 31)))

LSE = Calendar(
    "LSE", ("LSE",), "Europe/London", hours(at(8), at(16, 30)),
    (fixed("New Year's Day", 1, 1, "weekend_to_monday"), GOOD_FRIDAY, EASTER_MONDAY,
     EARLY_MAY.between(None, "1994"), EARLY_MAY.between("1996", "2019"), EARLY_MAY.between("2021"),
     SPRING_BANK.between(None, "2001"), SPRING_BANK.between("2003", "2011"),
     SPRING_BANK.between("2013"),
     weekday("Summer Bank Holiday", 8, 31, MON, -1), CHRISTMAS, WEEKEND_CHRISTMAS, BOXING_DAY,
     WEEKEND_BOXING_DAY),
    dates("1973-11-14 1977-06-07 1981-07-29 1995-05-08 1999-12-31 2002-06-03 2002-06-04",
          "2011-04-29 2012-06-04 2012-06-05 2020-05-08 2022-06-02 2022-06-03 2022-09-19",
          "2023-05-08"),
    SHORT_EVES)

OSE = Calendar(
    "OSE", ("OSE",), "Europe/Oslo", hours(at(9), at(16, 20)),
    (fixed("New Year's Day", 1, 1), easter("Maundy Thursday", -3), GOOD_FRIDAY, EASTER_MONDAY,
     fixed("Labour Day", 5, 1), fixed("Constitution Day", 5, 17), easter("Whit Monday", 50),
     easter("Ascension Day", 39), fixed("Christmas Eve", 12, 24), CHRISTMAS, BOXING_DAY,
     fixed("New Year's Eve", 12, 31)), (),
    (Special("market_close", at(13), rules=(easter("Wednesday before Easter", -4),)),))

SIX = Calendar(
    "SIX", ("SIX",), "Europe/Zurich", hours(at(9), at(17, 30)),
    (workday("New Year's Day", 1, 1), workday("Berchtold's Day", 1, 2), GOOD_FRIDAY, EASTER_MONDAY,
     workday("May Day", 5, 1), easter("Ascension Day", 39, weekdays=(THU,)),
     easter("Whit Monday", 50, weekdays=(MON,)), workday("National Day", 8, 1),
     fixed("Christmas Eve", 12, 24), CHRISTMAS_ON_WORKDAY, BOXING_DAY,
     fixed("New Year's Eve", 12, 31, "previous_friday")))

# Rules that the bond market schedules of London and Tokyo share.
SIFMA_NEW_YEAR = fixed("New Year's Day", 1, 1, "next_monday")
SIFMA_MAY_DAY = weekday("May Day", 5, 1, MON, 1)
SIFMA_SUMMER = weekday("Summer Bank Holiday", 8, 30, MON, -1)
SIFMA_CHRISTMAS_EVE = fixed("Christmas Eve", 12, 24, weekdays=(FRI,))
SIFMA_BOXING_DAY = workday("Boxing Day", 12, 26)
SIFMA_INDEPENDENCE = fixed("Independence Day", 7, 4, "nearest_workday", weekdays=WORKDAYS)
JUBILEE = dates("2022-06-02 2022-06-03")

SIFMA_UK = Calendar(
    "SIFMA_UK",
    ("SIFMAUK", "SIFMA_UK", "Capital_Markets_UK", "Financial_Markets_UK", "Bond_Markets_UK"),
    "Europe/London", hours(at(8), at(17)),
    (SIFMA_NEW_YEAR, MLK, PRESIDENTS.between("1971"), GOOD_FRIDAY, EASTER_MONDAY, SIFMA_MAY_DAY,
     MEMORIAL, JUNETEENTH, SIFMA_INDEPENDENCE, SIFMA_SUMMER, LABOR, COLUMBUS) + SIFMA_VETERANS
    + (THANKSGIVING, CHRISTMAS_ON_WORKDAY, SIFMA_CHRISTMAS_EVE, WEEKEND_CHRISTMAS,
       SIFMA_BOXING_DAY, WEEKEND_BOXING_DAY), JUBILEE)

CALENDARS = (EUREX, EUREX_BOND, LSE, OSE, SIX, SIFMA_UK)
