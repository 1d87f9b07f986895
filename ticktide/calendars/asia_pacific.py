"""Asian and Australian markets."""

from __future__ import annotations

from datetime import date

from ticktide.calendars.europe import (
    CHRISTMAS_ON_WORKDAY, EASTER_MONDAY, GOOD_FRIDAY, JUBILEE, SIFMA_BOXING_DAY,
    SIFMA_CHRISTMAS_EVE, SIFMA_INDEPENDENCE, SIFMA_MAY_DAY, SIFMA_NEW_YEAR, SIFMA_SUMMER,
    WEEKEND_BOXING_DAY, WEEKEND_CHRISTMAS)
from ticktide.calendars.model import (
    MON, SUN, THU, TUE, WED, Calendar, MarketTime, Rule, Special, at, dates, each_day, fixed,
    movable, weekday)
from ticktide.calendars.us import (
    JUNETEENTH, LABOR, MEMORIAL, MLK, NEW_YEAR, PRESIDENTS, SIFMA_VETERANS, THANKSGIVING, hours)

TO_MONDAY = "sunday_to_monday"


# --- Japan; rules and dates are fixed values ------------------------------

def japan(name: str, month: int, day: int, plain: tuple[str | None, str] | None,
          monday: tuple[str, str | None]) -> tuple[Rule, ...]:
    """A day that first had no substitute and later moved from Sunday to Monday."""
    later = fixed(name, month, day, TO_MONDAY, since=monday[0], until=monday[1])
    return ((fixed(name, month, day, since=plain[0], until=plain[1]),) if plain else ()) + (later,)


def equinox(name: str, which: str) -> tuple[Rule, ...]:
    return (movable(name, which, until="1972"), movable(name, which, 0, TO_MONDAY, since="1973"))


COMING_OF_AGE = weekday("Coming of Age Day", 1, 1, MON, 2, since="2000")
FOUNDATION = japan("National Foundation Day", 2, 11, ("1969", "1973"), ("1974", None))
EMPEROR = japan("The Emperor's Birthday", 2, 23, None, ("2020", None))
SPRING_EQUINOX = equinox("Vernal Equinox", "spring_equinox")
AUTUMN_EQUINOX = equinox("Autumnal Equinox", "autumn_equinox")
SHOWA = japan("Showa Day", 4, 29, (None, "1972"), ("1973", None))
CONSTITUTION = japan("Constitution Memorial Day", 5, 3, ("1948", "1972"), ("1973", None))
GREENERY = japan("Greenery Day", 5, 4, None, ("1985", None))
CHILDREN = japan("Children's Day", 5, 5, ("1948", "1972"), ("1973", None))
MARINE = weekday("Marine Day", 7, 1, MON, 3, since="2022")
MOUNTAIN = japan("Mountain Day", 8, 11, None, ("2022", None))
AGED = weekday("Respect for the Aged Day", 9, 1, MON, 3, since="2003")
HEALTH_2000 = weekday("Health and Sports Day", 10, 1, MON, 2, since="2000", until="2019")
SPORTS_2020 = fixed("Sports Day", 7, 24, years=(2020,))
SPORTS = weekday("Sports Day", 10, 1, MON, 2, since="2022")
CULTURE = japan("Culture Day", 11, 3, ("1948", "1972"), ("1973", None))
LABOR_THANKSGIVING = japan("Labor Thanksgiving Day", 11, 23, (None, "1972"), ("1973", None))
CITIZENS_DAY = movable("Citizen's Holiday", "autumn_equinox", -1, "if_day_after_third_monday",
                       since="2003", until="2098")

JPX = Calendar(
    "JPX", ("JPX", "XJPX"), "Asia/Tokyo",
    hours(at(9), at(15), at(11, 30), at(12, 30))
    + (MarketTime("market_close", at(15, 30), date(2024, 11, 5)),),
    (NEW_YEAR, fixed("January 2", 1, 2, TO_MONDAY), fixed("January 3", 1, 3))
    + japan("Coming of Age Day", 1, 15, ("1951", "1973"), ("1974", "1999")) + (COMING_OF_AGE,)
    + FOUNDATION + EMPEROR + SPRING_EQUINOX + SHOWA + CONSTITUTION + GREENERY + CHILDREN
    + (fixed("Golden Week substitute", 5, 6, since="2007", weekdays=(TUE, WED)),
       fixed("Marine Day", 7, 20, TO_MONDAY, since="1996", until="2002"),
       weekday("Marine Day", 7, 1, MON, 3, since="2003", until="2019"),
       fixed("Marine Day", 7, 23, years=(2020,)), fixed("Marine Day", 7, 22, years=(2021,)), MARINE,
       fixed("Mountain Day", 8, 11, TO_MONDAY, since="2016", until="2019"),
       fixed("Mountain Day", 8, 10, years=(2020,)), fixed("Mountain Day", 8, 8, years=(2021,)),
       fixed("Mountain Day, in lieu", 8, 9, years=(2021,)))
    + MOUNTAIN
    + japan("Respect for the Aged Day", 9, 15, ("1966", "1972"), ("1973", "2002")) + (AGED,)
    + AUTUMN_EQUINOX + (CITIZENS_DAY,)
    + japan("Health and Sports Day", 10, 10, ("1966", "1972"), ("1973", "1999"))
    + (HEALTH_2000, SPORTS_2020, fixed("Sports Day", 7, 23, years=(2021,)), SPORTS)
    + CULTURE + LABOR_THANKSGIVING
    + japan("The Emperor's Birthday", 12, 23, None, ("1990", "2018"))
    + (fixed("December 29", 12, 29, until="1988"), fixed("December 30", 12, 30, until="1988"),
       fixed("New Year's Eve", 12, 31, TO_MONDAY)),
    dates("1951-02-15 1953-02-09 1954-10-26 1959-04-10 1989-02-24 1990-11-12 1993-06-09",
          "2019-04-30 2019-05-01 2019-05-02 2019-10-22 2020-10-01"))

SIFMA_JP = Calendar(
    "SIFMA_JP",
    ("SIFMAJP", "SIFMA_JP", "Capital_Markets_JP", "Financial_Markets_JP", "Bond_Markets_JP"),
    "Asia/Tokyo", hours(at(8, 30), at(18, 30)),
    (SIFMA_NEW_YEAR, COMING_OF_AGE, MLK, FOUNDATION[-1], PRESIDENTS.between("1971")) + EMPEROR
    + SPRING_EQUINOX + (GOOD_FRIDAY, EASTER_MONDAY, SHOWA[-1], CONSTITUTION[-1]) + GREENERY
    + (CHILDREN[-1], MEMORIAL, JUNETEENTH, SIFMA_INDEPENDENCE, MARINE) + MOUNTAIN
    + (SIFMA_SUMMER, LABOR, AGED) + AUTUMN_EQUINOX
    + (SPORTS, SPORTS_2020, HEALTH_2000, CULTURE[-1]) + SIFMA_VETERANS
    + (LABOR_THANKSGIVING[-1], THANKSGIVING, CHRISTMAS_ON_WORKDAY, SIFMA_CHRISTMAS_EVE,
       SIFMA_BOXING_DAY, WEEKEND_BOXING_DAY),
    JUBILEE, (Special("market_close", at(15), rules=(SIFMA_MAY_DAY, WEEKEND_CHRISTMAS)),))


# --- Hong Kong; rules and dates are fixed values --------------------------

def spring_festival(since: str, until: str | None, moves: tuple[str, str, str]) -> tuple[Rule, ...]:
    return tuple(movable(f"Spring Festival, day {k + 1}", "spring", k, move, since=since, until=until)
                 for k, move in enumerate(moves))


def mid_autumn(since: str, until: str | None, observe: str) -> Rule:
    return movable("Day after Mid-Autumn Festival", "mid_autumn", 1, observe, since=since, until=until)


_FORWARD = ("sunday_plus_3", "sunday_plus_2", "sunday_plus_1")
_BACKWARD = ("sunday_minus_1", "sunday_minus_2", "sunday_minus_3")

HKEX = Calendar(
    "HKEX", ("HKEX",), "Asia/Shanghai", hours(at(9, 30), at(16), at(12), at(13)),
    (NEW_YEAR,) + spring_festival("1961", "1983-01-01", _FORWARD)
    + spring_festival("1983", "2010-07-01", _BACKWARD)
    + spring_festival("2010-07-01", None, _FORWARD)
    + (GOOD_FRIDAY, EASTER_MONDAY, movable("Tomb-Sweeping Day", "qingming", 0, TO_MONDAY, since="1961"),
       fixed("Labour Day", 5, 1, TO_MONDAY, since="1999-05-01"),
       movable("Buddha's Birthday", "buddha", 0, TO_MONDAY, since="1999-04-28"),
       movable("Dragon Boat Festival", "dragon_boat", 0, TO_MONDAY, since="1961"),
       fixed("Establishment Day", 7, 1, TO_MONDAY, since="1997-07-01"),
       mid_autumn("1961", "1983-01-01", TO_MONDAY), mid_autumn("1983", "2010", "sunday_minus_1"),
       mid_autumn("2011", None, TO_MONDAY),
       fixed("National Day", 10, 1, TO_MONDAY, since="1997-07-01"),
       movable("Double Ninth Festival", "double_ninth", 0, TO_MONDAY, since="1961"),
       fixed("Christmas", 12, 25, "sunday_plus_2", since="1954"),
       fixed("Boxing Day", 12, 26, TO_MONDAY, since="1954"),
       weekday("Liberation Day", 8, 31, MON, -1, since="1945-08-30", until="1997-07-01"),
       weekday("Queen's Birthday", 6, 1, MON, 3, since="1983", until="1997-06-01",
               not_years=(1983, 1985, 1988, 1993, 1994)),
       weekday("Queen's Birthday", 6, 1, MON, 2, years=(1983, 1988, 1993, 1994)),
       weekday("Queen's Birthday", 6, 1, MON, 4, years=(1985,)),
       fixed("Queen's Birthday", 4, 21, TO_MONDAY, since="1926-04-21", until="1983-01-01",
             not_years=(1974, 1981)),
       weekday("Queen's Birthday", 4, 21, SUN, 1, years=(1974, 1981)),
       weekday("First Monday in August", 8, 1, MON, 1, since="1960-08-01", until="1983-01-01")),
    dates("1970-07-01 1970-07-16 1970-09-14 1971-03-22 1971-07-01 1971-07-22 1971-08-31 1971-12-06",
          "1971-12-20 1973-04-16 1973-07-02 1973-07-17 1974-04-25 1974-07-01 1975-07-01 1975-07-28",
          "1975-10-14 1976-07-01 1977-07-01 1978-07-26 1978-07-27 1979-01-26 1979-07-02 1979-08-02",
          "1980-05-21 1980-07-01 1980-07-22 1981-04-27 1981-07-01 1981-07-06 1981-07-07 1981-07-29",
          "1982-07-01 1983-09-09 1985-06-24 1985-07-29 1986-04-01 1986-10-22 1987-10-20 1987-10-21",
          "1987-10-22 1987-10-23 1988-04-05 1991-06-18 1992-07-22 1993-09-17 1994-06-14 1997-06-30",
          "1997-07-02 1997-08-18 1997-10-02 1998-08-17 1998-10-02 1999-04-06 1999-09-16 1999-12-31",
          "2001-07-06 2001-07-25 2008-08-06 2008-08-22 2010-04-06 2011-09-29 2012-10-02 2013-08-14",
          "2015-04-07 2015-09-03 2016-08-02 2016-10-21 2017-08-23 2023-07-17 2023-09-01",
          "2023-09-08"))


# --- Shanghai; rules and dates are fixed values ---------------------------

_DAY_OFF = ("next_monday", "second_day_in_lieu", "third_day_in_lieu")


def three_days(name: str, month: int, day: int) -> tuple[Rule, ...]:
    return tuple(fixed(name, month, day + k, observe, since=f"2024-{month:02d}-{day + k:02d}")
                 for k, observe in enumerate(_DAY_OFF))


def three_lunar_days(name: str, festival: str, since: str) -> tuple[Rule, ...]:
    return tuple(movable(name, festival, k, observe, since=since)
                 for k, observe in enumerate(_DAY_OFF))


SSE_RULES = (
    three_days("New Year's Day", 1, 1)
    + tuple(movable("Spring Festival", "spring", k, since=f"2024-01-{21 + k}") for k in range(-1, 6))
    + three_days("Labour Day", 5, 1)
    + three_lunar_days("Tomb-Sweeping Day", "qingming", "2024-04-04")
    + three_lunar_days("Dragon Boat Festival", "dragon_boat", "2024-05-27")
    + three_lunar_days("Mid-Autumn Festival", "mid_autumn", "2024-09-07")
    + tuple(fixed("National Day", 10, k, since="2024-10-01") for k in range(1, 8)))

# The published closing days
SSE_CLOSED = dates(
    "1991-01-01 1991-02-15 1991-02-18 1991-05-01 1991-10-01 1991-10-02",
    "1992-01-01 1992-02-04 1992-02-05 1992-02-06 1992-05-01 1992-10-01 1992-10-02",
    "1993-01-01 1993-01-25 1993-01-26 1993-10-01",
    "1994-02-07 1994-02-08 1994-02-09 1994-02-10 1994-02-11 1994-05-02 1994-10-03 1994-10-04",
    "1995-01-02 1995-01-30 1995-01-31 1995-02-01 1995-02-02 1995-02-03 1995-05-01 1995-10-02",
    "1995-10-03",
    "1996-01-01 1996-02-19 1996-02-20 1996-02-21 1996-02-22 1996-02-23 1996-02-26 1996-02-27",
    "1996-02-28 1996-02-29 1996-03-01 1996-05-01 1996-09-30 1996-10-01 1996-10-02",
    "1997-01-01 1997-02-03 1997-02-04 1997-02-05 1997-02-06 1997-02-07 1997-02-10 1997-02-11",
    "1997-02-12 1997-02-13 1997-02-14 1997-05-01 1997-05-02 1997-06-30 1997-07-01 1997-10-01",
    "1997-10-02 1997-10-03",
    "1998-01-01 1998-01-02 1998-01-26 1998-01-27 1998-01-28 1998-01-29 1998-01-30 1998-02-02",
    "1998-02-03 1998-02-04 1998-02-05 1998-02-06 1998-05-01 1998-10-01 1998-10-02",
    "1999-01-01 1999-02-10 1999-02-11 1999-02-12 1999-02-15 1999-02-16 1999-02-17 1999-02-18",
    "1999-02-19 1999-02-22 1999-02-23 1999-02-24 1999-02-25 1999-02-26 1999-05-03 1999-10-01",
    "1999-10-04 1999-10-05 1999-10-06 1999-10-07 1999-12-20 1999-12-31",
    "2000-01-03 2000-01-31 2000-02-01 2000-02-02 2000-02-03 2000-02-04 2000-02-07 2000-02-08",
    "2000-02-09 2000-02-10 2000-02-11 2000-05-01 2000-05-02 2000-05-03 2000-05-04 2000-05-05",
    "2000-10-02 2000-10-03 2000-10-04 2000-10-05 2000-10-06",
    "2001-01-01 2001-01-22 2001-01-23 2001-01-24 2001-01-25 2001-01-26 2001-01-29 2001-01-30",
    "2001-01-31 2001-02-01 2001-02-02 2001-05-01 2001-05-02 2001-05-03 2001-05-04 2001-05-07",
    "2001-10-01 2001-10-02 2001-10-03 2001-10-04 2001-10-05",
    "2002-01-01 2002-01-02 2002-01-03 2002-02-11 2002-02-12 2002-02-13 2002-02-14 2002-02-15",
    "2002-02-18 2002-02-19 2002-02-20 2002-02-21 2002-02-22 2002-05-01 2002-05-02 2002-05-03",
    "2002-05-06 2002-05-07 2002-09-30 2002-10-01 2002-10-02 2002-10-03 2002-10-04 2002-10-07",
    "2003-01-01 2003-01-30 2003-01-31 2003-02-03 2003-02-04 2003-02-05 2003-02-06 2003-02-07",
    "2003-05-01 2003-05-02 2003-05-05 2003-05-06 2003-05-07 2003-05-08 2003-05-09 2003-10-01",
    "2003-10-02 2003-10-03 2003-10-06 2003-10-07",
    "2004-01-01 2004-01-19 2004-01-20 2004-01-21 2004-01-22 2004-01-23 2004-01-26 2004-01-27",
    "2004-01-28 2004-05-03 2004-05-04 2004-05-05 2004-05-06 2004-05-07 2004-10-01 2004-10-04",
    "2004-10-05 2004-10-06 2004-10-07",
    "2005-01-03 2005-02-07 2005-02-08 2005-02-09 2005-02-10 2005-02-11 2005-02-14 2005-02-15",
    "2005-05-02 2005-05-03 2005-05-04 2005-05-05 2005-05-06 2005-10-03 2005-10-04 2005-10-05",
    "2005-10-06 2005-10-07",
    "2006-01-02 2006-01-03 2006-01-26 2006-01-27 2006-01-30 2006-01-31 2006-02-01 2006-02-02",
    "2006-02-03 2006-05-01 2006-05-02 2006-05-03 2006-05-04 2006-05-05 2006-10-02 2006-10-03",
    "2006-10-04 2006-10-05 2006-10-06",
    "2007-01-01 2007-01-02 2007-01-03 2007-02-19 2007-02-20 2007-02-21 2007-02-22 2007-02-23",
    "2007-05-01 2007-05-02 2007-05-03 2007-05-04 2007-05-07 2007-10-01 2007-10-02 2007-10-03",
    "2007-10-04 2007-10-05 2007-12-31",
    "2008-01-01 2008-02-06 2008-02-07 2008-02-08 2008-02-11 2008-02-12 2008-04-04 2008-05-01",
    "2008-05-02 2008-06-09 2008-09-15 2008-09-29 2008-09-30 2008-10-01 2008-10-02 2008-10-03",
    "2009-01-01 2009-01-02 2009-01-26 2009-01-27 2009-01-28 2009-01-29 2009-01-30 2009-04-06",
    "2009-05-01 2009-05-28 2009-05-29 2009-10-01 2009-10-02 2009-10-05 2009-10-06 2009-10-07",
    "2009-10-08",
    "2010-01-01 2010-02-15 2010-02-16 2010-02-17 2010-02-18 2010-02-19 2010-04-05 2010-05-03",
    "2010-06-14 2010-06-15 2010-06-16 2010-09-22 2010-09-23 2010-09-24 2010-10-01 2010-10-04",
    "2010-10-05 2010-10-06 2010-10-07",
    "2011-01-03 2011-02-02 2011-02-03 2011-02-04 2011-02-07 2011-02-08 2011-04-04 2011-04-05",
    "2011-05-02 2011-06-06 2011-09-12 2011-10-03 2011-10-04 2011-10-05 2011-10-06 2011-10-07",
    "2012-01-02 2012-01-03 2012-01-23 2012-01-24 2012-01-25 2012-01-26 2012-01-27 2012-04-02",
    "2012-04-03 2012-04-04 2012-04-30 2012-05-01 2012-06-22 2012-10-01 2012-10-02 2012-10-03",
    "2012-10-04 2012-10-05",
    "2013-01-01 2013-01-02 2013-01-03 2013-02-11 2013-02-12 2013-02-13 2013-02-14 2013-02-15",
    "2013-04-04 2013-04-05 2013-04-29 2013-04-30 2013-05-01 2013-06-10 2013-06-11 2013-06-12",
    "2013-09-19 2013-09-20 2013-10-01 2013-10-02 2013-10-03 2013-10-04 2013-10-07",
    "2014-01-01 2014-01-31 2014-02-03 2014-02-04 2014-02-05 2014-02-06 2014-04-07 2014-05-01",
    "2014-05-02 2014-06-02 2014-09-08 2014-10-01 2014-10-02 2014-10-03 2014-10-06 2014-10-07",
    "2015-01-01 2015-01-02 2015-02-18 2015-02-19 2015-02-20 2015-02-23 2015-02-24 2015-04-06",
    "2015-05-01 2015-06-22 2015-09-03 2015-09-04 2015-10-01 2015-10-02 2015-10-05 2015-10-06",
    "2015-10-07",
    "2016-01-01 2016-02-08 2016-02-09 2016-02-10 2016-02-11 2016-02-12 2016-04-04 2016-05-02",
    "2016-06-09 2016-06-10 2016-09-15 2016-09-16 2016-10-03 2016-10-04 2016-10-05 2016-10-06",
    "2016-10-07",
    "2017-01-02 2017-01-27 2017-01-30 2017-01-31 2017-02-01 2017-02-02 2017-04-03 2017-04-04",
    "2017-05-01 2017-05-29 2017-05-30 2017-10-02 2017-10-03 2017-10-04 2017-10-05 2017-10-06",
    "2018-01-01 2018-02-15 2018-02-16 2018-02-19 2018-02-20 2018-02-21 2018-04-05 2018-04-06",
    "2018-04-30 2018-05-01 2018-06-18 2018-09-24 2018-10-01 2018-10-02 2018-10-03 2018-10-04",
    "2018-10-05 2018-12-31",
    "2019-01-01 2019-02-04 2019-02-05 2019-02-06 2019-02-07 2019-02-08 2019-04-05 2019-05-01",
    "2019-05-02 2019-05-03 2019-06-07 2019-09-13 2019-10-01 2019-10-02 2019-10-03 2019-10-04",
    "2019-10-07",
    "2020-01-01 2020-01-24 2020-01-27 2020-01-28 2020-01-29 2020-01-30 2020-01-31 2020-04-06",
    "2020-05-01 2020-05-04 2020-05-05 2020-06-25 2020-06-26 2020-10-01 2020-10-02 2020-10-05",
    "2020-10-06 2020-10-07 2020-10-08",
    "2021-01-01 2021-02-11 2021-02-12 2021-02-15 2021-02-16 2021-02-17 2021-04-05 2021-05-03",
    "2021-05-04 2021-05-05 2021-06-14 2021-09-20 2021-09-21 2021-10-01 2021-10-04 2021-10-05",
    "2021-10-06 2021-10-07",
    "2022-01-03 2022-01-31 2022-02-01 2022-02-02 2022-02-03 2022-02-04 2022-04-04 2022-04-05",
    "2022-05-02 2022-05-03 2022-05-04 2022-06-03 2022-09-12 2022-10-03 2022-10-04 2022-10-05",
    "2022-10-06 2022-10-07",
    "2023-01-02 2023-01-23 2023-01-24 2023-01-25 2023-01-26 2023-01-27 2023-04-05 2023-05-01",
    "2023-05-02 2023-05-03 2023-06-22 2023-06-23 2023-09-29 2023-10-02 2023-10-03 2023-10-04",
    "2023-10-05 2023-10-06",
    "2024-01-01 2024-02-09 2024-02-12 2024-02-13 2024-02-14 2024-02-15 2024-02-16 2024-04-04",
    "2024-04-05 2024-05-01 2024-05-02 2024-05-03 2024-06-10 2024-09-16 2024-09-17 2024-10-01",
    "2024-10-02 2024-10-03 2024-10-04 2024-10-07",
)

SSE = Calendar(
    "SSE", ("SSE",), "Asia/Shanghai", hours(at(9, 30), at(15), at(11, 30), at(13)),
    SSE_RULES, SSE_CLOSED)


# --- Bombay ---------------------------------------------------------------

# The published closing days
BSE_CLOSED = dates(
    "1997-01-23 1997-03-07 1997-03-24 1997-04-08 1997-04-14 1997-04-16 1997-04-18 1997-05-01",
    "1997-05-08 1997-08-15 1997-08-18 1997-08-25 1997-10-02 1997-10-28 1997-10-29 1997-10-31",
    "1997-12-25",
    "1998-04-09 1998-04-14 1998-04-28 1998-12-25",
    "1999-01-01 1999-01-20 1999-01-26 1999-03-02 1999-03-18 1999-03-25 1999-03-29 1999-04-02",
    "1999-04-14 1999-04-27 1999-04-30 1999-09-13 1999-10-19 1999-11-08 1999-11-10 1999-11-23",
    "1999-12-31",
    "2000-01-26 2000-03-17 2000-03-20 2000-04-14 2000-04-21 2000-05-01 2000-08-15 2000-09-01",
    "2000-10-02 2000-12-25",
    "2001-01-01 2001-01-26 2001-03-06 2001-04-05 2001-04-13 2001-05-01 2001-08-15 2001-08-22",
    "2001-10-02 2001-10-26 2001-11-16 2001-11-30 2001-12-17 2001-12-25",
    "2002-03-25 2002-03-29 2002-05-01 2002-08-15 2002-09-10 2002-10-02 2002-10-15 2002-11-06",
    "2002-11-19 2002-12-25",
    "2003-02-13 2003-03-14 2003-03-18 2003-04-14 2003-04-18 2003-05-01 2003-08-15 2003-10-02",
    "2003-11-26 2003-12-25",
    "2004-01-01 2004-01-26 2004-02-02 2004-03-02 2004-04-09 2004-04-14 2004-04-26 2004-10-13",
    "2004-10-22 2004-11-15 2004-11-26",
    "2005-01-21 2005-01-26 2005-03-25 2005-04-14 2005-07-28 2005-08-15 2005-09-07 2005-10-12",
    "2005-11-03 2005-11-04 2005-11-15",
    "2006-01-11 2006-01-26 2006-02-09 2006-03-15 2006-04-06 2006-04-11 2006-04-14 2006-05-01",
    "2006-08-15 2006-10-02 2006-10-24 2006-10-25 2006-12-25",
    "2007-01-01 2007-01-26 2007-01-30 2007-02-16 2007-03-27 2007-04-06 2007-05-01 2007-05-02",
    "2007-08-15 2007-10-02 2007-12-21 2007-12-25",
    "2008-03-06 2008-03-20 2008-03-21 2008-04-14 2008-04-18 2008-05-01 2008-05-19 2008-08-15",
    "2008-09-03 2008-10-02 2008-10-09 2008-10-30 2008-11-13 2008-11-27 2008-12-09 2008-12-25",
    "2009-01-08 2009-01-26 2009-02-23 2009-03-10 2009-03-11 2009-04-03 2009-04-07 2009-04-10",
    "2009-04-14 2009-04-30 2009-05-01 2009-09-21 2009-09-28 2009-10-02 2009-10-13 2009-10-19",
    "2009-11-02 2009-12-25 2009-12-28",
    "2010-01-01 2010-01-26 2010-02-12 2010-03-01 2010-03-24 2010-04-02 2010-04-14 2010-09-10",
    "2010-11-17 2010-12-17",
    "2011-01-26 2011-03-02 2011-04-12 2011-04-14 2011-04-22 2011-08-15 2011-08-31 2011-09-01",
    "2011-10-06 2011-10-27 2011-11-07 2011-11-10 2011-12-06",
    "2012-01-26 2012-02-20 2012-03-08 2012-04-05 2012-04-06 2012-05-01 2012-08-15 2012-08-20",
    "2012-09-19 2012-10-02 2012-10-24 2012-11-14 2012-11-28 2012-12-25",
    "2013-03-27 2013-03-29 2013-04-19 2013-04-24 2013-05-01 2013-08-09 2013-08-15 2013-09-09",
    "2013-10-02 2013-10-16 2013-11-04 2013-11-15 2013-12-25",
    "2014-02-27 2014-03-17 2014-04-08 2014-04-14 2014-04-18 2014-04-24 2014-05-01 2014-07-29",
    "2014-08-15 2014-08-29 2014-10-02 2014-10-03 2014-10-06 2014-10-15 2014-10-24 2014-11-04",
    "2014-11-06 2014-12-25",
    "2015-01-26 2015-02-17 2015-03-06 2015-04-02 2015-04-03 2015-04-14 2015-05-01 2015-09-17",
    "2015-09-25 2015-10-02 2015-10-22 2015-11-12 2015-11-25 2015-12-25",
    "2016-01-26 2016-03-07 2016-03-24 2016-03-25 2016-04-14 2016-04-15 2016-04-19 2016-07-06",
    "2016-08-15 2016-09-05 2016-09-13 2016-10-11 2016-10-12 2016-10-31 2016-11-14",
    "2017-01-26 2017-02-24 2017-03-13 2017-04-04 2017-04-14 2017-05-01 2017-06-26 2017-08-15",
    "2017-08-25 2017-10-02 2017-10-20 2017-12-25",
    "2018-01-26 2018-02-13 2018-03-02 2018-03-29 2018-03-30 2018-05-01 2018-08-15 2018-08-22",
    "2018-09-13 2018-09-20 2018-10-02 2018-10-18 2018-11-08 2018-11-23 2018-12-25",
    "2019-03-04 2019-03-21 2019-04-17 2019-04-19 2019-04-29 2019-05-01 2019-06-05 2019-08-12",
    "2019-08-15 2019-09-02 2019-09-10 2019-10-02 2019-10-08 2019-10-21 2019-10-28 2019-11-12",
    "2019-12-25",
    "2020-02-21 2020-03-10 2020-04-02 2020-04-06 2020-04-10 2020-04-14 2020-05-01 2020-07-31",
    "2020-10-02 2020-11-16 2020-11-30 2020-12-25",
    "2021-01-26 2021-03-11 2021-03-29 2021-04-02 2021-04-14 2021-04-21 2021-05-13 2021-07-21",
    "2021-08-19 2021-09-10 2021-10-15 2021-11-04 2021-11-05 2021-11-19",
    "2022-01-26 2022-03-01 2022-03-18 2022-04-14 2022-04-15 2022-05-03 2022-08-09 2022-08-15",
    "2022-08-31 2022-10-05 2022-10-24 2022-10-26 2022-11-08",
    "2023-01-26 2023-03-07 2023-03-30 2023-04-04 2023-04-07 2023-04-14 2023-05-01 2023-06-29",
    "2023-08-15 2023-09-19 2023-10-02 2023-10-24 2023-11-14 2023-11-27 2023-12-25",
    "2024-01-26 2024-03-08 2024-03-25 2024-03-29 2024-04-11 2024-04-17 2024-05-01 2024-06-17",
    "2024-07-17 2024-08-15 2024-10-02 2024-11-01 2024-11-15 2024-12-25",
)

BSE = Calendar("BSE", ("BSE", "NSE", "XNSE"), "Asia/Calcutta", hours(at(9, 15), at(15, 30)),
               (), BSE_CLOSED)

# --- Tel Aviv; dates are fixed values -------------------------------------

TASE_CLOSED = dates(
    "2019-03-21 2019-04-09 2019-04-25 2019-04-26 2019-05-08 2019-05-09 2019-06-09 2019-08-11",
    "2019-09-17 2019-09-29 2019-09-30 2019-10-01 2019-10-08 2019-10-09 2019-10-13 2019-10-14",
    "2019-10-20 2019-10-21",
    "2020-03-02 2020-03-10 2020-04-08 2020-04-09 2020-04-14 2020-04-15 2020-04-28 2020-04-29",
    "2020-05-28 2020-05-29 2020-07-30 2020-09-20 2020-09-27 2020-09-28",
    "2021-02-26 2021-03-28 2021-04-02 2021-04-14 2021-04-15 2021-05-16 2021-05-17 2021-07-18",
    "2021-09-06 2021-09-07 2021-09-08 2021-09-15 2021-09-16 2021-09-20 2021-09-21 2021-09-27",
    "2021-09-28",
    "2022-03-17 2022-03-18 2022-04-15 2022-04-21 2022-04-22 2022-05-05 2022-06-05 2022-08-07",
    "2022-09-25 2022-09-26 2022-09-27 2022-10-04 2022-10-05 2022-10-09 2022-10-10 2022-10-16",
    "2022-10-17 2022-11-01",
    "2023-03-07 2023-03-08 2023-04-05 2023-04-06 2023-04-11 2023-04-12 2023-04-25 2023-04-26",
    "2023-05-25 2023-05-26 2023-07-27 2023-09-15 2023-09-17 2023-09-24 2023-09-25 2023-09-29",
    "2023-10-06 2023-10-31",
    "2024-03-24 2024-03-25 2024-04-22 2024-04-23 2024-04-28 2024-04-29 2024-05-13 2024-05-14",
    "2024-06-11 2024-06-12 2024-08-13 2024-10-02 2024-10-03 2024-10-04 2024-10-11 2024-10-16",
    "2024-10-17 2024-10-23 2024-10-24",
    "2025-03-14 2025-04-13 2025-04-18 2025-04-30 2025-05-01 2025-06-01 2025-06-02 2025-08-03",
    "2025-09-22 2025-09-23 2025-09-24 2025-10-01 2025-10-02 2025-10-06 2025-10-07 2025-10-13",
    "2025-10-14",
)

TASE = Calendar("TASE", ("TASE",), "Asia/Jerusalem", hours(at(10), at(15, 59)), (), TASE_CLOSED,
                week=(SUN, MON, TUE, WED, THU))

# --- Sydney; rules and dates are fixed values -----------------------------

ASX = Calendar(
    "ASX", ("ASX",), "Australia/Sydney", hours(at(10), at(16, 10)),
    (fixed("New Year's Day", 1, 1, "weekend_to_monday"),
     fixed("Australia Day", 1, 26, "weekend_to_monday"), fixed("Anzac Day", 4, 25),
     weekday("Queen's Birthday", 6, 1, MON, 2), fixed("Christmas", 12, 25, "weekend_to_monday"),
     fixed("Boxing Day", 12, 26, "next_monday_or_tuesday"), GOOD_FRIDAY, EASTER_MONDAY),
    dates("2022-09-22"))

CALENDARS = (JPX, SIFMA_JP, HKEX, SSE, BSE, TASE, ASX)
