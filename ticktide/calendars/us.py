"""United States markets."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from ticktide.calendars.model import (
    FRI, MON, SAT, THU, TUE, WED, WORKDAYS, Calendar, MarketTime, Rule, Special, at, dates,
    each_day, easter, fixed, weekday)

SIX_DAYS = (MON, TUE, WED, THU, FRI, SAT)
NEW_YORK, CHICAGO = "America/New_York", "America/Chicago"

# Yearly US rules. Bounds differ between markets and are set with ``between``.
# Dates and bounds are fixed values.
NEW_YEAR = fixed("New Year's Day", 1, 1, "sunday_to_monday")
MLK = weekday("Martin Luther King Jr. Day", 1, 1, MON, 3)
PRESIDENTS = weekday("Presidents' Day", 2, 1, MON, 3)
GOOD_FRIDAY = easter("Good Friday", -2)
MEMORIAL = weekday("Memorial Day", 5, 25, MON, 1)
JUNETEENTH = fixed("Juneteenth", 6, 19, "nearest_workday", since="2022-06-19")
INDEPENDENCE = fixed("Independence Day", 7, 4, "nearest_workday")
LABOR = weekday("Labor Day", 9, 1, MON, 1)
COLUMBUS = weekday("Columbus Day", 10, 1, MON, 2)
THANKSGIVING = weekday("Thanksgiving", 11, 1, THU, 4)
DAY_AFTER_THANKSGIVING = weekday("Day after Thanksgiving", 11, 1, THU, 4, shift=1)
CHRISTMAS = fixed("Christmas", 12, 25, "nearest_workday")
CHRISTMAS_EVE = fixed("Christmas Eve", 12, 24, weekdays=(MON, TUE, WED, THU))
DAY_BEFORE_JULY_4 = fixed("Day before Independence Day", 7, 4, "day_before_if_tue_to_fri")


def friday_before(monday: Rule, since: str, until: str) -> Rule:
    return replace(monday, shift=-3, name=f"Friday before {monday.name}").between(since, until)


# National days of mourning and the hurricane of 2012
MOURNING = dates("1963-11-25 1968-04-09 1969-03-31 1972-12-28 1973-01-25 1994-04-27",
                 "2004-06-11 2007-01-02 2018-12-05")
SANDY = dates("2012-10-29 2012-10-30")

# --- NYSE -----------------------------------------------------------------

NYSE_RULES = (
    fixed("New Year's Day", 1, 1, "sunday_to_monday", since="1952-09-29", weekdays=WORKDAYS),
    fixed("New Year's Day", 1, 1, "sunday_to_monday", until="1952-09-28", weekdays=SIX_DAYS),
    MLK.between("1998"),
    PRESIDENTS.between("1971"),
    fixed("Washington's Birthday", 2, 22, "sunday_to_monday", until="1952-09-28", weekdays=SIX_DAYS),
    fixed("Washington's Birthday", 2, 22, "sunday_to_monday", since="1952-09-29", until="1963",
          weekdays=WORKDAYS),
    fixed("Washington's Birthday", 2, 22, "nearest_workday", since="1964", until="1970"),
    fixed("Lincoln's Birthday", 2, 12, "sunday_to_monday", since="1896", until="1953"),
    GOOD_FRIDAY.between("1908"),
    GOOD_FRIDAY.between("1885", "1897"),
    GOOD_FRIDAY.between("1899", "1905"),
    MEMORIAL.between("1971"),
    fixed("Memorial Day", 5, 30, "sunday_to_monday", until="1952-09-28", weekdays=SIX_DAYS),
    fixed("Memorial Day", 5, 30, "sunday_to_monday", since="1952-09-29", until="1963",
          weekdays=WORKDAYS),
    fixed("Memorial Day", 5, 30, "nearest_workday", since="1964", until="1969"),
    INDEPENDENCE.between("1954"),
    fixed("Independence Day", 7, 4, "sunday_to_monday", until="1952-09-28", weekdays=SIX_DAYS),
    fixed("Independence Day", 7, 4, "sunday_to_monday", since="1952-09-29", until="1953",
          weekdays=WORKDAYS),
    LABOR.between("1887"),
    fixed("Columbus Day", 10, 12, "sunday_to_monday", since="1909", until="1953"),
    weekday("Election Day", 11, 2, TUE, 1, since="1848", until="1967"),
    weekday("Presidential Election Day", 11, 2, TUE, 1, since="1968", until="1980", every=4),
    fixed("Veterans Day", 11, 11, "sunday_to_monday", since="1934", until="1953"),
    THANKSGIVING.between("1942"),
    weekday("Thanksgiving", 11, 30, THU, -1, since="1864", until="1938"),
    weekday("Thanksgiving", 11, 30, THU, -2, since="1939", until="1941"),
    CHRISTMAS.between("1954"),
    fixed("Christmas", 12, 25, "sunday_to_monday", until="1953"),
    JUNETEENTH,
)

# Closing days by occasion
NYSE_CLOSINGS = {
    "Saturday before New Year's Day": dates("1916-12-30"),
    "Saturday before Washington's Birthday": dates("1903-02-21"),
    "Saturday after Washington's Birthday": dates("1901-02-23 1907-02-23 1929-02-23 1946-02-23"),
    "Saturday before or after Lincoln's Birthday": dates("1899-02-11 1909-02-13"),
    "Lincoln's Birthday 1968": dates("1968-02-12"),
    "Grant's Birthday": dates("1897-04-27"),
    "Saturday after Good Friday": dates(
        "1900-04-14 1901-04-06 1902-03-29 1903-04-11 1905-04-22 1907-03-30 1908-04-18 1909-04-10",
        "1910-03-26 1911-04-15 1913-03-22 1920-04-03 1929-03-30 1930-04-19"),
    "Saturday before Decoration Day": dates(
        "1904-05-28 1909-05-29 1910-05-28 1921-05-28 1926-05-29 1937-05-29"),
    "Saturday after Decoration Day": dates("1902-05-31 1913-05-31 1919-05-31 1924-05-31 1930-05-31"),
    "Day before Decoration Day": dates("1899-05-29 1961-05-29"),
    "Monday before Independence Day": dates("1899-07-03"),
    "Saturday before Independence Day": dates(
        "1887-07-02 1892-07-02 1898-07-02 1904-07-02 1909-07-03 1910-07-02 1920-07-03 1921-07-02",
        "1926-07-03 1932-07-02 1937-07-03"),
    "Saturday after Independence Day": dates(
        "1890-07-05 1902-07-05 1913-07-05 1919-07-05 1930-07-05"),
    "Days after Independence Day": dates("1901-07-05 1901-07-06 1968-07-05"),
    "Saturday before Labor Day": dates(
        "1888-09-01 1898-09-03 1900-09-01 1901-08-31 1902-08-30 1903-09-05 1904-09-03 1907-08-31",
        "1908-09-05 1909-09-04 1910-09-03 1911-09-02 1912-08-31 1913-08-30 1917-09-01 1919-08-30",
        "1920-09-04 1921-09-03 1926-09-04 1929-08-31 1930-08-30 1931-09-05"),
    "Friday after Thanksgiving 1888": dates("1888-11-30"),
    "Christmas Eve": dates("1900-12-24 1945-12-24 1956-12-24"),
    "Day after Christmas": dates("1958-12-26"),
    "Saturday before Christmas": dates(
        "1887-12-24 1898-12-24 1904-12-24 1910-12-24 1911-12-23 1922-12-23 1949-12-24 1950-12-23"),
    "Saturday after Christmas": dates(
        "1891-12-26 1896-12-26 1903-12-26 1908-12-26 1925-12-26 1931-12-26 1936-12-26"),
    "Armistice and Veterans Day": dates("1921-11-11 1968-11-11"),
    "Saturday after Columbus Day": dates("1917-10-13 1945-10-13"),
    "Funeral of Ulysses Grant": dates("1885-08-08"),
    "Great blizzard": dates("1888-03-12 1888-03-13"),
    "Centennial of Washington's inauguration": dates("1889-04-29 1889-04-30 1889-05-01"),
    "Columbian celebration": dates("1892-10-12 1892-10-21 1892-10-22 1893-04-27"),
    "Charter Day": dates("1898-05-04"),
    "Welcome of the naval commander": dates("1898-08-20"),
    "Admiral Dewey celebration": dates("1899-09-29 1899-09-30"),
    "Funeral of Garret Hobart": dates("1899-11-25"),
    "Funeral of Queen Victoria": dates("1901-02-02"),
    "Move to the Produce Exchange": dates("1901-04-27 1901-05-11"),
    "Death and funeral of McKinley": dates("1901-09-14 1901-09-19"),
    "Coronation of King Edward VII": dates("1902-08-09"),
    "Opening of the new building": dates("1903-04-22"),
    "Hudson-Fulton celebration": dates("1909-09-25"),
    "Funeral of James Sherman": dates("1912-11-02"),
    "Onset of the war": each_day("1914-07-31", "1914-12-11", SIX_DAYS),
    "Draft registration": dates("1917-06-05 1918-09-12"),
    "Heat": dates("1917-08-04"),
    "Fuel shortage": dates("1918-01-28 1918-02-04 1918-02-11"),
    "Armistice signed": dates("1918-11-11"),
    "Homecoming and parade of divisions": dates("1919-03-25 1919-05-06"),
    "Backlog relief 1919": dates("1919-07-19 1919-08-02 1919-08-16"),
    "Return of General Pershing": dates("1919-09-10"),
    "Change of office locations": dates("1920-05-01"),
    "Death and funeral of Harding": dates("1923-08-03 1923-08-10"),
    "Lindbergh parade": dates("1927-06-13"),
    "Backlog relief 1928": dates(
        "1928-04-07 1928-04-21 1928-05-05 1928-05-12 1928-05-19 1928-05-26 1928-11-24"),
    "Backlog relief 1929": dates(
        "1929-02-09 1929-11-01 1929-11-02 1929-11-09 1929-11-16 1929-11-23 1929-11-29 1929-11-30"),
    "Funeral of Coolidge": dates("1933-01-07"),
    "Bank holidays": dates(
        "1933-03-04 1933-03-06 1933-03-07 1933-03-08 1933-03-09 1933-03-10 1933-03-11 1933-03-12",
        "1933-03-13 1933-03-14"),
    "Heavy volume 1933": dates("1933-07-29 1933-08-05 1933-08-12 1933-08-19 1933-08-26 1933-09-02"),
    "Summer Saturdays 1944": dates("1944-08-19 1944-08-26 1944-09-02"),
    "Day of mourning for Roosevelt": dates("1945-04-14"),
    "Summer Saturdays 1945": each_day("1945-07-07", "1945-09-01", (SAT,)),
    "VJ Day": dates("1945-08-15 1945-08-16"),
    "Navy Day": dates("1945-10-27"),
    "Railroad strike": dates("1946-05-25"),
    "Summer Saturdays 1946": each_day("1946-06-01", "1946-09-28", (SAT,)),
    "Summer Saturdays 1947": each_day("1947-05-31", "1947-09-27", (SAT,)),
    "Severe weather 1948": dates("1948-01-03"),
    "Summer Saturdays 1948": each_day("1948-05-29", "1948-09-25", (SAT,)),
    "Summer Saturdays 1949": each_day("1949-05-28", "1949-09-24", (SAT,)),
    "Summer Saturdays 1950": each_day("1950-06-03", "1950-09-30", (SAT,)),
    "Summer Saturdays 1951": each_day("1951-06-02", "1951-09-29", (SAT,)),
    "Summer Saturdays 1952": each_day("1952-05-31", "1952-09-27", (SAT,)),
    "Funeral of Kennedy": dates("1963-11-25"),
    "Day of mourning for Martin Luther King": dates("1968-04-09"),
    "Paperwork crisis": dates(
        "1968-06-12 1968-06-19 1968-06-26 1968-07-10 1968-07-17 1968-07-24 1968-07-31 1968-08-07",
        "1968-08-14 1968-08-21 1968-08-28 1968-09-11 1968-09-18 1968-09-25 1968-10-02 1968-10-09",
        "1968-10-16 1968-10-23 1968-10-30 1968-11-20 1968-12-04 1968-12-11 1968-12-18"),
    "Snow": dates("1969-02-10"),
    "Funeral of Eisenhower": dates("1969-03-31"),
    "First landing on the moon": dates("1969-07-21"),
    "Funeral of Truman": dates("1972-12-28"),
    "Funeral of Lyndon Johnson": dates("1973-01-25"),
    "Blackout": dates("1977-07-14"),
    "Hurricane Gloria": dates("1985-09-27"),
    "Funeral of Nixon": dates("1994-04-27"),
    "Attacks of September 11": dates("2001-09-11 2001-09-12 2001-09-13 2001-09-14"),
    "Mourning for Reagan": dates("2004-06-11"),
    "Mourning for Ford": dates("2007-01-02"),
    "Hurricane Sandy": SANDY,
    "Mourning for George H. W. Bush": dates("2018-12-05"),
}
NYSE_CLOSED = tuple(day for days in NYSE_CLOSINGS.values() for day in days)

_AFTER_1993 = DAY_AFTER_THANKSGIVING.between("1993")

# Late opens and early closes by time of day
NYSE_SPECIALS = (
    Special("market_open", at(9, 31), dates=dates("1990-12-27 1991-01-17 1991-02-25 2001-10-08")),
    Special("market_open", at(9, 32), dates=dates("2003-03-20 2004-06-07 2006-12-27")),
    Special("market_open", at(9, 33), dates=dates("2001-09-17")),
    Special("market_open", at(10, 15), dates=dates("1967-02-07 1974-01-16 1974-11-22 1976-06-08")),
    Special("market_open", at(10, 30), dates=dates("1919-12-30 1920-02-06 1995-12-18")),
    Special("market_open", at(10, 45), dates=dates("1925-01-24 1969-06-02")),
    Special("market_open", at(11), dates=dates(
        "1933-07-26 1933-07-27 1933-07-28 1934-02-20 1936-01-28 1960-12-12 1969-02-11",
        "1973-12-17 1978-02-07 1989-11-10 1996-01-08")),
    Special("market_open", at(11, 5), dates=dates("1965-11-10")),
    Special("market_open", at(11, 15), dates=dates("1976-02-02")),
    Special("market_open", at(12), dates=dates(
        "1910-05-20 1913-04-14 1913-09-22 1929-10-31 1933-07-24 1933-07-25 1978-01-20 2002-09-11")),
    Special("market_open", at(13), dates=dates("1921-08-02")),
    Special("market_close", at(11), dates=dates("1910-05-07")),
    Special("market_close", at(12), dates=dates(
        "1917-08-29 1917-10-24 1918-04-26 1920-09-16 1933-09-13")),
    Special("market_close", at(12, 30), dates=dates("1919-01-07 1924-02-06 1930-03-11 1933-08-04")),
    Special("market_close", at(13), rules=(
        fixed("Friday after Independence Day", 7, 5, weekdays=(FRI,), since="1996", until="2012"),
        fixed("Day before Independence Day", 7, 3, weekdays=(MON, TUE, THU), since="1995"),
        fixed("Wednesday before Independence Day", 7, 3, weekdays=(WED,), since="2013"),
        _AFTER_1993, CHRISTMAS_EVE.between("1999")),
        dates=dates("1908-06-26 1951-12-24 1996-12-24 1997-12-24 1997-12-26 1998-12-24",
                    "1999-12-24 2003-12-26") + dates(
            "1929-11-06 1929-11-07 1929-11-08 1929-11-11 1929-11-12 1929-11-13 1929-11-14 1929-11-15",
            "1929-11-18 1929-11-19 1929-11-20 1929-11-21 1929-11-22")),
    Special("market_close", at(14), rules=(DAY_AFTER_THANKSGIVING.between("1992", "1993-01-01"),),
            dates=dates("1964-10-23 1967-02-07 1974-12-24 1975-12-24 1978-02-06 1990-12-24",
                        "1991-12-24 1992-12-24 1996-01-08")
            + each_day("1928-05-21", "1928-05-25") + dates("1933-07-26 1933-07-27 1933-07-28")
            + each_day("1966-01-06", "1966-01-14") + each_day("1967-08-09", "1967-08-18")
            + each_day("1968-01-22", "1968-03-01") + each_day("1969-01-01", "1969-07-03")
            + each_day("1987-10-23", "1987-10-30")),
    Special("market_close", at(14, 7), dates=dates("1963-11-22")),
    Special("market_close", at(14, 30), dates=dates("1918-11-07 1925-09-18 1975-02-12 1994-02-11")
            + each_day("1969-07-07", "1969-09-26") + each_day("1987-11-02", "1987-11-04")),
    Special("market_close", at(15), dates=dates("1976-08-09")
            + each_day("1969-09-29", "1970-05-01") + each_day("1987-11-05", "1987-11-06")),
    Special("market_close", at(15, 17), dates=dates("1981-03-30")),
    Special("market_close", at(15, 28), dates=dates("1981-09-09")),
    Special("market_close", at(15, 30), dates=dates("1997-10-27")
            + each_day("1987-11-09", "1987-11-11")),
    Special("market_close", at(15, 56), dates=dates("2005-06-01")),
)

NYSE = Calendar(
    "NYSE", ("NYSE", "stock", "NASDAQ", "BATS", "DJIA", "DOW"), NEW_YORK,
    (MarketTime("pre", at(4)),
     MarketTime("market_open", at(10)), MarketTime("market_open", at(9, 30), date(1985, 1, 1)),
     MarketTime("market_close", at(15)), MarketTime("market_close", at(15, 30), date(1952, 9, 29)),
     MarketTime("market_close", at(16), date(1974, 1, 1)),
     MarketTime("post", at(20))),
    NYSE_RULES, NYSE_CLOSED, NYSE_SPECIALS, week=SIX_DAYS,
    saturday_until=date(1952, 9, 29), saturday_close=at(12))

IEX = Calendar(
    "IEX", ("IEX", "Investors_Exchange"), NEW_YORK,
    (MarketTime("pre", at(8)), MarketTime("market_open", at(9, 30)),
     MarketTime("market_close", at(16)), MarketTime("post", at(17))),
    (PRESIDENTS.between("1971"), GOOD_FRIDAY.between("1908"), MEMORIAL.between("1971"), JUNETEENTH,
     INDEPENDENCE.between("1954"), THANKSGIVING.between("1942"), CHRISTMAS.between("1999"),
     MLK.between("1998")),
    dates("1900-12-24 1945-12-24 1956-12-24"),
    (Special("market_close", at(13), rules=(_AFTER_1993,), dates=dates("2013-07-03")),),
    listed_after=date(2013, 8, 25))

# --- futures and options --------------------------------------------------

_OPEN_EVENING = at(17, days=-1)
_NOON = (MLK.between("1998"), PRESIDENTS, MEMORIAL.between("1971"), INDEPENDENCE.between("1954"),
         LABOR, THANKSGIVING)
_SHORT_DAYS = (_AFTER_1993, CHRISTMAS_EVE)
_FULL_DAYS = (NEW_YEAR, MLK.between("1998"), PRESIDENTS, GOOD_FRIDAY, MEMORIAL.between("1971"),
              INDEPENDENCE.between("1954"), LABOR, THANKSGIVING, CHRISTMAS.between("1954"))


def hours(open_minutes: int, close_minutes: int, break_start: int | None = None,
          break_end: int | None = None) -> tuple[MarketTime, ...]:
    times = [MarketTime("market_open", open_minutes), MarketTime("market_close", close_minutes)]
    if break_start is not None:
        times += [MarketTime("break_start", break_start), MarketTime("break_end", break_end)]
    return tuple(times)


_CFE_HOLIDAYS = (
    NEW_YEAR, MLK.between("1998"), PRESIDENTS,
    easter("Good Friday", -2, observe="unless_christmas_or_new_year_on_friday"),
    JUNETEENTH, INDEPENDENCE.between("1954"), MEMORIAL.between("1971"), LABOR, THANKSGIVING,
    CHRISTMAS.between("1954"))
_CFE_SPECIALS = (Special("market_close", at(12, 15), rules=(_AFTER_1993,)),)


def _cfe(name: str, aliases: tuple[str, ...], close: int) -> Calendar:
    return Calendar(name, aliases, CHICAGO, hours(at(8, 30), close), _CFE_HOLIDAYS,
                    SANDY + MOURNING, _CFE_SPECIALS)


CFE = _cfe("CFE", ("CFE", "CBOE_Futures"), at(15, 15))
CBOE_EQUITY_OPTIONS = _cfe("CBOE_Equity_Options", ("CBOE_Equity_Options",), at(15))
CBOE_INDEX_OPTIONS = _cfe("CBOE_Index_Options", ("CBOE_Index_Options",), at(15, 15))

CME_EQUITY = Calendar(
    "CME_Equity", ("CME_Equity", "CBOT_Equity"), CHICAGO,
    hours(_OPEN_EVENING, at(16), at(15, 15), at(15, 30)),
    (NEW_YEAR, GOOD_FRIDAY, CHRISTMAS.between("1954")), MOURNING,
    (Special("market_close", at(12), rules=_NOON + (JUNETEENTH,) + _SHORT_DAYS),))

CME_AGRICULTURE = Calendar(
    "CME_Agriculture",
    ("CME_Agriculture", "CBOT_Agriculture", "COMEX_Agriculture", "NYMEX_Agriculture"), CHICAGO,
    hours(at(17, 1, days=-1), at(17)), _FULL_DAYS + (JUNETEENTH,), MOURNING,
    (Special("market_close", at(12), rules=_SHORT_DAYS),))

# The jobs report comes out on the first Friday of a month; a Good Friday on
# that day is a short session, any other one is closed.
CME_BOND = Calendar(
    "CME_Bond",
    ("CME_Rate", "CBOT_Rate", "CME_InterestRate", "CBOT_InterestRate", "CME_Bond", "CBOT_Bond"),
    CHICAGO, hours(_OPEN_EVENING, at(16)),
    (NEW_YEAR, CHRISTMAS.between("1954"),
     easter("Good Friday", -2, observe="unless_first_friday", since="1970", until="2099")),
    MOURNING,
    (Special("market_close", at(12), rules=_NOON),
     Special("market_close", at(12, 15), rules=_SHORT_DAYS),
     Special("market_close", at(10), rules=(
         easter("Good Friday, jobs report", -2, observe="only_first_friday", since="1970",
                until="2099"),))))

GLOBEX_LIVESTOCK = Calendar(
    "CMEGlobex_Livestock",
    ("CMEGlobex_Livestock", "CMEGlobex_Live_Cattle", "CMEGlobex_Feeder_Cattle",
     "CMEGlobex_Lean_Hog", "CMEGlobex_Port_Cutout"), CHICAGO,
    hours(at(8, 30), at(13, 5)), _FULL_DAYS, (),
    (Special("market_close", at(12, 5), rules=_SHORT_DAYS),))

GLOBEX_GRAINS = Calendar(
    "CMEGlobex_GrainsAndOilseeds", ("CMEGlobex_Grains", "CMEGlobex_Oilseeds"), CHICAGO,
    hours(at(19, days=-1), at(13, 20), at(7, 45), at(8, 30)), _FULL_DAYS)

_UNTIL_2021 = (MLK.between("1998", "2021"), PRESIDENTS.between(None, "2021"),
               MEMORIAL.between(None, "2021"), INDEPENDENCE.between(None, "2021"))
_FROM_2022 = (MLK.between("2022"), PRESIDENTS.between("2022"), MEMORIAL.between("2022"),
              JUNETEENTH, INDEPENDENCE.between("2022"))
_GF_2021, _GF_2022 = GOOD_FRIDAY.between("2021", "2021"), GOOD_FRIDAY.between("2022", "2022")
_GF_FROM_2023 = GOOD_FRIDAY.between("2023")
_SHORT_GF = tuple(GOOD_FRIDAY.between(y, y) for y in ("2010", "2012", "2015")) + (
    _GF_2021, _GF_FROM_2023)
_GF_CLOSED = (easter("Good Friday", -2, until="2020", not_years=(2010, 2012, 2015)), _GF_2022)
_EVE_1993 = CHRISTMAS_EVE.between("1993")

GLOBEX_CRYPTO = Calendar(
    "CME Globex Crypto", ("CME Globex Cryptocurrencies", "CME Globex Crypto"), CHICAGO,
    hours(_OPEN_EVENING, at(16), at(16), at(17)),
    (GOOD_FRIDAY.between(None, "2020"), _GF_2022, CHRISTMAS.between("1999"), NEW_YEAR), (),
    (Special("market_close", at(8, 15), rules=(_GF_2021,)),
     Special("market_close", at(10, 15), rules=(_GF_FROM_2023,)),
     Special("market_close", at(12), rules=_UNTIL_2021 + (
         LABOR.between(None, "2021"), THANKSGIVING.between(None, "2021"))),
     Special("market_close", at(12, 15), rules=(
         _EVE_1993, DAY_BEFORE_JULY_4.between("1954"),
         DAY_AFTER_THANKSGIVING.between(None, "2020"))),
     Special("market_close", at(12, 45), rules=(DAY_AFTER_THANKSGIVING.between("2021"),)),
     Special("market_close", at(16), rules=_FROM_2022 + (
         LABOR.between("2022"), THANKSGIVING.between("2022")))))

GLOBEX_ENERGY_AND_METALS = Calendar(
    "CMEGlobex_EnergyAndMetals",
    ("CMEGlobex_EnergyAndMetals", "CMEGlobex_Energy", "CMEGlobex_CrudeAndRefined",
     "CMEGlobex_NYHarbor", "CMEGlobex_HO", "HO", "CMEGlobex_Crude", "CMEGlobex_CL", "CL",
     "CMEGlobex_Gas", "CMEGlobex_RB", "RB", "CMEGlobex_MicroCrude", "CMEGlobex_MCL", "MCL",
     "CMEGlobex_NatGas", "CMEGlobex_NG", "NG", "CMEGlobex_Dutch_NatGas", "CMEGlobex_TTF", "TTF",
     "CMEGlobex_LastDay_NatGas", "CMEGlobex_NN", "NN", "CMEGlobex_CarbonOffset", "CMEGlobex_CGO",
     "CGO", "C-GEO", "CMEGlobex_NGO", "NGO", "CMEGlobex_GEO", "GEO", "CMEGlobex_Metals",
     "CMEGlobex_PreciousMetals", "CMEGlobex_Gold", "CMEGlobex_GC", "GC", "CMEGlobex_Silver",
     "CMEGlobex_SI", "SI", "CMEGlobex_Platinum", "CMEGlobex_PL", "PL", "CMEGlobex_BaseMetals",
     "CMEGlobex_Copper", "CMEGlobex_HG", "HG", "CMEGlobex_Aluminum", "CMEGlobex_ALI", "ALI",
     "CMEGlobex_QC", "QC", "CMEGlobex_FerrousMetals", "CMEGlobex_HRC", "HRC", "CMEGlobex_BUS",
     "BUS", "CMEGlobex_TIO", "TIO"), CHICAGO,
    hours(_OPEN_EVENING, at(16)),
    (fixed("New Year's Day", 1, 1, since="1952-09-29", weekdays=WORKDAYS),
     GOOD_FRIDAY.between("1908"), CHRISTMAS.between("1999")), (),
    (Special("market_close", at(12), rules=_UNTIL_2021 + (
        LABOR.between("1887"), THANKSGIVING.between(None, "2021"))),
     Special("market_close", at(12, 45), rules=(DAY_AFTER_THANKSGIVING,)),
     Special("market_close", at(13, 30), rules=_FROM_2022 + (THANKSGIVING.between("2022"),))))

GLOBEX_EQUITY = Calendar(
    "CME Globex Equities", ("CME Globex Equity",), CHICAGO, hours(_OPEN_EVENING, at(16)),
    (NEW_YEAR,) + _GF_CLOSED + (CHRISTMAS.between("1954"),), (),
    (Special("market_close", at(10, 30), rules=(
        MLK.between("1998", "2014"), PRESIDENTS.between("1971", "2014"),
        MEMORIAL.between("1971", "2013"), INDEPENDENCE.between("1954", "2013"),
        LABOR.between("1887", "2013"), THANKSGIVING.between("1942", "2013"))),
     Special("market_close", at(12, 15), rules=(
         DAY_BEFORE_JULY_4.between("1954"), DAY_AFTER_THANKSGIVING.between("1942"), _EVE_1993)),
     Special("market_close", at(12), rules=(
         MLK.between("2015"), PRESIDENTS.between("2015"), MEMORIAL.between("2014"),
         INDEPENDENCE.between("2014"), LABOR.between("2014"), THANKSGIVING.between("2014"),
         JUNETEENTH)),
     Special("market_close", at(8, 15), rules=_SHORT_GF)))

GLOBEX_FX = Calendar(
    "CMEGlobex_FX", ("CMEGlobex_FX", "CME_FX", "CME_Currency"), CHICAGO,
    hours(_OPEN_EVENING, at(16)),
    (NEW_YEAR, GOOD_FRIDAY.between(None, "2020"), _GF_2022, CHRISTMAS.between("1954")), (),
    (Special("market_close", at(10, 15), rules=(_GF_2021, _GF_FROM_2023)),
     Special("market_close", at(12), rules=(
         MLK.between("1998", "2021"), PRESIDENTS.between("1971", "2021"),
         MEMORIAL.between("1971", "2021"), INDEPENDENCE.between("1954", "2021"),
         LABOR.between("1887", "2021"), THANKSGIVING.between("1942", "2021"))),
     Special("market_close", at(12, 15), rules=(
         DAY_AFTER_THANKSGIVING.between("1942"), _EVE_1993))))

GLOBEX_FIXED_INCOME = Calendar(
    "CME Globex Fixed Income", ("CME Globex Fixed Income", "CME Globex Interest Rate Products"),
    CHICAGO, hours(at(18, days=-1), at(17)),
    (NEW_YEAR,) + _GF_CLOSED + (CHRISTMAS.between("1954"),), (),
    (Special("market_close", at(12), rules=(
        MLK.between("1998"), PRESIDENTS.between("1971"), MEMORIAL.between("1971"),
        INDEPENDENCE.between("1954"), LABOR.between("1887"), THANKSGIVING.between("1942"),
        JUNETEENTH)),
     Special("market_close", at(15, 15), rules=(
         friday_before(MLK, "1998", "2015"), friday_before(PRESIDENTS, "1971", "2015"),
         easter("Thursday before Good Friday", -3, since="2009", until="2009"),
         friday_before(MEMORIAL, "1971", "2015"), friday_before(LABOR, "1887", "2014")),
         dates=dates("2010-07-02 2011-07-01")),
     Special("market_close", at(12, 15), rules=(
         DAY_AFTER_THANKSGIVING.between("1942"), _EVE_1993), dates=dates("2010-12-31")),
     Special("market_close", at(10, 15), rules=_SHORT_GF)))

ICE = Calendar(
    "ICE", ("ICE", "ICEUS", "NYFE"), "US/Eastern", hours(at(20, 1, days=-1), at(18)),
    (NEW_YEAR, GOOD_FRIDAY, CHRISTMAS.between("1954")), MOURNING + dates("2012-10-29"),
    (Special("market_close", at(13), rules=_NOON),))

# --- bond market holiday schedule -----------------------------------------

SIFMA_VETERANS = (
    fixed("Veterans Day", 11, 11, "sunday_to_monday", weekdays=WORKDAYS, until="2022"),
    fixed("Veterans Day", 11, 11, "sunday_to_monday", weekdays=WORKDAYS, since="2023-12-31"))

SIFMA_US = Calendar(
    "SIFMA_US",
    ("SIFMAUS", "SIFMA_US", "Capital_Markets_US", "Financial_Markets_US", "Bond_Markets_US"),
    NEW_YORK, hours(at(7), at(17, 30)),
    (fixed("New Year's Day", 1, 1, "sunday_to_monday", weekdays=WORKDAYS), MLK,
     PRESIDENTS.between("1971"), GOOD_FRIDAY.between(None, "2020"), MEMORIAL, JUNETEENTH,
     fixed("Independence Day", 7, 4, "nearest_workday", weekdays=WORKDAYS), LABOR, COLUMBUS)
    + SIFMA_VETERANS + (THANKSGIVING, CHRISTMAS),
    dates("2022-04-15 2024-03-29"),
    (Special("market_close", at(14), rules=(
        easter("Day before Good Friday", -3, until="2020"),
        weekday("Friday before Memorial Day", 5, 25, MON, 1, shift=-3),
        fixed("Day before Independence Day", 7, 4, "previous_workday", weekdays=WORKDAYS),
        fixed("Thursday before Independence Day", 7, 2, weekdays=(THU,)),
        DAY_AFTER_THANKSGIVING,
        fixed("Christmas Eve", 12, 25, "previous_workday"),
        fixed("Thursday before Christmas Eve", 12, 23, weekdays=(THU,)),
        fixed("New Year's Eve", 1, 1, "previous_workday", weekdays=WORKDAYS)),
        dates=dates("2021-04-02 2022-04-14 2023-04-07 2024-03-28")),))

CALENDARS = (
    NYSE, IEX, CFE, CBOE_EQUITY_OPTIONS, CBOE_INDEX_OPTIONS, CME_EQUITY, CME_AGRICULTURE, CME_BOND,
    GLOBEX_LIVESTOCK, GLOBEX_GRAINS, GLOBEX_CRYPTO, GLOBEX_ENERGY_AND_METALS, GLOBEX_EQUITY,
    GLOBEX_FX, GLOBEX_FIXED_INCOME, ICE, SIFMA_US)
