"""Canada and Brazil."""

from __future__ import annotations

from ticktide.calendars.europe import (
    BOXING_DAY, CHRISTMAS, GOOD_FRIDAY, WEEKEND_BOXING_DAY, WEEKEND_CHRISTMAS)
from ticktide.calendars.model import (
    FRI, MON, WORKDAYS, Calendar, Special, at, dates, easter, fixed, weekday)
from ticktide.calendars.us import LABOR, hours

# Rules and dates below are fixed values.
TSX = Calendar(
    "TSX", ("TSX", "TSXV"), "Canada/Eastern", hours(at(9, 30), at(16)),
    (fixed("New Year's Day", 1, 1, "weekend_to_monday"),
     weekday("Family Day", 2, 1, MON, 3, since="2008"), GOOD_FRIDAY,
     weekday("Victoria Day", 5, 24, MON, -1), fixed("Canada Day", 7, 1, "weekend_to_monday"),
     weekday("Civic Holiday", 8, 1, MON, 1), LABOR, weekday("Thanksgiving", 10, 1, MON, 2),
     CHRISTMAS, WEEKEND_CHRISTMAS, BOXING_DAY, WEEKEND_BOXING_DAY),
    dates("2001-09-11 2001-09-12"),
    (Special("market_close", at(13), rules=(
        fixed("Christmas Eve", 12, 24, weekdays=WORKDAYS, since="2010"),)),))

BMF = Calendar(
    "BMF", ("BMF", "B3"), "America/Sao_Paulo", hours(at(10, 1), at(16)),
    (fixed("New Year's Day", 1, 1), fixed("City of Sao Paulo", 1, 25, until="2021"),
     easter("Carnival Monday", -48), easter("Carnival Tuesday", -47), GOOD_FRIDAY,
     easter("Corpus Christi", 60), fixed("Tiradentes", 4, 21), fixed("Labour Day", 5, 1),
     fixed("Constitutionalist Revolution", 7, 9, since="1997", until="2019"),
     fixed("Independence Day", 9, 7), fixed("Our Lady of Aparecida", 10, 12),
     fixed("All Souls' Day", 11, 2), fixed("Republic Day", 11, 15),
     fixed("Black Awareness Day", 11, 20, since="2004", until="2019"),
     fixed("Black Awareness Day", 11, 20, since="2023-12-22"),
     fixed("Christmas Eve", 12, 24), fixed("Christmas", 12, 25), fixed("New Year's Eve", 12, 31),
     fixed("Friday before New Year's Eve", 12, 30, weekdays=(FRI,)),
     fixed("Friday before New Year's Eve", 12, 29, weekdays=(FRI,))),
    dates("2021-07-09 2021-11-20"),
    (Special("market_open", at(13, 1), rules=(easter("Ash Wednesday", -46),)),))

CALENDARS = (TSX, BMF)
