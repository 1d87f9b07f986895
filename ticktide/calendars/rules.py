"""Yearly rules as column expressions: anchor day, observance, bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ticktide.calendars import lunar
from ticktide.session import local_table


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b)).cast("int")


def _mod(a: Column, b: int) -> Column:
    return F.pmod(a, F.lit(b))


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by the anonymous computus."""
    a, b, c = _mod(year, 19), _div(year, 100), _mod(year, 100)
    d, e = _div(b, 4), _mod(b, 4)
    g = _div(b * 8 + 13, 25)
    h = _mod(a * 19 + b - d - g + 15, 30)
    i, k = _div(c, 4), _mod(c, 4)
    l = _mod(F.lit(32) + e * 2 + i * 2 - h - k, 7)
    m = _div(a + h * 11 + l * 19, 433)
    month = _div(h + l - m * 7 + 90, 25)
    return F.make_date(year, month, _mod(h + l - m * 7 + month * 33 + 19, 32))


# Day of the month of the equinoxes in Japan: first year, offset, century
# correction. Published approximation, valid from 1851 to 2150; fixed values.
SPRING_EQUINOX = ((2100, 21.8510, 1980), (1980, 20.8431, 1980), (1900, 20.8357, 1983),
                  (1851, 19.8277, 1983))
AUTUMN_EQUINOX = ((2100, 24.2488, 1980), (1980, 23.2488, 1980), (1900, 23.2588, 1983),
                  (1851, 22.2588, 1983))


def _equinox_day(year: Column, terms: tuple) -> Column:
    day = F.lit(None).cast("int")
    for first, offset, base in reversed(terms):
        drift = F.lit(offset) + (year - 1980) * F.lit(0.242194) - _div(year - base, 4)
        day = F.when(year >= first, F.floor(drift).cast("int")).otherwise(day)
    return day


def spring_equinox(year: Column) -> Column:
    return F.make_date(year, F.lit(3), _equinox_day(year, SPRING_EQUINOX))


def autumn_equinox(year: Column) -> Column:
    return F.make_date(year, F.lit(9), _equinox_day(year, AUTUMN_EQUINOX))


def qingming(year: Column) -> Column:
    """Tomb-sweeping day by the common century rule for 1900 to 2099."""
    y = _mod(year, 100)
    offset = F.when(year < 2000, F.lit(5.59)).otherwise(F.lit(4.81))
    day = F.floor(y * F.lit(0.2422) + offset) - _div(y, 4)
    return F.make_date(year, F.lit(4), day.cast("int"))


def nth_weekday(base: Column, which: Column, nth: Column) -> Column:
    """The n-th given weekday on or after ``base``; on or before it for n < 0."""
    ahead = F.pmod(which - F.weekday(base), F.lit(7)) + (nth - 1) * 7
    back = F.pmod(F.weekday(base) - which, F.lit(7)) - (nth + 1) * 7
    return F.when(nth > 0, F.date_add(base, ahead)).otherwise(F.date_sub(base, back))


def movable_days(spark: SparkSession, first_year: int, last_year: int,
                 festivals: set[str]) -> DataFrame:
    """Date of every movable anchor and year: (festival, year, anchor_day).

    Computed once per year here and joined to the rules, so that the long
    formulas are not repeated in every expression built on the date.
    """
    formulas = {"easter": easter_sunday, "spring_equinox": spring_equinox,
                "autumn_equinox": autumn_equinox, "qingming": qingming}
    years = local_table(spark, [(first_year, last_year)], "lo int, hi int").select(
        F.explode(F.sequence("lo", "hi")).alias("year"))
    used = {k: f for k, f in formulas.items() if k in festivals}
    days = F.array(*[F.struct(F.lit(name).alias("festival"), formula(F.col("year")).alias("day"))
                     for name, formula in used.items()])
    parts = []
    if used:
        parts.append(years.select("year", F.explode(days).alias("d")).select(
            "d.festival", "year", F.col("d.day").alias("anchor_day")))
    if festivals & {name for name, _, _ in lunar.FESTIVALS}:
        parts.append(lunar.festivals(spark, first_year, last_year).select(
            "festival", "year", F.col("festival_date").alias("anchor_day")))
    if not parts:
        return local_table(spark, [], "festival string, year int, anchor_day date")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _condition_holds(day: Column) -> Column:
    condition, year = F.col("condition"), F.col("year")
    first_friday = F.dayofmonth(day) <= 7
    christmas = F.weekday(F.make_date(year, F.lit(12), F.lit(25))).isin(4, 5)
    new_year = F.weekday(F.make_date(year, F.lit(1), F.lit(1))) == 4
    september = F.make_date(year, F.lit(9), F.lit(1))
    third_monday = nth_weekday(september, F.lit(0), F.lit(3))
    return (F.when(condition == "unless_first_friday", ~first_friday)
            .when(condition == "only_first_friday", first_friday)
            .when(condition == "unless_christmas_or_new_year_on_friday", ~(christmas | new_year))
            .when(condition == "if_day_after_third_monday", F.datediff(day, third_monday) == 1)
            .otherwise(F.lit(True)))


def expand(rules: DataFrame, first_year: int, last_year: int, festivals: set[str]) -> DataFrame:
    """One row per rule and year with its observed date ``day_off``.

    A neighbouring year is expanded on both sides because an observance can
    cross New Year. Years come from a sequence per rule, not from a join.
    ``festivals`` names the movable anchors that occur in the rules.
    """
    yearly = (rules
              .withColumn("year", F.explode(F.sequence(F.lit(first_year - 1), F.lit(last_year + 1))))
              .where((F.size("years") == 0) | F.array_contains("years", F.col("year")))
              .where(~F.array_contains("not_years", F.col("year")))
              .where(F.pmod(F.col("year"), F.col("every")) == 0))
    movable = movable_days(rules.sparkSession, first_year - 1, last_year + 1, festivals)
    base = F.make_date(F.col("year"), F.col("month"), F.col("day"))
    anchor = (F.when(F.col("anchor") == "fixed", base)
              .when(F.col("anchor") == "weekday", nth_weekday(base, F.col("weekday"), F.col("nth")))
              .otherwise(F.col("anchor_day")))
    # explode(filter(...)) drops undated rows and gives the date a name of its own.
    dated = lambda day: F.explode(F.filter(F.array(day), lambda d: d.isNotNull()))
    moved = F.date_add(F.col("_day"), F.element_at("moves", F.weekday("_day") + 1))
    return (yearly.join(movable, ["festival", "year"], "left")
            .withColumn("_day", dated(F.date_add(anchor, F.col("shift"))))
            .withColumn("day_off", dated(F.when(_condition_holds(F.col("_day")), moved)))
            .where(F.col("day_off").between(F.col("since"), F.col("until")))
            .where(F.array_contains("weekdays", F.weekday("day_off")))
            .drop("_day", "anchor_day"))
