"""Festivals of the Chinese lunisolar calendar, computed instead of listed.

A month begins on the day of a new moon in China Standard Time. The month with
the winter solstice is the 11th; if 13 months lie between two of them, the
first one without a major solar term is the leap month. New moons follow Meeus,
*Astronomical Algorithms*, chapter 49, and the sun's longitude chapter 25.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ticktide.session import local_table

# Festivals: name, month, day of the lunisolar calendar; fixed values.
FESTIVALS = (("spring", 1, 1), ("buddha", 4, 8), ("dragon_boat", 5, 5),
             ("mid_autumn", 8, 15), ("double_ninth", 9, 9))

# Periodic terms of the new moon: days, multiples of M, M', F, power of E.
# Published coefficients; fixed values.
NEW_MOON_TERMS = (
    (-0.40720, 0, 1, 0, 0), (0.17241, 1, 0, 0, 1), (0.01608, 0, 2, 0, 0), (0.01039, 0, 0, 2, 0),
    (0.00739, -1, 1, 0, 1), (-0.00514, 1, 1, 0, 1), (0.00208, 2, 0, 0, 2), (-0.00111, 0, 1, -2, 0),
    (-0.00057, 0, 1, 2, 0), (0.00056, 1, 2, 0, 1), (-0.00042, 0, 3, 0, 0), (0.00042, 1, 0, 2, 1),
    (0.00038, 1, 0, -2, 1), (-0.00024, -1, 2, 0, 1), (-0.00007, 2, 1, 0, 0), (0.00004, 0, 2, -2, 0),
    (0.00004, 3, 0, 0, 0), (0.00003, 1, 1, -2, 0), (0.00003, 0, 2, 2, 0), (-0.00003, 1, 1, 2, 0),
    (0.00003, -1, 1, 2, 0), (-0.00002, -1, 1, -2, 0), (-0.00002, 1, 3, 0, 0), (0.00002, 0, 4, 0, 0),
)
# Planetary terms: days, phase at epoch, degrees per lunation; fixed values.
PLANETARY_TERMS = (
    (0.000325, 299.77, 0.107408), (0.000165, 251.88, 0.016321), (0.000164, 251.83, 26.651886),
    (0.000126, 349.42, 36.412478), (0.000110, 84.66, 18.206239), (0.000062, 141.74, 53.303771),
    (0.000060, 207.14, 2.453732), (0.000056, 154.84, 7.306860), (0.000047, 34.52, 27.261239),
    (0.000042, 207.19, 0.121824), (0.000040, 291.34, 1.844379), (0.000037, 161.72, 24.198154),
    (0.000035, 239.56, 25.513099), (0.000023, 331.55, 3.592518),
)
LUNATIONS_PER_YEAR = 12.3685
CHINA_OFFSET_DAYS = 8 / 24
JULIAN_UNIX_EPOCH = 2440587.5


def _sin(degrees: Column) -> Column:
    return F.sin(degrees * F.lit(math.pi / 180))


def _poly(x: Column, *coefficients: float) -> Column:
    total = F.lit(0.0)
    for c in reversed(coefficients):
        total = total * x + F.lit(c)
    return total


def _clock_seconds(year: Column) -> Column:
    """Terrestrial minus universal time, after Espenak and Meeus."""
    t75, t00 = year - 1975, year - 2000
    before = F.lit(45.45) + t75 * 1.067 - t75 * t75 / 260 - t75 * t75 * t75 / 718
    around = F.lit(63.86) + t00 * 0.3345 - t00 * t00 * 0.060374 + t00 * t00 * t00 * 0.0017275
    now = F.lit(62.92) + t00 * 0.32217 + t00 * t00 * 0.005589
    century = (year - 1820) / 100
    later = F.lit(-20.0) + century * century * 32 - (F.lit(2150.0) - year) * 0.5628
    return (F.when(year < 1986, before).when(year < 2005, around).when(year < 2050, now)
            .otherwise(later))


def new_moon(k: Column) -> Column:
    """Julian day (universal time) of lunation ``k`` counted from January 2000."""
    k = k.cast("double")
    t = k / 1236.85
    e = _poly(t, 1.0, -0.002516, -0.0000074)
    sun = F.lit(2.5534) + k * 29.10535670 + t * t * -0.0000014 + t * t * t * -0.00000011
    moon = (F.lit(201.5643) + k * 385.81693528 + t * t * 0.0107582 + t * t * t * 0.00001238
            + t * t * t * t * -0.000000058)
    latitude = (F.lit(160.7108) + k * 390.67050284 + t * t * -0.0016118 + t * t * t * -0.00000227
                + t * t * t * t * 0.000000011)
    node = F.lit(124.7746) + k * -1.56375588 + t * t * 0.0020672 + t * t * t * 0.00000215
    day = (F.lit(2451550.09766) + k * 29.530588861 + t * t * 0.00015437
           + t * t * t * -0.000000150 + t * t * t * t * 0.00000000073)
    day = day + _sin(node) * -0.00017
    for size, m, m1, f, power in NEW_MOON_TERMS:
        factor = {0: F.lit(1.0), 1: e, 2: e * e}[power]
        day = day + factor * _sin(sun * m + moon * m1 + latitude * f) * F.lit(size)
    for i, (size, phase, speed) in enumerate(PLANETARY_TERMS):
        angle = F.lit(phase) + k * speed
        if i == 0:
            angle = angle - t * t * 0.009173
        day = day + _sin(angle) * F.lit(size)
    year = F.lit(2000.0) + k / LUNATIONS_PER_YEAR
    return day - _clock_seconds(year) / 86400


def sun_longitude(julian_day: Column) -> Column:
    """Apparent longitude of the sun in degrees."""
    t = (julian_day - 2451545.0) / 36525
    mean = _poly(t, 280.46646, 36000.76983, 0.0003032)
    anomaly = _poly(t, 357.52911, 35999.05029, -0.0001537)
    centre = (_poly(t, 1.914602, -0.004817, -0.000014) * _sin(anomaly)
              + _poly(t, 0.019993, -0.000101) * _sin(anomaly * 2) + _sin(anomaly * 3) * 0.000289)
    wobble = _sin(_poly(t, 125.04, -1934.136))
    return F.pmod(mean + centre - 0.00569 - wobble * 0.00478, F.lit(360.0))


def months(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Lunisolar months: first day, number, whether it is a leap month."""
    k0 = int((first_year - 2 - 2000) * LUNATIONS_PER_YEAR)
    k1 = int((last_year + 2 - 2000) * LUNATIONS_PER_YEAR)
    moons = spark.range(k0, k1, 1, 1).select(
        F.col("id").alias("k"),
        F.floor(new_moon(F.col("id")) + CHINA_OFFSET_DAYS - JULIAN_UNIX_EPOCH)
        .cast("int").alias("first_day"))
    # Twelfth of the ecliptic in which the sun stands at midnight of the first day.
    midnight = F.col("first_day") + F.lit(JULIAN_UNIX_EPOCH - CHINA_OFFSET_DAYS)
    ordered = Window.orderBy("k")  # a few thousand rows: twelve or thirteen a year
    terms = (moons.withColumn("sign", F.floor(sun_longitude(midnight) / 30).cast("int"))
             .withColumn("next_sign", F.lead("sign").over(ordered))
             .where(F.col("next_sign").isNotNull())
             .withColumn("has_term", F.col("sign") != F.col("next_sign"))
             # The sun passes 270 degrees; a month can hold two terms.
             .withColumn("solstice", F.col("sign").isin(7, 8) & F.col("next_sign").isin(9, 10))
             .withColumn("sui", F.sum(F.col("solstice").cast("int")).over(ordered)))
    in_sui = Window.partitionBy("sui").orderBy("k")
    whole = Window.partitionBy("sui")
    placed = (terms.withColumn("position", F.row_number().over(in_sui))
              .withColumn("length", F.count("*").over(whole))
              .withColumn("leap_position", F.when(F.col("length") == 13, F.min(
                  F.when(~F.col("has_term"), F.col("position"))).over(whole))))
    skipped = F.coalesce((F.col("position") >= F.col("leap_position")).cast("int"), F.lit(0))
    return placed.where((F.col("sui") > 0) & F.col("length").isin(12, 13)).select(
        F.date_from_unix_date("first_day").alias("first_day"),
        (F.pmod(F.col("position") + 9 - skipped, F.lit(12)) + 1).alias("month"),
        F.coalesce(F.col("position") == F.col("leap_position"), F.lit(False)).alias("leap"))


_kept: dict[tuple, DataFrame] = {}


def festivals(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Festival dates: festival, (Gregorian) year, festival_date.

    A handful of rows a year from long formulas, so they are kept for the session.
    """
    key = (spark.sparkContext.applicationId, first_year, last_year)
    if key not in _kept:
        _kept[key] = _festivals(spark, first_year, last_year).persist()
    return _kept[key]


def _festivals(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    names = local_table(spark, list(FESTIVALS), "festival string, month int, day int")
    day = F.date_add(F.col("first_day"), F.col("day") - 1)
    return (months(spark, first_year, last_year).where(~F.col("leap"))
            .join(F.broadcast(names), "month")
            .select("festival", F.year(day).alias("year"), day.alias("festival_date"))
            .where(F.col("year").between(first_year, last_year)))
