"""Published holidays, golden lookups and properties of the calendars."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ticktide.calendars import index, lookup, lunar, registry, sessions as S
from ticktide.plans.oracle import LUNAR_DATES


def days(df, column="day"):
    return sorted(str(r[0]) for r in df.select(column).distinct().collect())


PUBLISHED = {
    ("NYSE", 2024): "01-01 01-15 02-19 03-29 05-27 06-19 07-04 09-02 11-28 12-25",
    ("LSE", 2024): "01-01 03-29 04-01 05-06 05-27 08-26 12-25 12-26",
    ("TSX", 2024): "01-01 02-19 03-29 05-20 07-01 08-05 09-02 10-14 12-25 12-26",
    ("EUREX", 2024): "01-01 03-29 04-01 05-01 12-25 12-26",
    ("HKEX", 2024): "01-01 02-12 02-13 03-29 04-01 04-04 05-01 05-15 06-10 07-01 09-18 10-01 10-11 12-25 12-26",
    ("SIX", 2024): "01-01 01-02 03-29 04-01 05-01 05-09 05-20 08-01 12-24 12-25 12-26 12-31",
    ("JPX", 2024): "01-01 01-02 01-03 01-08 02-12 02-23 03-20 04-29 05-03 05-06 07-15 08-12 09-16 09-23 "
                   "10-14 11-04 12-31",
}


@pytest.mark.parametrize("name, year", list(PUBLISHED))
def test_published_weekday_holidays(spark, name, year):
    start, end = f"{year}-01-01", f"{year}-12-31"
    weekdays = S.calendar_days(spark, [name], start, end).where(F.weekday("day") < 5)
    closed = weekdays.join(S.valid_days(spark, [name], start, end), "day", "left_anti")
    assert days(closed) == [f"{year}-{d}" for d in PUBLISHED[name, year].split()]


def test_september_2001_and_early_closes(spark):
    schedule = S.sessions(spark, ["NYSE"], "2001-09-07", "2001-09-18")
    assert days(schedule, "session_date") == ["2001-09-07", "2001-09-10", "2001-09-17", "2001-09-18"]
    late = S.late_opens(schedule).first()
    assert late.market_open == datetime(2001, 9, 17, 13, 33)
    early = S.early_closes(S.sessions(spark, ["NYSE"], "2024-01-01", "2024-12-31"))
    assert days(early, "session_date") == ["2024-07-03", "2024-11-29", "2024-12-24"]


def test_special_close_clamps_post_unless_told_otherwise(spark):
    span = ("2024-11-29", "2024-11-29")
    forced = S.sessions(spark, ["NYSE"], *span).first()
    assert forced.post == forced.market_close == datetime(2024, 11, 29, 18)
    replaced = S.sessions(spark, ["NYSE"], *span, force_special_times=False).first()
    assert replaced.post == datetime(2024, 11, 30, 1) and replaced.market_close == datetime(2024, 11, 29, 18)
    ignored = S.sessions(spark, ["NYSE"], *span, force_special_times=None).first()
    assert ignored.market_close == datetime(2024, 11, 29, 21)


def test_effective_dated_close(spark):
    rows = S.sessions(spark, ["JPX"], "2024-11-01", "2024-11-06").orderBy("session_date").collect()
    assert [r.market_close.strftime("%d %H:%M") for r in rows] == ["01 06:00", "05 06:30", "06 06:30"]


def test_saturdays_end_in_1952(spark):
    rows = S.sessions(spark, ["NYSE"], "1952-01-01", "1952-12-31").where(F.weekday("session_date") == 5).collect()
    assert rows and max(r.session_date for r in rows) < date(1952, 9, 29)
    assert not any(r.market_close < r.regular_close for r in rows)


def test_patched_times(spark):
    times = registry.market_times_table(spark, ["NYSE"])
    times = registry.change_time(times, "NYSE", "market_open", 8 * 60)
    times = registry.add_time(registry.remove_time(times, "NYSE", "post"), "NYSE", "break_start", 12 * 60)
    row = S.sessions(spark, ["NYSE"], "2024-03-01", "2024-03-01", market_times=times).first()
    assert row.market_open == datetime(2024, 3, 1, 13) and row.post is None
    assert row.break_start == datetime(2024, 3, 1, 17)
    with pytest.raises(ValueError):
        registry.add_time(times, "NYSE", "interruption_start_1", 1)


def test_names_and_aliases():
    assert registry.get_calendar("stock").name == "NYSE" and "XNSE" in registry.calendar_names()
    with pytest.raises(KeyError):
        registry.get_calendar("nowhere")
    assert len(registry.CALENDARS) == 32


def test_lunisolar_festivals_are_the_published_ones(spark):
    found = {(r.festival, str(r.festival_date)) for r in lunar.festivals(spark, 1994, 2026).collect()}
    for name in ("spring", "dragon_boat", "mid_autumn", "buddha", "double_ninth"):
        assert {(name, d) for d in LUNAR_DATES[name].split()} <= found


def test_leap_month_of_2033(spark):
    leap = lunar.months(spark, 2033, 2034).where("leap AND first_day BETWEEN '2033-01-01' AND '2034-12-31'").collect()
    assert [(str(r.first_day), r.month) for r in leap] == [("2033-12-22", 11)]


# --- lookups --------------------------------------------------------------

@pytest.fixture(scope="module")
def table(spark):
    return lookup.shared_day_table(spark, ("NYSE",), "2023-02-01", "2023-04-30")


def ask(spark, table, moment, by="utc", strict=True, **columns):
    df = spark.createDataFrame([(datetime.fromisoformat(moment),)], "ts timestamp")
    joined = lookup.attach(df, table, "ts", "NYSE", by, strict=strict)
    return joined.select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def test_last_and_next_session(spark, table):
    t = F.col("ts")
    row = ask(spark, table, "2023-03-11 12:00:00", "before", o=F.col("at_open"), c=F.col("at_close"))
    assert row == {"o": datetime(2023, 3, 10, 14, 30), "c": datetime(2023, 3, 10, 21)}
    row = ask(spark, table, "2023-03-10 15:00:00", o=F.col("next_open"), m=lookup.minutes_until_next(t, "open"))
    assert row == {"o": datetime(2023, 3, 13, 13, 30), "m": (3 * 24 - 1) * 60 - 30}


def test_midnight_belongs_to_the_day_before_for_the_last_session(spark, table):
    assert ask(spark, table, "2023-03-10 00:00:00", "before", s=F.col("at_session"))["s"] == date(2023, 3, 9)
    assert ask(spark, table, "2023-03-10 00:00:01", "before", s=F.col("at_session"))["s"] == date(2023, 3, 10)


@pytest.mark.parametrize("moment, rth, extended, with_close", [
    ("2023-03-10 14:29:59", False, True, False), ("2023-03-10 14:30:00", True, True, False),
    ("2023-03-10 21:00:00", False, True, True), ("2023-03-11 01:00:00", False, False, False),
    ("2023-03-12 16:00:00", False, False, False)])
def test_open_at(spark, table, moment, rth, extended, with_close):
    t = F.col("ts")
    assert ask(spark, table, moment, "local", rth=lookup.is_open(t, only_rth=True),
               extended=lookup.is_open(t), with_close=lookup.is_open(t, True, True)) == {
        "rth": rth, "extended": extended, "with_close": with_close}


def test_uncovered_timestamps_are_flagged(spark, table):
    assert ask(spark, table, "2023-03-10 15:00:00", "local", ok=lookup.is_covered(F.col("ts")))["ok"]
    row = ask(spark, table, "2030-01-02 15:00:00", "local", strict=False, ok=F.coalesce(
        lookup.is_covered(F.col("ts")), F.lit(False)))
    with pytest.raises(Exception, match="no calendar day for 2030-01-02"):
        ask(spark, table, "2030-01-02 15:00:00", "local", ok=lookup.is_covered(F.col("ts")))
    assert row["ok"] is False


def between(spark, table, start, end):
    df = spark.createDataFrame([(datetime.fromisoformat(start), datetime.fromisoformat(end))],
                               "ts timestamp, until timestamp")
    local = lookup.attach(lookup.attach(df, table, "ts", "NYSE", "local", "s_"), table, "until", "NYSE", "local", "e_")
    utc = lookup.attach(lookup.attach(df, table, "ts", "NYSE", "utc", "s_"), table, "until", "NYSE", "utc", "e_")
    minutes = local.select(lookup.trading_minutes_between(F.col("ts"), F.col("until"), "s_", "e_")).first()[0]
    return minutes, utc.select(lookup.trading_days_between("s_", "e_")).first()[0]


def test_minutes_and_days_between(spark, table):
    assert between(spark, table, "2023-03-10 14:30:00", "2023-03-10 21:00:00")[0] == 390
    assert between(spark, table, "2023-03-10 00:00:00", "2023-03-15 00:00:00")[1] == 4


def test_minutes_add_up_over_adjacent_ranges(spark, table):
    a, b, c = "2023-03-09 12:00:00", "2023-03-13 15:17:00", "2023-03-21 03:00:00"
    parts = [between(spark, table, *pair)[0] for pair in ((a, b), (b, c), (a, c))]
    assert parts[0] + parts[1] == parts[2]


def test_salted_path_gives_the_same_rows(spark, table, monkeypatch):
    events = spark.range(200).select(F.timestamp_seconds(F.col("id") * 7000 + 1_677_000_000).alias("ts"), "id")
    ask_all = lambda t: sorted(map(tuple, lookup.attach(events, t, "ts", "NYSE").select(
        "id", "at_session", "next_session").collect()))
    assert ask_all(table) == ask_all(lookup.DayTable(table.frame, 10 ** 9))


# --- index and merge ------------------------------------------------------

def test_index_length_is_the_ceiling(spark):
    schedule = S.sessions(spark, ["HKEX", "NYSE"], "2024-01-02", "2024-03-28")
    for seconds in (600, 2700, 3600):
        expected = index.parts(schedule).select(
            F.sum(index.bar_count(F.col("start"), F.col("end"), seconds))).first()[0]
        assert index.trading_index(schedule, seconds).count() == expected


def test_index_labels(spark):
    schedule = S.sessions(spark, ["NYSE"], "2024-03-01", "2024-03-01")
    stamps = lambda *a: [r.stamp.strftime("%H:%M") for r in
                         index.trading_index(schedule, 7200, *a).orderBy("stamp").collect()]
    assert stamps("right", True) == ["16:30", "18:30", "20:30", "21:00"]
    assert stamps("left", None) == ["14:30", "16:30", "18:30", "20:30"]
    assert stamps("both", False) == ["14:30", "16:30", "18:30", "20:30"]
    assert stamps("right", None) == ["16:30", "18:30", "20:30", "22:30"]
    with pytest.raises(ValueError):
        index.trading_index(schedule, 90_000)


def test_crypto_break_is_reported_and_ignored(spark):
    schedule = S.sessions(spark, ["CME Globex Crypto"], "2024-03-01", "2024-03-08")
    reasons = {r.reason for r in index.violations(schedule, 3600).collect()}
    assert reasons == {"break outside the session"}
    assert index.parts(schedule).count() == schedule.count()


def test_inner_merge_lies_inside_the_outer(spark):
    schedule = S.sessions(spark, ["NYSE", "LSE"], "2024-01-01", "2024-06-30")
    outer = S.merge_schedules(schedule, "outer").alias("o")
    inner = S.merge_schedules(schedule, "inner", 2).alias("i")
    both = inner.join(outer, "session_date").where(
        "i.market_open >= o.market_open AND i.market_close <= o.market_close")
    assert both.count() == inner.count() > 100


# Published closing days and early closes of some markets, as plain facts: the
# registry is only asked through the schedule.
CLOSED = {
    "NYSE": {2023: "2023-01-02 2023-01-16 2023-02-20 2023-04-07 2023-05-29 2023-06-19 2023-07-04 2023-09-04 2023-11-23 2023-12-25",
             2012: "2012-01-02 2012-01-16 2012-02-20 2012-04-06 2012-05-28 2012-07-04 2012-09-03 2012-10-29 2012-10-30 2012-11-22 2012-12-25",
             2001: "2001-01-01 2001-01-15 2001-02-19 2001-04-13 2001-05-28 2001-07-04 2001-09-03 2001-09-11 2001-09-12 2001-09-13 2001-09-14 2001-11-22 2001-12-25"},
    "LSE": {2021: "2021-01-01 2021-04-02 2021-04-05 2021-05-03 2021-05-31 2021-08-30 2021-12-27 2021-12-28"},
    "BSE": {2019: "2019-03-04 2019-03-21 2019-04-17 2019-04-19 2019-04-29 2019-05-01 2019-06-05 2019-08-12 2019-08-15 2019-09-02 2019-09-10 2019-10-02 2019-10-08 2019-10-21 2019-10-28 2019-11-12 2019-12-25"},
    "SSE": {2019: "2019-01-01 2019-02-04 2019-02-05 2019-02-06 2019-02-07 2019-02-08 2019-04-05 2019-05-01 2019-05-02 2019-05-03 2019-06-07 2019-09-13 2019-10-01 2019-10-02 2019-10-03 2019-10-04 2019-10-07"},
}
EARLY = {"NYSE": {2023: "2023-07-03 2023-11-24", 2019: "2019-07-03 2019-11-29 2019-12-24"}}


@pytest.mark.parametrize("market,year", [(m, y) for m, years in CLOSED.items() for y in years])
def test_published_closing_days(spark, market, year):
    days = {r.day for r in S.valid_days(spark, [market], f"{year}-01-01", f"{year}-12-31").collect()}
    first = date(year, 1, 1).toordinal()
    off = [d.isoformat() for d in map(date.fromordinal, range(first, date(year, 12, 31).toordinal() + 1))
           if d.weekday() < 5 and d not in days]
    if (market, year) == ("SSE", 2019) or market != "BSE":
        assert " ".join(off) == CLOSED[market][year]
    else:
        # Bombay's closing days known here are a part of all.
        assert set(CLOSED[market][year].split()) <= set(off)


@pytest.mark.parametrize("market,year", [(m, y) for m, years in EARLY.items() for y in years])
def test_published_early_closes(spark, market, year):
    schedule = S.early_closes(S.sessions(spark, [market], f"{year}-01-01", f"{year}-12-31"))
    assert " ".join(sorted(str(r.session_date) for r in schedule.collect())) == EARLY[market][year]
