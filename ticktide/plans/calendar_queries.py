"""Calendars: rules, schedules, indexes and the markets, met with order dates
and event times so that the work grows with the tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from ticktide.calendars import index, lookup, registry, sessions as S
from ticktide.calendars.model import Rule, fixed
from ticktide.functions import times
from ticktide.plans import oracle as o
from ticktide.plans import views
from ticktide.plans.registry import query

ORDER_RANGE = views.ORDER_RANGE
LATER_RANGE = ("2018-01-01", "2024-12-31")
EVENTS = S.EVENTS


def order_days_sql(years: int = 0) -> str:
    day = f"CAST(o_orderdate + to_years({years}) AS DATE)" if years else "CAST(o_orderdate AS DATE)"
    return f"od AS (SELECT {day} AS day, count(*) AS orders FROM orders GROUP BY {day})"


def _join(first: str, *more: str) -> str:
    return first.rstrip() + "".join(",\n" + block for block in more) + "\n"


# --- rule kinds -----------------------------------------------------------

def rule_kind(name: str, calendars: list[str], wanted, years: int = 0, specials: bool = False,
              rules: tuple[Rule, ...] = ()):
    """Orders on the days that rules of one kind, or given rules, produce."""
    chosen = registry.resolve(calendars)
    pairs = [(c.name, r) for c in chosen for r in (
        [r for s in c.specials for r in s.rules] if specials else c.holidays) if wanted(r)]
    pairs += [(c.name, r) for c in chosen for r in rules]
    rows = [registry.rule_row(calendar, "holiday", None, r) for calendar, r in pairs]
    first, last = 1995 + years, 2001 + years
    sql = _join(o.with_(*o.holiday_blocks(rows, first, last)), order_days_sql(years)) + """
SELECT calendar, name, day_off::VARCHAR AS day, orders FROM days_off JOIN od ON od.day = day_off"""

    @query(name, sql)
    def run(spark, sf_dir):
        days = S.rule_days(spark, rows, date(first, 1, 1), date(last, 12, 31)).select(
            "calendar", "name", F.col("day_off").alias("day"))
        return views.order_dates(spark, sf_dir, years).join(F.broadcast(days), "day").select(
            "calendar", "name", "day", "orders")
    return run


def _plain(r: Rule) -> bool:
    return r.anchor == "fixed" and not r.observe


rule_kind("h01_fixed_dates", ["OSE", "BMF"], _plain)
rule_kind("h02_weekday_filter", ["SIX", "EUREX"], lambda r: _plain(r) and len(r.weekdays) < 7)
rule_kind("h03_nth_weekday", ["NYSE", "TSX"], lambda r: r.anchor == "weekday" and r.nth > 0)
rule_kind("h04_last_weekday", ["LSE", "TSX"], lambda r: r.anchor == "weekday" and r.nth < 0)
rule_kind("h05_easter", ["BMF", "OSE", "SIX"], lambda r: r.festival == "easter")
rule_kind("h06_chained_offset", ["CME Globex Fixed Income", "SIFMA_US"],
          lambda r: r.anchor == "weekday" and r.shift != 0, specials=True)
rule_kind("h07_sunday_and_nearest", ["NYSE", "JPX"],
          lambda r: r.observe in ("sunday_to_monday", "nearest_workday") and r.anchor == "fixed")
rule_kind("h08_other_observances", ["ASX", "LSE", "TSX", "SIFMA_UK"],
          lambda r: r.observe in ("weekend_to_monday", "next_monday", "next_monday_or_tuesday"))
rule_kind("h08_previous_days", ["SIFMA_US", "LSE", "EUREX"],
          lambda r: r.observe in ("previous_workday", "previous_friday"), specials=True)
rule_kind("h09_saturdays_next_to_holidays", ["NYSE"], lambda r: False, rules=(
    fixed("Saturday before Independence Day", 7, 4, "previous_saturday"),
    fixed("Saturday after Independence Day", 7, 4, "next_saturday"),
    fixed("Saturday before Christmas", 12, 25, "previous_saturday"),
    fixed("Saturday after Christmas", 12, 25, "next_saturday")))
rule_kind("h10_election_days", ["NYSE"], lambda r: r.month == 11 and r.day == 2, years=-27)
rule_kind("h11_good_friday_condition", ["CFE"], lambda r: r.festival == "easter")
rule_kind("h12_good_friday_by_year", ["CME Globex Equities", "CME_Bond"],
          lambda r: r.festival == "easter", years=12)
rule_kind("h13_around_july_and_november", ["CME Globex Crypto"],
          lambda r: r.observe == "day_before_if_tue_to_fri" or (r.month == 11 and r.shift == 1),
          specials=True)
rule_kind("h14_equinoxes", ["JPX"], lambda r: r.festival.endswith("equinox"))
rule_kind("h15_citizens_day", ["JPX"], lambda r: r.observe == "if_day_after_third_monday", years=11)
rule_kind("h16_lunisolar_days", ["HKEX"],
          lambda r: r.festival in o.LUNAR_DATES and "equinox" not in r.festival)
rule_kind("h16_days_in_lieu", ["SSE"], lambda r: True, years=23)
rule_kind("h17_queens_birthday", ["HKEX"], lambda r: r.name == "Queen's Birthday", years=-10)


def listed_sql(names: list[str]) -> str:
    rows = registry.closed_rows(registry.resolve(names))
    return o.values("closed", "calendar, day", [r for r in rows if 1995 <= r[1].year <= 2001])


@query("h18_listed_closures", o.with_(listed_sql(["NYSE", "BSE", "SSE", "HKEX", "JPX"]), order_days_sql())
       + "SELECT calendar, closed.day::VARCHAR AS day, orders FROM closed JOIN od ON od.day = closed.day")
def listed_closures(spark, sf_dir):
    closed = S.adhoc_holidays(spark, ["NYSE", "BSE", "SSE", "HKEX", "JPX"])
    return views.order_dates(spark, sf_dir).join(F.broadcast(closed), "day").select(
        "calendar", "day", "orders")


# --- schedule -------------------------------------------------------------

def on_order_days(spark, sf_dir, schedule: DataFrame, years: int = 0) -> DataFrame:
    days = views.order_dates(spark, sf_dir, years).withColumnRenamed("day", "session_date")
    return days.join(F.broadcast(schedule), "session_date")


NYSE_SQL = o.sessions(["NYSE"], *ORDER_RANGE)


def _schedule_sql(columns: str, base: str = NYSE_SQL, years: int = 0, where: str = "") -> str:
    return _join(base, order_days_sql(years)) + f"""
SELECT session_date::VARCHAR AS session_date, orders, {columns} FROM sess JOIN od ON day = session_date {where}"""


@query("c01_rule_holidays", _join(o.with_(*o.holiday_blocks(
    registry.holiday_rule_rows(registry.resolve(["NYSE"])), 1995, 2001)), order_days_sql()) + """
SELECT name, day_off::VARCHAR AS day, orders FROM days_off JOIN od ON od.day = day_off""")
def rule_holidays(spark, sf_dir):
    days = S.regular_holidays(spark, ["NYSE"], *ORDER_RANGE)
    return views.order_dates(spark, sf_dir).join(F.broadcast(days), "day").select("name", "day", "orders")


@query("c02_adhoc_holidays", o.with_(listed_sql(["LSE", "BSE", "JPX"]), order_days_sql()) + """
SELECT calendar, closed.day::VARCHAR AS day, orders FROM closed JOIN od ON od.day = closed.day""")
def adhoc_holidays(spark, sf_dir):
    days = S.adhoc_holidays(spark, ["LSE", "BSE", "JPX"])
    return views.order_dates(spark, sf_dir).join(F.broadcast(days), "day").select("calendar", "day", "orders")


@query("c03_valid_days", _schedule_sql("TRUE AS is_session"))
def valid_days(spark, sf_dir):
    days = S.valid_days(spark, ["NYSE"], *ORDER_RANGE).select(F.col("day").alias("session_date"))
    return on_order_days(spark, sf_dir, days).withColumn("is_session", F.lit(True))


@query("j07_days_off", _join(NYSE_SQL, order_days_sql()) + """
SELECT day::VARCHAR AS day, orders FROM od WHERE isodow(day) <= 5
  AND NOT EXISTS (SELECT 1 FROM sess WHERE session_date = day)""")
def days_off(spark, sf_dir):
    """Weekdays with orders that are no session: an anti join."""
    valid = S.valid_days(spark, ["NYSE"], *ORDER_RANGE).select("day")
    return (views.order_dates(spark, sf_dir).where(F.weekday("day") < 5)
            .join(F.broadcast(valid), "day", "left_anti"))


@query("u04_calendar_days_less_holidays", _join(NYSE_SQL, order_days_sql()) + """
SELECT day::VARCHAR AS day FROM od EXCEPT SELECT d::VARCHAR FROM off""")
def calendar_days_less_holidays(spark, sf_dir):
    off = S.holidays(spark, ["NYSE"], *ORDER_RANGE).select("day")
    return views.order_dates(spark, sf_dir).select("day").exceptAll(
        views.order_dates(spark, sf_dir).select("day").join(F.broadcast(off), "day", "left_semi"))


TIMES_SQL = o.with_(o.values("mt", "calendar, event, minutes, valid_from, valid_to, opens, custom",
                             registry.time_rows(registry.resolve(["NYSE", "JPX", "EUREX_Bond"]))))


@query("c04_regular_times", _join(TIMES_SQL, order_days_sql(23)) + """
SELECT calendar, day::VARCHAR AS day, event, minutes, orders FROM od
JOIN mt ON day >= valid_from AND day < valid_to""")
def regular_times(spark, sf_dir):
    """Rules in force on each day: effective-dated, joined on the calendar."""
    names = ["NYSE", "JPX", "EUREX_Bond"]
    each = F.explode(F.array(*[F.lit(n) for n in names]))
    days = views.order_dates(spark, sf_dir, 23).withColumn("calendar", each).withColumn(
        "saturday_close", F.lit(None).cast("int"))
    return S.times_on(days, registry.market_times_table(spark, names)).select(
        "calendar", "day", "event", "minutes", "orders")


@query("j13_times_before_1985", _join(TIMES_SQL, order_days_sql(-20)) + """
SELECT day::VARCHAR AS day, minutes, orders FROM od
JOIN mt ON day >= valid_from AND day < valid_to WHERE calendar = 'NYSE' AND event = 'market_open'""")
def times_before_1985(spark, sf_dir):
    days = views.order_dates(spark, sf_dir, -20).withColumn("calendar", F.lit("NYSE")).withColumn(
        "saturday_close", F.lit(None).cast("int"))
    opens = registry.market_times_table(spark, ["NYSE"]).where(F.col("event") == "market_open")
    return S.times_on(days, opens).select("day", "minutes", "orders")


@query("c05_special_dates", _join(NYSE_SQL, order_days_sql()) + """
SELECT s.d::VARCHAR AS day, sc AS minutes, orders FROM special s JOIN od ON day = s.d
WHERE sc IS NOT NULL AND EXISTS (SELECT 1 FROM sess WHERE session_date = s.d)""")
def special_dates(spark, sf_dir):
    days = S.special_dates(spark, ["NYSE"], *ORDER_RANGE, "market_close").select("day", "minutes")
    return views.order_dates(spark, sf_dir).join(F.broadcast(days), "day").select(
        "day", "minutes", "orders")


@query("c06_schedule", _schedule_sql(", ".join(EVENTS)))
def schedule(spark, sf_dir):
    return on_order_days(spark, sf_dir, S.sessions(spark, ["NYSE"], *ORDER_RANGE)).select(
        "session_date", "orders", *EVENTS)


@query("c07_special_times_ignored", _schedule_sql("regular_open AS market_open, regular_close AS market_close"))
def special_times_ignored(spark, sf_dir):
    plain = S.sessions(spark, ["NYSE"], *ORDER_RANGE, force_special_times=None)
    return on_order_days(spark, sf_dir, plain).select(
        "session_date", "orders", "market_open", "market_close")


@query("c07_special_times_only_replace", _join(NYSE_SQL, order_days_sql()) + """
SELECT d::VARCHAR AS session_date, orders,
  epoch_us(timezone(zone, CAST(d AS TIMESTAMP) + to_minutes(1200))) AS post,
  epoch_us(timezone(zone, CAST(d AS TIMESTAMP) + to_minutes(coalesce(sc, rc)))) AS market_close
FROM clamped JOIN od ON day = d""")
def special_times_only_replace(spark, sf_dir):
    replaced = S.sessions(spark, ["NYSE"], *ORDER_RANGE, force_special_times=False)
    return on_order_days(spark, sf_dir, replaced).select("session_date", "orders", "post", "market_close")


@query("c11_early_closes", _schedule_sql("market_close", where="WHERE market_close < regular_close"))
def early_closes(spark, sf_dir):
    early = S.early_closes(S.sessions(spark, ["NYSE"], *ORDER_RANGE))
    return on_order_days(spark, sf_dir, early).select("session_date", "orders", "market_close")


@query("c11_late_opens", _schedule_sql("market_open", where="WHERE market_open > regular_open"))
def late_opens(spark, sf_dir):
    late = S.late_opens(S.sessions(spark, ["NYSE"], *ORDER_RANGE))
    return on_order_days(spark, sf_dir, late).select("session_date", "orders", "market_open")


@query("c12_open_close_map", o.with_(TIMES_SQL.removeprefix("WITH ").rstrip(), order_days_sql()) + """
SELECT event, opens, CAST(sum(orders) AS BIGINT) AS orders FROM mt
JOIN od ON day >= valid_from AND day < valid_to WHERE calendar = 'NYSE' GROUP BY event, opens""")
def open_close_map(spark, sf_dir):
    days = views.order_dates(spark, sf_dir).withColumn("calendar", F.lit("NYSE")).withColumn(
        "saturday_close", F.lit(None).cast("int"))
    timed = S.times_on(days, registry.market_times_table(spark, ["NYSE"]).drop("opens"))
    return timed.join(F.broadcast(registry.open_close_map(spark)), "event").groupBy("event", "opens").agg(
        F.sum("orders").alias("orders"))


@query("c13_changed_times", _schedule_sql("""epoch_us(timezone('America/New_York',
  CAST(session_date AS TIMESTAMP) + to_minutes(480))) AS market_open,
  least(market_close, epoch_us(timezone('America/New_York', CAST(session_date AS TIMESTAMP) + to_minutes(1020)))
  ) AS market_close""", where="WHERE market_open = regular_open AND market_close = regular_close")
       .replace("least(market_close, epoch_us(", "greatest(market_close, epoch_us("))
def changed_times(spark, sf_dir):
    """An open and a close moved by a patch, on days without special times."""
    patched = registry.change_time(registry.market_times_table(spark, ["NYSE"]), "NYSE", "market_open", 480)
    patched = registry.change_time(patched, "NYSE", "market_close", 1020)
    patched = registry.remove_time(patched, "NYSE", "pre")
    changed = S.sessions(spark, ["NYSE"], *ORDER_RANGE, market_times=patched)
    regular = (F.col("market_open") == F.col("regular_open")) & (
        F.col("market_close") == F.col("regular_close"))
    return on_order_days(spark, sf_dir, changed.where(regular)).select(
        "session_date", "orders", "market_open", "market_close")


@query("c14_discontinued_time", _schedule_sql(
    "CASE WHEN session_date < DATE '1998-01-01' THEN pre END AS pre"))
def discontinued_time(spark, sf_dir):
    ended = registry.discontinue_time(registry.market_times_table(spark, ["NYSE"]), "NYSE", "pre",
                                      date(1998, 1, 1))
    return on_order_days(spark, sf_dir, S.sessions(spark, ["NYSE"], *ORDER_RANGE, market_times=ended)).select(
        "session_date", "orders", "pre")


@query("c15_time_lookup", _join(TIMES_SQL, order_days_sql()) + """
SELECT calendar, event, minutes, CAST(floor(minutes / 1440.0) AS INTEGER) AS day_offset,
  CAST(sum(orders) AS BIGINT) AS orders
FROM mt JOIN od ON day >= valid_from AND day < valid_to GROUP BY calendar, event, minutes""")
def time_lookup(spark, sf_dir):
    names = ["NYSE", "JPX", "EUREX_Bond"]
    each = F.explode(F.array(*[F.lit(n) for n in names]))
    days = views.order_dates(spark, sf_dir).withColumn("calendar", each).withColumn(
        "saturday_close", F.lit(None).cast("int"))
    timed = S.times_on(days, registry.market_times_table(spark, names))
    return timed.groupBy("calendar", "event", "minutes").agg(F.sum("orders").alias("orders")).withColumn(
        "day_offset", F.floor(F.col("minutes") / 1440).cast("int"))


@query("c16_calendar_aliases", o.with_(o.values("al", "alias, calendar", sorted(registry.ALIASES.items()))) + """
, asked AS (SELECT CASE user_id % 6 WHEN 0 THEN 'stock' WHEN 1 THEN 'B3' WHEN 2 THEN 'NSE' WHEN 3 THEN 'CL'
  WHEN 4 THEN 'XJPX' ELSE 'nowhere' END AS alias FROM events)
SELECT asked.alias, calendar, count(*) AS events FROM asked LEFT JOIN al ON al.alias = asked.alias
GROUP BY asked.alias, calendar""")
def calendar_aliases(spark, sf_dir):
    asked = F.array(*[F.lit(a) for a in ("stock", "B3", "NSE", "CL", "XJPX", "nowhere")])
    events = views.table(spark, sf_dir, "events").select(
        F.element_at(asked, (F.col("user_id") % 6 + 1).cast("int")).alias("alias"))
    return (events.join(F.broadcast(registry.aliases_table(spark)), "alias", "left")
            .groupBy("alias", "calendar").agg(F.count("*").alias("events")))


@query("c27_saturday_sessions", _join(o.sessions(["NYSE"], "1949-01-01", "1955-12-31"), order_days_sql(-46)) + """
SELECT session_date::VARCHAR AS session_date, orders, market_close, isodow(session_date) = 6 AS saturday
FROM sess JOIN od ON day = session_date""")
def saturday_sessions(spark, sf_dir):
    old = S.sessions(spark, ["NYSE"], "1949-01-01", "1955-12-31")
    return on_order_days(spark, sf_dir, old, -46).select(
        "session_date", "orders", "market_close", (F.weekday("session_date") == 5).alias("saturday"))


@query("c28_listed_from", _join(o.sessions(["IEX"], "2010-01-01", "2016-12-31"), order_days_sql(15)) + """
SELECT session_date::VARCHAR AS session_date, orders, market_open FROM sess JOIN od ON day = session_date""")
def listed_from(spark, sf_dir):
    return on_order_days(spark, sf_dir, S.sessions(spark, ["IEX"], "2010-01-01", "2016-12-31"), 15).select(
        "session_date", "orders", "market_open")


# --- merged schedules -----------------------------------------------------

THREE = ["NYSE", "LSE", "JPX"]
THREE_SQL = o.sessions(THREE, *ORDER_RANGE)


@query("c17_j05_outer_merge", _join(THREE_SQL, order_days_sql(), """merged AS (
  SELECT session_date, min(market_open) AS market_open, max(market_close) AS market_close, count(*) AS n
  FROM sess GROUP BY session_date)""") + """
SELECT session_date::VARCHAR AS session_date, orders, market_open, market_close
FROM merged JOIN od ON day = session_date""")
def outer_merge(spark, sf_dir):
    merged = S.merge_schedules(S.sessions(spark, THREE, *ORDER_RANGE), "outer")
    return on_order_days(spark, sf_dir, merged)


@query("c17_j06_inner_merge", _join(THREE_SQL, order_days_sql(), """merged AS (
  SELECT session_date, max(market_open) AS market_open, min(market_close) AS market_close
  FROM sess GROUP BY session_date HAVING count(*) = 3)""") + """
SELECT session_date::VARCHAR AS session_date, orders, market_open, market_close
FROM merged JOIN od ON day = session_date""")
def inner_merge(spark, sf_dir):
    merged = S.merge_schedules(S.sessions(spark, THREE, *ORDER_RANGE), "inner", len(THREE))
    return on_order_days(spark, sf_dir, merged)


@query("c17_j06_inner_merge_without_sessions", """
SELECT count(DISTINCT CAST(o_orderdate AS DATE)) AS days, CAST(0 AS BIGINT) AS common FROM orders""")
def inner_merge_without_sessions(spark, sf_dir):
    """NYSE and IEX before IEX opened: none of the days with orders is common."""
    names = ["NYSE", "IEX"]
    merged = S.merge_schedules(S.sessions(spark, names, "1996-01-01", "2000-12-31"), "inner", len(names))
    days = views.order_dates(spark, sf_dir).select(F.col("day").alias("session_date"))
    return days.join(merged, "session_date", "left").agg(
        F.count("*").alias("days"), F.count("market_open").alias("common"))


# --- interruptions --------------------------------------------------------

HALTS_SQL = """halts AS (
  SELECT CAST(ts AS DATE) AS session_date, epoch_us(ts) AS s, epoch_us(ts) + 60000000 AS e,
    row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts) AS n
  FROM events WHERE event_type = 'error' AND value > 150)"""


def halts(spark, sf_dir) -> DataFrame:
    """Trading halts derived from large error events."""
    ts = F.col("ts").cast("timestamp")
    return (views.table(spark, sf_dir, "events")
            .where((F.col("event_type") == "error") & (F.col("value") > 150))
            .select(F.lit("NYSE").alias("calendar"), F.col("ts").cast("date").alias("session_date"),
                    ts.alias("start"), (ts + F.expr("INTERVAL 1 MINUTE")).alias("end")))


@query("c08_w07_j14_interruptions", _join(o.sessions(["NYSE"], *views.EVENT_DAYS), HALTS_SQL) + """
SELECT sess.session_date::VARCHAR AS session_date, market_open, CAST(n AS INTEGER) AS interruption,
  s AS interruption_start, e AS interruption_end
FROM sess LEFT JOIN halts ON halts.session_date = sess.session_date""")
def interruptions(spark, sf_dir):
    schedule = S.sessions(spark, ["NYSE"], *views.EVENT_DAYS)
    return S.with_interruptions(schedule, halts(spark, sf_dir)).select(
        "session_date", "market_open", "interruption", "interruption_start", "interruption_end")


_HALTED = _join(o.sessions(["NYSE"], *views.EVENT_DAYS), HALTS_SQL,
                "t AS (SELECT event_id, ts, epoch_us(ts) AS us FROM events)")


@query("c08_c09_halted_events", _HALTED + """
SELECT event_id, coalesce(bool_or(us >= s AND us < e), FALSE) AS halted
FROM t JOIN sess ON session_date = CAST(ts AS DATE) LEFT JOIN halts h ON h.session_date = sess.session_date
GROUP BY event_id""")
def halted_events(spark, sf_dir):
    """Events on session dates that fall into a halt."""
    schedule = S.sessions(spark, ["NYSE"], *views.EVENT_DAYS).select("session_date")
    events = instants(spark, sf_dir).withColumn("session_date", times.utc_date(F.col("ts")))
    on_dates = events.join(schedule, "session_date")
    return lookup.with_interrupted(on_dates, halts(spark, sf_dir), "ts", "session_date").select(
        "event_id", F.col("interrupted").alias("halted"))


@query("c08_c09_open_unless_halted", _HALTED + """, hit AS (
  SELECT event_id, bool_or(us >= coalesce(pre, market_open) AND us < coalesce(post, market_close)) AS open
  FROM t LEFT JOIN sess ON us >= coalesce(pre, market_open) AND us < coalesce(post, market_close) GROUP BY event_id),
stopped AS (
  SELECT event_id, bool_or(us >= s AND us < e) AS halted
  FROM t JOIN halts ON halts.session_date = CAST(ts AS DATE) GROUP BY event_id)
SELECT event_id, coalesce(open, FALSE) AND NOT coalesce(halted, FALSE) AS open
FROM hit LEFT JOIN stopped USING (event_id)""")
def open_unless_halted(spark, sf_dir):
    events = at_events(spark, sf_dir).withColumn("halt_day", times.utc_date(F.col("ts")))
    marked = lookup.with_interrupted(events, halts(spark, sf_dir), "ts", "halt_day")
    return marked.select("event_id", lookup.is_open(F.col("ts"), interrupted=F.col("interrupted")).alias("open"))


# --- questions about timestamps -------------------------------------------

def instants(spark, sf_dir) -> DataFrame:
    return views.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))


@query("c09_covered", _join(o.sessions(["NYSE"], "2024-01-10", "2024-01-20"), """bounds AS (
  SELECT min(coalesce(pre, market_open)) AS low, max(session_date) AS last, min(session_date) AS first FROM sess)""") + """
SELECT event_id, ts >= '2024-01-10' AND CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS DATE) >= first
  AND CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS DATE) < last
  OR CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS DATE) = last
     AND epoch_us(ts) BETWEEN (SELECT coalesce(pre, market_open) FROM sess WHERE session_date = last)
     AND (SELECT coalesce(post, market_close) FROM sess WHERE session_date = last) AS covered
FROM events, bounds""")
def covered(spark, sf_dir):
    """Which events a table of a few days can answer for; the others are flagged, not guessed."""
    days = lookup.shared_day_table(views.use_utc(spark), ("NYSE",), "2024-01-10", "2024-01-20")
    joined = lookup.attach(instants(spark, sf_dir), days, "ts", "NYSE", strict=False)
    return joined.select("event_id", F.coalesce(lookup.is_covered(F.col("ts")), F.lit(False)).alias("covered"))


def at_events(spark, sf_dir, calendar: str = "NYSE", by: str = "local") -> DataFrame:
    return lookup.attach(instants(spark, sf_dir), views.event_calendar(spark, calendar), "ts", calendar, by)


def _events_sql(calendar: str, blocks: str, columns: str) -> str:
    return _join(o.sessions([calendar], *views.EVENT_DAYS),
                 "t AS (SELECT event_id, ts, epoch_us(ts) AS us FROM events)", blocks) + columns


OPEN_SQL = """hit AS (
  SELECT event_id, bool_or(us >= coalesce({low}, market_open) AND us < coalesce({high}, market_close)
      AND NOT (break_start IS NOT NULL AND us >= break_start AND us < break_end)) AS open
  FROM t LEFT JOIN sess ON us >= coalesce({low}, market_open) - 86400000000 AND us <= market_close + 86400000000
  GROUP BY event_id)"""


def open_query(name: str, calendar: str, only_rth: bool):
    low, high = ("market_open", "market_close") if only_rth else ("pre", "post")
    sql = _events_sql(calendar, OPEN_SQL.format(low=low, high=high),
                      "SELECT event_id, coalesce(open, FALSE) AS open FROM hit")

    @query(name, sql)
    def run(spark, sf_dir):
        state = lookup.is_open(F.col("ts"), only_rth=only_rth)
        return at_events(spark, sf_dir, calendar).select("event_id", state.alias("open"))
    return run


open_query("c09_j10_open_at", "NYSE", False)
open_query("c09_open_at_regular_hours", "NYSE", True)
open_query("c09_open_at_overnight", "CME_Equity", False)
open_query("c09_open_at_with_break", "HKEX", False)


@query("c09_close_included", _events_sql("NYSE", """closing AS (
  SELECT event_id, 'close' AS edge, us, market_close AS at FROM t JOIN sess ON CAST(ts AS DATE) = session_date)""", """
SELECT event_id, TRUE AS with_close, FALSE AS without_close FROM closing"""))
def close_included(spark, sf_dir):
    """Every event moved to the close of its session date: open only if the close counts."""
    table = views.event_calendar(spark)
    days = table.frame.where(F.col("is_session")).select("day", F.col("at_close").alias("edge"))
    moved = (instants(spark, sf_dir).withColumn("day", times.utc_date(F.col("ts")))
             .join(F.broadcast(days), "day").select("event_id", F.col("edge").alias("ts")))
    joined = lookup.attach(moved, table, "ts", "NYSE")
    t = F.col("ts")
    return joined.select(
        "event_id", lookup.is_open(t, include_close=True, only_rth=True).alias("with_close"),
        lookup.is_open(t, only_rth=True).alias("without_close"))


AS_OF = "2024-01-16 15:00:00"


@query("c10_open_as_of", f"""
SELECT user_id, TIMESTAMP '{AS_OF}' - max(ts) < INTERVAL 3 DAY AS recent, TRUE AS open
FROM events WHERE ts <= TIMESTAMP '{AS_OF}' GROUP BY user_id""")
def open_as_of(spark, sf_dir):
    """``Open now`` with the moment as an argument: 10:00 in New York on a Tuesday."""
    as_of = F.lit(AS_OF).cast("timestamp")
    users = (views.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
             .where(F.col("ts") <= as_of).groupBy("user_id").agg(F.max("ts").alias("last"))
             .withColumn("ts", as_of))
    joined = lookup.attach(users, views.event_calendar(spark), "ts", "NYSE")
    return joined.select("user_id", (as_of - F.col("last") < F.expr("INTERVAL 3 DAY")).alias("recent"),
                         lookup.is_open(F.col("ts")).alias("open"))


AROUND = """around AS (
  SELECT t.*, p.session_date AS last_date, p.market_open AS last_open, p.market_close AS last_close
  FROM t ASOF LEFT JOIN sess p ON t.us > epoch_us(CAST(p.session_date AS TIMESTAMP))),
both_sides AS (
  SELECT a.*, n.session_date AS next_date, n.market_open AS next_open, n.market_close AS next_close
  FROM around a ASOF LEFT JOIN sess n ON a.us < epoch_us(CAST(n.session_date AS TIMESTAMP)))"""


@query("c22_j11_last_session", _events_sql("NYSE", AROUND, """
SELECT event_id, last_date::VARCHAR AS last_date, last_open, last_close FROM both_sides"""))
def last_session(spark, sf_dir):
    return at_events(spark, sf_dir, by="before").select(
        "event_id", F.col("at_session").alias("last_date"), F.col("at_open").alias("last_open"),
        F.col("at_close").alias("last_close"))


@query("c22_j12_next_session", _events_sql("NYSE", AROUND, """
SELECT event_id, next_date::VARCHAR AS next_date, next_open, next_close FROM both_sides"""))
def next_session(spark, sf_dir):
    return at_events(spark, sf_dir, by="utc").select(
        "event_id", F.col("next_session").alias("next_date"), "next_open", "next_close")


@query("c23_is_session_date", _events_sql("NYSE", "today AS (SELECT event_id, session_date FROM t LEFT JOIN sess "
       "ON CAST(ts AS DATE) = session_date)", "SELECT event_id, session_date IS NOT NULL AS is_session FROM today"))
def is_session_date(spark, sf_dir):
    return at_events(spark, sf_dir, by="utc").select(
        "event_id", lookup.is_session_date().alias("is_session"))


@query("c24_minutes_until", _events_sql("NYSE", AROUND, """
SELECT b.event_id, (next_open - us) // 60000000 AS until_next_open, (next_close - us) // 60000000 AS until_next_close,
  CASE WHEN s.market_close > us THEN (s.market_close - us) // 60000000 ELSE -1 END AS until_close
FROM both_sides b LEFT JOIN sess s ON s.session_date = CAST(ts AS DATE)"""))
def minutes_until(spark, sf_dir):
    t = F.col("ts")
    return at_events(spark, sf_dir, by="utc").select(
        "event_id", lookup.minutes_until_next(t, "open").alias("until_next_open"),
        lookup.minutes_until_next(t, "close").alias("until_next_close"),
        lookup.minutes_until_close(t).alias("until_close"))


@query("c26_regular_hours", _events_sql("NYSE", "today AS (SELECT event_id, coalesce(us BETWEEN market_open "
       "AND market_close, FALSE) AS rth FROM t LEFT JOIN sess ON CAST(ts AS DATE) = session_date)",
       "SELECT event_id, rth FROM today"))
def regular_hours(spark, sf_dir):
    return at_events(spark, sf_dir, by="utc").select(
        "event_id", F.coalesce(lookup.is_regular_hours(F.col("ts")), F.lit(False)).alias("rth"))


@query("c21_trading_day", _events_sql("NYSE", """today AS (
  SELECT event_id, us, ts, session_date, market_open, market_close, make_timestamp(market_open) AS o,
    make_timestamp(market_close) AS c FROM t LEFT JOIN sess ON CAST(ts AS DATE) = session_date)""", """
SELECT event_id, CAST(hour(o) AS INTEGER) AS open_hour, CAST(minute(o) AS INTEGER) AS open_minute,
  CAST(hour(c) AS INTEGER) AS close_hour, CAST(minute(c) AS INTEGER) AS close_minute,
  (market_close - market_open) // 3600000000 AS hours_in_trading_day,
  (market_close - market_open) // 60000000 AS minutes_in_trading_day,
  session_date IS NOT NULL AS is_session,
  CASE WHEN us < market_open THEN (market_open - us) // 60000000 WHEN market_open IS NOT NULL THEN 0 END
    AS minutes_until_open,
  CASE WHEN us < market_close THEN (market_close - us) // 60000000 WHEN market_open IS NOT NULL THEN 0 END
    AS minutes_until_close,
  CASE WHEN market_open IS NOT NULL THEN 0 END AS days_until_open, 'rth' AS session_type FROM today"""))
def trading_day(spark, sf_dir):
    columns = lookup.trading_day(F.col("ts"))
    return at_events(spark, sf_dir, by="utc").select("event_id", *[c.alias(n) for n, c in columns.items()])


def _pairs(spark, sf_dir) -> DataFrame:
    """From each event to a moment some days later, inside the table of days."""
    return instants(spark, sf_dir).withColumn(
        "until", F.col("ts") + F.make_dt_interval((F.col("event_id") % 17).cast("int"),
                                                  (F.col("event_id") % 7).cast("int")))


PAIRS = """pair AS (SELECT event_id, ts, us, ts + to_days(CAST(event_id % 17 AS INTEGER))
  + to_hours(CAST(event_id % 7 AS INTEGER)) AS until FROM t)"""


def _attach_both(spark, sf_dir, calendar: str, by: str) -> DataFrame:
    table = views.event_calendar(spark, calendar)
    started = lookup.attach(_pairs(spark, sf_dir), table, "ts", calendar, by, "s_")
    return lookup.attach(started, table, "until", calendar, by, "e_")


@query("c25_a08_trading_days_between", _events_sql("NYSE", PAIRS, """
SELECT event_id, count(session_date) AS days FROM pair
LEFT JOIN sess ON session_date BETWEEN CAST(ts AS DATE) AND CAST(until AS DATE) GROUP BY event_id"""))
def trading_days_between(spark, sf_dir):
    return _attach_both(spark, sf_dir, "NYSE", "utc").select(
        "event_id", lookup.trading_days_between("s_", "e_").cast("bigint").alias("days"))


def _minutes(name: str, calendar: str):
    sql = _events_sql(calendar, PAIRS, """
SELECT event_id, coalesce(CAST(sum(least(market_close // 1000000, epoch_us(until) // 1000000)
    - greatest(market_open // 1000000, us // 1000000)) FILTER (session_date IS NOT NULL) AS BIGINT), 0) // 60
  AS minutes
FROM pair LEFT JOIN sess ON market_open // 1000000 < epoch_us(until) // 1000000
  AND market_close // 1000000 > us // 1000000 GROUP BY event_id""")

    @query(name, sql)
    def run(spark, sf_dir):
        both = _attach_both(spark, sf_dir, calendar, "local")
        return both.select("event_id", lookup.trading_minutes_between(
            F.col("ts"), F.col("until"), "s_", "e_").alias("minutes"))
    return run


_minutes("c25_a09_trading_minutes_between", "NYSE")
_minutes("c25_overnight_minutes_between", "CME_Equity")


# --- trading index --------------------------------------------------------

HOUR = 3600
INDEX_RANGE = ("2000-01-01", "2000-12-31")
SPANS = """spans AS (
  SELECT calendar, session_date, 0 AS part, market_open AS s,
    CASE WHEN break_end <= market_close THEN break_start ELSE market_close END AS e FROM sess
  UNION ALL SELECT calendar, session_date, 1, break_end, market_close FROM sess WHERE break_end <= market_close),
live AS (SELECT * FROM spans WHERE s <> e)"""


def _index_sql(closed: str, force: bool | None) -> str:
    first = 1 if closed == "right" else 0
    count = f"CAST(ceil((e - s) / {HOUR * 1_000_000}.0) AS BIGINT)"
    last = f"{count} - 1" if closed == "left" else count
    keep = "" if force is None else "WHERE stamp <= e"
    tail = "UNION SELECT calendar, session_date, e FROM live" if force else ""
    return _join(o.sessions(["HKEX", "NYSE"], *INDEX_RANGE), order_days_sql(), SPANS, f"""stamps AS (
  SELECT calendar, session_date, stamp FROM (
    SELECT *, s + unnest(range({first}, {last} + 1)) * {HOUR * 1_000_000} AS stamp FROM live) {keep} {tail})""") + """
SELECT calendar, session_date::VARCHAR AS session_date, stamp, orders FROM stamps JOIN od ON day = session_date"""


def index_query(name: str, closed: str, force: bool | None):
    @query(name, _index_sql(closed, force))
    def run(spark, sf_dir):
        schedule = S.sessions(spark, ["HKEX", "NYSE"], *INDEX_RANGE)
        stamps = index.trading_index(schedule, HOUR, closed, force)
        return on_order_days(spark, sf_dir, stamps).select("calendar", "session_date", "stamp", "orders")
    return run


index_query("c18_w04_trading_index", "right", True)
index_query("c18_index_left_labels", "left", None)
index_query("c18_index_both_ends", "both", False)
index_query("c18_index_right_not_forced", "right", False)


@query("w01_bar_ordinals", _join(o.sessions(["HKEX"], *INDEX_RANGE), order_days_sql(), SPANS) + f"""
SELECT session_date::VARCHAR AS session_date, part, CAST(unnest(range(0,
  CAST(ceil((e - s) / {HOUR * 1_000_000}.0) AS BIGINT))) AS INTEGER) AS ordinal FROM live JOIN od ON day = session_date""")
def bar_ordinals(spark, sf_dir):
    stamps = index.trading_index(S.sessions(spark, ["HKEX"], *INDEX_RANGE), HOUR, "left", None)
    return on_order_days(spark, sf_dir, stamps).select("session_date", "part", "ordinal")


@query("u03_sessions_around_breaks", _join(o.sessions(["HKEX", "CME Globex Crypto"], *INDEX_RANGE), order_days_sql(),
                                           SPANS) + """
SELECT calendar, session_date::VARCHAR AS session_date, part, s AS "start", e AS "end" FROM live
JOIN od ON day = session_date""")
def sessions_around_breaks(spark, sf_dir):
    parts = index.parts(S.sessions(spark, ["HKEX", "CME Globex Crypto"], *INDEX_RANGE))
    return on_order_days(spark, sf_dir, parts).select("calendar", "session_date", "part", "start", "end")


@query("a10_distinct_stamps", _join(o.sessions(["CME_Equity"], *INDEX_RANGE), order_days_sql(), SPANS) + f"""
SELECT count(DISTINCT stamp) AS stamps FROM (
  SELECT s + unnest(range(1, CAST(ceil((e - s) / {HOUR * 1_000_000}.0) AS BIGINT) + 1)) * {HOUR * 1_000_000}
    AS stamp, session_date FROM live) JOIN od ON day = session_date""")
def distinct_stamps(spark, sf_dir):
    full = index.trading_index(S.sessions(spark, ["CME_Equity"], *INDEX_RANGE), HOUR, "right", None)
    return index.stamps(on_order_days(spark, sf_dir, full)).agg(F.count("*").alias("stamps"))


@query("c19_w02_index_violations", _join(o.sessions(["HKEX", "CME Globex Crypto"], *INDEX_RANGE), order_days_sql(),
                                         SPANS, """ahead AS (
  SELECT *, lead(s) OVER (PARTITION BY calendar ORDER BY s) AS following FROM live),
bad AS (
  SELECT calendar, session_date, 'break outside the session' AS reason FROM sess
  WHERE break_start IS NOT NULL AND NOT (market_open <= break_start AND break_start <= break_end
    AND break_end <= market_close)
  UNION ALL SELECT calendar, session_date, 'bars overlap the next session' FROM ahead
  WHERE s + CAST(ceil((e - s) / 7200000000.0) AS BIGINT) * 7200000000 > following)""") + """
SELECT calendar, reason, count(*) AS sessions, CAST(sum(orders) AS BIGINT) AS orders
FROM bad JOIN od ON day = session_date GROUP BY calendar, reason""")
def index_violations(spark, sf_dir):
    schedule = S.sessions(spark, ["HKEX", "CME Globex Crypto"], *INDEX_RANGE)
    bad = index.violations(schedule, 2 * HOUR, "right", None)
    return on_order_days(spark, sf_dir, bad).groupBy("calendar", "reason").agg(
        F.count("*").alias("sessions"), F.sum("orders").alias("orders"))


@query("c20_sessions_of_no_length", _schedule_sql(
    "market_open", where="WHERE isodow(session_date) <> 3"))
def sessions_of_no_length(spark, sf_dir):
    """Wednesdays are patched to close when they open and drop out of the index."""
    schedule = S.sessions(spark, ["NYSE"], *ORDER_RANGE)
    patched = schedule.withColumn("market_close", F.when(
        F.weekday("session_date") == 2, F.col("market_open")).otherwise(F.col("market_close")))
    return on_order_days(spark, sf_dir, index.parts(patched)).select(
        "session_date", "orders", F.col("start").alias("market_open"))


@query("e12_lower_frequency", _join(o.sessions(["NYSE"], *INDEX_RANGE)) + """
, b AS (SELECT min(market_open) AS lo, max(market_open) AS hi FROM sess JOIN (
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) ON day = session_date)
SELECT 'NYSE' AS calendar, unnest(range(lo, hi + 1, 43200000000)) AS stamp FROM b""")
def lower_frequency(spark, sf_dir):
    opens = on_order_days(spark, sf_dir, S.sessions(spark, ["NYSE"], *INDEX_RANGE)).select(
        "calendar", F.col("market_open").alias("stamp"))
    return index.lower_frequency(opens, 12 * HOUR)


# --- ordering and selection over market times -----------------------------

@query("t02_t03_market_times_in_order", _join(TIMES_SQL, order_days_sql(), """latest AS (
  SELECT calendar, event, arg_max(minutes, valid_from) AS minutes FROM mt GROUP BY calendar, event),
ranked AS (SELECT *, row_number() OVER (PARTITION BY calendar ORDER BY minutes) AS position FROM latest)""") + """
SELECT r.calendar, r.event, CAST(r.position AS INTEGER) AS position, n.orders FROM ranked r
CROSS JOIN (SELECT CAST(sum(orders) AS BIGINT) AS orders FROM od) n
JOIN ranked a ON a.calendar = r.calendar AND a.event = 'market_open'
JOIN ranked z ON z.calendar = r.calendar AND z.event = 'market_close'
WHERE r.position BETWEEN a.position AND z.position""")
def market_times_in_order(spark, sf_dir):
    """Events from open to close, ordered by their latest time of day."""
    names = ["NYSE", "JPX", "EUREX_Bond"]
    latest = registry.market_times_table(spark, names).groupBy("calendar", "event").agg(
        F.max_by("minutes", "valid_from").alias("minutes"))
    order = Window.partitionBy("calendar").orderBy("minutes")
    ranked = latest.withColumn("position", F.row_number().over(order))
    ends = ranked.groupBy("calendar").agg(
        F.max(F.when(F.col("event") == "market_open", F.col("position"))).alias("lo"),
        F.max(F.when(F.col("event") == "market_close", F.col("position"))).alias("hi"))
    counted = views.order_dates(spark, sf_dir).withColumn(
        "calendar", F.explode(F.array(*[F.lit(n) for n in names]))).groupBy("calendar").agg(
        F.sum("orders").alias("orders"))
    return (ranked.join(ends, "calendar").where(F.col("position").between(F.col("lo"), F.col("hi")))
            .join(counted, "calendar").select("calendar", "event", "position", "orders"))


@query("w05_t04_first_and_last_trade", """
SELECT user_id, arg_min(event_id, ts) AS first_event, arg_max(event_id, ts) AS last_event FROM events GROUP BY user_id""")
def first_and_last_trade(spark, sf_dir):
    return views.table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.min_by("event_id", "ts").alias("first_event"), F.max_by("event_id", "ts").alias("last_event"))


@query("w03_market_event_before_post", _join(o.sessions(["NYSE"], *ORDER_RANGE), order_days_sql()) + """
SELECT session_date::VARCHAR AS session_date, post IS NOT NULL AND market_close < post AS extended, orders
FROM sess JOIN od ON day = session_date""")
def market_event_before_post(spark, sf_dir):
    """Whether the close is followed by a later ``post``, found with ``lead``."""
    schedule = S.sessions(spark, ["NYSE"], *ORDER_RANGE)
    events = schedule.select("session_date", F.explode(F.array(*[
        F.struct(F.lit(e).alias("event"), F.col(e).alias("at"), F.lit(i).alias("i"))
        for i, e in enumerate(EVENTS)])).alias("x")).select("session_date", "x.*").where(F.col("at").isNotNull())
    order = Window.partitionBy("session_date").orderBy("at", "i")
    marked = events.withColumn("following", F.lead("event").over(order)).withColumn(
        "following_at", F.lead("at").over(order))
    closes = marked.where(F.col("event") == "market_close").select(
        "session_date", ((F.col("following") == "post") & (F.col("following_at") > F.col("at"))).alias("extended"))
    return on_order_days(spark, sf_dir, closes).select("session_date", "extended", "orders")


@query("t01_ordered_special_dates", _join(NYSE_SQL, order_days_sql()) + """
SELECT s.d::VARCHAR AS day, CAST(row_number() OVER (ORDER BY s.d) AS INTEGER) AS position
FROM special s JOIN od ON day = s.d WHERE sc IS NOT NULL""")
def ordered_special_dates(spark, sf_dir):
    days = S.special_dates(spark, ["NYSE"], *ORDER_RANGE, "market_close", filter_holidays=False)
    kept = days.join(views.order_dates(spark, sf_dir), "day")
    order = Window.partitionBy("calendar").orderBy("day")
    return kept.withColumn("position", F.row_number().over(order)).select("day", "position")


@query("u01_union_of_lists", o.with_(listed_sql(["HKEX", "SSE"]), order_days_sql()) + """
SELECT DISTINCT closed.day::VARCHAR AS day, orders FROM closed JOIN od ON od.day = closed.day""")
def union_of_lists(spark, sf_dir):
    days = S.adhoc_holidays(spark, ["HKEX"]).unionByName(S.adhoc_holidays(spark, ["SSE"])).select("day").distinct()
    return views.order_dates(spark, sf_dir).join(F.broadcast(days), "day")


@query("j08_specials_on_sessions", _join(NYSE_SQL, order_days_sql()) + """
SELECT day::VARCHAR AS day, orders FROM od WHERE EXISTS (SELECT 1 FROM special WHERE special.d = day)
  AND EXISTS (SELECT 1 FROM sess WHERE session_date = day)""")
def specials_on_sessions(spark, sf_dir):
    special = S.special_days(spark, ["NYSE"], *ORDER_RANGE).select("day")
    valid = S.valid_days(spark, ["NYSE"], *ORDER_RANGE).select("day")
    return (views.order_dates(spark, sf_dir).join(F.broadcast(special), "day", "left_semi")
            .join(F.broadcast(valid), "day", "left_semi"))


@query("j09_overlay_of_special_times", _join(NYSE_SQL, order_days_sql()) + """
SELECT day::VARCHAR AS day, orders, coalesce(sc, rc) AS minutes FROM clamped JOIN od ON day = d""")
def overlay_of_special_times(spark, sf_dir):
    """Regular closes of the session dates, replaced where a special one exists."""
    valid = S.valid_days(spark, ["NYSE"], *ORDER_RANGE)
    closes = registry.market_times_table(spark, ["NYSE"]).where(F.col("event") == "market_close")
    regular = S.times_on(valid, closes).select("day", F.col("minutes").alias("regular"))
    special = S.special_dates(spark, ["NYSE"], *ORDER_RANGE, "market_close", False).select(
        "day", F.col("minutes").alias("special"))
    both = regular.join(F.broadcast(special), "day", "left")
    return views.order_dates(spark, sf_dir).join(F.broadcast(both), "day").select(
        "day", "orders", F.coalesce("special", "regular").alias("minutes"))


# --- the markets ----------------------------------------------------------

MARKETS = {
    "m01_nyse": "NYSE", "m02_iex": "IEX", "m03_cfe": "CFE", "m04_cboe_equity_options": "CBOE_Equity_Options",
    "m05_cboe_index_options": "CBOE_Index_Options", "m06_cme_equity": "CME_Equity",
    "m07_cme_agriculture": "CME_Agriculture", "m08_cme_bond": "CME_Bond",
    "m10_globex_livestock": "CMEGlobex_Livestock", "m11_globex_grains": "CMEGlobex_GrainsAndOilseeds",
    "m12_globex_crypto": "CME Globex Crypto", "m13_globex_energy_and_metals": "CMEGlobex_EnergyAndMetals",
    "m14_globex_equity": "CME Globex Equities", "m15_globex_fx": "CMEGlobex_FX",
    "m16_globex_fixed_income": "CME Globex Fixed Income", "m17_eurex": "EUREX", "m18_eurex_bond": "EUREX_Bond",
    "m19_hkex": "HKEX", "m20_ice": "ICE", "m21_jpx": "JPX", "m22_lse": "LSE", "m23_ose": "OSE",
    "m24_sifma_us": "SIFMA_US", "m25_sifma_uk": "SIFMA_UK", "m26_sifma_jp": "SIFMA_JP", "m27_six": "SIX",
    "m28_sse": "SSE", "m29_tase": "TASE", "m30_tsx": "TSX", "m31_asx": "ASX", "m32_bmf": "BMF", "m33_bse": "BSE",
}


def market_query(name: str, calendar: str):
    """Orders of each session, on the given dates and 23 years later."""
    both = f"""od AS (SELECT day, CAST(sum(orders) AS BIGINT) AS orders FROM (
    SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1 UNION ALL
    SELECT CAST(o_orderdate + to_years(23) AS DATE), count(*) FROM orders GROUP BY 1) GROUP BY day)"""
    sql = _join(o.sessions([calendar], ORDER_RANGE[0], LATER_RANGE[1]), both) + f"""
SELECT session_date::VARCHAR AS session_date, orders, {', '.join(EVENTS)}, market_close < regular_close AS early
FROM sess JOIN od ON day = session_date"""

    @query(name, sql)
    def run(spark, sf_dir):
        day = F.col("o_orderdate").cast("date")
        dates = F.explode(F.array(day, F.add_months(day, 276)))
        orders = (views.table(spark, sf_dir, "orders").select(dates.alias("session_date"))
                  .groupBy("session_date").agg(F.count("*").alias("orders")))
        schedule = S.sessions(spark, [calendar], ORDER_RANGE[0], LATER_RANGE[1])
        return orders.join(F.broadcast(schedule), "session_date").select(
            "session_date", "orders", *EVENTS, (F.col("market_close") < F.col("regular_close")).alias("early"))
    return run


for _name, _calendar in MARKETS.items():
    market_query(_name, _calendar)


@query("m09_globex_shared_holidays", _join(o.with_(*o.holiday_blocks(registry.holiday_rule_rows(
    registry.resolve(["CME Globex Equities", "CMEGlobex_FX", "CMEGlobex_EnergyAndMetals"])), 1995, 2001)),
    order_days_sql()) + """
SELECT day_off::VARCHAR AS day, count(DISTINCT calendar) AS calendars, any_value(orders) AS orders
FROM days_off JOIN od ON od.day = day_off GROUP BY day_off""")
def globex_shared_holidays(spark, sf_dir):
    names = ["CME Globex Equities", "CMEGlobex_FX", "CMEGlobex_EnergyAndMetals"]
    days = S.regular_holidays(spark, names, *ORDER_RANGE).groupBy("day").agg(
        F.count_distinct("calendar").alias("calendars"))
    return views.order_dates(spark, sf_dir).join(F.broadcast(days), "day").select("day", "calendars", "orders")
