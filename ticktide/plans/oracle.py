"""SQL building blocks for the comparison engine.

The SQL states the expected values from the given tables. It shares the fixed
dimensions with the library, written out as VALUES, and no other code.
"""

from __future__ import annotations

from datetime import date

from ticktide import dims
from ticktide.calendars import registry
from ticktide.calendars.model import Rule


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return str(value)
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(literal(v) for v in value) + "]::INT[]"
    return "'" + str(value).replace("'", "''") + "'"


def values(name: str, columns: str, rows: list[tuple]) -> str:
    body = ",\n".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def with_(*blocks: str) -> str:
    return "WITH " + ",\n".join(blocks) + "\n"


# --- equity trades --------------------------------------------------------

PUBLISHERS = values("pub", "publisher_id, publisher", list(dims.PUBLISHERS.items()))

RAW = """raw AS (
  SELECT event_id, event_type, user_id AS instrument_id, ts,
    CASE WHEN event_id % 10 = 9 THEN 'trades' ELSE 'mbp-1' END AS rtype,
    CAST(event_id % 62 + 1 AS INTEGER) AS publisher_id,
    epoch_us(ts) * 1000 + event_id % 1000 AS ts_event,
    CAST(round(value * 100) AS BIGINT) AS cents,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS lot
  FROM events)"""

TBBO = RAW + """,
tbbo AS (
  SELECT *,
    CASE WHEN event_id % 13 = 0 THEN lot * 10000 ELSE lot END AS size,
    CASE WHEN event_id % 11 = 2 THEN NULL WHEN event_id % 11 = 1 THEN cents + 1
         WHEN event_id % 11 = 0 THEN cents - event_id % 5 - 3
         ELSE cents - event_id % 5 - 1 END AS bid_cents,
    CASE WHEN event_id % 11 = 2 THEN NULL WHEN event_id % 11 = 0 THEN cents - 1
         WHEN event_id % 11 = 1 THEN cents + event_id % 5 + 3
         ELSE cents + event_id % 5 + 1 END AS ask_cents,
    CASE event_type WHEN 'click' THEN 'A' WHEN 'purchase' THEN 'B' ELSE 'N' END AS side,
    CASE event_id % 3 WHEN 0 THEN 194 WHEN 1 THEN 130 ELSE 40 END AS flags
  FROM raw)"""

SYMBOLOGY = """sym AS (
  SELECT DISTINCT user_id AS instrument_id, 'SYM' || user_id AS symbol
  FROM events WHERE user_id % 50 <> 7)"""

EQUITY = with_(PUBLISHERS, TBBO, SYMBOLOGY, """eq AS (
  SELECT CAST(event_id AS BIGINT) AS sequence, instrument_id, publisher_id, ts_event AS event_ns,
    (ts_event + 135800 + (event_id % 7) * 1000) // 1000000 AS received_ts,
    (ts_event + 300000 + (event_id % 7) * 1000) // 1000000 AS out_ts,
    ts_event // 1000000 AS "timestamp", symbol, size AS qty,
    CAST(cents * 0.01 AS DECIMAL(16,4)) AS price, side, split_part(publisher, '.', 3) AS venue,
    CAST(bid_cents * 0.01 AS DECIMAL(18,6)) AS bid_px,
    CAST(ask_cents * 0.01 AS DECIMAL(18,6)) AS ask_px,
    lot + 1 AS bid_qty, lot + 2 AS ask_qty, CAST(event_id % 4 AS INTEGER) AS bid_ct,
    CAST(event_id % 6 AS INTEGER) AS ask_ct, flags, 0 AS depth,
    concat_ws('|', CASE WHEN cents > ask_cents THEN 'ABOVE_ASK' END,
                   CASE WHEN cents < bid_cents THEN 'BELOW_BID' END,
                   CASE WHEN cents::HUGEINT * size > 100000000 THEN 'WHALE' END) AS tags,
    concat_ws('|', CASE WHEN publisher IS NULL THEN 'unknown venue' END,
                   CASE WHEN symbol IS NULL THEN 'unknown symbol' END,
                   CASE WHEN size <= 0 THEN 'size not positive' END,
                   CASE WHEN cents <= 0 THEN 'price not positive' END) AS reason
  FROM tbbo LEFT JOIN pub USING (publisher_id) LEFT JOIN sym USING (instrument_id)
  WHERE rtype = 'mbp-1')""", "eqv AS (SELECT * FROM eq WHERE reason = '')")

# --- option trades --------------------------------------------------------

OPTION = """WITH joined AS (
  SELECT *, l_orderkey AS o, CAST(l_linenumber AS BIGINT) AS n,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS ext, CAST(l_quantity AS BIGINT) AS q,
    CAST(round(l_discount * 100) AS BIGINT) AS disc, CAST(round(l_tax * 100) AS BIGINT) AS tax,
    CAST(round(p_retailprice * 100) AS BIGINT) AS retail,
    CAST(l_shipdate AS DATE) AS shipped
  FROM lineitem JOIN part ON l_partkey = p_partkey),
item AS (
  SELECT *, ext // (q * 100) AS price_c,
    epoch_ms(shipped::TIMESTAMP) + (o % 86400) * 1000 AS executed,
    CAST(shipped + CAST(n * 30 AS INTEGER) AS DATE) AS exp_full,
    o || '-' || n || '-' || l_partkey AS id,
    CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'R' THEN 'B' ELSE 'N' END AS side,
    CASE WHEN l_linestatus = 'F' THEN 'B' WHEN n % 2 = 0 THEN 'R' ELSE 'N' END AS bias
  FROM joined),
book AS (
  SELECT *,
    CASE WHEN o % 9 = 0 THEN price_c + 1 WHEN o % 9 = 1 THEN price_c WHEN o % 9 = 2 THEN price_c - 9
         ELSE price_c - disc - 1 END AS bid_c,
    CASE WHEN o % 9 = 0 THEN price_c + 6 WHEN o % 9 = 1 THEN price_c WHEN o % 9 = 2 THEN price_c - 1
         ELSE price_c + tax + 1 END AS ask_c
  FROM item),
scored AS (
  SELECT *,
    CASE WHEN price_c < bid_c THEN -1.0 WHEN price_c > ask_c THEN 1.0 WHEN ask_c = bid_c THEN 0.0
      ELSE (CASE WHEN bias = 'R' THEN -1 ELSE 1 END) * abs(2.0 / (1.0 + exp(
        -((price_c / 100.0)::DOUBLE - ((bid_c / 100.0)::DOUBLE + (ask_c / 100.0)::DOUBLE) / 2)
         / (((ask_c / 100.0)::DOUBLE - (bid_c / 100.0)::DOUBLE) / 2))) - 1) END AS score_d,
    CASE WHEN (o + n) % 23 <> 0 THEN ext * 100 END AS premium_c,
    'P' || (l_partkey % 1000) AS underlying,
    rpad('P' || (l_partkey % 1000), 6, ' ') || strftime(exp_full, '%y%m%d')
      || CASE WHEN l_returnflag = 'R' THEN 'P' ELSE 'C' END
      || lpad(CAST(CAST(round(p_retailprice) AS BIGINT) * 1000 AS VARCHAR), 8, '0') AS symbol
  FROM book),
opt AS (
  SELECT id, executed AS "timestamp", symbol, underlying,
    CAST((retail + (o % 21 - 10) * 100) * 0.01 AS DECIMAL(12,2)) AS spot,
    CAST(CAST(round(p_retailprice) AS BIGINT) AS DECIMAL(12,2)) AS strike,
    CASE WHEN (o + n) % 19 <> 0 THEN exp_full ELSE DATE '1970-01-01' END AS exp_date,
    CAST(CASE WHEN (o + n) % 19 <> 0 THEN exp_full ELSE DATE '1800-01-01' END - shipped AS INTEGER)
      AS dte,
    CASE WHEN l_returnflag = 'R' THEN 'P' ELSE 'C' END AS put_call,
    CAST(q AS INTEGER) AS qty, CAST(price_c * 0.01 AS DECIMAL(12,2)) AS price,
    CAST(coalesce(premium_c, 0) * 0.01 AS DECIMAL(12,2)) AS premium, side, bias,
    CAST(round(score_d, 6) AS DECIMAL(8,6)) AS score,
    CASE WHEN (o + n) % 17 <> 0 THEN 'X' || (l_suppkey % 10) ELSE '' END AS venue,
    lower(l_linestatus) AS trade_code,
    CAST(CASE WHEN (o + n) % 13 <> 0 THEN ((o * 7 + n) % 100000) * 0.00001 ELSE 0.00000001 END
      AS DECIMAL(18,16)) AS iv,
    CAST(bid_c * 0.01 AS DECIMAL(14,4)) AS bid_px, CAST(ask_c * 0.01 AS DECIMAL(14,4)) AS ask_px,
    CAST(CASE WHEN (o + n) % 11 <> 0 THEN (price_c + n) * 0.01 ELSE 0 END AS DECIMAL(14,4)) AS theo,
    CAST(CASE WHEN (o + n) % 7 <> 0 THEN ((o + n) % 100000) * 0.00001 ELSE 0.00000001 END
      AS DECIMAL(16,14)) AS delta,
    CAST(((o * 3) % 100000) * 0.00001 AS DECIMAL(16,14)) AS gamma,
    CAST(-((o * 5) % 100000) * 0.00001 AS DECIMAL(16,14)) AS theta,
    CAST(((n * 11) % 100000) * 0.00001 AS DECIMAL(16,14)) AS vega,
    CAST(((o * 2) % 100000) * 0.00001 AS DECIMAL(16,14)) AS rho,
    CAST(q * 2 AS INTEGER) AS vol_ask, CAST(q AS INTEGER) AS vol_bid,
    CAST(CASE WHEN (o + n) % 3 <> 0 THEN n ELSE 0 END AS INTEGER) AS vol_no_side,
    CAST(n AS INTEGER) AS vol_mid, CAST(o % 4 AS INTEGER) AS vol_leg,
    CAST(CASE WHEN o % 251 <> 0 THEN o % 3 END AS INTEGER) AS vol_stock,
    CAST(CASE WHEN n = 7 THEN 0 ELSE q * 3 END AS INTEGER) AS vol,
    CAST(CASE WHEN (o + n) % 5 <> 0 THEN l_suppkey * 10 ELSE 0 END AS INTEGER) AS oi,
    concat_ws('|', CASE WHEN n = 3 THEN 'SWEEP|SWEEP' END, CASE WHEN n % 3 = 0 THEN 'FLOOR|CROSS' END,
      CASE WHEN premium_c >= 100000000 THEN 'MILLIONAIRE' END,
      CASE WHEN price_c > ask_c THEN 'ABOVE_ASK' WHEN price_c < bid_c THEN 'BELOW_BID' END) AS tags,
    concat_ws('|', CASE l_returnflag WHEN 'A' THEN 'ASK_SIDE' WHEN 'R' THEN 'BID_SIDE' ELSE 'NO_SIDE' END,
      CASE WHEN l_linestatus = 'F' THEN 'BULLISH' WHEN n % 2 = 0 THEN 'BEARISH' END,
      CASE WHEN n = 3 THEN 'SWEEP|SWEEP' END, CASE WHEN n % 3 = 0 THEN 'FLOOR|CROSS' END) AS raw_tags,
    o, n, shipped, exp_full
  FROM scored),
optv AS (SELECT * FROM opt WHERE vol_stock IS NOT NULL)
"""

# --- sessions -------------------------------------------------------------

# Published dates of lunisolar festivals in the years the tests touch.
LUNAR_DATES = {
    "spring": "1994-02-10 1995-01-31 1996-02-19 1997-02-07 1998-01-28 1999-02-16 2000-02-05 "
              "2001-01-24 2002-02-12 2003-02-01 2017-01-28 2018-02-16 2019-02-05 2020-01-25 "
              "2021-02-12 2022-02-01 2023-01-22 2024-02-10 2025-01-29 2026-02-17",
    "dragon_boat": "1994-06-13 1995-06-02 1996-06-20 1997-06-09 1998-05-30 1999-06-18 2000-06-06 "
                   "2001-06-25 2002-06-15 2003-06-04 2017-05-30 2018-06-18 2019-06-07 2020-06-25 "
                   "2021-06-14 2022-06-03 2023-06-22 2024-06-10 2025-05-31 2026-06-19",
    "mid_autumn": "1994-09-20 1995-09-09 1996-09-27 1997-09-16 1998-10-05 1999-09-24 2000-09-12 "
                  "2001-10-01 2002-09-21 2003-09-11 2017-10-04 2018-09-24 2019-09-13 2020-10-01 "
                  "2021-09-21 2022-09-10 2023-09-29 2024-09-17 2025-10-06 2026-09-25",
    "buddha": "1994-05-18 1995-05-07 1996-05-24 1997-05-14 1998-05-03 1999-05-22 2000-05-11 "
              "2001-04-30 2002-05-19 2003-05-08 2017-05-03 2018-05-22 2019-05-12 2020-04-30 "
              "2021-05-19 2022-05-08 2023-05-26 2024-05-15 2025-05-05 2026-05-24",
    "double_ninth": "1994-10-13 1995-11-01 1996-10-20 1997-10-10 1998-10-28 1999-10-17 2000-10-06 "
                    "2001-10-25 2002-10-14 2003-10-04 2017-10-28 2018-10-17 2019-10-07 2020-10-25 "
                    "2021-10-14 2022-10-04 2023-10-23 2024-10-11 2025-10-29 2026-10-18",
    "qingming": "1994-04-05 1995-04-05 1996-04-04 1997-04-05 1998-04-05 1999-04-05 2000-04-04 "
                "2001-04-05 2002-04-05 2003-04-05 2017-04-04 2018-04-05 2019-04-05 2020-04-04 "
                "2021-04-04 2022-04-05 2023-04-05 2024-04-04 2025-04-04 2026-04-05",
    "spring_equinox": "1994-03-21 1995-03-21 1996-03-20 1997-03-20 1998-03-21 1999-03-21 "
                      "2000-03-20 2001-03-20 2002-03-21 2003-03-21 2017-03-20 2018-03-21 "
                      "2019-03-21 2020-03-20 2021-03-20 2022-03-21 2023-03-21 2024-03-20 "
                      "2025-03-20 2026-03-20",
    "autumn_equinox": "1994-09-23 1995-09-23 1996-09-23 1997-09-23 1998-09-23 1999-09-23 "
                      "2000-09-23 2001-09-23 2002-09-23 2003-09-23 2006-09-23 2007-09-23 "
                      "2008-09-23 2009-09-23 2010-09-23 2011-09-23 2012-09-22 2013-09-23 2017-09-23 2018-09-23 "
                      "2019-09-23 2020-09-22 2021-09-23 2022-09-23 2023-09-23 2024-09-22 "
                      "2025-09-23 2026-09-23",
}


def movable_block(first: int, last: int) -> str:
    rows = [(name, int(d[:4]), date.fromisoformat(d)) for name, text in LUNAR_DATES.items()
            for d in text.split()]
    return values("listed", "festival, year, day", rows) + f""",
years AS (SELECT CAST(unnest(range({first - 1}, {last + 2})) AS INTEGER) AS year),
moon AS (
  SELECT year, (19 * (year % 19) + year // 100 - year // 400
    - (year // 100 - (year // 100 + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM years),
dominical AS (
  SELECT year, h, (32 + 2 * ((year // 100) % 4) + 2 * ((year % 100) // 4) - h - year % 4) % 7 AS l
  FROM moon),
golden AS (SELECT year, h, l, (year % 19 + 11 * h + 22 * l) // 451 AS m FROM dominical),
movable AS (
  SELECT festival, year, day FROM listed
  UNION ALL
  SELECT 'easter', year, make_date(year, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1)
  FROM golden)"""


EXPANDED = """placed AS (
  SELECT r.*, y.year,
    (CASE anchor
      WHEN 'fixed' THEN make_date(y.year, r.month, r.day)
      WHEN 'weekday' THEN CASE WHEN nth > 0
        THEN make_date(y.year, r.month, r.day)
          + CAST((weekday - (isodow(make_date(y.year, r.month, r.day)) - 1) + 7) % 7 + (nth - 1) * 7 AS INTEGER)
        ELSE make_date(y.year, r.month, r.day)
          - CAST(((isodow(make_date(y.year, r.month, r.day)) - 1) - weekday + 7) % 7 - (nth + 1) * 7 AS INTEGER) END
      ELSE m.day END) + CAST(shift AS INTEGER) AS raw_day
  FROM rules r CROSS JOIN years y
  LEFT JOIN movable m ON m.festival = r.festival AND m.year = y.year
  WHERE (len(years) = 0 OR list_contains(years, y.year))
    AND NOT list_contains(not_years, y.year) AND y.year % every = 0),
observed AS (
  SELECT *, CAST(raw_day + CAST(moves[isodow(raw_day)] AS INTEGER) AS DATE) AS day_off FROM placed
  WHERE raw_day IS NOT NULL AND CASE condition
    WHEN 'unless_first_friday' THEN day(raw_day) > 7
    WHEN 'only_first_friday' THEN day(raw_day) <= 7
    WHEN 'unless_christmas_or_new_year_on_friday' THEN
      isodow(make_date(year, 12, 25)) NOT IN (5, 6) AND isodow(make_date(year, 1, 1)) <> 5
    WHEN 'if_day_after_third_monday' THEN
      isodow(raw_day) = 2 AND day(raw_day) BETWEEN 16 AND 22
    ELSE TRUE END),
days_off AS (
  SELECT * FROM observed
  WHERE day_off BETWEEN since AND until AND list_contains(weekdays, isodow(day_off) - 1))"""

RULE_COLUMNS = ("calendar, event, minutes, name, anchor, month, day, weekday, nth, festival, shift, "
                "moves, condition, weekdays, since, until, years, not_years, every")


# Stands in for a calendar without rules; it has no day in any year.
NO_RULE = registry.rule_row("", "holiday", None, Rule("none", "festival", festival="none"))


def rules_block(rows: list[tuple]) -> str:
    return values("rules", RULE_COLUMNS, rows or [NO_RULE])


def holiday_blocks(rows: list[tuple], first: int, last: int) -> list[str]:
    return [rules_block(rows), movable_block(first, last), EXPANDED]


def session_blocks(names: list[str], start: str, end: str) -> list[str]:
    """CTEs ending in ``sess``: session dates with events as epoch microseconds."""
    chosen = registry.resolve(names)
    rows = registry.holiday_rule_rows(chosen) + registry.special_rule_rows(chosen)
    listed = [(c, "holiday", None, d) for c, d in registry.closed_rows(chosen)]
    listed += [(c, e, m, d) for c, e, m, d in registry.special_date_rows(chosen)]
    window = (date.fromisoformat(start), date.fromisoformat(end))
    listed = [row for row in listed if window[0] <= row[3] <= window[1]]
    listed = listed or [("", "", 0, date(1800, 1, 1))]
    wall = lambda m: (f"epoch_us(timezone(zone, CAST(d AS TIMESTAMP) + to_minutes({m})))")
    return [
        *holiday_blocks(rows, window[0].year, window[1].year),
        values("listed_days", "calendar, event, minutes, day", listed),
        values("cal", "calendar, zone, week, saturday_until, saturday_close, listed_after",
               registry.calendar_rows(chosen)),
        values("mt", "calendar, event, minutes, valid_from, valid_to, opens, custom",
               registry.time_rows(chosen)),
        f"""off AS (
  SELECT calendar, day_off AS d FROM days_off WHERE event = 'holiday'
  UNION SELECT calendar, day FROM listed_days WHERE event = 'holiday')""",
        f"""open_days AS (
  SELECT c.*, CAST(g.d AS DATE) AS d FROM cal c
  CROSS JOIN (SELECT unnest(generate_series(DATE '{start}', DATE '{end}', INTERVAL 1 DAY)) AS d) g
  WHERE list_contains(week, isodow(g.d) - 1)
    AND (isodow(g.d) <> 6 OR saturday_until IS NULL OR g.d < saturday_until)
    AND CAST(g.d AS DATE) > listed_after
    AND NOT EXISTS (SELECT 1 FROM off WHERE off.calendar = c.calendar AND off.d = CAST(g.d AS DATE)))""",
        """regular AS (
  SELECT o.calendar, o.d, any_value(o.zone) AS zone,
    max(m.minutes) FILTER (m.event = 'pre') AS pre,
    max(m.minutes) FILTER (m.event = 'market_open') AS market_open,
    max(m.minutes) FILTER (m.event = 'break_start') AS break_start,
    max(m.minutes) FILTER (m.event = 'break_end') AS break_end,
    max(CASE WHEN isodow(o.d) = 6 AND saturday_close IS NOT NULL THEN saturday_close
        ELSE m.minutes END) FILTER (m.event = 'market_close') AS market_close,
    max(m.minutes) FILTER (m.event = 'post') AS post
  FROM open_days o JOIN mt m ON m.calendar = o.calendar AND o.d >= m.valid_from AND o.d < m.valid_to
  GROUP BY o.calendar, o.d)""",
        """special AS (
  SELECT calendar, d, min(minutes) FILTER (event = 'market_open') AS so,
    min(minutes) FILTER (event = 'market_close') AS sc
  FROM (SELECT calendar, day_off AS d, event, minutes FROM days_off WHERE event <> 'holiday'
        UNION ALL SELECT calendar, day, event, minutes FROM listed_days WHERE event <> 'holiday')
  GROUP BY calendar, d)""",
        """clamped AS (
  SELECT r.calendar, r.zone, r.d, so, sc, market_open AS ro, market_close AS rc,
    CASE WHEN pre IS NOT NULL THEN least(greatest(pre, so), sc) END AS pre,
    least(greatest(coalesce(so, market_open), so), sc) AS market_open,
    CASE WHEN break_start IS NOT NULL THEN least(greatest(break_start, so), sc) END AS break_start,
    CASE WHEN break_end IS NOT NULL THEN least(greatest(break_end, so), sc) END AS break_end,
    least(greatest(coalesce(sc, market_close), so), sc) AS market_close,
    CASE WHEN post IS NOT NULL THEN least(greatest(post, so), sc) END AS post
  FROM regular r LEFT JOIN special s ON s.calendar = r.calendar AND s.d = r.d)""",
        "sess AS (SELECT calendar, d AS session_date, "
        + ", ".join(f"{wall(e)} AS {e}" for e in
                    ("pre", "market_open", "break_start", "break_end", "market_close", "post"))
        + f", {wall('ro')} AS regular_open, {wall('rc')} AS regular_close FROM clamped)",
    ]


def sessions(names: list[str], start: str, end: str) -> str:
    return with_(*session_blocks(names, start, end))
