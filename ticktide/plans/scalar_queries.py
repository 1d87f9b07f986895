"""Scalar functions over whole tables: decimals, timestamps, option prices."""

from __future__ import annotations

from pyspark.sql import Window, functions as F, types as T

from ticktide.functions import decimals, pricing, times
from ticktide.operators import tables
from ticktide.plans import oracle as o
from ticktide.plans import views
from ticktide.plans.registry import query

# Signed test amounts with six decimals, exact in both engines.
MICROS = """WITH amt AS (
  SELECT event_id, (CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END)
    * (CAST(round(value * 100) AS BIGINT) * 10000 + event_id % 10000) AS micros FROM events),
m AS (SELECT event_id, micros, CAST(micros * 0.000001 AS DECIMAL(18,6)) AS x FROM amt)
"""


def amounts(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    micros = F.when(F.col("event_id") % 2 == 0, 1).otherwise(-1) * (
        F.round(F.col("value") * 100).cast("bigint") * 10000 + F.col("event_id") % 10000)
    return events.select("event_id", micros.alias("micros"),
                         decimals.from_fixed(micros, 6).cast("decimal(18,6)").alias("x"))


@query("d01_coerce_down", MICROS + """
SELECT event_id, CASE WHEN abs(trunc(x * 100)) < 10000 THEN
    CAST((CASE WHEN micros < 0 THEN -1 ELSE 1 END) * (abs(micros) // 10000) * 0.01 AS DECIMAL(4,2))::VARCHAR
  END AS y FROM m""")
def coerce_down(spark, sf_dir):
    return amounts(spark, sf_dir).select("event_id", decimals.coerce_down(F.col("x"), 4, 2).alias("y"))


def _half_even(scale: int) -> str:
    unit = 10 ** (6 - scale)
    return f"""(CASE WHEN micros < 0 THEN -1 ELSE 1 END) * (abs(micros) // {unit} + CASE
      WHEN abs(micros) % {unit} > {unit // 2} THEN 1
      WHEN abs(micros) % {unit} = {unit // 2} AND (abs(micros) // {unit}) % 2 = 1 THEN 1 ELSE 0 END)"""


@query("d02_coerce_half_even", MICROS + f"""
SELECT event_id, CASE WHEN abs(k) < 10000000 THEN CAST(k * 0.0001 AS DECIMAL(7,4))::VARCHAR END AS y
FROM (SELECT event_id, {_half_even(4)} AS k FROM m)""")
def coerce_half_even(spark, sf_dir):
    return amounts(spark, sf_dir).select(
        "event_id", decimals.coerce_half_even(F.col("x"), 3, 4).alias("y"))


@query("d03_quantise", MICROS + f"""
SELECT event_id, CASE WHEN abs(k) < 100000 THEN CAST(k * 0.001 AS DECIMAL(5,3))::VARCHAR END AS y
FROM (SELECT event_id, {_half_even(3)} AS k FROM m)""")
def quantise(spark, sf_dir):
    return amounts(spark, sf_dir).select("event_id", decimals.quantise(F.col("x"), 5, 3).alias("y"))


@query("d04_fixed_point", MICROS + """
SELECT event_id, micros AS fixed, x::VARCHAR AS back FROM m""")
def fixed_point(spark, sf_dir):
    fixed = decimals.to_fixed(F.col("x"), 6)
    return amounts(spark, sf_dir).select(
        "event_id", fixed.alias("fixed"), decimals.from_fixed(fixed, 6).cast("decimal(18,6)").alias("back"))


@query("d05_signed_bytes", MICROS + """
, b AS (SELECT event_id, x, micros, length(bin(abs(micros))) AS bits FROM m)
SELECT event_id, (bits + 8) // 8 AS width,
  right(printf('%016X', micros), CAST(2 * ((bits + 8) // 8) AS INTEGER)) AS raw, x::VARCHAR AS back FROM b""")
def signed_bytes(spark, sf_dir):
    raw = decimals.to_signed_bytes(F.col("x"), 6)
    return amounts(spark, sf_dir).withColumn("raw", raw).select(
        "event_id", F.octet_length("raw").cast("bigint").alias("width"), "raw",
        decimals.from_signed_bytes(F.col("raw"), 6).cast("decimal(18,6)").alias("back"))


@query("d05_wide_bytes", MICROS + "SELECT event_id, x::VARCHAR AS back FROM m")
def wide_bytes(spark, sf_dir):
    """Nine bytes and more: sign-extended bytes decoded in Arrow batches."""
    raw = decimals.to_signed_bytes(F.col("x"), 6)
    fill = F.when(F.col("x") < 0, "FF" * 12).otherwise("00" * 12)
    wide = F.unhex(F.concat(fill, F.hex(raw)))
    return amounts(spark, sf_dir).select(
        "event_id", decimals.from_wide_signed_bytes(6)(wide).cast("decimal(18,6)").alias("back"))


@query("d06_text_bytes", MICROS + f"""
SELECT event_id, CAST(k * 0.000001 AS DECIMAL(18,6))::VARCHAR AS text,
  CAST(k * 0.000001 AS DECIMAL(38,6))::VARCHAR AS back
FROM (SELECT event_id, (CASE WHEN micros < 0 THEN -1 ELSE 1 END) * (abs(micros) // 100 + CASE
      WHEN abs(micros) % 100 > 50 THEN 1
      WHEN abs(micros) % 100 = 50 AND (abs(micros) // 100) % 2 = 1 THEN 1 ELSE 0 END) AS k FROM m)""")
def text_bytes(spark, sf_dir):
    raw = decimals.to_text_bytes(F.col("x"), 2)
    return amounts(spark, sf_dir).select(
        "event_id", F.decode(raw, "UTF-8").alias("text"), decimals.from_text_bytes(raw).alias("back"))


@query("d07_half_up_cents", MICROS + """
SELECT event_id, CAST((CASE WHEN micros < 0 THEN -1 ELSE 1 END) * ((abs(micros) + 5000) // 10000) * 0.01
  AS DECIMAL(15,2))::VARCHAR AS cents FROM m""")
def half_up_cents(spark, sf_dir):
    return amounts(spark, sf_dir).select(
        "event_id", decimals.half_up_cents(F.col("x")).cast("decimal(15,2)").alias("cents"))


@query("d08_currency_text", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '$' WHEN 1 THEN '€' WHEN 2 THEN '£' ELSE 'CHF' END
  || format('{:,.2f}', o_totalprice) AS shown FROM orders""")
def currency_text(spark, sf_dir):
    iso = F.element_at(F.array(*[F.lit(c) for c in ("USD", "EUR", "GBP", "CHF")]),
                       (F.col("o_orderkey") % 4 + 1).cast("int"))
    return views.table(spark, sf_dir, "orders").select("o_orderkey", decimals.currency_text(
        F.col("o_totalprice").cast("decimal(18,2)"), iso).alias("shown"))


@query("d09_unscaled", MICROS + """
SELECT event_id, ((CASE WHEN micros < 0 THEN -1 ELSE 1 END) * ((abs(micros) + 50) // 100))::VARCHAR AS unscaled
FROM m""")
def unscaled(spark, sf_dir):
    return amounts(spark, sf_dir).select("event_id", decimals.unscaled(F.col("x"), 4).alias("unscaled"))


# --- option prices --------------------------------------------------------



def _nested(coefficients: tuple[float, ...], x: str) -> str:
    text = repr(coefficients[0])
    for c in coefficients[1:]:
        text = f"({text} * {x} + {c!r})"
    return text


def _cdf(x: str) -> str:
    a = f"abs({x})"
    upper = (f"(exp(-{a} * {a} / 2) * {_nested(pricing._HART_TOP, a)} / {_nested(pricing._HART_BOTTOM, a)})")
    far = f"(exp(-{a} * {a} / 2) / ({a} + 1 / ({a} + 2 / ({a} + 3 / ({a} + 4 / ({a} + 0.65)))))"
    far += " / 2.506628274631)"
    tail = f"(CASE WHEN {a} > 37 THEN 0 WHEN {a} < 7.07106781186547 THEN {upper} ELSE {far} END)"
    return f"(CASE WHEN {x} > 0 THEN 1 - {tail} ELSE {tail} END)"


# One contract per line item: spot and strike near each other, 30 days and more.
CONTRACTS = """, c AS (
  SELECT id, symbol, spot::DOUBLE AS s, strike::DOUBLE AS k, n * 30 / 365.25 AS t,
    0.15 + (o % 40) / 100.0 AS v, put_call = 'C' AS call, exp_full, shipped FROM opt),
d AS (SELECT *, (ln(s / k) + v * v / 2 * t) / (v * sqrt(t)) AS d1 FROM c),
e AS (SELECT *, d1 - v * sqrt(t) AS d2, CASE WHEN call THEN 1.0 ELSE -1.0 END AS cp FROM d),
p AS (SELECT *, exp(-0.05 * t) * cp * (s * """ + _cdf("(cp * d1)") + " - k * " + _cdf("(cp * d2)") + """) AS price,
  exp(-0.05 * t) * exp(-d1 * d1 / 2) / sqrt(2 * pi()) AS density FROM e)
"""


def contracts(spark, sf_dir):
    items = views.option_view(spark, sf_dir)
    order = F.split_part("id", F.lit("-"), F.lit(1)).cast("bigint")
    line = F.split_part("id", F.lit("-"), F.lit(2)).cast("bigint")
    return items.select(
        "id", "option_symbol", F.col("underlying_price").cast("double").alias("s"),
        F.col("strike").cast("double").alias("k"), (line * 30 / F.lit(365.25)).alias("t"),
        (F.lit(0.15) + (order % 40) / F.lit(100.0)).alias("v"),
        (F.col("option_type") == "call").alias("call"),
        F.date_add(times.expiry_from_millis(F.col("executed_at").cast("bigint")),
                   (line * 30).cast("int")).alias("expiry"),
        times.expiry_from_millis(F.col("executed_at").cast("bigint")).alias("traded"))


def _model():
    return [F.col(c) for c in ("s", "k", "t", "v", "call")]


def _with_d(spark, sf_dir):
    return pricing.with_d1_d2(contracts(spark, sf_dir), *_model()[:4])


def _d():
    return F.col("d1"), F.col("d2")


@query("d10_black_76", o.OPTION + CONTRACTS + "SELECT id, round(price, 6) AS price FROM p")
def black_76(spark, sf_dir):
    return _with_d(spark, sf_dir).select(
        "id", F.round(pricing.black_76(*_model(), d=_d()), 6).alias("price"))


@query("d11_greeks", o.OPTION + CONTRACTS + """
SELECT id, round(CASE WHEN call THEN exp(-0.05 * t) * """ + _cdf("d1") + " ELSE -exp(-0.05 * t) * "
       + _cdf("(-d1)") + """ END, 6) AS delta,
  round(density / (s * v * sqrt(t)), 6) AS gamma, round(s * density * sqrt(t), 6) AS vega,
  round(0.05 * price - s * density * v / (2 * sqrt(t)), 6) AS theta, round(-t * price, 6) AS rho FROM p""")
def greeks(spark, sf_dir):
    columns = pricing.greeks(*_model(), d=_d())
    return _with_d(spark, sf_dir).select(
        "id", *[F.round(c, 6).alias(n) for n, c in columns.items()])


@query("d11_implied_volatility", o.OPTION + CONTRACTS + """
SELECT id, round(v, 4) AS sigma FROM c""")
def implied_volatility(spark, sf_dir):
    """The volatility that a model price implies is the one it was made with."""
    priced = _with_d(spark, sf_dir).withColumn("price", pricing.black_76(*_model(), d=_d()))
    solved = pricing.with_implied_volatility(priced, *[F.col(c) for c in ("price", "s", "k", "t", "call")])
    return solved.select("id", F.round("sigma", 4).alias("sigma"))


@query("d11_volatility_surface", o.OPTION + CONTRACTS + """
SELECT exp_full::VARCHAR AS expiry, k AS strike, count(*) AS contracts, round(avg(v), 6) AS volatility
FROM c GROUP BY exp_full, k""")
def volatility_surface(spark, sf_dir):
    return (contracts(spark, sf_dir).groupBy("expiry", F.col("k").alias("strike"))
            .agg(F.count("*").alias("contracts"), F.round(F.avg("v"), 6).alias("volatility")))


@query("d11_volatility_skew", o.OPTION + CONTRACTS + """
SELECT exp_full::VARCHAR AS expiry, round(avg(v) FILTER (k < s) - avg(v) FILTER (k > s), 6) AS skew
FROM c GROUP BY exp_full""")
def volatility_skew(spark, sf_dir):
    below, above = F.col("k") < F.col("s"), F.col("k") > F.col("s")
    skew = F.avg(F.when(below, F.col("v"))) - F.avg(F.when(above, F.col("v")))
    return contracts(spark, sf_dir).groupBy("expiry").agg(F.round(skew, 6).alias("skew"))


@query("d11_daily_theoretical_pnl", o.OPTION + CONTRACTS + """
, day AS (SELECT symbol, shipped, avg(price) AS theo FROM p GROUP BY symbol, shipped)
SELECT symbol, shipped::VARCHAR AS traded,
  round(theo - lag(theo) OVER (PARTITION BY symbol ORDER BY shipped), 4) AS pnl FROM day""")
def daily_theoretical_pnl(spark, sf_dir):
    """Change of a contract's mean model price from one trading date to the next."""
    daily = (contracts(spark, sf_dir).groupBy(F.col("option_symbol").alias("symbol"), "traded")
             .agg(F.avg(pricing.black_76(*_model())).alias("theo")))
    before = F.lag("theo").over(Window.partitionBy("symbol").orderBy("traded"))
    return daily.select("symbol", "traded", F.round(F.col("theo") - before, 4).alias("pnl"))


# --- schema-driven coercion -----------------------------------------------

COERCED = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("amount", T.DecimalType(12, 2)),
    T.StructField("at", T.LongType(), True, {"logicalType": "timestamp-millis"}),
    T.StructField("label", T.StringType())])


@query("d12_coerce_record", MICROS + """
SELECT event_id::VARCHAR AS id, CAST((CASE WHEN micros < 0 THEN -1 ELSE 1 END) * (abs(micros) // 10000) * 0.01
  AS DECIMAL(12,2))::VARCHAR AS amount, epoch_us(ts) // 1000 AS at, event_type AS label FROM m JOIN events USING (event_id)""")
def coerce_record(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    record = amounts(spark, sf_dir).join(events, "event_id").select(
        F.col("event_id").cast("string").alias("id"), F.col("x").alias("amount"),
        F.col("ts").cast("timestamp").alias("at"),
        F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")).alias("label"))
    return tables.coerce_record(record, COERCED)


@query("f08_type_hooks", MICROS + """
SELECT 'id-' || event_id AS id, CAST(abs(micros) // 10000 * 0.01 AS DECIMAL(12,2))::VARCHAR AS amount,
  epoch_us(ts) // 3600000000 * 3600000 AS at, upper(event_type) AS label FROM m JOIN events USING (event_id)""")
def type_hooks(spark, sf_dir):
    """A function per field before the rule of its type: sign, hour, prefix, letter case."""
    events = views.table(spark, sf_dir, "events")
    record = amounts(spark, sf_dir).join(events, "event_id").select(
        F.col("event_id").cast("string").alias("id"), F.col("x").alias("amount"),
        F.col("ts").cast("timestamp").alias("at"),
        F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")).alias("label"))
    return tables.coerce_record(record, COERCED, {
        "id": lambda c: F.concat(F.lit("id-"), c), "amount": F.abs,
        "at": lambda c: F.date_trunc("hour", c), "label": F.upper})


# --- timestamps -----------------------------------------------------------

NAMES = ["days", "seconds", "milliseconds", "microseconds", "nanoseconds"]
SCALED = o.with_(o.RAW) + """, v AS (
  SELECT event_id, ts_event, ts_event // 1000000 AS ms,
    CASE event_id % 5 WHEN 0 THEN 'days' WHEN 1 THEN 'seconds' WHEN 2 THEN 'milliseconds'
      WHEN 3 THEN 'microseconds' ELSE 'nanoseconds' END AS resolution,
    CASE event_id % 5 WHEN 0 THEN ts_event // 86400000000000 WHEN 1 THEN ts_event // 1000000000
      WHEN 2 THEN ts_event // 1000000 WHEN 3 THEN ts_event // 1000 ELSE ts_event END AS value FROM raw)
"""
_SCALED_MS = """CASE event_id % 5 WHEN 0 THEN value * 86400000 WHEN 1 THEN value * 1000 WHEN 2 THEN value
  WHEN 3 THEN value // 1000 ELSE value // 1000000 END"""


def scaled(spark, sf_dir):
    raw = views.tbbo_raw(views.table(spark, sf_dir, "events"))
    k = (F.col("sequence") % 5).cast("int")
    units = [86_400_000_000_000, 1_000_000_000, 1_000_000, 1000, 1]
    value = F.col("ts_event")
    for i, unit in enumerate(units):
        value = F.when(k == i, times.floor_div(F.col("ts_event"), unit)).otherwise(value)
    return raw.select(
        F.col("sequence").cast("bigint").alias("event_id"),
        times.floor_div(F.col("ts_event"), 1_000_000).alias("ms"),
        F.element_at(F.array(*[F.lit(n) for n in NAMES]), k + 1).alias("resolution"),
        value.alias("value"))


@query("e01_named_resolution", SCALED + f"SELECT event_id, {_SCALED_MS} AS ms FROM v")
def named_resolution(spark, sf_dir):
    return scaled(spark, sf_dir).select(
        "event_id", times.to_millis(F.col("value"), F.col("resolution")).alias("ms"))


@query("e02_to_resolution", SCALED + """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN ms // 86400000 WHEN 1 THEN ms // 1000 WHEN 2 THEN ms
  WHEN 3 THEN ms * 1000 ELSE ms * 1000000 END AS value FROM v""")
def to_resolution(spark, sf_dir):
    return scaled(spark, sf_dir).select(
        "event_id", times.from_millis(F.col("ms"), F.col("resolution")).alias("value"))


@query("e03_detected_resolution", SCALED + f"SELECT event_id, resolution, {_SCALED_MS} AS ms FROM v")
def detected_resolution(spark, sf_dir):
    return scaled(spark, sf_dir).select(
        "event_id", times.detect_resolution(F.col("value")).alias("resolution"),
        times.any_to_millis(F.col("value")).alias("ms"))


@query("e04_text_and_date", """
SELECT event_id, epoch_us(ts) // 1000 AS from_text, epoch_ms(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS from_date
FROM events""")
def text_and_date(spark, sf_dir):
    text = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return views.table(spark, sf_dir, "events").select(
        "event_id", times.text_to_millis(text).alias("from_text"),
        times.date_to_millis(F.col("ts").cast("date")).alias("from_date"))


@query("e05_scaled_seconds", """
SELECT event_id, epoch_us(ts) // 1000000 AS s, (epoch_us(ts) // 1000000) * 1000 AS ms,
  (epoch_us(ts) // 1000000) * 1000000 AS us FROM events""")
def scaled_seconds(spark, sf_dir):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return views.table(spark, sf_dir, "events").select(
        "event_id", times.scale_seconds(seconds, "seconds").alias("s"),
        times.scale_seconds(seconds, "milliseconds").alias("ms"),
        times.scale_seconds(seconds, "microseconds").alias("us"))


@query("e06_units_since_epoch", """
SELECT event_id, epoch_us(ts) // 1000000 AS s, epoch_us(ts) // 1000 AS ms, epoch_us(ts) AS us FROM events""")
def units_since_epoch(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    return views.table(spark, sf_dir, "events").select(
        "event_id", times.since_epoch(ts, "seconds").alias("s"),
        times.since_epoch(ts, "milliseconds").alias("ms"),
        times.since_epoch(ts, "microseconds").alias("us"))


@query("e07_friendly_delta", """
WITH d AS (SELECT event_id, CAST((epoch_ms(TIMESTAMP '2024-01-30 23:58:00') - epoch_us(ts) // 1000)
    // (CASE WHEN event_id % 2 = 0 THEN 1000 ELSE 50000 END) AS BIGINT) AS s FROM events)
SELECT event_id, CASE WHEN s < 180 THEN 'just now' WHEN s // 86400 = 1 THEN 'yesterday'
  WHEN s // 86400 > 1 THEN (s // 86400) || ' days ago' WHEN s // 3600 >= 12 THEN (s // 3600) || ' hours ago'
  WHEN s // 3600 > 0 THEN (s // 3600) || ' hours ' || ((s // 60) % 60) || ' minutes ago'
  ELSE (s // 60) || ' minutes ago' END AS words FROM d""")
def friendly_delta(spark, sf_dir):
    end = F.unix_millis(F.lit("2024-01-30 23:58:00").cast("timestamp"))
    gap = end - F.unix_millis(F.col("ts").cast("timestamp"))
    seconds = F.when(F.col("event_id") % 2 == 0, times.floor_div(gap, 1000)).otherwise(
        times.floor_div(gap, 50_000))
    return views.table(spark, sf_dir, "events").select(
        "event_id", times.friendly_delta(end - seconds * 1000, end).alias("words"))


@query("e08_expiry_forms", o.OPTION + """
SELECT id, shipped::VARCHAR AS traded, strftime(shipped, '%Y%m%d') AS text, epoch_ms(shipped::TIMESTAMP) AS back
FROM opt""")
def expiry_forms(spark, sf_dir):
    day = times.expiry_from_millis(F.col("executed_at").cast("bigint"))
    return views.option_view(spark, sf_dir).select(
        "id", day.alias("traded"), times.expiry_text(day).alias("text"),
        times.date_to_millis(day).alias("back"))


@query("e09_time_to_expiry", o.OPTION + CONTRACTS + """
SELECT id, CAST(exp_full - DATE '1998-06-30' AS INTEGER) AS days,
  round(CAST(exp_full - DATE '1998-06-30' AS INTEGER) / 365.25, 9) AS years FROM c""")
def time_to_expiry(spark, sf_dir):
    as_of = F.lit("1998-06-30").cast("date")
    return contracts(spark, sf_dir).select(
        "id", times.days_to_expiry(F.col("expiry"), as_of).alias("days"),
        F.round(times.years_to_expiry(F.col("expiry"), as_of), 9).alias("years"))


@query("e10_wall_time_to_utc", """
SELECT o_orderkey, epoch_us(timezone('America/New_York', o_orderdate + INTERVAL 570 MINUTE)) AS ny,
  epoch_us(timezone('Europe/London', o_orderdate + INTERVAL 480 MINUTE)) AS london,
  epoch_us(timezone('America/Chicago', o_orderdate - INTERVAL 420 MINUTE)) AS chicago FROM orders""")
def wall_time_to_utc(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    wall = times.market_wall_to_utc
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", wall(day, F.lit(570), "America/New_York").alias("ny"),
        wall(day, F.lit(480), "Europe/London").alias("london"),
        wall(day, F.lit(-420), "America/Chicago").alias("chicago"))


@query("e11_clean_dates", """
SELECT event_id, CAST(ts AS DATE)::VARCHAR AS day, epoch_us(date_trunc('hour', ts)) AS hour FROM events""")
def clean_dates(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    return views.table(spark, sf_dir, "events").select(
        "event_id", times.utc_date(ts).alias("day"), F.date_trunc("hour", ts).alias("hour"))
