"""Volume bars, counters, keyed tables, schema evolution."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ticktide import schemas
from ticktide.functions import messages, times
from ticktide.operators import bars, lookups, tables
from ticktide.plans import oracle as o
from ticktide.plans import views
from ticktide.plans.registry import query
from ticktide.sources import framed
from ticktide.sources.external import latest_schemas

HALF_HOUR, DAY = 1_800_000, 86_400_000
HOUR_US = 3_600_000_000

_OHLC = """CAST(arg_min(price, ord) AS {d})::VARCHAR AS open, max(price)::VARCHAR AS high,
  min(price)::VARCHAR AS low, CAST(arg_max(price, ord) AS {d})::VARCHAR AS price,
  CAST(sum(qty) AS BIGINT) AS volume, count(*) AS trades"""
_EQ_OHLC = _OHLC.format(d="DECIMAL(16,4)")
_OPT_OHLC = _OHLC.format(d="DECIMAL(12,2)")


def clock_sql(base: str, source: str, width: int, symbol: str, ohlc: str, order: str,
              extra: str = "") -> str:
    return base + f"""
SELECT {symbol} AS symbol, "timestamp" - "timestamp" % {width} AS "timestamp", {ohlc}{extra}
FROM (SELECT *, {order} AS ord FROM {source})
GROUP BY {symbol}, "timestamp" - "timestamp" % {width}"""


_EQ_ORDER = '"timestamp"::HUGEINT * 4294967296 + sequence'


def _option_bars(spark, sf_dir):
    trades = (views.option_trades(spark, sf_dir).drop("symbol")
              .withColumn("cents", (F.col("price") * 100).cast("bigint")))
    return bars.clock_bars(trades, DAY, symbol="underlying",
                           order=bars.arrival_order("timestamp", "cents"), open_interest="oi",
                           interest_order=bars.arrival_order("timestamp", "oi"))


@query("a01_option_volume_bars", clock_sql(
    o.OPTION, "optv", DAY, "underlying", _OPT_OHLC,
    '"timestamp"::HUGEINT * 4294967296 + CAST(price * 100 AS BIGINT)',
    ", CAST(arg_max(oi, \"timestamp\"::HUGEINT * 4294967296 + oi) AS INTEGER) AS oi"))
def option_volume_bars(spark, sf_dir):
    """Trades carry no sequence, so equal times are ordered by value."""
    return _option_bars(spark, sf_dir)


@query("a01_declared_layout", o.OPTION + """
SELECT underlying AS symbol, "timestamp" - "timestamp" % 86400000 AS "timestamp",
  CAST(arg_max(oi, "timestamp"::HUGEINT * 4294967296 + oi) AS INTEGER) AS oi,
  CAST(arg_max(price, "timestamp"::HUGEINT * 4294967296 + CAST(price * 100 AS BIGINT)) AS DECIMAL(12,2))::VARCHAR
    AS price
FROM optv GROUP BY underlying, "timestamp" - "timestamp" % 86400000""")
def declared_layout(spark, sf_dir):
    return bars.declared_bars(_option_bars(spark, sf_dir))


@query("a02_stock_volume_bars", clock_sql(o.EQUITY, "eqv", HALF_HOUR, "symbol", _EQ_OHLC, _EQ_ORDER))
def stock_volume_bars(spark, sf_dir):
    return bars.clock_bars(views.equity_trades(spark, sf_dir), HALF_HOUR)


@query("a03_futures_volume_bars", clock_sql("""WITH f AS (
  SELECT 'F' || (o_custkey % 40) AS symbol, epoch_ms(o_orderdate) + (o_orderkey % 86400) * 1000 AS "timestamp",
    CAST(o_orderkey AS BIGINT) AS sequence, CAST(round(o_totalprice * 100) * 0.01 AS DECIMAL(16,4)) AS price,
    CAST(o_orderkey % 50 + 1 AS INTEGER) AS qty FROM orders)
""", "f", 7 * DAY, "symbol", _EQ_OHLC, _EQ_ORDER))
def futures_volume_bars(spark, sf_dir):
    trades = views.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("F"), (F.col("o_custkey") % 40).cast("string")).alias("symbol"),
        (F.unix_millis(F.col("o_orderdate").cast("timestamp"))
         + (F.col("o_orderkey") % 86400) * 1000).alias("timestamp"),
        F.col("o_orderkey").cast("bigint").alias("sequence"),
        F.col("o_totalprice").cast("decimal(16,4)").alias("price"),
        (F.col("o_orderkey") % 50 + 1).cast("int").alias("qty"))
    return bars.clock_bars(trades, 7 * DAY)


@query("a04_crypto_volume_bars", clock_sql(o.with_(o.RAW) + """, f AS (
  SELECT 'C' || (instrument_id % 12) AS symbol, ts_event // 1000000 AS "timestamp",
    CAST(event_id AS BIGINT) AS sequence, CAST(cents * 0.01 AS DECIMAL(16,4)) AS price, lot AS qty FROM raw)
""", "f", 300_000, "symbol", _EQ_OHLC, _EQ_ORDER))
def crypto_volume_bars(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    trades = views.tbbo_raw(events).select(
        F.concat(F.lit("C"), (F.col("instrument_id") % 12).cast("string")).alias("symbol"),
        times.floor_div(F.col("ts_event"), 1_000_000).alias("timestamp"), "sequence",
        (F.col("price").cast("decimal(20,0)") * F.lit("0.000000001").cast("decimal(10,9)"))
        .cast("decimal(16,4)").alias("price"),
        (F.col("levels")[0]["bid_sz"] - 1).alias("qty"))
    return bars.clock_bars(trades, 300_000)


def _session_sql(closed: str) -> str:
    label = ("open_ms + k * 1800000" if closed == "left"
             else "least(open_ms + (k + 1) * 1800000, close_ms)")
    blocks = ",\n".join(o.session_blocks(["NYSE"], *views.EVENT_DAYS))
    return o.EQUITY.rstrip() + ",\n" + blocks + f""",
in_bars AS (
  SELECT e.*, session_date, market_open // 1000 AS open_ms, market_close // 1000 AS close_ms,
    ("timestamp" - market_open // 1000) // 1800000 AS k, {_EQ_ORDER} AS ord
  FROM eqv e JOIN sess s ON "timestamp" * 1000 >= market_open AND "timestamp" * 1000 < market_close)
SELECT symbol, session_date::VARCHAR AS session_date, {label} AS "timestamp", {_EQ_OHLC}
FROM in_bars GROUP BY symbol, session_date, {label}"""


@query("a05_session_bars", _session_sql("right"))
def session_bars(spark, sf_dir):
    table = views.event_calendar(spark)
    return bars.session_bars(views.equity_trades(spark, sf_dir), table, "NYSE", HALF_HOUR)


@query("a05_session_bars_left", _session_sql("left"))
def session_bars_left(spark, sf_dir):
    table = views.event_calendar(spark)
    return bars.session_bars(views.equity_trades(spark, sf_dir), table, "NYSE", HALF_HOUR, "left")


@query("a06_throughput", """
WITH c AS (SELECT epoch_us(ts) - epoch_us(ts) % 15000000 AS interval_us, count(*) AS messages FROM events
  GROUP BY epoch_us(ts) - epoch_us(ts) % 15000000)
SELECT interval_us, messages, CAST(sum(messages) OVER (ORDER BY interval_us) AS BIGINT) AS all_time FROM c""")
def throughput(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return bars.throughput(events, "ts")


@query("w06_running_total_by_topic", """
WITH c AS (SELECT event_type, epoch_us(ts) - epoch_us(ts) % 3600000000 AS interval_us, count(*) AS messages
  FROM events GROUP BY event_type, epoch_us(ts) - epoch_us(ts) % 3600000000)
SELECT *, CAST(sum(messages) OVER (PARTITION BY event_type ORDER BY interval_us) AS BIGINT) AS all_time FROM c""")
def running_total_by_topic(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return bars.throughput(events, "ts", 3600, ["event_type"])


@query("a07_delivery_outcomes", """
SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
  CASE WHEN value > 200 THEN 'error' ELSE 'ok' END AS status, count(*) AS messages FROM events
GROUP BY event_type, user_id % 4, value > 200""")
def delivery_outcomes(spark, sf_dir):
    deliveries = views.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.when(F.col("value") > 200, "queue full").alias("error"))
    return bars.outcome_counts(deliveries)


@query("a11_volume_by_side", o.EQUITY + """
SELECT symbol, CAST(coalesce(sum(qty) FILTER (side = 'A'), 0) AS BIGINT) AS vol_ask,
  CAST(coalesce(sum(qty) FILTER (side = 'B'), 0) AS BIGINT) AS vol_bid,
  CAST(coalesce(sum(qty) FILTER (side = 'N'), 0) AS BIGINT) AS vol_no_side FROM eqv GROUP BY symbol""")
def volume_by_side(spark, sf_dir):
    return bars.volume_by_side(views.equity_trades(spark, sf_dir),
                               {"vol_ask": "A", "vol_bid": "B", "vol_no_side": "N"})


# --- keyed tables ---------------------------------------------------------

@query("s17_compaction", """
SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
  arg_max(value, event_id) AS value FROM events GROUP BY user_id""")
def compaction(spark, sf_dir):
    rows = views.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return tables.latest_per_key(rows, ["user_id"], "event_id")


@query("s19_latest_schema", """
SELECT event_type || '-value' AS subject, CAST(max(event_id) AS BIGINT) AS version,
  arg_max(props, event_id) AS schema FROM events GROUP BY event_type""")
def latest_schema(spark, sf_dir):
    versions = views.table(spark, sf_dir, "events").select(
        F.concat(F.col("event_type"), F.lit("-value")).alias("subject"),
        F.col("event_id").alias("version"), F.col("props").alias("schema"))
    return latest_schemas(versions)


REPLAY_FROM = "2024-01-25"


def replayed(events):
    """Records with a slice delivered a second time."""
    return events.unionByName(events.where(F.col("ts") >= F.lit(REPLAY_FROM).cast("timestamp_ntz")))


@query("x04_deduplicated_replay", o.with_(o.TBBO) + """
SELECT instrument_id, count(*) AS records, CAST(sum(cents) AS BIGINT) AS cents FROM tbbo
GROUP BY instrument_id""")
def deduplicated_replay(spark, sf_dir):
    raw = views.tbbo_raw(replayed(views.table(spark, sf_dir, "events")))
    once = tables.deduplicate(raw, ["instrument_id", "ts_event", "sequence"])
    return once.groupBy("instrument_id").agg(
        F.count("*").alias("records"),
        times.floor_div(F.sum("price"), 10_000_000).alias("cents"))


# --- as-of ----------------------------------------------------------------

@query("j11_asof_last_quote", """
WITH q AS (SELECT user_id, epoch_us(ts) AS quoted, value AS quote FROM events WHERE event_type = 'view'),
t AS (SELECT event_id, user_id, epoch_us(ts) AS traded FROM events WHERE event_type = 'purchase')
SELECT event_id, t.user_id, traded, quote, quoted AS matched_ts
FROM t ASOF LEFT JOIN q ON t.user_id = q.user_id AND t.traded >= q.quoted""")
def asof_last_quote(spark, sf_dir):
    """Each purchase with the last view of the same user before it."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    events = views.table(spark, sf_dir, "events")
    quotes = events.where(F.col("event_type") == "view").select(
        "user_id", micros.alias("quoted"), F.col("value").alias("quote"))
    trades = events.where(F.col("event_type") == "purchase").select(
        "event_id", "user_id", micros.alias("traded"))
    return lookups.asof_backward(trades, quotes, ["user_id"], "traded", "quoted", ["quote"],
                                 HOUR_US)


@query("x05_symbology_as_of", """
WITH m AS (SELECT user_id % 10 AS instrument_id, epoch_us(ts) AS valid_from, 'S' || event_id AS symbol
  FROM events WHERE event_type = 'signup'),
t AS (SELECT event_id, user_id % 10 AS instrument_id, epoch_us(ts) AS traded FROM events
  WHERE event_type <> 'signup')
SELECT event_id, symbol FROM t ASOF LEFT JOIN m
  ON t.instrument_id = m.instrument_id AND t.traded >= m.valid_from""")
def symbology_as_of(spark, sf_dir):
    """Symbol of an instrument at the time of the trade, from a log of changes."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    events = views.table(spark, sf_dir, "events")
    instrument = (F.col("user_id") % 10).alias("instrument_id")
    changes = events.where(F.col("event_type") == "signup").select(
        instrument, micros.alias("valid_from"),
        F.concat(F.lit("S"), F.col("event_id").cast("string")).alias("symbol"))
    trades = events.where(F.col("event_type") != "signup").select(
        "event_id", instrument, micros.alias("traded"))
    return lookups.asof_backward(trades, changes, ["instrument_id"], "traded", "valid_from",
                                 ["symbol"], HOUR_US).select("event_id", "symbol")


# --- schema evolution -----------------------------------------------------

READER = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("value", T.DoubleType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("currency", T.StringType(), False, {"default": "USD"}),
    T.StructField("note", T.StringType()),
])


@query("u05_schema_resolution", """
SELECT event_id, value, user_id::VARCHAR AS user_id, 'USD' AS currency, NULL::VARCHAR AS note FROM events""")
def schema_resolution(spark, sf_dir):
    return tables.resolve_schema(views.table(spark, sf_dir, "events"), READER)


# Three versions of one record: a field is added, one changes its type, one goes.
_ID, _VALUE = T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())
_USER, _TEXT_USER = T.StructField("user_id", T.LongType()), T.StructField("user_id", T.StringType())
WRITERS = {
    11: T.StructType([_ID, _VALUE]),
    12: T.StructType([_ID, _VALUE, _USER, T.StructField("currency", T.StringType())]),
    13: T.StructType([_ID, _TEXT_USER, T.StructField("note", T.StringType())]),
}


def framed_events(events):
    """Frames of three schema ids; some are cut, some have a strange head, id or payload."""
    eid = F.col("event_id")
    number = F.when(eid % 53 == 5, 99).otherwise(11 + eid % 3)
    record = (F.when(eid % 3 == 0, F.to_json(F.struct("event_id", "value")))
              .when(eid % 3 == 1, F.to_json(F.struct("event_id", "value", "user_id", F.lit("EUR").alias("currency"))))
              .otherwise(F.to_json(F.struct("event_id", F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"),
                                            F.col("event_type").alias("note")))))
    payload = F.when(eid % 59 == 7, F.substring(record, 1, 12)).otherwise(record)
    whole = messages.frame(number.cast("int"), F.encode(payload, "UTF-8"))
    return events.select("event_id", F.when(eid % 61 == 3, F.substring(whole, 1, 4)).when(
        eid % 67 == 4, F.concat(F.unhex(F.lit("01")), F.substring(whole, 2, 1 << 20))).otherwise(whole).alias("value"))


@query("g12_s19_u05_frames_of_three_schemas", """
WITH e AS (SELECT *, CASE WHEN event_id % 61 = 3 THEN 'frame too short' WHEN event_id % 67 = 4 THEN 'unexpected magic byte'
  WHEN event_id % 53 = 5 THEN 'unknown schema id' WHEN event_id % 59 = 7 THEN 'unreadable payload' END AS reason,
  event_id % 3 AS k FROM events)
SELECT event_id, reason, CASE WHEN reason IS NULL THEN event_id END AS read_id,
  CASE WHEN reason IS NULL AND k < 2 THEN value END AS value,
  CASE WHEN reason IS NULL AND k = 1 THEN user_id::VARCHAR WHEN reason IS NULL AND k = 2 THEN 'u' || user_id END AS user_id,
  CASE WHEN reason IS NULL THEN CASE WHEN k = 1 THEN 'EUR' ELSE 'USD' END END AS currency,
  CASE WHEN reason IS NULL AND k = 2 THEN event_type END AS note FROM e""")
def frames_of_three_schemas(spark, sf_dir):
    """JSON payloads; Spark's Avro package is not on this class path."""
    frames = framed_events(views.table(spark, sf_dir, "events"))
    read = framed.resolve_frames(frames, WRITERS, READER)
    return read.select("event_id", "reason", F.col("record.event_id").alias("read_id"),
                       *[f"record.{c}" for c in ("value", "user_id", "currency", "note")])


@query("u02_union_without_duplicates", """
SELECT day::VARCHAR AS day FROM (
  SELECT CAST(o_orderdate AS DATE) AS day FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem)""")
def union_without_duplicates(spark, sf_dir):
    ordered = views.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    shipped = views.table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    # Both sides shrink to one row per day before the union is shuffled.
    return ordered.distinct().unionByName(shipped.distinct()).dropDuplicates()


@query("f01_published_message_keys", o.EQUITY + """
SELECT 'trade-' || sequence AS message_id, out_ts AS ts_out, 'feed' AS source_id, 'tbbo' AS dataset_id,
  1 AS schema_version, 'equity_trades-key' AS schema_subject, 'AVRO' AS schema_type, 'ticktide' AS service_id
FROM eqv""")
def published_message_keys(spark, sf_dir):
    """Key records: the given fields, the rest from the schema's defaults."""
    given = views.equity_trades(spark, sf_dir).select(
        F.concat(F.lit("trade-"), F.col("sequence").cast("string")).alias("message_id"),
        F.col("out_ts").alias("ts_out"), F.lit("feed").alias("source_id"),
        F.lit("tbbo").alias("dataset_id"), F.lit(1).alias("schema_version"),
        F.lit("equity_trades-key").alias("schema_subject"), F.lit("ticktide").alias("service_id"))
    return tables.resolve_schema(given, schemas.MESSAGE_KEY)
