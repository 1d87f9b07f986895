"""Option feed: frames, mapped fields, rejection, symbols, message checks."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ticktide import dims, schemas
from ticktide.functions import checks, symbols, tags, times
from ticktide.operators import lookups, option, quality
from ticktide.plans import oracle as o
from ticktide.plans import views
from ticktide.plans.registry import query
from ticktide.sources import frames


# --- frames ---------------------------------------------------------------

def _only(*fields: str) -> T.StructType:
    return T.StructType([schemas.OPTION_ITEM[name] for name in fields])


@query("s04_frame_items", o.OPTION + """
SELECT id FROM opt WHERE o % 97 <> 0 UNION ALL SELECT id || '-b' FROM opt WHERE o % 97 <> 0""")
def frame_items(spark, sf_dir):
    return frames.option_items(views.option_frames(spark, sf_dir), schema=_only("id")).select("id")


@query("s05_priced_items", o.OPTION + """
SELECT id, price::VARCHAR AS price FROM opt WHERE o % 97 <> 0
UNION ALL SELECT id || '-b', '0' FROM opt WHERE o % 97 <> 0 AND n % 4 = 3""")
def priced_items(spark, sf_dir):
    items = frames.option_items(views.option_frames(spark, sf_dir), schema=_only("id", "price"))
    return frames.priced(items).select("id", "price")


@query("s06_malformed_frames", o.OPTION + """
SELECT id, 'malformed JSON frame' AS reason FROM opt WHERE o % 97 = 0
UNION ALL SELECT id, 'item is no object' FROM opt WHERE o % 97 <> 0 AND o % 89 = 0""")
def malformed_frames(spark, sf_dir):
    return frames.bad_frames(views.option_frames(spark, sf_dir)).select("id", "reason")


@query("s14_root_key", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def root_key(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    wrapped = F.to_json(F.struct(F.lit("trade").alias("type"),
                                 F.from_json("props", "k int").alias("data")))
    inner = frames.root_key(wrapped)
    return events.select("event_id", F.from_json(inner, "k int")["k"].alias("k"))


@query("g11_json_decode", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) * 2 AS doubled FROM events""")
def json_decode(spark, sf_dir):
    parsed = F.from_json("props", T.StructType([T.StructField("k", T.IntegerType())]))
    return views.table(spark, sf_dir, "events").select("event_id", (parsed["k"] * 2).alias("doubled"))


# --- mapped fields --------------------------------------------------------

def _fields(name: str, columns: list[str], sql: str | None = None):
    text = {"spot", "strike", "price", "premium", "score", "iv", "theo", "bid_px", "ask_px", "delta",
            "gamma", "theta", "vega", "rho", "exp_date"}
    shown = sql or ", ".join(f"{c}::VARCHAR AS {c}" if c in text else f'"{c}"' for c in columns)

    @query(name, o.OPTION + f"SELECT id, {shown} FROM opt")
    def run(spark, sf_dir):
        return views.option_records(spark, sf_dir).select("id", *columns)
    return run


@query("p20_raw_tags", o.OPTION + "SELECT id, raw_tags FROM opt")
def raw_tags(spark, sf_dir):
    return views.option_view(spark, sf_dir).select(
        "id", tags.raw_tags(F.col("tags"), F.col("report_flags")).alias("raw_tags"))


_fields("p21_side", ["side"])
_fields("p22_bias", ["bias"])
_fields("p23_tags", ["tags"])


def _tagged(name: str, words: list[str]):
    hit = " OR ".join(f"list_contains(string_split(tags, '|'), '{w}')" for w in words)

    @query(name, o.OPTION + f"SELECT id, {hit} AS tagged FROM opt")
    def run(spark, sf_dir):
        found = F.arrays_overlap("tags", F.array(*[F.lit(w) for w in words]))
        return views.option_records(spark, sf_dir).select("id", found.alias("tagged"))
    return run


_tagged("p24_millionaire", ["MILLIONAIRE"])
_tagged("p25_outside_book", ["ABOVE_ASK", "BELOW_BID"])
_fields("p26_expiry_date", ["exp_date"])
_fields("p27_days_to_expiry", ["dte"])
_fields("p28_score", ["score"])
_fields("p29_put_call", ["put_call"])
_fields("p30_quantities", ["qty", "vol", "oi"])
_fields("p31_volumes", ["vol_ask", "vol_bid", "vol_no_side", "vol_mid", "vol_leg", "vol_stock"])
_fields("p32_price_and_score", ["price", "score"])
_fields("p33_model_values", ["premium", "iv", "theo", "delta", "gamma", "vega", "theta", "rho"])
_fields("p34_market_prices", ["spot", "strike", "bid_px", "ask_px"])
_fields("p35_text_fields", ["symbol", "underlying", "venue", "trade_code"])


@query("p36_published_option_trades", o.OPTION + """
SELECT id, "timestamp", symbol, underlying, spot::VARCHAR AS spot, strike::VARCHAR AS strike,
  exp_date::VARCHAR AS exp_date, dte, put_call, qty, price::VARCHAR AS price,
  premium::VARCHAR AS premium, side, bias, score::VARCHAR AS score, venue, trade_code,
  iv::VARCHAR AS iv, bid_px::VARCHAR AS bid_px, ask_px::VARCHAR AS ask_px, theo::VARCHAR AS theo,
  delta::VARCHAR AS delta, gamma::VARCHAR AS gamma, theta::VARCHAR AS theta, vega::VARCHAR AS vega,
  rho::VARCHAR AS rho, vol_ask, vol_bid, vol_no_side, vol_mid, vol_leg, vol_stock, vol, oi, tags
FROM optv""")
def published(spark, sf_dir):
    return views.option_trades(spark, sf_dir)


@query("p37_rejected_items", o.OPTION + """
SELECT id, 'bad vol_stock' AS reason FROM opt WHERE vol_stock IS NULL""")
def rejected(spark, sf_dir):
    return quality.quarantine(views.option_records(spark, sf_dir, settle=True)).select("id", "reason")


@query("p38_key", o.OPTION + "SELECT symbol AS key, count(*) AS trades FROM optv GROUP BY symbol")
def option_key(spark, sf_dir):
    trades = views.option_trades(spark, sf_dir)
    return trades.groupBy(option.key(trades).alias("key")).agg(F.count("*").alias("trades"))


@query("p39_event_time", o.with_(o.RAW) + """, t AS (
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN ts_event WHEN 1 THEN ts_event // 1000000
    WHEN 2 THEN ts_event // 1000000000 ELSE ts_event // 100000 END AS v FROM raw)
SELECT event_id, CASE event_id % 4 WHEN 0 THEN v // 1000000 WHEN 1 THEN v WHEN 2 THEN v * 1000 END
  AS event_ms FROM t""")
def event_time(spark, sf_dir):
    raw = views.tbbo_raw(views.table(spark, sf_dir, "events"))
    eid = F.col("sequence").cast("bigint")
    value = (F.when(eid % 4 == 0, F.col("ts_event"))
             .when(eid % 4 == 1, times.floor_div(F.col("ts_event"), 1_000_000))
             .when(eid % 4 == 2, times.floor_div(F.col("ts_event"), 1_000_000_000))
             .otherwise(times.floor_div(F.col("ts_event"), 100_000)))
    return raw.select(eid.alias("event_id"), times.event_millis(value).alias("event_ms"))


@query("p40_bull_bear_score", o.OPTION + """
SELECT underlying, bias, count(*) AS trades, sum(score)::VARCHAR AS total FROM opt
GROUP BY underlying, bias""")
def bull_bear_score(spark, sf_dir):
    return (views.option_records(spark, sf_dir).groupBy("underlying", "bias")
            .agg(F.count("*").alias("trades"), F.sum("score").alias("total")))


@query("s04_frames_to_trades", o.OPTION + """
SELECT id, symbol, price::VARCHAR AS price, dte, tags FROM optv WHERE o % 97 <> 0
UNION ALL
SELECT id || '-b', '', '0.00', CAST(DATE '1800-01-01' - DATE '1970-01-01' AS INTEGER), ''
FROM opt WHERE o % 97 <> 0 AND n % 4 = 3""")
def frames_to_trades(spark, sf_dir):
    """JSON text to published records in one stage before the sink."""
    records = views.option_records_from_frames(spark, sf_dir)
    return option.published(records).select("id", "symbol", "price", "dte", "tags")


# --- message and value checks ---------------------------------------------

@query("p41_message_type_filter", """
SELECT user_id, count(*) AS connects FROM events WHERE event_type = 'signup' GROUP BY user_id""")
def message_type_filter(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    message = F.to_json(F.struct(
        F.when(F.col("event_type") == "signup", "connect").otherwise(F.col("event_type")).alias("type"),
        "user_id"))
    return (events.withColumn("message", message)
            .where(F.get_json_object("message", "$.type") == "connect")
            .groupBy("user_id").agg(F.count("*").alias("connects")))


@query("p42_field_rules", """
SELECT event_id, concat_ws('|',
    CASE WHEN NOT length(repeat('x', CAST(user_id % 13 AS INTEGER))) BETWEEN 1 AND 10 THEN 'symbol length' END,
    CASE WHEN value < 1 THEN 'price not positive' END) AS reason
FROM events""")
def field_rules(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    symbol = F.expr("repeat('x', cast(user_id % 13 AS int))")
    rules = {"symbol length": ~checks.length_between(symbol, 1, 10),
             "price not positive": F.floor(F.col("value")) <= 0}
    return quality.with_reasons(events, rules).select("event_id", "reason")


@query("p43_enum_members", """
SELECT event_id, event_type IN ('click', 'view') AS known,
  event_id % 5 = 0 OR event_type IN ('click', 'view') AS known_or_null FROM events""")
def enum_members(spark, sf_dir):
    members = ["click", "view"]
    maybe = F.when(F.col("event_id") % 5 != 0, F.col("event_type"))
    return views.table(spark, sf_dir, "events").select(
        "event_id", checks.in_enum(F.col("event_type"), members).alias("known"),
        checks.in_enum_or_null(maybe, members).alias("known_or_null"))


@query("p44_printable_text", """
SELECT doc_id, trim(text) <> '' AND NOT regexp_matches(replace(text, ' ', ''), '[\\p{C}\\p{Z}]')
  AS printable FROM documents""")
def printable_text(spark, sf_dir):
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", checks.printable_text(F.col("text")).alias("printable"))


@query("p45_decimal_text", """
SELECT event_id, TRY_CAST(CASE event_id % 3 WHEN 0 THEN event_type ELSE value::VARCHAR END
  AS DECIMAL(38,18)) IS NOT NULL AS decimal FROM events""")
def decimal_text(spark, sf_dir):
    text = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(
        F.col("value").cast("string"))
    return views.table(spark, sf_dir, "events").select(
        "event_id", checks.decimal_text(text).alias("decimal"))


@query("p46_utf8_and_trim", """
SELECT doc_id, length(trim(text, ' ')) AS n_chars,
  doc_id % 4 <> 0 AS valid FROM documents""")
def utf8_and_trim(spark, sf_dir):
    """Every fourth text gets a byte that no UTF-8 text contains."""
    documents = views.table(spark, sf_dir, "documents")
    broken = F.unhex(F.concat(F.hex(F.encode("text", "UTF-8")), F.lit("FF"))).cast("string")
    text = F.when(F.col("doc_id") % 4 == 0, broken).otherwise(F.col("text"))
    return documents.select(
        "doc_id", F.length(checks.trimmed_utf8(F.concat(F.lit("  "), F.col("text")))).alias("n_chars"),
        checks.utf8(text).alias("valid"))


@query("p47_entitlements", o.with_(o.values("ent", "entitlement, level", list(dims.ENTITLEMENTS.items())),
    """tagged AS (SELECT *, CASE event_id % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'free' WHEN 2 THEN 'basic'
      WHEN 3 THEN 'pro' ELSE 'pro_plus' END AS entitlement FROM events)""") + """
SELECT entitlement, count(*) AS visible FROM tagged JOIN ent USING (entitlement) WHERE level <= 1
GROUP BY entitlement""")
def entitlements(spark, sf_dir):
    names = F.array(*[F.lit(e) for e in ("none", "free", "basic", "pro", "pro_plus")])
    events = views.table(spark, sf_dir, "events").withColumn(
        "entitlement", F.element_at(names, (F.col("event_id") % 5 + 1).cast("int")))
    return (lookups.entitled(events, dims.entitlements(spark), 1)
            .groupBy("entitlement").agg(F.count("*").alias("visible")))


# --- symbols --------------------------------------------------------------

@query("g01_symbol_parse", o.OPTION + """
SELECT id, underlying, strptime('20' || strftime(exp_full, '%y%m%d'), '%Y%m%d')::DATE::VARCHAR AS expiration_date,
  put_call, CAST(strike AS DECIMAL(22,9))::VARCHAR AS strike FROM opt""")
def symbol_parse(spark, sf_dir):
    parts = symbols.parse(F.col("option_symbol"))
    return views.option_view(spark, sf_dir).select("id", *[c.alias(n) for n, c in parts.items()])


@query("g02_symbol_format", o.OPTION + "SELECT id, symbol FROM opt")
def symbol_format(spark, sf_dir):
    parts = symbols.parse(F.col("option_symbol"))
    return views.option_view(spark, sf_dir).select("id", symbols.format_symbol(
        parts["underlying"], parts["expiration_date"], parts["put_call"], parts["strike"]
    ).alias("symbol"))


@query("g03_symbol_struct", o.OPTION + """
SELECT id, '{"underlying":"' || underlying || '","expiration_date":"20' || strftime(exp_full, '%y%m%d')
  || '","put_call":"' || put_call || '","strike":' || strike::DOUBLE || ',"symbol":"' || symbol || '"}'
  AS document FROM opt""")
def symbol_struct(spark, sf_dir):
    return views.option_view(spark, sf_dir).select(
        "id", F.to_json(symbols.to_struct(F.col("option_symbol"))).alias("document"))


# --- nested validation ----------------------------------------------------

LEG = T.StructType([
    T.StructField("side", T.StringType(), False, {"symbols": ["A", "B", "N"]}),
    T.StructField("qty", T.IntegerType(), False)])
ORDER = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("legs", T.ArrayType(LEG, False), False),
    T.StructField("note", T.StringType(), True)])


@query("g14_nested_validation", o.OPTION + """
SELECT id, side IN ('A', 'B', 'N') AND n <> 5 AND o % 3 <> 1 AND n <> 6 AS fits FROM (
  SELECT id, o, n, CASE WHEN n = 4 THEN 'M' ELSE side END AS side FROM opt)""")
def nested_validation(spark, sf_dir):
    items = views.option_view(spark, sf_dir)
    order = F.split_part("id", F.lit("-"), F.lit(1)).cast("bigint")
    line = F.split_part("id", F.lit("-"), F.lit(2)).cast("int")
    side = F.when(line == 4, "M").otherwise(tags.side(
        tags.raw_tags(F.col("tags"), F.col("report_flags"))))
    leg = F.struct(side.alias("side"), F.when(line != 5, F.col("size").cast("int")).alias("qty"))
    record = F.struct(
        F.when(order % 3 != 1, F.col("id")).alias("id"),
        F.when(line != 6, F.array(leg, leg)).alias("legs"), F.lit(None).cast("string").alias("note"))
    return items.select("id", record.alias("record")).select(
        "id", checks.conforms(F.col("record"), ORDER, nullable=False).alias("fits"))


@query("f07_schema_fit", o.EQUITY + "SELECT count(*) AS records, count(*) AS fitting FROM eqv")
def schema_fit(spark, sf_dir):
    trades = views.equity_trades(spark, sf_dir)
    record = F.struct(*schemas.EQUITY_TRADES.fieldNames())
    fits = checks.conforms(F.col("record"), schemas.EQUITY_TRADES, nullable=False)
    return trades.select(record.alias("record")).agg(
        F.count("*").alias("records"), F.count(F.when(fits, 1)).alias("fitting"))


