"""Record layouts as explicit StructTypes. Field names, types and scales are
the published record schemas of the feeds and are fixed values."""

from pyspark.sql import types as T


def _dec(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


def _enum(name: str, symbols: list[str], nullable: bool = False) -> T.StructField:
    return T.StructField(name, T.StringType(), nullable, {"symbols": symbols})


def _req(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, False)


# --- raw inputs -----------------------------------------------------------

BOOK_LEVEL = T.StructType([
    T.StructField("bid_px", T.LongType()),
    T.StructField("ask_px", T.LongType()),
    T.StructField("bid_sz", T.IntegerType()),
    T.StructField("ask_sz", T.IntegerType()),
    T.StructField("bid_ct", T.IntegerType()),
    T.StructField("ask_ct", T.IntegerType()),
])

TBBO_RAW = T.StructType([
    T.StructField("rtype", T.StringType()),
    T.StructField("publisher_id", T.IntegerType()),
    T.StructField("instrument_id", T.LongType()),
    T.StructField("ts_event", T.LongType()),
    T.StructField("ts_recv", T.LongType()),
    T.StructField("ts_out", T.LongType()),
    T.StructField("price", T.LongType()),
    T.StructField("size", T.IntegerType()),
    T.StructField("action", T.StringType()),
    T.StructField("side", T.StringType()),
    T.StructField("flags", T.IntegerType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("sequence", T.LongType()),
    T.StructField("levels", T.ArrayType(BOOK_LEVEL)),
])

# All scalars of an option item arrive as JSON text or numbers; they are read
# as text and parsed once, with bad values routed to quarantine.
OPTION_ITEM = T.StructType(
    [T.StructField(name, T.StringType()) for name in (
        "id", "option_symbol", "underlying_symbol", "exchange", "trade_code",
        "executed_at", "expiry", "option_type", "price", "nbbo_bid", "nbbo_ask",
        "underlying_price", "strike", "premium", "implied_volatility", "theo",
        "delta", "gamma", "vega", "theta", "rho", "size", "volume",
        "open_interest", "ask_vol", "bid_vol", "no_side_vol", "mid_vol",
        "multi_vol", "stock_multi_vol",
    )]
    + [T.StructField(name, T.ArrayType(T.StringType())) for name in ("tags", "report_flags")]
)

# --- normalised outputs ---------------------------------------------------

EQUITY_TRADES = T.StructType([
    _req("received_ts", T.LongType()),
    _req("out_ts", T.LongType()),
    _req("timestamp", T.LongType()),
    _req("symbol", T.StringType()),
    _req("qty", T.IntegerType()),
    _req("price", _dec(16, 4)),
    _enum("side", ["A", "B", "N"]),
    _req("venue", T.StringType()),
    T.StructField("bid_px", _dec(18, 6)),
    T.StructField("ask_px", _dec(18, 6)),
    _req("bid_qty", T.IntegerType()),
    _req("ask_qty", T.IntegerType()),
    _req("bid_ct", T.IntegerType()),
    _req("ask_ct", T.IntegerType()),
    _req("sequence", T.LongType()),
    _req("flags", T.IntegerType()),
    _req("depth", T.IntegerType()),
    _req("tags", T.ArrayType(T.StringType(), False)),
])

OPTION_TRADES = T.StructType([
    _req("id", T.StringType()),
    _req("timestamp", T.LongType()),
    _req("symbol", T.StringType()),
    _req("underlying", T.StringType()),
    _req("spot", _dec(12, 2)),
    _req("strike", _dec(12, 2)),
    _req("exp_date", T.DateType()),
    _req("dte", T.IntegerType()),
    _enum("put_call", ["P", "C"]),
    _req("qty", T.IntegerType()),
    _req("price", _dec(12, 2)),
    _req("premium", _dec(12, 2)),
    _enum("side", ["A", "B", "N"]),
    _enum("bias", ["B", "R", "N"]),
    _req("score", _dec(8, 6)),
    _req("venue", T.StringType()),
    _req("trade_code", T.StringType()),
    _req("iv", _dec(18, 16)),
    _req("bid_px", _dec(14, 4)),
    _req("ask_px", _dec(14, 4)),
    _req("theo", _dec(14, 4)),
    _req("delta", _dec(16, 14)),
    _req("gamma", _dec(16, 14)),
    _req("theta", _dec(16, 14)),
    _req("vega", _dec(16, 14)),
    _req("rho", _dec(16, 14)),
    _req("vol_ask", T.IntegerType()),
    _req("vol_bid", T.IntegerType()),
    _req("vol_no_side", T.IntegerType()),
    _req("vol_mid", T.IntegerType()),
    _req("vol_leg", T.IntegerType()),
    _req("vol_stock", T.IntegerType()),
    _req("vol", T.IntegerType()),
    _req("oi", T.IntegerType()),
    _req("tags", T.ArrayType(T.StringType(), False)),
])

MESSAGE_KEY = T.StructType([
    _req("message_id", T.StringType()),
    _req("ts_out", T.LongType()),
    _req("source_id", T.StringType()),
    _req("dataset_id", T.StringType()),
    _req("schema_version", T.IntegerType()),
    _req("schema_subject", T.StringType()),
    T.StructField("schema_type", T.StringType(), False, {"default": "AVRO"}),
    _req("service_id", T.StringType()),
])

VOLUME_BARS = T.StructType([
    _req("symbol", T.StringType()),
    _req("timestamp", T.LongType()),
    _req("oi", T.IntegerType()),
    _req("price", _dec(12, 2)),
])

HEADERS = T.ArrayType(T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.BinaryType()),
]))
