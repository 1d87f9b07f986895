"""Option trades: text items of the JSON feed to typed records."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ticktide import schemas
from ticktide.functions import decimals, tags, times
from ticktide.operators import quality

PLACEHOLDER = "0.00000001"
# Published decimal fields: input field, default when missing; fixed values.
DECIMAL_INPUTS = {
    "spot": ("underlying_price", "0"), "strike": ("strike", "0"),
    "price": ("price", "0"), "premium": ("premium", PLACEHOLDER),
    "bid_px": ("nbbo_bid", "0"), "ask_px": ("nbbo_ask", "0"),
    "iv": ("implied_volatility", PLACEHOLDER), "theo": ("theo", PLACEHOLDER),
    "delta": ("delta", PLACEHOLDER), "gamma": ("gamma", PLACEHOLDER),
    "vega": ("vega", PLACEHOLDER), "theta": ("theta", PLACEHOLDER), "rho": ("rho", PLACEHOLDER),
}
# The prices that are compared exactly.
COMPARED = ("price", "bid_px", "ask_px")
# Published integer fields and their inputs; fixed values.
INTEGER_INPUTS = {
    "qty": "size", "vol": "volume", "oi": "open_interest", "vol_ask": "ask_vol",
    "vol_bid": "bid_vol", "vol_no_side": "no_side_vol", "vol_mid": "mid_vol",
    "vol_leg": "multi_vol", "vol_stock": "stock_multi_vol",
}
TEXT_INPUTS = {
    "id": "id", "symbol": "option_symbol", "underlying": "underlying_symbol",
    "venue": "exchange", "trade_code": "trade_code",
}
# Fields whose text may not parse.
CAN_FAIL = ("timestamp", "exp_date", "dte", *DECIMAL_INPUTS, *INTEGER_INPUTS)
MISSING_EXPIRY = "1970-01-01"
MISSING_EXPIRY_FOR_DAYS = "1800-01-01"


def _text(name: str) -> Column:
    source, default = DECIMAL_INPUTS[name]
    return F.coalesce(F.col(source), F.lit(default))


def _whole(name: str) -> Column:
    empty = F.coalesce(F.col(name), F.lit("")) == ""
    return F.coalesce(F.col(name).try_cast("int"), F.when(empty, 0))


def _expiry(default: str) -> Column:
    parsed = F.substring("expiry", 1, 10).try_cast("date")
    return F.coalesce(parsed, F.when(F.col("expiry").isNull(), F.lit(default).cast("date")))


def trade_date(executed_ms: Column, zone: str) -> Column:
    return times.market_date(F.timestamp_millis(executed_ms), zone)


def parse(items: DataFrame, zone: str = "UTC") -> DataFrame:
    """Text fields to typed columns, null where a text does not parse.

    Decimals of no more places than the schema has, nearly all of them, are read as they
    are published; any other as decimal(38,18), then cut. Price, bid and ask are compared
    exactly, so all three are read wide when one of them is; the comparisons and the prices as
    doubles stay beside the published ones.
    """
    types = {field.name: field.dataType for field in schemas.OPTION_TRADES.fields}
    plain = {name: decimals.plain_text_down(_text(name), types[name].precision, types[name].scale)
             for name in DECIMAL_INPUTS}
    missed = {name: value.isNull() for name, value in plain.items()}
    missed |= dict.fromkeys(COMPARED, reduce(or_, [missed[name] for name in COMPARED]))
    texts = {source for source in TEXT_INPUTS.values()} | {"option_type", "tags", "report_flags"}
    wide = items.select(
        *sorted(texts - {"tags", "report_flags"}),
        F.coalesce(F.col("executed_at"), F.lit("0")).try_cast("bigint").alias("timestamp"),
        _expiry(MISSING_EXPIRY).alias("exp_date"), _expiry(MISSING_EXPIRY_FOR_DAYS).alias("_expiry"),
        *[value.alias(name) for name, value in plain.items()],
        tags.joined(F.col("tags"), F.col("report_flags")).alias("words"),
        *[F.when(missed[name], _text(name).try_cast("decimal(38,18)")).alias(f"_{name}")
          for name in DECIMAL_INPUTS],
        *[_whole(source).alias(name) for name, source in INTEGER_INPUTS.items()])
    price, bid, ask = [F.col(name) for name in COMPARED]
    wide_price, wide_bid, wide_ask = [F.col(f"_{name}") for name in COMPARED]
    numbers = {
        **{name: F.col(name) for name in ("timestamp", "exp_date", *INTEGER_INPUTS)},
        "dte": F.datediff("_expiry", trade_date(F.col("timestamp"), zone)),
        **{name: F.coalesce(name, decimals.coerce_down(
            F.col(f"_{name}"), types[name].precision, types[name].scale)) for name in DECIMAL_INPUTS}}
    return wide.select(
        *sorted(texts - {"tags", "report_flags"}), *[value.alias(name) for name, value in numbers.items()],
        reduce(or_, [numbers[name].isNull() for name in CAN_FAIL]).alias("_failed"),
        tags.upper(F.col("words")).alias("_words"),
        F.coalesce(price < bid, wide_price < wide_bid).alias("_below"),
        F.coalesce(price > ask, wide_price > wide_ask).alias("_above"),
        F.coalesce(ask == bid, wide_ask == wide_bid).alias("_locked"),
        *[F.coalesce(F.col(name).cast("double"), F.col(f"_{name}").cast("double")).alias(f"_{name}")
          for name in COMPARED])


def normalise(items: DataFrame, zone: str = "UTC", settle: bool = True) -> DataFrame:
    """Typed records with the array ``reason``; days to expiry count from the
    trade date in ``zone``.

    Rejection looks at parsed columns only, so a query that reads few fields of
    the valid records computes no tags and no scores. ``settle=False`` is for
    queries that read few fields and do not filter on ``reason``: the fields they
    leave out are then not even parsed.
    """
    typed = parse(items, zone)
    if settle:
        typed = quality.settled(typed, "_failed")
    below, above, locked = F.col("_below"), F.col("_above"), F.col("_locked")
    prices = [F.col(f"_{name}") for name in COMPARED]
    words, bias = F.col("_words"), tags.bias(F.col("_words"))
    # A zero price or score is documented to become the placeholder 1e-8. The
    # published scales (2 and 6) cut that back to zero, so zero is left alone.
    derived = {
        **{name: F.coalesce(F.col(source), F.lit("")) for name, source in TEXT_INPUTS.items()},
        "put_call": F.upper(F.substring(F.coalesce(F.col("option_type"), F.lit("C")), 1, 1)),
        "side": tags.side(words),
        "bias": bias,
        # The cast rounds half up, as `round` does.
        "score": tags.placed_score(below, above, locked, *prices, bias).try_cast("decimal(8,6)"),
        "tags": F.concat(
            tags.without_side_and_bias(words),
            tags.keep_set(
                F.when(F.col("premium") >= tags.MILLIONAIRE_PREMIUM, F.lit("MILLIONAIRE")),
                tags.placed_tag(below, above))),
    }
    record = typed.select(
        *[derived.get(name, F.col(name)).alias(name) for name in schemas.OPTION_TRADES.fieldNames()],
        times.event_millis(F.col("timestamp")).alias("event_ms"), "_failed")
    return quality.with_reasons(record, mapping_rules(), failed="_failed")


def mapping_rules() -> quality.Rules:
    """A field that did not map rejects the record. Text fields and arrays have
    defaults and cannot fail."""
    return {f"bad {name}": F.col(name).isNull() for name in CAN_FAIL}


def published(records: DataFrame) -> DataFrame:
    return quality.valid(records).select(*schemas.OPTION_TRADES.fieldNames())


def key(records: DataFrame) -> Column:
    return records["symbol"]
