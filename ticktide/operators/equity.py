"""Equity trades with the best bid and offer: raw record to typed record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ticktide import schemas
from ticktide.functions import decimals, tags, times
from ticktide.operators import quality
from ticktide.operators.lookups import lookup
from ticktide.sources.landing import book_records

# Bits of the flags field; fixed values.
FLAG_BITS = {"last": 128, "tob": 64, "snapshot": 32, "mbp": 16, "bad_ts_recv": 8,
             "maybe_bad_book": 4, "publisher_specific": 2}

# Raw book names and the names of the published record; fixed values.
PUBLISHED_NAMES = {
    "bid_px_00": "bid_px", "ask_px_00": "ask_px", "bid_qty_00": "bid_qty",
    "ask_qty_00": "ask_qty", "bid_ct_00": "bid_ct", "ask_ct_00": "ask_ct",
}


def flag_columns(flags: Column) -> dict[str, Column]:
    return {f"flag_{name}": flags.bitwiseAND(F.lit(bit)) != 0 for name, bit in FLAG_BITS.items()}


def rejection_rules() -> quality.Rules:
    return {
        "unknown venue": F.col("venue").isNull(),
        "unknown symbol": F.col("symbol").isNull(),
        "size not positive": F.coalesce(F.col("qty"), F.lit(0)) <= 0,
        "price not positive": F.coalesce(F.col("price") <= 0, F.lit(True)),
    }


def extract(records: DataFrame) -> DataFrame:
    """Scaled prices, millisecond times and the level-0 book of each record."""
    top = F.col("levels")[0]
    price = decimals.feed_price(F.col("price"))
    bid, ask = decimals.feed_price(top["bid_px"]), decimals.feed_price(top["ask_px"])
    return records.select(
        "publisher_id", "instrument_id", F.col("ts_event").alias("event_ns"),
        times.floor_div(F.col("ts_recv"), 1_000_000).alias("received_ts"),
        times.floor_div(F.col("ts_out"), 1_000_000).alias("out_ts"),
        times.floor_div(F.col("ts_event"), 1_000_000).alias("timestamp"),
        F.col("size").alias("qty"),
        decimals.coerce_down(price, 16, 4).alias("price"),
        "side", "sequence", "flags", "depth",
        decimals.coerce_down(bid, 18, 6).alias("bid_px_00"),
        decimals.coerce_down(ask, 18, 6).alias("ask_px_00"),
        top["bid_sz"].alias("bid_qty_00"), top["ask_sz"].alias("ask_qty_00"),
        top["bid_ct"].alias("bid_ct_00"), top["ask_ct"].alias("ask_ct_00"),
        # Tags compare the exact prices, before they are cut to the schema scale.
        tags.keep_set(tags.above_ask(price, ask), tags.below_bid(price, bid),
                      tags.whale(price, F.col("size"))).alias("tags"),
    ).withColumnsRenamed(PUBLISHED_NAMES)


def normalise(records: DataFrame, publishers: DataFrame, symbology: DataFrame) -> DataFrame:
    """All book records, typed, with the array ``reason`` of failed rules.

    ``symbology`` has one row (instrument_id, symbol) per instrument.
    """
    typed = extract(book_records(records))
    named = lookup(lookup(typed, publishers.select("publisher_id", "venue"), ["publisher_id"]),
                   symbology.select("instrument_id", "symbol"), ["instrument_id"])
    return quality.with_reasons(named, rejection_rules())


def published(records: DataFrame) -> DataFrame:
    """The valid records in the column order of the published schema."""
    return quality.valid(records).select(*schemas.EQUITY_TRADES.fieldNames())
