"""Feed-shaped views over the given tables.

The tables hold no market data, so trades are derived from ``events`` and
``lineitem``. All derived numbers are integers or decimals, which both Spark and
the comparison engine compute exactly.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ticktide import dims
from ticktide.calendars import lookup
from ticktide.functions import tags
from ticktide.functions.decimals import UNDEF_PRICE
from ticktide.operators import equity, option
from ticktide.session import use_utc
from ticktide.sources import frames

# Days of the calendars for ``events`` and ``orders``: the days that the tables may
# have, and those around them that questions about a day may reach.
EVENT_DAYS = ("2023-12-01", "2024-03-01")
ORDER_RANGE = ("1995-01-01", "2001-12-31")
ORDER_DAYS = ("1994-12-01", "2002-01-31")


def within(day: Column, days: tuple[str, str]) -> Column:
    """A filter that keeps every row and fails on a day outside the range."""
    text = F.concat(F.lit("no calendar built for "), day.cast("string"))
    return F.when(day.isNull() | day.between(*[F.lit(d).cast("date") for d in days]), True).otherwise(
        F.raise_error(text).cast("boolean"))


EVENT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                "value double, props string")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def line_items(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """``lineitem`` dealt over the session's partitions.

    Texts and decimals of a row cost far more than its bytes, so tasks are not cut
    by bytes: a small file would be one task. Only the columns that are read move.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return table(spark, sf_dir, "lineitem").select(*columns).repartition(parts, "l_orderkey", "l_linenumber")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a stream. The path is a pattern because the file source
    wants a folder or a pattern, and the table may be one file or a folder."""
    return (use_utc(spark).readStream.schema(EVENT_SCHEMA)
            .parquet(os.path.join(sf_dir, "events.parque[t]")))


def tbbo_raw(events: DataFrame) -> DataFrame:
    """Raw trade records with the top of the book, one per event."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    eid = F.col("event_id")
    lot = F.get_json_object("props", "$.k").cast("int")
    # Every 13th trade is a block; prices sit above, below or inside the book.
    size = F.when(eid % 13 == 0, lot * 10000).otherwise(lot)
    gap = (eid % 5) + 1
    fixed = lambda c: c * F.lit(10_000_000).cast("bigint")
    undefined = eid % 11 == 2
    bid = F.when(eid % 11 == 1, cents + 1).when(eid % 11 == 0, cents - gap - 2).otherwise(cents - gap)
    ask = F.when(eid % 11 == 0, cents - 1).when(eid % 11 == 1, cents + gap + 2).otherwise(cents + gap)
    marker = F.lit(UNDEF_PRICE)
    ts = F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + eid % 1000
    return events.select(
        F.when(eid % 10 == 9, "trades").otherwise("mbp-1").alias("rtype"),
        (eid % 62 + 1).cast("int").alias("publisher_id"),
        F.col("user_id").alias("instrument_id"),
        ts.alias("ts_event"), (ts + 135_800 + (eid % 7) * 1000).alias("ts_recv"),
        (ts + 300_000 + (eid % 7) * 1000).alias("ts_out"),
        fixed(cents).alias("price"), size.alias("size"), F.lit("T").alias("action"),
        F.when(F.col("event_type") == "click", "A").when(F.col("event_type") == "purchase", "B")
        .otherwise("N").alias("side"),
        F.when(eid % 3 == 0, 194).when(eid % 3 == 1, 130).otherwise(40).alias("flags"),
        F.lit(0).alias("depth"), eid.alias("sequence"),
        F.array(F.struct(
            F.when(undefined, marker).otherwise(fixed(bid)).alias("bid_px"),
            F.when(undefined, marker).otherwise(fixed(ask)).alias("ask_px"),
            (lot + 1).alias("bid_sz"), (lot + 2).alias("ask_sz"),
            (eid % 4).cast("int").alias("bid_ct"), (eid % 6).cast("int").alias("ask_ct"),
        )).alias("levels"),
    )


def symbology(events: DataFrame) -> DataFrame:
    """Instrument to symbol; every 50th instrument has none."""
    return (events.select(F.col("user_id").alias("instrument_id")).distinct()
            .where(F.col("instrument_id") % 50 != 7)
            .withColumn("symbol", F.concat(F.lit("SYM"), F.col("instrument_id").cast("string"))))


def equity_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return equity.normalise(tbbo_raw(events), dims.publishers(spark), symbology(events))


def equity_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid equity trades, published columns."""
    return equity.published(equity_records(spark, sf_dir))


def timed_equity_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equity_trades(spark, sf_dir).withColumn("ts", F.timestamp_millis("timestamp"))


def _half_up(value: Column) -> Column:
    """``round`` to a bigint, half away from zero, without its detour through text. What is
    left of a double after its whole part is exact."""
    whole = value.cast("bigint")
    rest = value - whole
    return whole + F.when(rest.between(0.5, 1), 1).when(rest.between(-1, -0.5), -1).otherwise(0)


def _cents_text(cents) -> object:
    whole = F.call_function("div", cents, F.lit(100)).cast("string")
    return F.concat(whole, F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def option_items(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Option trade items as the feed sends them: scalars as text."""
    cents = lambda c: _half_up(F.col(c) * 100)
    shipped = F.col("l_shipdate").cast("date")
    line = F.col("l_linenumber").cast("bigint")
    # Numbers that several texts show are columns, made once.
    joined = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        line.alias("line"), F.col("l_quantity").cast("bigint").alias("qty"), shipped.alias("shipped"),
        F.date_add(shipped, (line * 30).cast("int")).alias("expires"),
        *[cents(c).alias(c) for c in ("l_extendedprice", "l_discount", "l_tax")],
        cents("p_retailprice").alias("retail"), _half_up(F.col("p_retailprice")).alias("strike"))
    order, line, qty = F.col("l_orderkey"), F.col("line"), F.col("qty")
    price = F.call_function("div", F.col("l_extendedprice"), qty * 100)
    # The book is 0.10 wide at most; price above, below or inside, or a locked book.
    case = order % 9
    bid = (F.when(case == 0, price + 1).when(case == 1, price).when(case == 2, price - 9)
           .otherwise(price - F.col("l_discount") - 1))
    ask = (F.when(case == 0, price + 6).when(case == 1, price).when(case == 2, price - 1)
           .otherwise(price + F.col("l_tax") + 1))
    executed = F.unix_date("shipped").cast("bigint") * 86_400_000 + (order % 86_400) * 1000
    put = F.col("l_returnflag") == "R"
    strike, expiry = F.col("strike"), F.col("expires")
    # As `yyMMdd`, without a formatter.
    day = F.abs(F.year(expiry) % 100) * 10_000 + F.month(expiry) * 100 + F.day(expiry)
    symbol = F.concat(F.rpad(F.concat(F.lit("P"), (F.col("l_partkey") % 1000).cast("string")), 6, " "),
                      F.lpad(day.cast("string"), 6, "0"), F.when(put, "P").otherwise("C"),
                      F.lpad((strike * 1000).cast("string"), 8, "0"))
    greek = lambda sign, number: F.concat(F.lit(sign + "0."), F.lpad((number % 100000).cast("string"), 5, "0"))
    maybe = lambda column, k: F.when((order + line) % k != 0, column)
    word = lambda condition, text: F.when(condition, F.lit(text))
    return joined.select(
        F.concat_ws("-", order.cast("string"), line.cast("string"), F.col("l_partkey").cast("string"))
        .alias("id"),
        symbol.alias("option_symbol"),
        F.concat(F.lit("P"), (F.col("l_partkey") % 1000).cast("string")).alias("underlying_symbol"),
        maybe(F.concat(F.lit("X"), (F.col("l_suppkey") % 10).cast("string")), 17).alias("exchange"),
        F.lower("l_linestatus").alias("trade_code"),
        executed.cast("string").alias("executed_at"),
        maybe(expiry.cast("string"), 19).alias("expiry"),
        F.when(put, "put").otherwise("call").alias("option_type"),
        _cents_text(price).alias("price"), _cents_text(bid).alias("nbbo_bid"),
        _cents_text(ask).alias("nbbo_ask"),
        _cents_text(F.col("retail") + (order % 21 - 10) * 100).alias("underlying_price"),
        strike.cast("string").alias("strike"),
        maybe(_cents_text(F.col("l_extendedprice") * 100), 23).alias("premium"),
        maybe(greek("", order * 7 + line), 13).alias("implied_volatility"),
        maybe(_cents_text(price + line), 11).alias("theo"),
        maybe(greek("", order + line), 7).alias("delta"), greek("", order * 3).alias("gamma"),
        greek("", line * 11).alias("vega"), greek("-", order * 5).alias("theta"),
        greek("", order * 2).alias("rho"),
        qty.cast("string").alias("size"),
        F.when(line == 7, "").otherwise((qty * 3).cast("string")).alias("volume"),
        maybe((F.col("l_suppkey") * 10).cast("string"), 5).alias("open_interest"),
        (qty * 2).cast("string").alias("ask_vol"), qty.cast("string").alias("bid_vol"),
        maybe(line.cast("string"), 3).alias("no_side_vol"), line.cast("string").alias("mid_vol"),
        (order % 4).cast("string").alias("multi_vol"),
        F.when(order % 251 == 0, "n/a").otherwise((order % 3).cast("string")).alias("stock_multi_vol"),
        tags.keep_set(
            word(F.col("l_returnflag") == "A", "ask_side"), word(F.col("l_returnflag") == "R", "bid_side"),
            word(F.col("l_returnflag") == "N", "no_side"),
            word(F.col("l_linestatus") == "F", "bullish"),
            word((F.col("l_linestatus") == "O") & (line % 2 == 0), "bearish"),
            word(line == 3, "sweep"), word(line == 3, "sweep")).alias("tags"),
        F.when(line % 3 == 0, F.array(F.lit("floor"), F.lit("cross"))).alias("report_flags"),
    )


def option_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_items(
        spark, sf_dir, "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    return option_items(lines, table(spark, sf_dir, "part"))


def option_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON frames: a channel name, the item, and a second item whose price is
    missing, empty, the number zero or the text "0"; a nested field and a text hold
    a zero price, too. Some frames end in a number, some are cut short."""
    items = option_view(spark, sf_dir)
    order = F.split_part("id", F.lit("-"), F.lit(1)).cast("bigint")
    line = F.split_part("id", F.lit("-"), F.lit(2)).cast("bigint")
    first = F.to_json(F.struct(*items.columns))
    second = F.concat(F.lit('{"id":"'), F.col("id"), F.lit('-b"'),
                      F.when(line % 4 == 0, "").when(line % 4 == 1, ',"price":""')
                      .when(line % 4 == 2, ',"price":0').otherwise(',"price":"0"'),
                      F.lit(',"meta":{"price":0},"note":"a \\"price\\":0, b"}'))
    loose = F.when(order % 89 == 0, ",7").otherwise("")
    whole = F.concat(F.lit('["option_trades",'), first, F.lit(","), second, loose, F.lit("]"))
    return items.select(
        "id", F.when(order % 97 == 0, F.substring(whole, 1, 40)).otherwise(whole).alias("value"))


def option_records(spark: SparkSession, sf_dir: str, settle: bool = False) -> DataFrame:
    """All mapped records; ``settle`` them before filtering on the reason."""
    return option.normalise(option_view(spark, sf_dir), settle=settle)


def option_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return option.published(option_records(spark, sf_dir, settle=True))


def option_records_from_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return option.normalise(frames.priced(frames.option_items(option_frames(spark, sf_dir))))


def event_calendar(spark: SparkSession, *names: str) -> lookup.DayTable:
    return lookup.shared_day_table(use_utc(spark), names or ("NYSE",), *EVENT_DAYS)


def order_calendar(spark: SparkSession, *names: str) -> lookup.DayTable:
    return lookup.shared_day_table(use_utc(spark), names or ("NYSE",), *ORDER_DAYS)


def order_dates(spark: SparkSession, sf_dir: str, years: int = 0) -> DataFrame:
    """Orders per date, dates optionally moved by whole years: (day, orders)."""
    day = F.col("o_orderdate").cast("date")
    orders = table(spark, sf_dir, "orders").where(within(day, ORDER_RANGE))
    if years:
        day = F.add_months(day, 12 * years)
    return (orders.groupBy(day.alias("day"))
            .agg(F.count("*").alias("orders")))
