"""Volume bars per symbol, on the clock or on the market session."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ticktide.calendars.lookup import DayTable, attach, in_session
from ticktide.functions import times

# Feed sequences are unsigned 32-bit numbers: one more than the highest.
SEQUENCES = 1 << 32
# Cells of bars by gap: six hours.
CELL_US = 6 * 3_600_000_000


def arrival_order(ts: str = "timestamp", sequence: str = "sequence") -> Column:
    """One decimal that sorts like (time, sequence).

    A struct would do as well but cannot live in a hash aggregation buffer, and
    the aggregate would fall back to sorting every partition.
    """
    high = F.col(ts).cast("decimal(19,0)") * F.lit(SEQUENCES).cast("decimal(11,0)")
    return high + F.col(sequence).cast("decimal(19,0)")


def bar_measures(order: Column, open_interest: str | None = None,
                 interest_order: Column | None = None) -> dict[str, Column]:
    measures = {
        "open": F.min_by("price", order), "high": F.max("price"), "low": F.min("price"),
        "price": F.max_by("price", order), "volume": F.sum("qty"), "trades": F.count("*"),
    }
    if open_interest:
        measures["oi"] = F.max_by(
            open_interest, interest_order if interest_order is not None else order)
    return measures


def clock_bars(trades: DataFrame, width_ms: int, symbol: str = "symbol", ts: str = "timestamp",
               order: Column | None = None, open_interest: str | None = None,
               interest_order: Column | None = None) -> DataFrame:
    """Bars of ``width_ms`` milliseconds. ``timestamp`` is the start of the bar.

    One shuffle on (symbol, bar). Partial aggregation on the map side reduces a
    hot symbol to one row per bar and task before anything moves.
    """
    start = F.col(ts) - F.pmod(F.col(ts), F.lit(width_ms).cast("bigint"))
    measures = bar_measures(order if order is not None else arrival_order(ts), open_interest,
                            interest_order)
    return (trades.groupBy(F.col(symbol).alias("symbol"), start.alias("bar_start"))
            .agg(*[column.alias(name) for name, column in measures.items()])
            .withColumnRenamed("bar_start", "timestamp"))


def declared_bars(trades: DataFrame) -> DataFrame:
    """Bars in the declared output layout: symbol, timestamp, oi, price."""
    return trades.select("symbol", "timestamp", F.col("oi").cast("int").alias("oi"),
                         F.col("price").cast("decimal(12,2)").alias("price"))


def sliding_bars(trades: DataFrame, width: str, slide: str, symbol: str = "symbol",
                 instant: str = "ts", order: Column | None = None) -> DataFrame:
    """Overlapping windows, batch or streaming."""
    return _windowed(trades, F.window(instant, width, slide), symbol, order)


def gap_bars(trades: DataFrame, gap: str, symbol: str = "symbol", instant: str = "ts",
             order: Column | None = None, cell_us: int = CELL_US) -> DataFrame:
    """Bars that end after a pause of ``gap`` without trades.

    A stream has session windows, which are merged in each task before they move.
    In batch a symbol is cut into time cells, so that a hot one is spread over as
    many tasks as it has cells. Trades of a cell make fragments; only the first
    and the last one of a cell can go on in another, so bars are put together
    from two rows a cell at most.
    """
    order = order if order is not None else arrival_order()
    if trades.isStreaming:
        return _windowed(trades, F.session_window(instant, gap), symbol, order)
    pause = F.expr(f"INTERVAL {gap}")
    cell = times.floor_div(F.unix_micros(instant), cell_us)
    rows = trades.select(F.col(symbol).alias("symbol"), cell.alias("_cell"), F.col(instant).alias("_at"),
                         order.alias("_order"), "price", "qty")
    in_cell = Window.partitionBy("symbol", "_cell").orderBy("_at")
    last = F.lag("_at").over(in_cell)
    fresh = F.when(F.col("_at") < last + pause, 0).otherwise(1)
    rows = rows.withColumn("_fresh", fresh).withColumn("_part", F.sum("_fresh").over(
        in_cell.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    parts = rows.groupBy("symbol", "_cell", "_part").agg(
        F.min("_at").alias("_from"), F.max("_at").alias("_to"), F.min("_order").alias("_low"), F.max("_order").alias("_high"),
        F.min_by("price", "_order").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", "_order").alias("price"), F.sum("qty").alias("volume"), F.count("*").alias("trades"))
    parts = parts.withColumn("_parts", F.max("_part").over(Window.partitionBy("symbol", "_cell")))
    edge = (F.col("_part") == 1) | (F.col("_part") == F.col("_parts"))
    shown = ["symbol", F.col("_from").alias("bar_start"), (F.col("_to") + pause).alias("bar_end"),
             "open", "high", "low", "price", "volume", "trades"]
    by_symbol = Window.partitionBy("symbol").orderBy("_from")
    joins = F.col("_from") < F.lag("_to").over(by_symbol) + pause
    edges = parts.where(edge).withColumn("_fresh", F.when(joins, 0).otherwise(1)).withColumn(
        "_bar", F.sum("_fresh").over(by_symbol.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    joined = edges.groupBy("symbol", "_bar").agg(
        F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.min_by("open", "_low").alias("open"),
        F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("price", "_high").alias("price"),
        F.sum("volume").alias("volume"), F.sum("trades").alias("trades"))
    return parts.where(~edge).select(*shown).unionByName(joined.select(*shown))


def tumbling_bars(trades: DataFrame, width: str, symbol: str = "symbol", instant: str = "ts",
                  order: Column | None = None) -> DataFrame:
    return _windowed(trades, F.window(instant, width), symbol, order)


def _windowed(trades: DataFrame, window: Column, symbol: str, order: Column | None) -> DataFrame:
    measures = bar_measures(order if order is not None else arrival_order())
    grouped = trades.groupBy(F.col(symbol).alias("symbol"), window.alias("bar"))
    return (grouped.agg(*[column.alias(name) for name, column in measures.items()])
            .select("symbol", F.col("bar.start").alias("bar_start"),
                    F.col("bar.end").alias("bar_end"), *measures))


def session_bars(trades: DataFrame, days: DayTable, calendar: str, width_ms: int,
                 closed: str = "right", symbol: str = "symbol",
                 ts: str = "timestamp") -> DataFrame:
    """Bars that start at the market open instead of the epoch.

    Trades meet the day table on the market's local date, an equality join, so
    no session is searched per trade. Left labels carry the start of a bar,
    right labels its end, the last one cut at the close.
    """
    joined = attach(trades.withColumn("_instant", F.timestamp_millis(F.col(ts))), days, "_instant",
                    calendar)
    t, instant = F.col(ts), F.col("_instant")
    edge = lambda event: F.unix_millis(in_session(instant, event))
    placed = joined.select(symbol, ts, "sequence", "price", "qty",
                           in_session(instant, "session").alias("session_date"),
                           edge("open").alias("_open"), edge("close").alias("_close"))
    placed = placed.where(F.col("session_date").isNotNull())
    ordinal = times.floor_div(t - F.col("_open"), width_ms)
    start = F.col("_open") + ordinal * F.lit(width_ms).cast("bigint")
    label = start if closed == "left" else F.least(start + width_ms, F.col("_close"))
    measures = bar_measures(arrival_order(ts))
    return (placed.groupBy(F.col(symbol).alias("symbol"), "session_date", label.alias("bar"))
            .agg(*[column.alias(name) for name, column in measures.items()])
            .withColumnRenamed("bar", "timestamp"))


def volume_by_side(trades: DataFrame, sides: Mapping[str, str], symbol: str = "symbol") -> DataFrame:
    """Traded volume per symbol and aggressor side; ``sides`` maps output to code."""
    columns = [F.coalesce(F.sum(F.when(F.col("side") == code, F.col("qty"))), F.lit(0)).alias(name)
               for name, code in sides.items()]
    return trades.groupBy(symbol).agg(*columns)


def throughput(messages: DataFrame, instant: str, seconds: int = 15,
               by: list[str] | None = None) -> DataFrame:
    """Messages per interval with the all-time total so far.

    The running total is a prefix sum in two levels: inside each day, then over
    the day totals, so no task has to hold all intervals.
    """
    keys = by or []
    width = seconds * 1_000_000
    micros = F.unix_micros(instant)
    start = micros - F.pmod(micros, F.lit(width).cast("bigint"))
    counts = messages.groupBy(*keys, start.alias("interval_us")).agg(F.count("*").alias("messages"))
    return with_totals(counts, keys).select(*keys, "interval_us", "messages", "all_time")


def with_totals(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``all_time``, the sum of ``messages`` of a key up to ``interval_us``, as a
    prefix sum in two levels. A null is a key like any other."""
    counts = counts.withColumn("_day", times.floor_div(F.col("interval_us"), 86_400_000_000))
    in_day = Window.partitionBy(*keys, "_day").orderBy("interval_us")
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_day").rowsBetween(
        Window.unboundedPreceding, -1)
    days = (counts.groupBy(*keys, "_day").agg(F.sum("messages").alias("_total"))
            .withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0)))
            .select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_day").alias("_of_day"), "_before"))
    same = F.col("_day") == F.col("_of_day")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return (counts.withColumn("_within", F.sum("messages").over(
                in_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .join(days, same).withColumn("all_time", F.col("_before") + F.col("_within"))
            .select(*[c for c in counts.columns if c != "_day"], "all_time"))


def outcome_counts(deliveries: DataFrame) -> DataFrame:
    """Deliveries per topic, partition and status (ok or error)."""
    status = F.when(F.col("error").isNull(), "ok").otherwise("error")
    return deliveries.groupBy("topic", "partition", status.alias("status")).agg(
        F.count("*").alias("messages"))
