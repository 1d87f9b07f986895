"""Trading index: the bar timestamps of a schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

DAY_SECONDS = 86_400


def parts(schedule: DataFrame) -> DataFrame:
    """Trading stretches ``start``/``end``: one per session, two with a break.

    A break that ends after the close is ignored here; ``violations`` reports it.
    Stretches of no length are dropped. No second scan: the parts are an array.
    """
    broken = (F.col("break_start").isNotNull() & F.col("break_end").isNotNull()
              & (F.col("break_end") <= F.col("market_close")))
    piece = lambda a, b: F.struct(F.col(a).alias("start"), F.col(b).alias("end"))
    pieces = F.when(broken, F.array(piece("market_open", "break_start"),
                                    piece("break_end", "market_close"))).otherwise(
        F.array(piece("market_open", "market_close")))
    return (schedule.select("calendar", "session_date", F.posexplode(pieces).alias("part", "span"))
            .select("calendar", "session_date", "part", "span.start", "span.end")
            .where(F.col("start") != F.col("end")))


def bar_count(start: Column, end: Column, seconds: int) -> Column:
    length = F.unix_seconds(end) - F.unix_seconds(start)
    return F.ceil(length / F.lit(seconds)).cast("int")


def check_frequency(seconds: int) -> None:
    if not 0 < seconds <= DAY_SECONDS:
        raise ValueError("the frequency must be one day or less")


def trading_index(schedule: DataFrame, seconds: int, closed: str | None = "right",
                  force_close: bool | None = True) -> DataFrame:
    """Bar stamps per session: calendar, session_date, ordinal, stamp.

    ``closed`` labels bars by their right or left end, or both; ``force_close``
    True makes the close the last stamp, False drops stamps after the close,
    None leaves them.
    """
    check_frequency(seconds)
    if closed not in ("left", "right", "both", None):
        raise ValueError("closed must be left, right, both or None")
    bars = bar_count(F.col("start"), F.col("end"), seconds)
    first = 1 if closed == "right" else 0
    last = bars - 1 if closed == "left" else bars
    step = lambda i: F.timestamp_seconds(F.unix_seconds("start") + i * F.lit(seconds))
    stamps = F.transform(F.sequence(F.lit(first), last), step)
    if force_close is not None:
        stamps = F.filter(stamps, lambda s: s <= F.col("end"))
        if force_close:
            stamps = F.array_union(stamps, F.array("end"))
    return (parts(schedule)
            .select("calendar", "session_date", "part",
                    F.posexplode(stamps).alias("ordinal", "stamp")))


def stamps(index: DataFrame) -> DataFrame:
    """Distinct stamps per calendar."""
    return index.select("calendar", "stamp").distinct()


def lower_frequency(index: DataFrame, seconds: int) -> DataFrame:
    """A regular grid from the first to the last stamp of each calendar.

    The grid is built day by day, so its rows spread over tasks even when one
    calendar has a long range.
    """
    bounds = index.groupBy("calendar").agg(F.min("stamp").alias("first"), F.max("stamp").alias("last"))
    last_step = F.call_function(
        "div", F.unix_seconds("last") - F.unix_seconds("first"), F.lit(seconds).cast("bigint"))
    chunk = max(1, DAY_SECONDS // seconds)
    chunks = bounds.withColumn("steps", last_step).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("steps"),
                                      F.lit(chunk).cast("bigint"))))
    spread = chunks.repartition("calendar", "chunk")
    stop = F.least(F.col("chunk") + (chunk - 1), F.col("steps"))
    step = F.explode(F.sequence(F.col("chunk"), stop))
    return (spread.withColumn("step", step)
            .select("calendar", F.timestamp_seconds(
                F.unix_seconds("first") + F.col("step") * seconds).alias("stamp")))


def violations(schedule: DataFrame, seconds: int, closed: str | None = "right",
               force_close: bool | None = True) -> DataFrame:
    """Rows of a schedule that an index of this frequency cannot use, with reasons."""
    check_frequency(seconds)
    ordered = Window.partitionBy("calendar").orderBy("start")
    spans = parts(schedule).withColumn("following", F.lead("start").over(ordered))
    end_of_bars = (F.unix_seconds("start")
                   + bar_count(F.col("start"), F.col("end"), seconds) * F.lit(seconds))
    overlap = F.lit(force_close is None and closed != "left") & (
        end_of_bars > F.unix_seconds("following"))
    vanishing = F.lit(force_close is False and closed == "right") & (
        F.unix_seconds("end") - F.unix_seconds("start") < seconds)
    of_bars = spans.select("calendar", "session_date", F.explode(F.filter(F.array(
        F.when(overlap, F.lit("bars overlap the next session")),
        F.when(vanishing, F.lit("session shorter than a bar"))), lambda r: r.isNotNull())
    ).alias("reason"))
    pause = F.col("break_start").isNotNull() & F.col("break_end").isNotNull()
    in_order = ((F.col("market_open") <= F.col("break_start"))
                & (F.col("break_start") <= F.col("break_end"))
                & (F.col("break_end") <= F.col("market_close")))
    of_rows = schedule.select("calendar", "session_date", F.explode(F.filter(F.array(
        F.when(F.col("market_close") < F.col("market_open"), F.lit("close before open")),
        F.when(pause & ~in_order, F.lit("break outside the session"))), lambda r: r.isNotNull())
    ).alias("reason"))
    return of_rows.unionByName(of_bars)
