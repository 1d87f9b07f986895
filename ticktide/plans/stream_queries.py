"""The same results from streams: files in, available input processed, files out."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticktide import dims
from ticktide.operators import equity, lookups, tables
from ticktide.plans import bar_queries, views
from ticktide.plans import oracle as o
from ticktide.plans.registry import query
from ticktide.session import shared_folder
from ticktide.sources.landing import book_records
from ticktide.streaming import commits, delivery, jobs, keyed

DELAY_US = 600_000_000


def trade_stream(spark, sf_dir):
    """Valid equity trades as a stream; dimensions are joined statically."""
    raw = views.tbbo_raw(views.event_stream(spark, sf_dir))
    static = views.symbology(views.table(spark, sf_dir, "events"))
    records = equity.normalise(raw, dims.publishers(spark), static)
    return equity.published(records)


@query("x01_streamed_equity_trades", o.EQUITY + """
SELECT sequence, "timestamp", symbol, qty, price::VARCHAR AS price, venue, tags FROM eqv""")
def streamed_equity_trades(spark, sf_dir):
    return jobs.run_to_files(trade_stream(spark, sf_dir), "trades").select(
        "sequence", "timestamp", "symbol", "qty", "price", "venue", "tags")


@query("x02_event_time", o.EQUITY + """
SELECT sequence, "timestamp" * 1000 AS ts FROM eqv""")
def event_time(spark, sf_dir):
    timed = jobs.with_event_time(trade_stream(spark, sf_dir), F.col("timestamp"), "10 minutes")
    return jobs.run_to_files(timed.select("sequence", "ts"), "event-time")


@query("x04_streamed_deduplication", o.with_(o.TBBO) + """
SELECT CAST(event_id AS BIGINT) AS sequence, instrument_id, ts_event FROM tbbo WHERE rtype = 'mbp-1'""")
def streamed_deduplication(spark, sf_dir):
    """A feed that delivers a slice twice; the state holds a day of keys."""
    raw = book_records(views.tbbo_raw(bar_queries.replayed(views.event_stream(spark, sf_dir))))
    timed = raw.withColumn("ts", F.timestamp_micros(F.floor(F.col("ts_event") / 1000)))
    once = tables.deduplicate(timed, ["instrument_id", "ts_event", "sequence"], "ts", "24 hours")
    return jobs.run_to_files(once.select("sequence", "instrument_id", "ts_event"), "dedup")


@query("x05_stream_static_symbology", o.with_(o.TBBO, o.SYMBOLOGY) + """
SELECT CAST(event_id AS BIGINT) AS sequence, symbol FROM tbbo LEFT JOIN sym USING (instrument_id)""")
def stream_static_symbology(spark, sf_dir):
    raw = views.tbbo_raw(views.event_stream(spark, sf_dir)).select("instrument_id", "sequence")
    static = views.symbology(views.table(spark, sf_dir, "events"))
    return jobs.run_to_files(lookups.lookup(raw, static, ["instrument_id"]).select("sequence", "symbol"),
                             "symbology")


def _closed(width_us: int, slide_us: int) -> str:
    """Windows that the watermark has closed when all input is read."""
    return o.EQUITY + f""", w AS (
  SELECT *, "timestamp" * 1000 AS us, "timestamp"::HUGEINT * 4294967296 + sequence AS ord FROM eqv),
wide AS (
  SELECT *, us - us % {slide_us} - unnest(range(0, {width_us // slide_us})) * {slide_us} AS bar_start FROM w),
mark AS (SELECT max(us) - {DELAY_US} AS us FROM w)
SELECT symbol, bar_start, bar_start + {width_us} AS bar_end,
  CAST(arg_min(price, ord) AS DECIMAL(16,4))::VARCHAR AS open, max(price)::VARCHAR AS high, min(price)::VARCHAR AS low,
  CAST(arg_max(price, ord) AS DECIMAL(16,4))::VARCHAR AS price, CAST(sum(qty) AS BIGINT) AS volume,
  count(*) AS trades
FROM wide WHERE bar_start + {width_us} <= (SELECT us FROM mark) GROUP BY symbol, bar_start"""


def timed_stream(spark, sf_dir):
    return trade_stream(spark, sf_dir).withColumn("ts", F.timestamp_millis("timestamp"))


@query("x06_streamed_bars", _closed(3_600_000_000, 3_600_000_000))
def streamed_bars(spark, sf_dir):
    return jobs.run_to_files(
        jobs.windowed_bars(timed_stream(spark, sf_dir), "1 hour", "10 minutes"), "bars")


@query("x06_streamed_sliding_bars", _closed(7_200_000_000, 3_600_000_000))
def streamed_sliding_bars(spark, sf_dir):
    return jobs.run_to_files(jobs.windowed_bars(
        timed_stream(spark, sf_dir), "2 hours", "10 minutes", slide="1 hour"), "sliding")


_GAPS = o.EQUITY + """, w AS (
  SELECT *, "timestamp" * 1000 AS us, "timestamp"::HUGEINT * 4294967296 + sequence AS ord FROM eqv),
b AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY symbol ORDER BY us) < 7200000000 THEN 0 ELSE 1 END AS fresh FROM w),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY symbol ORDER BY us, ord) AS grp FROM b)
SELECT symbol, min(us) AS bar_start, max(us) + 7200000000 AS bar_end, count(*) AS trades,
  CAST(sum(qty) AS BIGINT) AS volume FROM g GROUP BY symbol, grp"""


@query("x06_streamed_gap_bars", _GAPS + f" HAVING max(us) + 7200000000 <= (SELECT max(us) - {DELAY_US} FROM w)")
def streamed_gap_bars(spark, sf_dir):
    bars = jobs.gap_bars(timed_stream(spark, sf_dir), "2 hours", "10 minutes")
    return jobs.run_to_files(bars, "gaps").select("symbol", "bar_start", "bar_end", "trades", "volume")


@query("x06_gap_bars", _GAPS)
def gap_bars(spark, sf_dir):
    """Session windows over the whole table, in batch."""
    from ticktide.operators.bars import gap_bars as bars_by_gap
    trades = views.timed_equity_trades(spark, sf_dir)
    return bars_by_gap(trades, "2 hours").select("symbol", "bar_start", "bar_end", "trades", "volume")


@query("x07_late_trades", o.EQUITY.rstrip() + """,
t AS (SELECT *, "timestamp" * 1000 AS us, sequence % 7 = 3 AS held FROM eqv),
marks AS (SELECT max(us) FILTER (NOT held) - 600000000 AS first, max(us) - 600000000 AS last FROM t),
placed AS (SELECT *, us - us % 3600000000 + 3600000000 AS bar_end FROM t, marks),
counted AS (
  SELECT symbol, bar_end, count(*) AS trades FROM placed
  WHERE NOT (held AND bar_end <= first) GROUP BY symbol, bar_end, last HAVING bar_end <= last)
SELECT (SELECT count(*) FROM counted) AS bars, (SELECT CAST(sum(trades) AS BIGINT) FROM counted) AS trades,
  (SELECT count(*) FROM placed WHERE held AND bar_end <= first) AS late""")
def late_trades(spark, sf_dir):
    """A feed in two deliveries: the second brings every seventh trade, most of
    them behind the watermark that the query reported after the first. Bars leave
    them out; their number is a result. The streams run while this is built."""
    root = shared_folder(spark, "late")
    held = F.col("sequence") % 7 == 3
    trades = views.timed_equity_trades(spark, sf_dir).select(
        "sequence", "symbol", "timestamp", "ts", "price", "qty")
    for part in (~held, held):
        trades.where(part).write.mode("append").parquet(f"{root}/feed")
        stream = spark.readStream.schema(trades.schema).parquet(f"{root}/feed")
        done = jobs.write_files(jobs.windowed_bars(stream, "1 hour", "10 minutes"), f"{root}/bars", f"{root}/checkpoint")
        done.awaitTermination()
        if part is not held:
            mark = F.lit(jobs.watermark(done)).cast("timestamp")
    end = F.window("ts", "1 hour")["end"]
    late = trades.where(held & (end <= mark)).count()
    return spark.read.parquet(f"{root}/bars").agg(
        F.count("*").alias("bars"), F.sum("trades").alias("trades"), F.lit(late).cast("bigint").alias("late"))


@query("x03_idempotent_batches", o.EQUITY + "SELECT symbol, count(*) AS trades FROM eqv GROUP BY symbol")
def idempotent_batches(spark, sf_dir):
    """Every batch counts once, from its commit on."""
    root = shared_folder(spark, "batches")
    stream = trade_stream(spark, sf_dir)
    jobs.write_batches(stream, commits.committed_folder(f"{root}/table"), f"{root}/checkpoint").awaitTermination()
    return commits.committed(spark, f"{root}/table", stream.schema).groupBy("symbol").agg(F.count("*").alias("trades"))


@query("x10_streamed_compaction", """
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def streamed_compaction(spark, sf_dir):
    """A batch rewrites the key buckets that it touches."""
    root = shared_folder(spark, "compaction")
    stream = views.event_stream(spark, sf_dir).select("user_id", "event_id", "event_type")
    sink = commits.compacted_table(f"{root}/table", ["user_id"], "event_id", buckets=8)
    jobs.write_batches(stream, sink, f"{root}/checkpoint").awaitTermination()
    return commits.compacted(spark, f"{root}/table", stream.schema)


@query("a12_x09_batch_statistics", o.EQUITY + """
SELECT 'equity_trades' AS topic, count(*) AS records, CAST(sum(qty) AS BIGINT) AS volume FROM eqv""")
def batch_statistics(spark, sf_dir):
    root = shared_folder(spark, "statistics")
    handle = jobs.statistics_sink(f"{root}/stats", jobs.idempotent_folder(f"{root}/data"), "equity_trades",
                                  {"records": F.count("*"), "volume": F.sum("qty")})
    jobs.write_batches(trade_stream(spark, sf_dir), handle, f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/stats").groupBy("topic").agg(
        F.sum("records").alias("records"), F.sum("volume").alias("volume"))


@query("s09_s13_file_round_trip", o.EQUITY + "SELECT sequence, price::VARCHAR AS price, tags FROM eqv")
def file_round_trip(spark, sf_dir):
    """Objects written by the configured file output and read by the file input."""
    from ticktide.sources.external import read_input, write_output
    path = shared_folder(spark, "objects")
    trades = views.equity_trades(spark, sf_dir).select("sequence", "price", "tags")
    write_output(trades, {"type": "file", "path": path, "format": "parquet"})
    return read_input(spark, {"type": "file", "path": path, "schema": trades.schema})


@query("f05_feed_hooks", o.EQUITY + """
SELECT symbol, count(*) AS trades FROM eqv GROUP BY symbol""")
def feed_hooks(spark, sf_dir):
    """A feed job as three functions: validate, extract, coerce."""
    events = views.table(spark, sf_dir, "events")
    publishers, symbology = dims.publishers(spark), views.symbology(events)
    trades = jobs.transform_stream(
        views.tbbo_raw(events), book_records,
        lambda raw: equity.normalise(raw, publishers, symbology), equity.published)
    return trades.groupBy("symbol").agg(F.count("*").alias("trades"))


@query("x05_streamed_symbology_changes", """
WITH e AS (SELECT *, epoch_us(ts) AS us, user_id % 10 AS instrument_id FROM events),
mark AS (SELECT max(us) // 1000 * 1000 - 600000000 AS us FROM e),
m AS (SELECT instrument_id, us, max('S' || lpad(event_id::VARCHAR, 12, '0')) AS symbol FROM e
  WHERE event_type = 'signup' GROUP BY instrument_id, us),
t AS (SELECT event_id, instrument_id, us FROM e WHERE event_type <> 'signup' AND us <= (SELECT us FROM mark))
SELECT event_id, symbol FROM t ASOF LEFT JOIN m ON t.instrument_id = m.instrument_id AND t.us >= m.us""")
def streamed_symbology_changes(spark, sf_dir):
    """Symbols change while the stream runs; each trade gets the symbol of its time."""
    events = views.event_stream(spark, sf_dir).select(
        "event_id", "event_type", (F.col("user_id") % 10).alias("instrument_id"), F.col("ts").cast("timestamp").alias("ts"))
    changing = F.col("event_type") == "signup"
    symbol = F.concat(F.lit("S"), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    found = keyed.asof_lookup(
        events.where(~changing).drop("event_type"),
        events.where(changing).select("instrument_id", "ts", symbol.alias("symbol")),
        ["instrument_id"], "ts", ["symbol"], "10 minutes")
    return jobs.run_to_files(found.select("event_id", "symbol"), "symbol-changes")


@query("a06_w06_streamed_running_total", """
WITH c AS (SELECT event_type, epoch_us(ts) - epoch_us(ts) % 3600000000 AS interval_us, count(*) AS messages
  FROM events GROUP BY ALL),
t AS (SELECT *, CAST(sum(messages) OVER (PARTITION BY event_type ORDER BY interval_us) AS BIGINT) AS all_time FROM c)
SELECT * FROM t WHERE interval_us + 3600000000 <= (SELECT max(epoch_us(ts)) // 1000 * 1000 - 600000000 FROM events)""")
def streamed_running_total(spark, sf_dir):
    """Messages of an hour and of all hours so far, by topic."""
    root = shared_folder(spark, "running")
    events = views.event_stream(spark, sf_dir).select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    counts = keyed.interval_counts(events, "ts", 3600, "10 minutes", ["event_type"])
    sink = keyed.totals_sink(f"{root}/table", ["event_type"], 3600)
    jobs.write_batches(counts, sink, f"{root}/checkpoint").awaitTermination()
    return commits.committed(spark, f"{root}/table", keyed.totals_schema(counts))


@query("s12_s13_streamed_upsert", """
SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id""")
def streamed_upsert(spark, sf_dir):
    """A stream into the output that its configuration declares, an upserted table."""
    from ticktide.sources.external import write_stream
    root = shared_folder(spark, "upsert")
    stream = views.event_stream(spark, sf_dir).select("user_id", "event_id", "value")
    config = {"type": "table", "path": f"{root}/table", "keys": ["user_id"], "version": "event_id", "buckets": 8}
    write_stream(stream, config, f"{root}/checkpoint").awaitTermination()
    return commits.compacted(spark, f"{root}/table", stream.schema)


# Topics, keys and values that a broker refuses, by event; bytes of key and value in ``size``.
MESSAGES = """WITH msg AS (
  SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'no topic ' || event_type ELSE event_type END AS topic,
    CASE WHEN event_id % 7 <> 0 THEN 'u' || user_id END AS key,
    CASE WHEN event_id % 14 <> 0 THEN props END AS value FROM events),
judged AS (SELECT *, CASE WHEN contains(topic, ' ') THEN 'illegal topic name'
    WHEN key IS NULL AND value IS NULL THEN 'no key'
    WHEN coalesce(strlen(key), 0) + coalesce(strlen(value), 0) > 12 THEN 'message too large' END AS refusal FROM msg)
"""


def _delivered(spark, sf_dir, purpose):
    events, n = views.event_stream(spark, sf_dir), F.col("event_id")
    messages = events.select(
        "event_id", F.when(n % 11 == 0, F.concat(F.lit("no topic "), F.col("event_type")))
        .otherwise(F.col("event_type")).alias("topic"),
        F.when(n % 7 != 0, F.concat(F.lit("u"), F.col("user_id"))).alias("key"),
        F.when(n % 14 != 0, F.col("props")).alias("value"))
    root = shared_folder(spark, purpose)
    sink = delivery.delivered(commits.committed_folder(f"{root}/sent"), f"{root}/refused", max_bytes=12)
    jobs.write_batches(messages, sink, f"{root}/checkpoint").awaitTermination()
    return root, messages.schema


@query("f06_undelivered_messages", MESSAGES + """
SELECT event_id, topic, key, value, refusal FROM judged WHERE refusal IS NOT NULL""")
def undelivered_messages(spark, sf_dir):
    """What a broker would refuse is kept with the reason, message by message."""
    root, schema = _delivered(spark, sf_dir, "undelivered")
    return delivery.undelivered(spark, f"{root}/refused", schema)


@query("f06_delivered_messages", MESSAGES + """
SELECT topic, count(*) AS messages, count(key) AS keyed, count(value) AS valued FROM judged
WHERE refusal IS NULL GROUP BY topic""")
def delivered_messages(spark, sf_dir):
    """All other messages of the same stream, once each."""
    root, schema = _delivered(spark, sf_dir, "delivered")
    sent = commits.committed(spark, f"{root}/sent", schema)
    return sent.groupBy("topic").agg(F.count("*").alias("messages"), F.count("key").alias("keyed"),
                                     F.count("value").alias("valued"))
