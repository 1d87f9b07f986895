"""Equity feed: source, field, tag, rejection and envelope queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticktide import dims
from ticktide.functions import decimals, messages, symbols, tags
from ticktide.operators import equity, lookups, quality, tables
from ticktide.plans import oracle as o
from ticktide.plans import views
from ticktide.plans.registry import query
from ticktide.sources import landing

AS_OF = "2024-01-20 12:00:00"


@query("s01_equity_feed", o.with_(o.TBBO) + """
SELECT rtype, publisher_id, instrument_id, ts_event, cents * 10000000 AS price, size, side, flags,
  CAST(event_id AS BIGINT) AS sequence FROM tbbo""")
def equity_feed(spark, sf_dir):
    return views.tbbo_raw(views.table(spark, sf_dir, "events")).select(
        "rtype", "publisher_id", "instrument_id", "ts_event", "price", "size", "side", "flags",
        "sequence")


@query("s02_book_records", o.with_(o.TBBO) + """
SELECT publisher_id, count(*) AS records FROM tbbo WHERE rtype = 'mbp-1' GROUP BY publisher_id""")
def book_records(spark, sf_dir):
    raw = views.tbbo_raw(views.table(spark, sf_dir, "events"))
    return landing.book_records(raw).groupBy("publisher_id").agg(F.count("*").alias("records"))


@query("s03_bounded_replay", f"""
SELECT event_id, epoch_us(ts) AS ts FROM events
WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL '23:59:59'""")
def bounded_replay(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    as_of = F.lit(AS_OF).cast("timestamp")
    return landing.replayed(events, F.col("ts"), as_of).select("event_id", "ts")


@query("s16_retention", f"""
SELECT event_type, count(*) AS kept FROM events
WHERE epoch_us(ts) // 1000 > epoch_ms(TIMESTAMP '{AS_OF}') - 604800000 GROUP BY event_type""")
def retention(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    kept = landing.retained(events, F.col("ts"), F.lit(AS_OF).cast("timestamp"), 604_800_000)
    return kept.groupBy("event_type").agg(F.count("*").alias("kept"))


def _fields(name: str, columns: list[str], sql: str):
    @query(name, o.EQUITY + f"SELECT sequence, {sql} FROM eq")
    def run(spark, sf_dir):
        return views.equity_records(spark, sf_dir).select("sequence", *columns)
    return run


_fields("p01_millisecond_times", ["received_ts", "out_ts", "timestamp"],
        'received_ts, out_ts, "timestamp"')
_fields("p02_venue", ["publisher_id", "venue"], "publisher_id, venue")
_fields("p03_symbol", ["instrument_id", "symbol"], "instrument_id, symbol")
_fields("p04_quantity", ["qty"], "qty")
_fields("p05_exact_prices", ["price", "bid_px", "ask_px"],
        "price::VARCHAR AS price, bid_px::VARCHAR AS bid_px, ask_px::VARCHAR AS ask_px")
_fields("p06_pass_through", ["side", "flags", "depth"], "side, flags, depth")
_fields("p07_top_of_book", ["bid_qty", "ask_qty", "bid_ct", "ask_ct"],
        "bid_qty, ask_qty, bid_ct, ask_ct")


def _tagged(name: str, tag: str):
    @query(name, o.EQUITY + f"""
SELECT sequence, list_contains(string_split(tags, '|'), '{tag}') AS tagged FROM eq""")
    def run(spark, sf_dir):
        return views.equity_records(spark, sf_dir).select(
            "sequence", F.array_contains("tags", tag).alias("tagged"))
    return run


_tagged("p08_above_ask", "ABOVE_ASK")
_tagged("p09_below_bid", "BELOW_BID")
_tagged("p10_whale", "WHALE")


@query("q01_raw_whale", o.with_(o.TBBO) + """
SELECT count(*) AS records, count(*) FILTER (cents::HUGEINT * 10000000 * size > 1000000) AS raw_whales,
  count(*) FILTER (cents::HUGEINT * size > 100000000) AS whales FROM tbbo""")
def raw_whale(spark, sf_dir):
    raw = views.tbbo_raw(views.table(spark, sf_dir, "events"))
    price = decimals.feed_price(F.col("price"))
    return raw.agg(F.count("*").alias("records"),
                   F.count(tags.raw_whale(F.col("price"), F.col("size"))).alias("raw_whales"),
                   F.count(tags.whale(price, F.col("size"))).alias("whales"))


@query("p11_quarantine", o.EQUITY + "SELECT sequence, reason FROM eq WHERE reason <> ''")
def quarantine(spark, sf_dir):
    return quality.quarantine(views.equity_records(spark, sf_dir)).select("sequence", "reason")


@query("p12_flag_bits", o.EQUITY + """
SELECT sequence, flags & 128 <> 0 AS flag_last, flags & 64 <> 0 AS flag_tob,
  flags & 32 <> 0 AS flag_snapshot, flags & 16 <> 0 AS flag_mbp, flags & 8 <> 0 AS flag_bad_ts_recv,
  flags & 4 <> 0 AS flag_maybe_bad_book, flags & 2 <> 0 AS flag_publisher_specific FROM eq""")
def flag_bits(spark, sf_dir):
    bits = equity.flag_columns(F.col("flags"))
    return views.equity_records(spark, sf_dir).select(
        "sequence", *[c.alias(n) for n, c in bits.items()])


@query("p13_published_equity_trades", o.EQUITY + """
SELECT received_ts, out_ts, "timestamp", symbol, qty, price::VARCHAR AS price, side, venue,
  bid_px::VARCHAR AS bid_px, ask_px::VARCHAR AS ask_px, bid_qty, ask_qty, bid_ct, ask_ct, sequence,
  flags, depth, tags FROM eqv""")
def published(spark, sf_dir):
    return views.equity_trades(spark, sf_dir)


# --- lookups --------------------------------------------------------------

@query("j01_publisher_lookup", o.with_(o.PUBLISHERS, o.TBBO) + """
SELECT publisher, count(*) AS trades FROM tbbo LEFT JOIN pub USING (publisher_id) GROUP BY publisher""")
def publisher_lookup(spark, sf_dir):
    raw = views.tbbo_raw(views.table(spark, sf_dir, "events"))
    named = lookups.lookup(raw, dims.publishers(spark).select("publisher_id", "publisher"),
                           ["publisher_id"])
    return named.groupBy("publisher").agg(F.count("*").alias("trades"))


@query("j02_symbology_lookup", o.with_(o.TBBO, o.SYMBOLOGY) + """
SELECT event_id AS sequence, symbol FROM tbbo LEFT JOIN sym USING (instrument_id)""")
def symbology_lookup(spark, sf_dir):
    """The shuffled and salted form, which does not rely on a small dimension."""
    events = views.table(spark, sf_dir, "events")
    raw = views.tbbo_raw(events).select("instrument_id", F.col("sequence").cast("bigint").alias("sequence"))
    return lookups.salted_lookup(raw, views.symbology(events), ["instrument_id"]).select(
        "sequence", "symbol")


@query("j03_venue_and_dataset", o.with_(
    o.values("ven", "venue_id, venue", list(dims.VENUES.items())),
    o.values("ds", "dataset_id, dataset_name", list(dims.DATASETS.items()))) + """
SELECT event_id, venue, dataset_name FROM events
LEFT JOIN ven ON venue_id = event_id % 43 + 1 LEFT JOIN ds ON dataset_id = event_id % 31 + 1""")
def venue_and_dataset(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") % 43 + 1).cast("int").alias("venue_id"),
        (F.col("event_id") % 31 + 1).cast("int").alias("dataset_id"))
    named = lookups.lookup(events, dims.venues(spark), ["venue_id"])
    return lookups.lookup(named, dims.datasets(spark), ["dataset_id"]).select(
        "event_id", "venue", "dataset_name")


@query("j04_provider_round_trip", o.with_(o.values(
    "prov", "provider_id, provider, provider_type, description", dims.PROVIDERS),
    "inv AS (SELECT provider, max(provider_id) AS canonical_id FROM prov GROUP BY provider)") + """
SELECT event_id, prov.provider, provider_type, canonical_id
FROM events LEFT JOIN prov ON provider_id = 1001 + event_id % 25
LEFT JOIN inv ON inv.provider = prov.provider""")
def provider_round_trip(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").select(
        "event_id", (F.lit(1001) + F.col("event_id") % 25).cast("int").alias("provider_id"))
    table = dims.providers(spark)
    inverse = lookups.last_id_by_symbol(table).withColumnRenamed("provider_id", "canonical_id")
    named = lookups.lookup(events, table, ["provider_id"])
    return lookups.lookup(named, inverse, ["provider"]).select(
        "event_id", "provider", "provider_type", "canonical_id")


# --- envelope -------------------------------------------------------------

@query("s08_message_envelope", o.EQUITY + """
SELECT 'equity_trades' AS topic, symbol || '.' || sequence AS key, "timestamp",
  'pipeline_id=equity_trades|entitlement_id=none|schema_version=1|ts_ms=' || "timestamp" AS headers
FROM eqv""")
def message_envelope(spark, sf_dir):
    trades = views.equity_trades(spark, sf_dir)
    key = messages.composite_key(F.col("symbol"), F.col("sequence"))
    sent = tables.envelope(trades, "equity_trades", key, tables.json_value(trades), F.col("timestamp"))
    shown = F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), F.decode(h["value"], "UTF-8")))
    return sent.select("topic", F.decode("key", "UTF-8").alias("key"), "timestamp",
                       shown.alias("headers"))


@query("f02_f03_f04_message_hooks", """
SELECT event_type AS topic, CASE WHEN event_id % 3 = 0 THEN 'k' || event_id
    ELSE sha256(event_id || '|' || user_id) END AS key,
  CASE WHEN event_id % 5 <> 0 THEN epoch_us(ts) // 1000 END AS "timestamp",
  'dataset_id=user' || user_id || '|pipeline_id=' || event_type || '|entitlement_id=none|schema_version=3'
    || CASE WHEN event_id % 5 <> 0 THEN '|ts_ms=' || epoch_us(ts) // 1000 ELSE '' END
    || CASE WHEN event_id % 2 = 0 THEN '|k=' || json_extract_string(props, '$.k') ELSE '' END AS headers
FROM events""")
def message_hooks(spark, sf_dir):
    """A feed's own key, event time and headers; what a record lacks gets no header."""
    events = views.table(spark, sf_dir, "events")
    given = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("k"), F.col("event_id")))
    instant = F.when(F.col("event_id") % 5 != 0, F.unix_millis(F.col("ts").cast("timestamp")))
    even = F.when(F.col("event_id") % 2 == 0, F.from_json("props", "k int")["k"])
    sent = tables.envelope(
        events, "events", messages.key_or_generated(given, F.col("event_id"), F.col("user_id")),
        F.encode("props", "UTF-8"), instant, schema_version=3,
        extra={"dataset_id": F.concat(F.lit("user"), F.col("user_id")), "pipeline_id": F.col("event_type"), "k": even})
    shown = F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), F.decode(h["value"], "UTF-8")))
    topic = messages.header_value(F.col("headers"), "pipeline_id")
    return sent.select(topic.alias("topic"), F.decode("key", "UTF-8").alias("key"), "timestamp", shown.alias("headers"))


@query("g05_publisher_parts", o.with_(o.PUBLISHERS, o.TBBO) + """
SELECT event_id AS sequence, split_part(publisher, '.', 1) AS dataset, split_part(publisher, '.', 2) AS feed
FROM tbbo JOIN pub USING (publisher_id)""")
def publisher_parts(spark, sf_dir):
    raw = views.tbbo_raw(views.table(spark, sf_dir, "events"))
    table = dims.publishers(spark).select("publisher_id", "publisher")
    named = lookups.lookup(raw, table, ["publisher_id"], "inner")
    return named.select(F.col("sequence").cast("bigint").alias("sequence"),
                        symbols.dotted_part(F.col("publisher"), 1).alias("dataset"),
                        symbols.dotted_part(F.col("publisher"), 2).alias("feed"))


@query("g06_tag_counts", o.EQUITY + """, t AS (
  SELECT unnest(string_split(tags, '|')) AS tag FROM eqv WHERE tags <> '')
SELECT tag, count(*) AS trades FROM t GROUP BY tag""")
def tag_counts(spark, sf_dir):
    return (views.equity_trades(spark, sf_dir).select(F.explode("tags").alias("tag"))
            .groupBy("tag").agg(F.count("*").alias("trades")))


@query("g07_header_lookup", """
SELECT event_id, event_type AS source_id, CASE WHEN event_id % 4 <> 0 THEN 'user' || user_id END AS dataset_id,
  CASE WHEN event_id % 4 <> 0 THEN 3 ELSE 2 END AS n_headers FROM events""")
def header_lookup(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    built = messages.headers({
        "source_id": F.col("event_type"),
        "dataset_id": F.when(F.col("event_id") % 4 != 0, F.concat(F.lit("user"), F.col("user_id"))),
        "schema_version": F.lit(1)})
    return events.withColumn("h", built).select(
        "event_id", messages.header_value(F.col("h"), "source_id").alias("source_id"),
        messages.header_value(F.col("h"), "dataset_id").alias("dataset_id"),
        F.size("h").alias("n_headers"))


@query("g08_subject_names", """
SELECT event_type || '-value' AS value_subject, event_type || '-key' AS key_subject, count(*) AS n
FROM events GROUP BY event_type""")
def subject_names(spark, sf_dir):
    topic = F.col("event_type")
    return (views.table(spark, sf_dir, "events")
            .groupBy(messages.subject(topic, "value").alias("value_subject"),
                     messages.subject(topic, "key").alias("key_subject"))
            .agg(F.count("*").alias("n")))


@query("g09_key_or_generated", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'k' || event_id
  ELSE sha256(event_id || '|' || user_id) END AS key FROM events""")
def key_or_generated(spark, sf_dir):
    key = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("k"), F.col("event_id")))
    return views.table(spark, sf_dir, "events").select(
        "event_id", messages.key_or_generated(key, F.col("event_id"), F.col("user_id")).alias("key"))


@query("g10_composite_key", o.with_(o.TBBO) + """
SELECT publisher_id || '.' || instrument_id || '.' || event_id AS key FROM tbbo""")
def composite_key(spark, sf_dir):
    return views.tbbo_raw(views.table(spark, sf_dir, "events")).select(messages.composite_key(
        F.col("publisher_id"), F.col("instrument_id"), F.col("sequence")).alias("key"))


@query("g12_frame_split", """
SELECT event_id, CASE WHEN event_id % 9 NOT IN (0, 1) THEN user_id END AS schema_id,
  CASE WHEN event_id % 9 NOT IN (0, 1) THEN event_type END AS payload,
  CASE event_id % 9 WHEN 0 THEN 'frame too short' WHEN 1 THEN 'unexpected magic byte' END AS reason
FROM events""")
def frame_split(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    good = messages.frame(F.col("user_id"), F.encode("event_type", "UTF-8"))
    wire = (F.when(F.col("event_id") % 9 == 0, F.substring(good, 1, 5))
            .when(F.col("event_id") % 9 == 1, F.unhex(F.concat(F.lit("01"), F.hex(good))))
            .otherwise(good))
    parts = messages.split_frame(F.col("wire"))
    return events.withColumn("wire", wire).select(
        "event_id", parts["schema_id"].alias("schema_id"),
        F.decode(parts["payload"], "UTF-8").alias("payload"), parts["reason"].alias("reason"))
