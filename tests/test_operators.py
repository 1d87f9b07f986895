"""Operators against brute force on small and skewed inputs."""

import itertools
import json
import random
from bisect import bisect_right
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from ticktide import dims, schemas
from ticktide.functions import decimals, tags
from ticktide.operators import bars, equity, lookups, option, quality, tables
from ticktide.plans import views
from ticktide.session import estimated_bytes, local_table, shared_folder
from ticktide.sources import external, frames, landing


def test_lookups_agree_on_a_hot_key(spark):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"))
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    rows = lambda df: sorted((tuple(r) for r in df.select("id", "k", "v").collect()), key=repr)
    plain = rows(facts.join(dim, ["k"], "left"))
    assert rows(lookups.lookup(facts, dim, ["k"])) == plain
    assert rows(lookups.lookup(facts, dim, ["k"], limit=0)) == plain


def test_lookup_broadcasts_only_below_the_limit(spark):
    dim = local_table(spark, [(1, "a")], "k int, v string")
    facts = spark.range(10).select(F.col("id").cast("int").alias("k"))
    assert 0 < estimated_bytes(dim) < 1000
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(lookups.lookup(facts, dim, ["k"]))
    assert "strategy=broadcast" not in plan(lookups.lookup(facts, dim, ["k"], limit=0))


@pytest.mark.parametrize("limit", [4_000_000, 7])
def test_asof_matches_brute_force_with_a_hot_key(spark, limit):
    rng = random.Random(9)
    key = lambda: 0 if rng.random() < 0.5 else rng.randrange(5)
    right = sorted({(key(), rng.randrange(5000)) for _ in range(200)})
    left = [(i, key(), rng.randrange(-100, 6000)) for i in range(500)]
    rdf = spark.createDataFrame([(k, t, f"v{t}") for k, t in right], "k int, rt bigint, v string")
    ldf = spark.createDataFrame(left, "id int, k int, lt bigint")
    got = {r.id: (r.v, r.matched_ts) for r in lookups.asof_backward(
        ldf, rdf, ["k"], "lt", "rt", ["v"], 400, limit).collect()}
    for i, k, t in left:
        times = [x for kk, x in right if kk == k]
        at = bisect_right(times, t)
        assert got[i] == ((f"v{times[at - 1]}", times[at - 1]) if at else (None, None))
    assert len(got) == len(left)


def test_asof_cuts_cells_that_the_right_side_crowds(spark):
    """Few left rows and very many right rows in one cell: no group of the last window holds over an eighth."""
    right = [(0, t, f"v{t}") for t in range(4000)]
    rdf = spark.createDataFrame(right, "k int, rt bigint, v string")
    ldf = spark.createDataFrame([(i, 0, i * 401) for i in range(10)], "id int, k int, lt bigint")
    joined = lookups.asof_backward(ldf, rdf, ["k"], "lt", "rt", ["v"], 10_000, 300)
    assert {(r.id, r.matched_ts) for r in joined.collect()} == {(i, i * 401) for i in range(10)}
    sizes = {}
    plan = lookups.asof_backward(ldf, rdf, ["k"], "lt", "rt", ["v"], 10_000, 300, seen=sizes)
    plan.count()
    groups = [r["count"] for r in sizes["rows"].groupBy("k", "_cell", "_group").count().collect()]
    assert max(groups) <= 4000 / 8 and sum(groups) >= 4010


@pytest.mark.parametrize("cell_us", [1_000_000, 7_000_000, 3_600_000_000])
def test_gap_bars_match_brute_force(spark, cell_us):
    rng = random.Random(5)
    rows = []
    for symbol, n in (("HOT", 400), ("B", 60), ("C", 1)):
        at = -20_000
        for i in range(n):
            at += rng.choice([0, 500, 1000, 1999, 2000, 2001, 9000])
            rows.append((symbol, at, i, float(rng.randrange(50)), rng.randrange(9)))
    df = spark.createDataFrame(rows, "symbol string, timestamp bigint, sequence int, price double, qty int").withColumn(
        "ts", F.timestamp_millis("timestamp"))
    got = sorted((r.symbol, round(r.bar_start.timestamp() * 1000), round(r.bar_end.timestamp() * 1000), r.open, r.high,
                  r.low, r.price, r.volume, r.trades)
                 for r in bars.gap_bars(df, "2 seconds", cell_us=cell_us).collect())
    want = []
    for symbol in ("HOT", "B", "C"):
        own = [r for r in rows if r[0] == symbol]
        groups = [[own[0]]]
        for r in own[1:]:
            groups.append([r]) if r[1] - groups[-1][-1][1] >= 2000 else groups[-1].append(r)
        want += [(symbol, g[0][1], g[-1][1] + 2000, g[0][3], max(r[3] for r in g), min(r[3] for r in g), g[-1][3],
                  sum(r[4] for r in g), len(g)) for g in groups]
    assert got == sorted(want)


def test_orders_outside_the_calendar_are_an_error(spark, tmp_path):
    from ticktide import plans
    orders = spark.createDataFrame([(1, "1995-01-04"), (2, "2001-12-05")], "o_orderkey bigint, day string")
    for extra in ([], ["1994-12-15"], ["2002-01-15"]):
        rows = orders.unionByName(spark.createDataFrame([(9, d) for d in extra], "o_orderkey bigint, day string"))
        folder = str(tmp_path / "-".join(["orders", *extra]))
        rows.select("o_orderkey", F.col("day").cast("timestamp_ntz").alias("o_orderdate")).write.parquet(f"{folder}/orders.parquet")
        for name in ("c06_schedule", "c03_valid_days"):
            query = plans.queries()[name](spark, folder)
            if extra:
                with pytest.raises(Exception, match="no calendar built"):
                    query.collect()
            else:
                assert query.count() == 2


def raw_trade(**changes):
    level = {"bid_px": 1_930_000_000, "ask_px": 1_960_000_000, "bid_sz": 200, "ask_sz": 200, "bid_ct": 0, "ask_ct": 0}
    level.update({k: changes.pop(k) for k in list(changes) if k in level})
    record = dict(rtype="mbp-1", publisher_id=41, instrument_id=18614, ts_event=1734094801744190849,
                  ts_recv=1734094801745205429, ts_out=1734094801745300000, price=1_960_000_000, size=200,
                  action="T", side="N", flags=194, depth=0, sequence=56493, levels=[level])
    return {**record, **changes}


def normalised(spark, *records):
    raw = spark.createDataFrame([tuple(r[f] if f != "levels" else [tuple(x.values()) for x in r[f]]
                                       for f in schemas.TBBO_RAW.fieldNames()) for r in records], schemas.TBBO_RAW)
    symbology = local_table(spark, [(18614, "ABC")], "instrument_id bigint, symbol string")
    return equity.normalise(raw, dims.publishers(spark), symbology)


def test_logged_equity_record(spark):
    row = equity.published(normalised(spark, raw_trade())).first()
    assert (row.timestamp, row.symbol, row.venue, row.price, row.tags) == (
        1734094801744, "ABC", "IEXG", Decimal("1.9600"), [])
    assert row.bid_px == Decimal("1.930000") and row.__fields__ == schemas.EQUITY_TRADES.fieldNames()


def test_undefined_book_and_tags(spark):
    undefined = 9223372036854775807
    rows = normalised(spark, raw_trade(bid_px=undefined, ask_px=undefined), raw_trade(price=2_000_000_000),
                      raw_trade(price=1_900_000_000), raw_trade(size=600_000)).collect()
    assert [r.tags for r in rows] == [[], ["ABOVE_ASK"], ["BELOW_BID"], ["WHALE"]]
    assert rows[0].bid_px is None and rows[0].reason == []


def test_rejected_records_name_every_reason(spark):
    bad = raw_trade(publisher_id=99, instrument_id=1, size=0, price=0)
    marked = normalised(spark, bad, raw_trade(), raw_trade(rtype="ohlcv"))
    assert marked.count() == 2
    assert quality.quarantine(marked).first().reason == [
        "unknown venue", "unknown symbol", "size not positive", "price not positive"]
    path = shared_folder(spark, "routed")
    quality.write_routed(marked, path)
    assert {r.status for r in spark.read.parquet(path).collect()} == {"valid", "quarantine"}


def option_frame(*items, channel="option_trades"):
    return json.dumps([channel, *items])


def from_frames(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return frames.priced(frames.option_items(df))


def test_numeric_zero_is_no_price_but_text_zero_is(spark):
    items = from_frames(spark, option_frame({"id": "a", "price": 0}, {"id": "b", "price": "0"}, {"id": "c"},
                                            {"id": "d", "price": ""}, {"id": "e", "price": 0.0},
                                            {"id": "f", "price": 1.5}, {"price": 0, "id": "g"}))
    assert sorted(r.id for r in items.collect()) == ["b", "f"]


def test_frames_without_items_and_broken_frames(spark):
    assert from_frames(spark, '["option_trades"]', "[]", '["x", {"id', "not json").count() == 0
    broken = frames.bad_frames(spark.createDataFrame([('["x", {"id',), ('["x"]',)], "value string"))
    assert [r.value for r in broken.collect()] == ['["x", {"id']


def test_frames_of_objects_are_read_as_those_taken_apart(spark):
    items = [{"id": "a", "price": 0.5, "tags": "x"}, {"id": {"z": 1}, "price": "0", "tags": ["p", None]}, {}, {"price": 0}]
    read = [sorted(map(str, frames.option_items(spark.createDataFrame([(t,)], "value string")).collect()))
            for t in (option_frame(*items), option_frame(*items, channel="a,b"), option_frame(*items, None, 7, [{}]))]
    assert len(read[0]) == 4 and read[0] == read[1] == read[2]
    bad = spark.createDataFrame([('["x",]',), ('["x",{}',), ('["x",{},null,7]',), ('["x",{},{"a":[1]}]',)], "value string")
    assert set(map(tuple, frames.bad_frames(bad).select("value", "position").collect())) == {
        ('["x",]', None), ('["x",{}', None), ('["x",{},null,7]', 2), ('["x",{},null,7]', 3)}


def test_frames_are_read_by_the_fields_asked_for_and_keep_digits(spark):
    df = spark.createDataFrame([('["x",{"id":"a","price":0.12345678901234567890123}]',)], "value string")
    narrow = lambda *names: frames.option_items(df, schema=T.StructType([T.StructField(n, T.StringType()) for n in names]))
    assert [tuple(r) for r in narrow("id").collect()] == [("a",)]
    assert narrow("price").first().price == "0.12345678901234567890123"


def test_option_defaults(spark):
    row = option.published(option.normalise(from_frames(spark, option_frame({"price": "1.5"})))).first()
    assert (row.id, row.put_call, row.qty, row.side, row.bias, row.tags) == ("", "C", 0, "N", "N", ["ABOVE_ASK"])
    assert (str(row.exp_date), row.dte, row.iv) == ("1970-01-01", -62091, Decimal("0.0000000100000000"))


def test_option_trade_date_follows_the_zone(spark):
    item = {"price": "1", "executed_at": 1704067200000, "expiry": "2024-01-19"}
    items = from_frames(spark, option_frame(item))
    assert option.normalise(items).first().dte == 18
    assert option.normalise(items, "America/New_York").first().dte == 19


def test_option_mapping_failure_is_quarantined(spark):
    items = from_frames(spark, option_frame({"price": "1", "strike": "x", "size": "many"}))
    assert quality.quarantine(option.normalise(items)).first().reason == ["bad strike", "bad qty"]


def test_millionaire_and_side_words(spark):
    item = {"price": "5", "nbbo_bid": "4", "nbbo_ask": "6", "premium": "1000000", "tags": ["ask_side", "bullish", "etf"],
            "report_flags": ["floor"]}
    row = option.published(option.normalise(from_frames(spark, option_frame(item)))).first()
    assert (row.side, row.bias, row.tags) == ("A", "B", ["ETF", "FLOOR", "MILLIONAIRE"])


def test_decimal_texts_read_short_or_wide_alike(spark):
    texts = ["5", "5.00", "-0.12", "0.129", "-0.129", "1e-3", "-6E-3", "1.5e2", "1e12", "99999999999", "9999999999.99", " 7.1 ",
             "7.12345", ".5", "5.", "+3", "-", "x", "", "1.2.3", "0.1234567890123456789", None]
    rows = [(f"{i}", p, b, a) for i, (p, b, a) in enumerate(itertools.product(texts, texts, texts[:8]))]
    items = spark.createDataFrame(rows, "id string, price string, nbbo_bid string, nbbo_ask string")
    for field in schemas.OPTION_ITEM:
        if field.name not in items.columns:
            items = items.withColumn(field.name, F.lit(None).cast(field.dataType))
    wide = {c: F.coalesce(F.col(c), F.lit("0")).try_cast("decimal(38,18)") for c in ("price", "nbbo_bid", "nbbo_ask")}
    exact = items.select("id", *[c.alias(n) for n, c in wide.items()])
    expected = exact.select(
        "id", decimals.coerce_down(F.col("price"), 12, 2), decimals.coerce_down(F.col("nbbo_bid"), 14, 4),
        decimals.coerce_down(F.col("nbbo_ask"), 14, 4), tags.outside_book(F.col("price"), F.col("nbbo_bid"), F.col("nbbo_ask")),
        F.round(tags.bull_bear_score(F.col("price"), F.col("nbbo_bid"), F.col("nbbo_ask"), F.lit("N")), 6).try_cast("decimal(8,6)"))
    for settle in (True, False):
        got = option.normalise(items, settle=settle).select("id", "price", "bid_px", "ask_px", F.try_element_at("tags", F.lit(1)), "score")
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, expected.collect())))


def test_published_option_trades_convert_each_value_once(spark, sf_dir):
    plan = views.option_trades(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    record = plan.split("Generate")[0]
    assert "decimal(38,18)" not in record and "as double)" not in record and "transform(" not in record
    assert plan.count("Generate explode(array(_failed") == 1 and "round(" not in plan and "date_format" not in plan


def test_cents_are_rounded_half_away_from_zero(one):
    values = [0.49999999999999994, 0.5, -0.5, 2.5, -2.5, 1.4999999999999998, 4503599627370495.5, -4503599627370495.5, 84197.04 * 100]
    for value in values:
        row = one("v double", (value,), a=views._half_up(F.col("v")), b=F.round("v").cast("bigint"))
        assert row["a"] == row["b"], value


def test_latest_per_key_and_deduplication(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c"), (1, 7, "b")], "k int, v int, x string")
    assert sorted(map(tuple, tables.latest_per_key(df, ["k"], "v").collect())) == [(1, 7, "b"), (2, 1, "c")]
    assert tables.deduplicate(df, ["k", "v"]).count() == 3


def test_schema_resolution(spark):
    written = spark.createDataFrame([(1, "x", (5,))], "a int, gone string, n struct<p:int>")
    reader = T.StructType([
        T.StructField("n", T.StructType([T.StructField("p", T.LongType()),
                                         T.StructField("q", T.StringType(), False, {"default": "?"})])),
        T.StructField("a", T.LongType(), False), T.StructField("z", T.StringType())])
    assert tables.resolve_schema(written, reader).first().asDict(True) == {
        "n": {"p": 5, "q": "?"}, "a": 1, "z": None}
    with pytest.raises(tables.SchemaMismatch, match="missing"):
        tables.resolve_schema(written, T.StructType([T.StructField("missing", T.IntegerType(), False)]))


def test_coercion_hooks_run_before_the_rule(spark):
    df = spark.createDataFrame([("  1.239 ",)], "amount string")
    schema = T.StructType([T.StructField("amount", T.DecimalType(6, 2))])
    row = tables.coerce_record(df, schema, {"amount": lambda c: F.trim(c).cast("decimal(20,6)")}).first()
    assert row.amount == Decimal("1.23")


def test_throughput_running_total_crosses_days(spark):
    df = spark.range(0, 200).select(F.timestamp_seconds(F.col("id") * 3600).alias("ts"))
    rows = bars.throughput(df, "ts", 7200).orderBy("interval_us").collect()
    assert [r.all_time for r in rows] == list(range(2, 201, 2))


def test_one_symbol_may_hold_all_trades(spark):
    df = spark.range(10_000).select(F.lit("HOT").alias("symbol"), (F.col("id") * 10).alias("timestamp"),
                                    F.col("id").cast("int").alias("sequence"),
                                    F.col("id").cast("decimal(16,4)").alias("price"), F.lit(1).alias("qty"))
    rows = bars.clock_bars(df, 50_000).orderBy("timestamp").collect()
    assert [(r.open, r.price, r.volume) for r in rows] == [(0, 4999, 5000), (5000, 9999, 5000)]


def test_retention_and_replay_without_bounds(spark):
    df = spark.range(5).select(F.timestamp_seconds("id").alias("ts"))
    assert landing.replayed(df, F.col("ts"), None).count() == 5
    assert landing.retained(df, F.col("ts"), F.timestamp_seconds(F.lit(100)), -1).count() == 5


def test_external_endpoints(spark):
    options = external.kafka_read_options("host:9092", "trades", "group")
    assert options["startingOffsets"] == "earliest" and options["kafka.group.id"] == "group"
    if not external.has_source(spark, "kafka"):
        with pytest.raises(RuntimeError):
            external.kafka_scan(spark, "host:9092", "trades")
    for call in (lambda: external.read_input(spark, {"type": "flink"}),
                 lambda: external.read_input(spark, {"type": "file", "format": "xls", "path": "x"}),
                 lambda: external.write_output(spark.range(1), {"type": "flink"})):
        with pytest.raises(ValueError):
            call()
    path = shared_folder(spark, "objects")
    external.write_objects(spark.range(3), path, "parquet")
    with pytest.raises(RuntimeError):
        external.write_objects(spark.range(3), path + "-2", "no-such-format")
    assert spark.read.parquet(path).count() == 3


def test_envelope_has_the_sink_layout(spark):
    df = spark.createDataFrame([("k1", 5)], "k string, ms bigint")
    sent = tables.envelope(df, "t", F.col("k"), tables.json_value(df), F.col("ms"), source_id="s")
    assert sent.schema["headers"].dataType.elementType.fieldNames() == ["key", "value"]
    row = sent.first()
    assert bytes(row.key) == b"k1" and json.loads(bytes(row.value)) == {"k": "k1", "ms": 5}
    assert [h.key for h in row.headers] == ["source_id", "pipeline_id", "entitlement_id", "schema_version", "ts_ms"]


def test_house_provider_is_supplied_by_the_caller(spark):
    assert dims.providers(spark).where("provider_id = 1021").count() == 0
    assert dims.providers(spark, (1021, "HOUSE", "Vendor", "own data")).count() == 24


def test_frames_of_several_schemas(spark):
    from ticktide.functions import messages
    from ticktide.sources import framed
    field = T.StructField
    writers = {1: T.StructType([field("a", T.IntegerType())]),
               2: T.StructType([field("a", T.LongType()), field("b", T.StringType()), field("old", T.StringType())])}
    reader = T.StructType([field("a", T.LongType(), False), field("b", T.StringType(), False, {"default": "none"}),
                           field("c", T.DoubleType())])
    given = [(1, '{"a": 7}'), (2, '{"a": 8, "b": "x", "old": "y"}'), (3, '{"a": 1}'), (2, '{"a": '), (1, ""), (1, None), (2, "[]"),
             (1, '{"a": "text"}'), (2, "{}")]
    frames = spark.createDataFrame([(i, s, p) for i, (s, p) in enumerate(given)], "i int, s int, p string").select(
        "i", messages.frame(F.col("s"), F.encode("p", "UTF-8")).alias("value"), F.lit("kept").alias("_extra"))
    read = framed.resolve_frames(frames, writers, reader)
    assert read.columns == ["i", "value", "_extra", "record", "reason"]
    rows = {r.i: r for r in read.collect()}
    assert len(rows) == len(given)
    assert tuple(rows[0].record) == (7, "none", None) and tuple(rows[1].record) == (8, "x", None)
    assert rows[0].reason is None and rows[1].reason is None
    assert [rows[i].reason for i in (2, 3, 4, 5)] == ["unknown schema id", "unreadable payload", "frame too short", "frame too short"]
    assert all(rows[i].record is None for i in (2, 3, 4, 5, 6, 7))
    assert rows[6].reason == rows[7].reason == "unreadable payload"
    assert tuple(rows[8].record) == (None, None, None)  # an object without fields
    assert framed.resolve_frames(frames, {}, reader).where("reason is null").count() == 0
    with pytest.raises(tables.SchemaMismatch):
        framed.resolve_frames(frames, {1: T.StructType([field("b", T.StringType())])}, reader)
    registry = spark.createDataFrame([(k, w.json()) for k, w in writers.items()] * 2, "schema_id int, schema string")
    assert framed.writer_schemas(registry) == writers
    with pytest.raises(ValueError):
        framed.writer_schemas(registry, most=1)
    with pytest.raises(ValueError):
        framed.writer_schemas(registry.unionByName(registry.withColumn("schema_id", F.lit(1))))
