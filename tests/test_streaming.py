"""Streams give the batch result; late rows are dropped and counted."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ticktide.operators import tables
from ticktide.session import shared_folder
from ticktide.sources import external
from ticktide.streaming import commits, delivery, jobs, keyed

DDL = "symbol string, timestamp bigint, sequence int, price double, qty int"


def trades(spark, rows):
    return spark.createDataFrame(rows, DDL)


def stream(spark, folder):
    return spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(folder).withColumn(
        "ts", F.timestamp_millis("timestamp"))


def write_one(df, folder, name):
    df.coalesce(1).write.mode("append").parquet(folder)


def test_late_trades_are_dropped_and_counted(spark):
    folder, root = shared_folder(spark, "late-in"), shared_folder(spark, "late-out")
    hour = 3_600_000
    write_one(trades(spark, [("A", hour + 1, 1, 1.0, 1), ("A", 5 * hour, 2, 1.0, 1)]), folder, "a")
    with jobs.progress_log(spark) as log:
        for late in ([], [("A", hour + 2, 3, 1.0, 100), ("A", 9 * hour, 4, 1.0, 1)]):
            if late:
                write_one(trades(spark, late), folder, "b")
            bars = jobs.windowed_bars(stream(spark, folder), "1 hour", "10 minutes")
            jobs.write_files(bars, f"{root}/data", f"{root}/cp").awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    closed = {(r.bar_start.hour, r.volume) for r in spark.read.parquet(f"{root}/data").collect()}
    assert closed == {(1, 1), (5, 1)}
    assert sum(b["late_rows"] for b in log.batches) == 1


def test_replayed_files_change_nothing(spark):
    folder, root = shared_folder(spark, "dedup-in"), shared_folder(spark, "dedup-out")
    rows = [("A", 1000 * (i + 1), i, 1.0, 1) for i in range(50)]
    write_one(trades(spark, rows), folder, "a")
    write_one(trades(spark, rows[20:] + [("A", 60_000, 60, 1.0, 1)]), folder, "b")
    once = tables.deduplicate(stream(spark, folder), ["symbol", "timestamp", "sequence"], "ts", "24 hours")
    jobs.write_files(once, f"{root}/data", f"{root}/cp").awaitTermination()
    out = spark.read.parquet(f"{root}/data")
    assert out.count() == out.select("sequence").distinct().count() == 51


def test_compacted_table_survives_a_repeated_batch(spark):
    path = shared_folder(spark, "compact")
    handle = commits.compacted_table(path, ["symbol"], "sequence")
    first = trades(spark, [("A", 1, 1, 1.0, 1), ("B", 1, 2, 1.0, 1)])
    second = trades(spark, [("A", 2, 3, 1.0, 9)])
    handle(first, 0), handle(second, 1), handle(second, 1), handle(first, 0)
    table = {r.symbol: r.qty for r in commits.compacted(spark, path, first.schema).collect()}
    assert table == {"A": 9, "B": 1}


def test_compaction_rewrites_touched_buckets(spark):
    """Files of other buckets stay as they are; what no commit names any more goes."""
    path = shared_folder(spark, "buckets")
    handle = commits.compacted_table(path, ["symbol"], "sequence", buckets=16)
    log = commits.CommitLog(spark, path)
    expected = {}
    for batch_id in range(6):
        rows = [(f"S{i}", 1, 1000 * batch_id + i, 1.0, batch_id) for i in (range(200) if batch_id == 0 else [batch_id, 77])]
        expected |= {r[0]: r[4] for r in rows}
        handle(trades(spark, rows), batch_id)
        assert log.read(batch_id)["rewritten"] == 16 if batch_id == 0 else log.read(batch_id)["rewritten"] <= 2
    schema = trades(spark, []).schema
    assert {r.symbol: r.qty for r in commits.compacted(spark, path, schema).collect()} == expected
    folders = {(int(p.parent.name[6:]), int(p.name[7:])) for p in Path(path, "data").glob("batch=*/bucket=*")}
    named = {(b, int(k)) for d in (4, 5) for k, b in log.read(d)["buckets"].items()}
    assert named == folders


def test_a_batch_that_fails_before_its_commit_is_not_seen(spark, monkeypatch):
    path = shared_folder(spark, "commits")
    for handle, read in ((commits.committed_folder(f"{path}/a"), lambda s: commits.committed(spark, f"{path}/a", s)),
                         (commits.compacted_table(f"{path}/b", ["sequence"], "timestamp", buckets=4),
                          lambda s: commits.compacted(spark, f"{path}/b", s))):
        batches = [trades(spark, [("A", 1, 10 * b + i, 1.0, 1) for i in range(10)]) for b in range(3)]
        schema = batches[0].schema
        assert read(schema).count() == 0
        handle(batches[0], 0)
        with monkeypatch.context() as m:
            m.setattr(commits.CommitLog, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                handle(batches[1], 1)
        assert read(schema).count() == 10  # neither half a batch nor the whole one
        handle(batches[1], 1), handle(batches[1], 1), handle(batches[2], 2)
        assert read(schema).count() == read(schema).select("sequence").distinct().count() == 30


def test_idempotent_folder_overwrites_its_own_batch(spark):
    path = shared_folder(spark, "idempotent")
    handle = jobs.idempotent_folder(path)
    batch = trades(spark, [("A", 1, 1, 1.0, 1)])
    handle(batch, 0), handle(batch, 0), handle(batch, 1)
    assert spark.read.parquet(path).count() == 2


def test_event_time_falls_back_to_the_clock(spark):
    df = spark.createDataFrame([(1000,), (None,)], "ms bigint")
    rows = jobs.with_event_time(df, F.col("ms"), "1 minute").orderBy(F.col("ms").asc_nulls_last()).collect()
    assert rows[0].ts.year == 1970 and rows[1].ts.year > 2000


def test_symbols_that_change_while_the_stream_runs(spark):
    """Trades and changes come in several batches, out of order within the watermark."""
    root = shared_folder(spark, "changes")
    start, minute = 1_700_000_000_000, 60_000
    change_ddl, trade_ddl = "k string, ms bigint, symbol string", "k string, ms bigint, id bigint, price decimal(9,2)"
    batches = [
        ([("a", 0, "A0"), ("b", 2, "B0")], [("a", 1, 1), ("a", 4, 2), ("b", 1, 3), (None, 1, 4), ("c", 2, 5)]),
        # The change of minute 3 arrives after trade 2 of minute 4, but before the watermark gets there.
        ([("a", 3, "A3"), ("a", 3, "A2"), ("a", 9, "A9")], [("a", 9, 6), ("a", 8, 7)]),
        # At or behind the watermark of minute 4: both are dropped, as is the one of minute 15 in the next batch.
        ([("a", 1, "late")], [("a", 2, 8), ("b", 20, 9), ("a", 20, 10)]),
        ([("b", 16, "B16"), ("b", 15, "late")], [("b", 40, 11)]),
    ]
    for shards in (1, 4):
        path = f"{root}/{shards}"
        for changes, trades_ in batches:
            spark.createDataFrame([(k, start + m * minute, s) for k, m, s in changes], change_ddl).coalesce(1).write.mode(
                "append").parquet(f"{path}/changes")
            spark.createDataFrame([(k, start + m * minute, i, None) for k, m, i in trades_], trade_ddl).coalesce(1).write.mode(
                "append").parquet(f"{path}/trades")
            read = lambda name, ddl: spark.readStream.schema(ddl).parquet(f"{path}/{name}").withColumn(
                "ts", F.timestamp_millis("ms"))
            found = keyed.asof_lookup(read("trades", trade_ddl), read("changes", change_ddl), ["k"], "ts", ["symbol"],
                                      "5 minutes", shards)
            jobs.write_files(found, f"{path}/out", f"{path}/checkpoint").awaitTermination()
        out = spark.read.parquet(f"{path}/out")
        assert dict(out.dtypes)["price"] == "decimal(9,2)" and dict(out.dtypes)["ts"] == "timestamp"
        rows = out.collect()
        assert all(r.ts.timestamp() * 1000 == r.ms for r in rows)
        assert sorted((r.id, r.symbol) for r in rows) == [
            (1, "A0"), (2, "A3"), (3, None), (5, None), (6, "A9"), (7, "A3"), (9, "B16"), (10, "A9")]


def test_running_totals_go_on_after_a_restart(spark):
    path = shared_folder(spark, "totals")
    hour = 3600
    ddl = "topic string, s bigint"
    feed = [[("x", 10), ("x", 20), (None, 30), ("x", hour + 5), ("y", 2 * hour)], [("x", 3 * hour + 1), ("y", 5 * hour)],
            [("x", 4 * hour + 9), (None, 6 * hour), ("x", 40 * hour), ("y", 43 * hour), ("y", 50 * hour)]]
    expected = {}
    for name, expiry in (("ever", None), ("day", 24 * hour)):
        for rows in feed:
            spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{path}/{name}/feed")
            stream = spark.readStream.schema(ddl).parquet(f"{path}/{name}/feed").withColumn("ts", F.timestamp_seconds("s"))
            counts = keyed.interval_counts(stream, "ts", hour, "0 seconds", ["topic"])
            sink = keyed.totals_sink(f"{path}/{name}/table", ["topic"], hour, expiry)
            jobs.write_batches(counts, sink, f"{path}/{name}/checkpoint").awaitTermination()
        done = commits.committed(spark, f"{path}/{name}/table", keyed.totals_schema(counts))
        expected[name] = sorted(((r.topic or "", r.interval_us // 3_600_000_000, r.messages, r.all_time) for r in done.collect()))
    # x: the row of hour 4 came behind the watermark of hour 5.
    assert expected["ever"] == [("", 0, 1, 1), ("", 6, 1, 2), ("x", 0, 2, 2), ("x", 1, 1, 3), ("x", 3, 1, 4), ("x", 40, 1, 5),
                                ("y", 2, 1, 1), ("y", 5, 1, 2), ("y", 43, 1, 3)]
    assert expected["day"] == [("", 0, 1, 1), ("", 6, 1, 2), ("x", 0, 2, 2), ("x", 1, 1, 3), ("x", 3, 1, 4), ("x", 40, 1, 1),
                               ("y", 2, 1, 1), ("y", 5, 1, 2), ("y", 43, 1, 1)]


def test_totals_of_a_repeated_batch_count_once(spark, monkeypatch):
    path = shared_folder(spark, "totals-twice")
    handle = keyed.totals_sink(path, ["topic"], 3600)
    batch = lambda h: spark.createDataFrame([("x", h * 3_600_000_000, 5)], "topic string, interval_us bigint, messages bigint")
    handle(batch(0), 0)
    with monkeypatch.context() as m:
        m.setattr(commits.CommitLog, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            handle(batch(1), 1)
    handle(batch(1), 1), handle(batch(1), 1), handle(batch(2), 2)
    rows = commits.committed(spark, path, keyed.totals_schema(batch(0))).collect()
    assert sorted(r.all_time for r in rows) == [5, 10, 15]


def test_declared_outputs_of_a_stream(spark, capfd):
    root = shared_folder(spark, "outputs")
    write_one(trades(spark, [("A", 1, 1, 1.0, 1), ("A", 2, 2, 1.0, 7), ("B", 1, 3, 1.0, 1)]), f"{root}/in", "a")
    source = spark.readStream.schema(DDL).parquet(f"{root}/in")
    run = lambda n, **config: external.write_stream(source, config, f"{root}/cp-{n}").awaitTermination()
    run("file", type="file", path=f"{root}/file", format="json")
    assert spark.read.schema(DDL).json(f"{root}/file").count() == 3
    run("s3", type="s3", path=f"{root}/s3")
    run("s3", type="s3", path=f"{root}/s3")  # nothing new, nothing twice
    assert spark.read.parquet(f"{root}/s3").count() == 3
    run("batches", type="batches", path=f"{root}/batches")
    assert commits.committed(spark, f"{root}/batches", source.schema).count() == 3
    run("table", type="table", path=f"{root}/table", keys=["symbol"], version="sequence", buckets=4)
    assert {r.symbol: r.qty for r in commits.compacted(spark, f"{root}/table", source.schema).collect()} == {"A": 7, "B": 1}
    run("console", type="console", options={"numRows": "2"})
    external.write_output(trades(spark, [("A", 1, 1, 1.0, 1)]), {"type": "console"})
    for wrong, error in (({"type": "pigeon"}, ValueError), ({"type": "file", "format": "tar", "path": "x"}, ValueError),
                         ({"type": "kafka", "servers": "x"}, RuntimeError)):
        with pytest.raises(error):
            external.write_stream(source, wrong, f"{root}/cp-wrong")


MESSAGE = "topic string, key binary, value binary, headers array<struct<key:string,value:binary>>"


def test_reasons_of_refused_messages(spark):
    key, value, header = b"k", b"v" * 10, [("h", b"xx")]
    given = [("t.a-b_1", key, value, header), ("t", key, None, None), ("t", None, value, None),
             (None, key, value, None), ("a b", key, value, None), ("..", key, value, None), ("t" * 250, key, value, None),
             ("t", None, None, None), ("t", key, value, [(None, b"x")]), ("t", key, b"v" * 17, header), ("t", b"", b"", [])]
    df = spark.createDataFrame(given, MESSAGE)
    assert [r[0] for r in df.select(delivery.refusal(df, max_bytes=20)).collect()] == [
        None, None, None, "no topic", "illegal topic name", "illegal topic name", "illegal topic name",
        "no key", "header without a key", "message too large", None]
    assert df.where(delivery.refusal(df, 20, compacted=True) == "no key").count() == 2


def test_refused_messages_count_once_when_sending_fails(spark):
    root = shared_folder(spark, "delivery")
    batch = spark.createDataFrame([("t", b"k", b"v", None), ("t", None, None, None), ("t", b"k", b"w", None)], MESSAGE)
    write, attempts = commits.committed_folder(f"{root}/sent"), []

    def send(df, batch_id):
        write(df, batch_id)
        attempts.append(batch_id)
        if len(attempts) == 1:
            raise OSError("connection lost")

    sink = delivery.delivered(send, f"{root}/refused")
    with pytest.raises(OSError):
        sink(batch, 0)
    assert delivery.undelivered(spark, f"{root}/refused", batch.schema).count() == 0
    sink(batch, 0)
    sink(batch, 0)
    assert commits.committed(spark, f"{root}/sent", batch.schema).count() == 2
    assert [r.refusal for r in delivery.undelivered(spark, f"{root}/refused", batch.schema).collect()] == ["no key"]
    assert delivery.outcomes(spark, f"{root}/refused") == [{"batch": 0, "delivered": 2, "refused": 1}]
    assert len(attempts) == 2
