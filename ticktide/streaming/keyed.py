"""Streams with keyed state of their own: lookups in a dimension that changes, running totals.

State is kept by key: in the state store, where Python sees the rows of one key at a
time and what a group holds is bounded by the watermark's delay, or in a table with one
row per key beside the results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ticktide.operators import bars
from ticktide.streaming import commits

SHARDS = 8
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def _asof(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Facts that the watermark has passed, each with the version of its time."""
    at, facts, since, versions = (list(c) for c in state.get) if state.exists else ([], [], [], [])
    for rows in frames:
        fresh = rows["_fact"].notna()
        at += rows.loc[fresh, "_us"].tolist()
        facts += rows.loc[fresh, "_fact"].tolist()
        since += rows.loc[~fresh, "_us"].tolist()
        versions += rows.loc[~fresh, "_version"].tolist()
    known = sorted(zip(since, versions))
    since, versions = [k[0] for k in known], [k[1] for k in known]
    mark = state.getCurrentWatermarkMs() * 1000
    at, facts = np.array(at, dtype="int64"), np.array(facts, dtype=object)
    ready = at <= mark
    place = np.searchsorted(np.array(since, dtype="int64"), at[ready], side="right") - 1
    if ready.any():
        found = [versions[p] if p >= 0 else None for p in place]
        yield pd.DataFrame({"_fact": facts[ready], "_version": pd.Series(found, dtype=object)})
    # Of the versions behind the watermark only the last one can still be asked for.
    first = max(int(np.searchsorted(since, mark, side="right")) - 1, 0)
    at, facts = at[~ready], facts[~ready]
    state.update((at.tolist(), facts.tolist(), since[first:], versions[first:]))
    if len(at):
        state.setTimeoutTimestamp(max(-(-int(at.min()) // 1000) - 1, mark // 1000 + 1))


def asof_lookup(facts: DataFrame, changes: DataFrame, by: list[str], instant: str, values: list[str],
                delay: str, shards: int = SHARDS) -> DataFrame:
    """Each fact with the ``values`` that its key had at its time, both sides being streams.

    ``changes`` has the columns ``by``, ``instant`` (a timestamp) and ``values``: a key
    has the values of its last change at or before the fact; of changes at one time the
    highest values count. A fact waits in the state until the watermark (the latest time
    of both sides less ``delay``) has reached it, as an older change may still come; then
    it is emitted once, with nulls where the key had no values yet. Rows that come at or behind
    the watermark, which begins at 1970, are dropped. Rows without a key or a time have no match and are not
    emitted.

    The facts of a key are dealt over ``shards`` groups by a hash of the row, so that a
    hot key is shared by as many tasks; each group holds the key's changes.
    """
    part = F.pmod(F.xxhash64(*facts.columns), F.lit(shards)).cast("int")
    us = F.unix_micros(instant)
    text = F.lit(None).cast("string")
    known = [F.col(c).isNotNull() for c in [*by, instant]]
    usable = known[0]
    for condition in known[1:]:
        usable = usable & condition
    asking = facts.where(usable).select(*by, part.alias("_part"), F.col(instant).alias("_at"), us.alias("_us"),
                                        F.to_json(F.struct(*facts.columns), _JSON).alias("_fact"), text.alias("_version"))
    telling = changes.where(usable).select(
        *by, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_part"), F.col(instant).alias("_at"),
        us.alias("_us"), text.alias("_fact"), F.to_json(F.struct(*values), _JSON).alias("_version"))
    met = asking.unionByName(telling).withWatermark("_at", delay).groupBy(*by, "_part").applyInPandasWithState(
        _asof, "_fact string, _version string",
        "at array<bigint>, facts array<string>, since array<bigint>, versions array<string>",
        "append", GroupStateTimeout.EventTimeTimeout)
    fact = F.from_json("_fact", facts.schema, _JSON)
    version = F.from_json("_version", changes.select(*values).schema, _JSON)
    return (met.select(fact.alias("_f"), version.alias("_v"))
            .select("_f.*", *[F.col(f"_v.{c}").alias(c) for c in values]))


def interval_counts(records: DataFrame, instant: str, seconds: int, delay: str, by: list[str]) -> DataFrame:
    """Rows per key and interval of a stream, emitted once, when the watermark has passed
    the interval; so a key's intervals arrive in the order of time."""
    return (records.withWatermark(instant, delay).groupBy(*by, F.window(instant, f"{seconds} seconds"))
            .agg(F.count("*").alias("messages"))
            .select(*by, F.unix_micros("window.start").alias("interval_us"), "messages"))


def totals_sink(path: str, by: list[str], seconds: int, expiry_seconds: int | None = None) -> commits.Handler:
    """A sink for `interval_counts` that adds the count of all intervals of the key so far.

    The running totals, one row per key, are written beside the rows of each batch and
    both count from the batch's commit on; so a stream that starts again goes on with
    the totals of the last finished batch, and a batch that runs twice counts once.

    With ``expiry_seconds`` a key that is silent for longer starts at zero when it comes
    again, and leaves the totals; without, totals are kept for good. A null is a key
    like any other.
    """
    gap = None if expiry_seconds is None else expiry_seconds * 1_000_000
    width = seconds * 1_000_000

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = commits.CommitLog(spark, path)
        done = log.batches()
        if batch_id in done:
            return
        # Written first: everything below reads the counts several times, the state once.
        folder = f"{log.data}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(f"{path}/counts/batch={batch_id}")
        counts = spark.read.schema(batch.schema).parquet(f"{path}/counts/batch={batch_id}")
        keys = counts.select(*by).schema
        known = spark.createDataFrame([], T.StructType([*keys, *_TOTAL])) if not done else spark.read.schema(
            T.StructType([*keys, *_TOTAL])).parquet(f"{path}/totals/batch={done[-1]}")
        same = [counts[c].eqNullSafe(known[c]) for c in by]
        rows = counts.join(known, reduce(and_, same), "left").select(*[counts[c] for c in by], "interval_us", "messages", "total", "last")
        run = by
        if gap is not None:
            order = Window.partitionBy(*by).orderBy("interval_us")
            before = F.coalesce(F.lag("interval_us").over(order) + width, F.col("last"))
            rows = (rows.withColumn("_fresh", F.coalesce((F.col("interval_us") - before > gap).cast("int"), F.lit(0)))
                    .withColumn("_run", F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
                    .drop("_fresh").withColumn("total", F.when(F.col("_run") == 0, F.col("total"))))
            run = [*by, "_run"]
        bars.with_totals(rows, run).select(
            *by, "interval_us", "messages", (F.coalesce("total", F.lit(0)) + F.col("all_time")).alias("all_time")
        ).write.mode("overwrite").parquet(folder)
        now = spark.read.parquet(folder).groupBy(*by).agg(
            F.max_by("all_time", "interval_us").alias("total"), (F.max("interval_us") + width).alias("last"))
        totals = known.unionByName(now).groupBy(*by).agg(
            F.max_by("total", "last").alias("total"), F.max("last").alias("last"))
        if gap is not None:
            latest = spark.read.parquet(folder).agg(F.max("interval_us")).first()[0]  # one number
            totals = totals.where(F.lit(latest).isNull() | (F.lit(latest) - F.col("last") <= gap))
        totals.write.mode("overwrite").parquet(f"{path}/totals/batch={batch_id}")
        log.commit(batch_id, {})
        log.delete(f"{path}/counts/batch={batch_id}")
        if len(done) > 1:
            log.delete(f"{path}/totals/batch={done[-2]}")

    return handle


_TOTAL = [T.StructField("total", T.LongType()), T.StructField("last", T.LongType())]


def totals_schema(counts: DataFrame) -> T.StructType:
    """Columns of the rows that `totals_sink` writes for these counts."""
    return T.StructType([*counts.schema, T.StructField("all_time", T.LongType())])
