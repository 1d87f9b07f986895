"""The batch transforms on streams: windows, late data, keyed tables, metrics.

Every function takes and returns DataFrames. The sinks are written so that a
batch which runs twice after a failure leaves the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ticktide.operators import bars, tables
from ticktide.session import shared_folder

Transform = Callable[[DataFrame], DataFrame]


def with_event_time(records: DataFrame, event_ms: Column, delay: str, column: str = "ts") -> DataFrame:
    """Event time from the source, else the moment of processing, with a watermark."""
    instant = tables.event_time(event_ms, F.current_timestamp())
    return records.withColumn(column, instant).withWatermark(column, delay)


def windowed_bars(trades: DataFrame, width: str, delay: str, slide: str | None = None,
                  instant: str = "ts", symbol: str = "symbol") -> DataFrame:
    """Volume bars over event time. In append mode a bar is emitted once, when
    the watermark has passed its end; later trades for it are dropped."""
    marked = trades.withWatermark(instant, delay)
    if slide:
        return bars.sliding_bars(marked, width, slide, symbol, instant)
    return bars.tumbling_bars(marked, width, symbol, instant)


def gap_bars(trades: DataFrame, gap: str, delay: str, instant: str = "ts",
             symbol: str = "symbol") -> DataFrame:
    return bars.gap_bars(trades.withWatermark(instant, delay), gap, symbol, instant)


def transform_stream(source: DataFrame, validate: Transform, extract: Transform,
                     coerce: Transform) -> DataFrame:
    """The three hooks of a feed job, in order."""
    return source.transform(validate).transform(extract).transform(coerce)


def started(writer: DataStreamWriter, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Start a sink: for what is there now, or at intervals until it is stopped."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def write_files(records: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                available_now: bool = True, interval: str = "15 seconds") -> StreamingQuery:
    """Exactly-once file sink: the checkpoint and the sink's own log decide
    which files count, so a repeated batch is not seen twice."""
    writer = (records.writeStream.format(fmt).outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now
            else writer.trigger(processingTime=interval)).start()


def write_batches(records: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append") -> StreamingQuery:
    return (records.writeStream.foreachBatch(handle).outputMode(mode)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def idempotent_folder(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A batch sink that overwrites the folder of its own batch id."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch_id}")

    return handle


def watermark(done: StreamingQuery) -> str:
    """The last watermark that a finished query reported."""
    return max(p["eventTime"]["watermark"] for p in done.recentProgress if "watermark" in p["eventTime"])


def statistics_sink(stats_path: str, write: Callable[[DataFrame, int], None], topic: str,
                    measures: dict[str, Column]) -> Callable[[DataFrame, int], None]:
    """Write each batch and, from the same pass, one row of statistics about it.

    ``write`` has to write a repeated batch again, as `idempotent_folder` does: one
    that leaves it out would never report the numbers that are waited for."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"{topic}-{batch_id}")
        write(batch.observe(seen, *[c.alias(n) for n, c in measures.items()]), batch_id)
        row = {"topic": topic, "batch_id": batch_id, **seen.get}
        (batch.sparkSession.createDataFrame([row]).coalesce(1)
         .write.mode("overwrite").parquet(f"{stats_path}/batch={batch_id}"))

    return handle


class ProgressLog(StreamingQueryListener):
    """Keeps the rows, rate and late rows of each finished batch of its query."""

    def __init__(self) -> None:
        self.batches: list[dict] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.batches.append({
            "batch": progress.batchId, "rows": progress.numInputRows,
            "rows_per_second": progress.processedRowsPerSecond,
            "late_rows": sum(s.numRowsDroppedByWatermark for s in progress.stateOperators),
        })

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


@contextmanager
def progress_log(spark: SparkSession) -> Iterator[ProgressLog]:
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


def run_to_files(records: DataFrame, name: str) -> DataFrame:
    """Run a stream over all available input and read the result back from the
    shared folder; nothing passes through the driver."""
    spark = records.sparkSession
    root = shared_folder(spark, name)
    write_files(records, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(records.schema).parquet(f"{root}/data")
