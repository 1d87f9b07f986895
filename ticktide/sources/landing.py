"""Feed tables as they land: the same layout for batch and streaming reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ticktide import schemas

REPLAY_WINDOW = "INTERVAL '23:59:59' HOUR TO SECOND"
BOOK_RECORD = "mbp-1"


def read_landing(spark: SparkSession, path: str, schema: T.StructType = schemas.TBBO_RAW,
                 fmt: str = "parquet", streaming: bool = False, **options: str) -> DataFrame:
    """Landing folder as a DataFrame. The schema is explicit, never inferred."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).format(fmt).options(**options).load(path)


def book_records(records: DataFrame) -> DataFrame:
    """Keep trades that carry the top of the book."""
    return records.where(F.col("rtype") == BOOK_RECORD)


def replayed(records: DataFrame, event_ts: Column, as_of: Column | None) -> DataFrame:
    """Bounded replay: the last 23:59:59 before ``as_of``; all rows without it."""
    if as_of is None:
        return records
    return records.where(event_ts >= as_of - F.expr(REPLAY_WINDOW))


def retained(records: DataFrame, event_ts: Column, as_of: Column,
             retention_ms: int = 2_592_000_000) -> DataFrame:
    """Time retention, 30 days by default; a negative value keeps everything."""
    if retention_ms < 0:
        return records
    return records.where(F.unix_millis(event_ts) > F.unix_millis(as_of) - F.lit(retention_ms))
