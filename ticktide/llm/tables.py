"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ticktide.session import shared_root

ROWS_AT_ONCE = 256


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder.

    The session's `shared_root` names the folder.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator needs, so that no other name can clash.

    A missing text counts as the empty one.
    """
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def text_slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that very long texts do not pile up as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def byte_slices(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each, in column 1, hold some ``size`` bytes, or are a single one."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            begun = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, begun + size, side="right")))
            yield batch.slice(at, to - at)
            at = to


def hex64(value: Column) -> Column:
    """A 64-bit number as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")
