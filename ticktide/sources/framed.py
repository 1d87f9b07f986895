"""Framed messages of several schema versions as one table of a reader's schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ticktide.functions import messages
from ticktide.operators import tables

Decoder = Callable[[Column, T.StructType], Column]
CORRUPT = "_corrupt"
MOST_SCHEMAS = 10_000


def json_payload(payload: Column, written: T.StructType) -> Column:
    """A JSON payload as a struct, null when it is no JSON object of that schema."""
    marked = T.StructType([*written, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.decode(payload, "UTF-8"), marked, {"columnNameOfCorruptRecord": CORRUPT})
    fields = F.struct(*[parsed[name].alias(name) for name in written.fieldNames()])
    return F.when(parsed[CORRUPT].isNull(), fields)


def writer_schemas(versions: DataFrame, most: int = MOST_SCHEMAS) -> dict[int, T.StructType]:
    """Schemas by id from registry rows (schema_id, schema), the schema as Spark's JSON.

    They become part of the plan and so pass through the driver; more than ``most`` is
    an error, and so is an id with two schemas.
    """
    rows = versions.select("schema_id", "schema").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} schemas in the registry")
    found = {r.schema_id: T.StructType.fromJson(_json(r.schema)) for r in rows}
    if len(found) < len(rows):
        raise ValueError("a schema id stands for two schemas")
    return found


def _json(text: str) -> dict:
    import json
    return json.loads(text)


def resolve_frames(frames: DataFrame, writers: Mapping[int, T.StructType], reader: T.StructType,
                   decode: Decoder = json_payload, value: str = "value", record: str = "record") -> DataFrame:
    """Adds ``record``, the frame's payload in the reader's schema, and ``reason``.

    A payload is read with the schema of the id in its frame and projected to the
    reader: fields match by name, missing ones take their default, unknown ones are
    left out. A reader that cannot take one of the writers is a `SchemaMismatch` when
    the plan is built. Every frame stays a row: where it is too short, has another magic
    byte, an id that is not in ``writers`` or an unreadable payload, ``record`` is null
    and ``reason`` says why. One pass, no shuffle. A null frame is a short one.

    ``decode`` reads a payload; `external.decode_avro` with the schema's text is one
    where Spark's Avro package is on the class path.
    """
    parts = messages.split_frame(F.col(value))
    payload, number = F.col("_frame.payload"), F.col("_frame.schema_id")
    split = frames.withColumn("_frame", F.struct(
        F.coalesce(parts["reason"], F.when(F.col(value).isNull(), "frame too short")).alias("reason"),
        parts["schema_id"].alias("schema_id"), parts["payload"].alias("payload")))
    chosen = F.lit(None).cast(reader)
    for schema_id, written in writers.items():
        decoded = tables.resolved_struct(decode(payload, written), written, reader)
        chosen = F.when(number == schema_id, decoded).otherwise(chosen)
    known = number.isin(list(writers)) if writers else F.lit(False)
    reason = F.coalesce("_frame.reason", F.when(~known, "unknown schema id"),
                        F.when(F.col(record).isNull(), "unreadable payload"))
    # A generator, so that a filter on a field does not decode the payload once more.
    return (split.select("*", F.inline_outer(F.array(F.struct(chosen.alias(record)))))
            .select(*frames.columns, record, reason.alias("reason")))
