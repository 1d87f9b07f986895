"""Table shaping: envelope, compaction, de-duplication, schema evolution,
schema-driven coercion."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ticktide.functions import checks, decimals, messages, times


# --- message envelope -----------------------------------------------------

def envelope(records: DataFrame, topic: str, key: Column, value: Column, event_ms: Column,
             source_id: str | None = None, dataset_id: str | None = None,
             schema_version: int = 1, entitlement: str = "none",
             extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Key, value and headers in the layout of a Kafka sink.

    The sink takes no event time column, so the time travels as header ``ts_ms``.
    ``extra`` are headers of the caller's own; one with a given name takes its place.
    """
    entries = {
        "source_id": F.lit(source_id), "dataset_id": F.lit(dataset_id),
        "pipeline_id": F.lit(topic), "entitlement_id": F.lit(entitlement),
        "schema_version": F.lit(schema_version), "ts_ms": event_ms, **(extra or {}),
    }
    return records.select(
        F.lit(topic).alias("topic"), F.encode(key.cast("string"), "UTF-8").alias("key"),
        value.alias("value"), messages.headers(entries).alias("headers"),
        event_ms.alias("timestamp"))


def event_time(event_ms: Column, ingested: Column) -> Column:
    """Source event time, else the time the record was taken in."""
    return F.coalesce(F.timestamp_millis(event_ms), ingested)


def json_value(records: DataFrame) -> Column:
    return F.encode(F.to_json(F.struct(*records.columns)), "UTF-8")


# --- keyed tables ---------------------------------------------------------

def latest_per_key(rows: DataFrame, keys: list[str], version: str | list[str]) -> DataFrame:
    """Compaction: the row with the highest version of every key. ``version`` may
    name several columns; rows equal in all of them are ordered by their contents,
    so that the result does not depend on the order of arrival."""
    others = [c for c in rows.columns if c not in keys]
    versions = [version] if isinstance(version, str) else version
    whole = F.struct(*others)
    newest = F.max_by(whole, F.struct(*versions, F.to_json(whole))).alias("_row")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*rows.columns)


def deduplicate(rows: DataFrame, identity: list[str], instant: str | None = None,
                delay: str = "24 hours") -> DataFrame:
    """One row per identity. On a stream the state is bounded by the watermark,
    which has to cover the replay window."""
    if rows.isStreaming:
        return rows.withWatermark(instant, delay).dropDuplicatesWithinWatermark(identity)
    return rows.dropDuplicates(identity)


# --- schema evolution -----------------------------------------------------

class SchemaMismatch(ValueError):
    """A reader field has neither a written value nor a default."""


def _resolved(column: Column, written: T.DataType, wanted: T.DataType, path: str) -> Column:
    if isinstance(wanted, T.StructType) and isinstance(written, T.StructType):
        fields = _resolved_fields(lambda name: column[name], written, wanted, f"{path}.")
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(wanted, T.ArrayType) and isinstance(written, T.ArrayType):
        return F.transform(
            column, lambda e: _resolved(e, written.elementType, wanted.elementType, f"{path}[]"))
    return column if written == wanted else column.cast(wanted)


def _resolved_fields(get, written: T.StructType, wanted: T.StructType, prefix: str) -> list[Column]:
    columns = []
    for field in wanted.fields:
        if field.name in written.fieldNames():
            column = _resolved(get(field.name), written[field.name].dataType, field.dataType,
                               prefix + field.name)
        elif "default" in field.metadata:
            column = F.lit(field.metadata["default"]).cast(field.dataType)
        elif field.nullable:
            column = F.lit(None).cast(field.dataType)
        else:
            raise SchemaMismatch(f"no value and no default for {prefix}{field.name}")
        columns.append(column.alias(field.name))
    return columns


def resolve_schema(rows: DataFrame, reader: T.StructType) -> DataFrame:
    """Project written rows to a reader schema: fields match by name, unknown
    ones are dropped, missing ones take their default. A required field without
    a default fails here, when the plan is built, not while it runs."""
    return rows.select(*_resolved_fields(lambda name: F.col(name), rows.schema, reader, ""))


def resolved_struct(record: Column, written: T.StructType, reader: T.StructType) -> Column:
    """`resolve_schema` for a struct column; a null record stays null."""
    fields = _resolved_fields(lambda name: record[name], written, reader, "")
    return F.when(record.isNotNull(), F.struct(*fields))


# --- schema-driven coercion -----------------------------------------------

def coerce_record(rows: DataFrame, schema: T.StructType,
                  hooks: Mapping[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Bring every column to its schema type with the rule of that type:
    decimals are cut toward zero, text is trimmed, times become integers.
    ``hooks`` are functions per field that run before the rule. A field that the
    rows lack takes its default or null; a required one without a default is a
    `SchemaMismatch`. The result has the fields of the schema, in its order."""
    columns, hooks = [], hooks or {}
    for field in schema.fields:
        if field.name not in rows.columns:
            columns += _resolved_fields(F.col, T.StructType(), T.StructType([field]), "")
            continue
        value, given = F.col(field.name), rows.schema[field.name].dataType
        if field.name in hooks:
            value = hooks[field.name](value)
        logical = field.metadata.get("logicalType", "")
        if isinstance(field.dataType, T.DecimalType):
            value = decimals.coerce_down(value, field.dataType.precision, field.dataType.scale)
        elif logical.startswith(("timestamp-", "time-")) and isinstance(given, T.TimestampType):
            unit = {"millis": "milliseconds", "micros": "microseconds"}[logical.split("-")[1]]
            value = times.since_epoch(value, unit)
        elif isinstance(field.dataType, T.StringType):
            value = checks.trimmed_utf8(value)
        columns.append(value.alias(field.name))
    return rows.select(*columns)
