"""Message envelope: keys, headers, subjects and the framed payload."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MAGIC_BYTE = "00"
FRAME_HEAD = 5


def subject(topic: Column, field: str) -> Column:
    return F.concat(topic, F.lit("-"), F.lit(field))


def composite_key(*parts: Column) -> Column:
    return F.concat_ws(".", *[p.cast("string") for p in parts])


def key_or_generated(key: Column, *identity: Column) -> Column:
    """Message key, else a digest of the identifying columns: a retried task
    then produces the same key again, which a random id would not."""
    return F.coalesce(key, F.sha2(F.concat_ws("|", *[p.cast("string") for p in identity]), 256))


def headers(entries: dict[str, Column]) -> Column:
    """Header list; entries without a value are left out."""
    items = [F.when(value.isNotNull(),
                    F.struct(F.lit(key).alias("key"),
                             F.encode(value.cast("string"), "UTF-8").alias("value")))
             for key, value in entries.items()]
    return F.filter(F.array(*items), lambda item: item.isNotNull())


def header_value(column: Column, key: str) -> Column:
    """Last value under a key, as text."""
    hits = F.filter(column, lambda item: item["key"] == key)
    return F.decode(F.try_element_at(hits, F.lit(-1))["value"], "UTF-8")


def frame(schema_id: Column, payload: Column) -> Column:
    """Magic byte 0, four bytes of schema id, then the payload."""
    return F.unhex(F.concat(F.lit(MAGIC_BYTE), F.lpad(F.hex(schema_id), 8, "0"), F.hex(payload)))


def split_frame(value: Column) -> dict[str, Column]:
    """Schema id, payload and the reason a frame is unusable."""
    reason = (F.when(F.octet_length(value) <= FRAME_HEAD, "frame too short")
              .when(F.hex(F.substring(value, 1, 1)) != MAGIC_BYTE, "unexpected magic byte"))
    schema_id = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")
    payload = F.substring(value, FRAME_HEAD + 1, 2147483647)
    return {
        "schema_id": F.when(reason.isNull(), schema_id),
        "payload": F.when(reason.isNull(), payload),
        "reason": reason,
    }
