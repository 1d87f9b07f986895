"""JSON frames ``[channel, item, item, ...]`` as one row per item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ticktide import schemas

ZERO_NUMBER = r"^-?0+(?:\.0*)?(?:[eE][+-]?\d+)?$"
MOST_CHARS = 2**31 - 1
# A frame up to its first comma, where the channel is a plain text.
CHANNEL = r'^\s*\[\s*"[^"\\]*"\s*$'


def frame_items(text: Column) -> Column:
    """The frame as an array of JSON texts, null when it is not a JSON array."""
    return F.from_json(text, "array<string>")


def _is_object(item: Column) -> Column:
    return F.coalesce(F.ltrim(item).startswith("{"), F.lit(False))


def _objects(text: Column, layout: T.StructType) -> Column:
    """What follows the channel as an array of ``layout``, parsed in one pass; null
    where the channel is no plain text or an item no object."""
    head = F.substring_index(text, ",", 1)
    rest = F.concat(F.lit("["), F.substring(text, F.length(head) + 2, F.lit(MOST_CHARS)))
    return F.when(head.rlike(CHANNEL), F.from_json(rest, T.ArrayType(layout)))


def bad_frames(frames: DataFrame, text: str = "value") -> DataFrame:
    """Frames that do not parse or are empty, and items that are no objects, with
    the reason, for the quarantine table. ``position`` is null for a whole frame.

    Only frames that hold something else than objects are taken apart into texts.
    """
    objects = _objects(F.col(text), T.StructType([T.StructField("id", T.StringType())]))
    # One expression on the parsed array, which is evaluated as often as it is named.
    sound = F.aggregate(objects, F.lit(0), lambda n, item: F.when((n < 0) | item.isNull(), -1).otherwise(n + 1)) > 0
    elements = F.when(sound, F.array(F.lit(None).cast("string"))).otherwise(frame_items(F.col(text)))
    items = frames.select(*frames.columns, F.posexplode_outer(elements).alias("position", "_item"))
    reason = (F.when(F.col("position").isNull(), "malformed JSON frame")
              .when((F.col("position") > 0) & ~_is_object(F.col("_item")), "item is no object"))
    marked = items.select(*frames.columns, "position", reason.alias("_reason"))
    return marked.where(F.col("_reason").isNotNull()).select(
        *frames.columns, "position", F.array("_reason").alias("reason"))


def option_items(frames: DataFrame, text: str = "value",
                 schema: T.StructType = schemas.OPTION_ITEM) -> DataFrame:
    """Items of all well-formed frames, flattened to columns.

    The first element names the channel. A frame of objects is parsed once; one
    that holds anything else is taken apart first. Nothing is shuffled. The
    generator is an outer one: for the others the optimizer adds a filter on the
    size of the array, which would parse the JSON once more. And as a generator it
    stops a filter on an item's field from moving below the parsing.

    A price that is the JSON number zero is no price, the text "0" is one; it is
    read as a variant, whose type tells, whatever nested fields or texts hold.

    ``schema`` may be narrower than the feed's: fields it lacks are passed over.
    """
    typed = T.StructType([T.StructField("price", T.VariantType()) if f.name == "price" else f for f in schema.fields])
    apart = F.transform(F.filter(frame_items(F.col(text)), lambda item, at: (at > 0) & _is_object(item)),
                        lambda item: F.from_json(item, typed))
    items = (frames.select(F.explode_outer(F.coalesce(_objects(F.col(text), typed), apart)).alias("item"))
             .where(F.col("item").isNotNull()))
    if "price" not in schema.names:
        return items.select("item.*")
    given = F.try_variant_get("price", "$", "string")
    zero = given.rlike(ZERO_NUMBER) & (F.schema_of_variant("price") != "STRING")
    return items.select("item.*").withColumn("price", F.when(~F.coalesce(zero, F.lit(False)), given))


def priced(items: DataFrame) -> DataFrame:
    """Drop items whose price is missing, empty or the number zero."""
    return items.where(F.col("price").isNotNull() & (F.col("price") != ""))


def root_key(text: Column, key: str = "data") -> Column:
    """The part of a JSON message below its root key, as JSON text."""
    return F.get_json_object(text, f"$.{key}")
