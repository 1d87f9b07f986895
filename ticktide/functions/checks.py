"""Value checks, all boolean columns: true means acceptable."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def in_enum(value: Column, symbols: list[str]) -> Column:
    return F.coalesce(value.isin(*symbols), F.lit(False))


def in_enum_or_null(value: Column, symbols: list[str]) -> Column:
    return value.isNull() | value.isin(*symbols)


def printable_text(value: Column) -> Column:
    """Not empty, not only blanks, and no control or separator character but space."""
    bare = F.replace(value, F.lit(" "), F.lit(""))
    return F.coalesce((F.trim(value) != "") & ~bare.rlike(r"[\p{C}\p{Z}]"), F.lit(False))


def decimal_text(value: Column) -> Column:
    return value.try_cast("decimal(38,18)").isNotNull()


def utf8(value: Column) -> Column:
    return F.is_valid_utf8(value)


def trimmed_utf8(value: Column) -> Column:
    """Trimmed text, null when the bytes are not UTF-8."""
    return F.trim(F.try_validate_utf8(value))


def length_between(value: Column, low: int, high: int) -> Column:
    return F.coalesce(F.length(value).between(low, high), F.lit(False))


def conforms(value: Column, dtype: T.DataType, nullable: bool = True,
             metadata: dict | None = None) -> Column:
    """Whether a nested value fits a record layout: required fields present,
    enum members known, and the same for every array element and map value."""
    if isinstance(dtype, T.StructType):
        fits = F.lit(True)
        for field in dtype.fields:
            fits = fits & conforms(value[field.name], field.dataType, field.nullable, field.metadata)
    elif isinstance(dtype, T.ArrayType):
        fits = F.forall(value, lambda e: conforms(e, dtype.elementType, dtype.containsNull))
    elif isinstance(dtype, T.MapType):
        fits = F.forall(F.map_values(value),
                        lambda e: conforms(e, dtype.valueType, dtype.valueContainsNull))
    else:
        symbols = (metadata or {}).get("symbols")
        fits = value.isin(*symbols) if symbols else F.lit(True)
    return F.when(value.isNull(), F.lit(nullable)).otherwise(F.coalesce(fits, F.lit(False)))
