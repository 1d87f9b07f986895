"""Exact decimal columns: fixed-point integers, scale coercion, byte forms."""

from __future__ import annotations

from decimal import Decimal
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

PRICE_SCALE = 9
# Undefined-price marker of the feed (largest signed 64-bit integer); fixed value.
UNDEF_PRICE = 9223372036854775807
# Currency symbols by ISO code; fixed values.
CURRENCY_SYMBOLS = {"USD": "$", "EUR": "€", "GBP": "£"}


def _power_of_ten(exponent: int) -> Column:
    """10**exponent as an exact decimal of the smallest type that holds it."""
    text = format(Decimal(1).scaleb(exponent), "f")
    return F.lit(text).cast(T.DecimalType(abs(exponent) + 1, max(-exponent, 0)))


def from_fixed(value: Column, scale: int = PRICE_SCALE) -> Column:
    """Fixed-point integer to decimal, without passing through a double."""
    return value.cast("decimal(20,0)") * _power_of_ten(-scale)


def to_fixed(value: Column, scale: int = PRICE_SCALE) -> Column:
    """Decimal to fixed-point integer, digits below the scale dropped."""
    return (value * _power_of_ten(scale)).try_cast("bigint")


def feed_price(value: Column, scale: int = PRICE_SCALE) -> Column:
    """``from_fixed`` with the undefined-price marker read as null."""
    return from_fixed(F.when(value != F.lit(UNDEF_PRICE), value), scale)


def truncate(value: Column, scale: int) -> Column:
    """Round toward zero. A plain cast would round half up."""
    places = F.lit(scale)
    return F.when(value < 0, F.ceil(value, places)).otherwise(F.floor(value, places))


def coerce_down(value: Column, precision: int, scale: int) -> Column:
    """Round toward zero to ``scale``; null when the digits exceed ``precision``."""
    return truncate(value, scale).try_cast(T.DecimalType(precision, scale))


def plain_text_down(text: Column, precision: int, scale: int) -> Column:
    """Decimal text of at most ``scale`` places, read without a wider decimal; null for
    any other, which `coerce_down` of the wide decimal reads.

    A negative exponent hides places. A text has fewer places than characters.
    """
    few = (F.length(text) <= scale + 1) | F.substring(text, -(scale + 1), scale + 1).contains(".")
    plain = ~text.contains("e-") & ~text.contains("E-") & (few | ~text.contains("."))
    return F.when(plain, text.try_cast(T.DecimalType(precision, scale)))


def coerce_half_even(value: Column, precision: int, scale: int) -> Column:
    """Round half even; null when there are more than ``precision`` integer digits."""
    rounded = F.bround(value, scale).try_cast(T.DecimalType(min(38, precision + scale), scale))
    return F.when(F.abs(rounded) < _power_of_ten(precision), rounded)


def quantise(value: Column, precision: int, scale: int) -> Column:
    """Round half even into the schema's own precision and scale, else null."""
    return F.bround(value, scale).try_cast(T.DecimalType(precision, scale))


def unscaled(value: Column, scale: int) -> Column:
    """Integral value of a decimal at its schema scale."""
    return F.round(value * _power_of_ten(scale), 0).try_cast("decimal(38,0)")


def half_up_cents(value: Column) -> Column:
    return F.round(value, 2)


def currency_text(value: Column, iso: Column) -> Column:
    """``$1,234.56``; an unknown currency shows its ISO code."""
    symbol = iso
    for code, sign in CURRENCY_SYMBOLS.items():
        symbol = F.when(iso == code, F.lit(sign)).otherwise(symbol)
    return F.concat(symbol, F.format_number(value, 2))


def to_text_bytes(value: Column, scale: int = PRICE_SCALE) -> Column:
    """Value divided by 10**scale, six places, as UTF-8 text bytes."""
    shifted = F.bround(value * _power_of_ten(-scale), 6)
    return F.encode(shifted.cast("string"), "UTF-8")


def from_text_bytes(value: Column) -> Column:
    parsed = F.decode(value, "UTF-8").try_cast("decimal(38,12)")
    return F.bround(parsed, 6).try_cast("decimal(38,6)")


def to_signed_bytes(value: Column, scale: int) -> Column:
    """Shortest big-endian two's-complement form of the unscaled integer."""
    number = to_fixed(value, scale)
    width = F.floor((F.length(F.bin(F.abs(number))) + 8) / 8).cast("int")
    padded = F.lpad(F.hex(number), 16, "0")
    return F.unhex(F.substring(padded, F.lit(17) - width * 2, width * 2))


def from_signed_bytes(value: Column, scale: int) -> Column:
    """Big-endian two's-complement bytes (up to 8) to decimal, inside the JVM."""
    text = F.hex(value)
    negative = F.conv(F.substring(text, 1, 1), 16, 10).cast("int") >= 8
    extended = F.when(negative, F.lpad(text, 16, "F")).otherwise(F.lpad(text, 16, "0"))
    number = F.conv(extended, 16, -10).try_cast("bigint")
    return F.when(F.octet_length(value) <= 8, from_fixed(number, scale))


def from_wide_signed_bytes(scale: int):
    """Column function for byte strings beyond 8 bytes, one Arrow batch at a time."""

    @F.pandas_udf(T.DecimalType(38, scale))
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        limit = 10 ** 38
        for batch in batches:
            numbers = [None if raw is None else int.from_bytes(raw, "big", signed=True)
                       for raw in batch]
            yield pd.Series([None if n is None or abs(n) >= limit else Decimal(n).scaleb(-scale)
                             for n in numbers], dtype=object)

    return decode


def to_wide_signed_bytes(scale: int):
    """Column function from decimal(38, scale) to two's-complement bytes of any length."""

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            numbers = [None if x is None else int(x.scaleb(scale)) for x in batch]
            yield pd.Series([None if n is None else n.to_bytes((n.bit_length() + 8) // 8, "big", signed=True)
                             for n in numbers], dtype=object)

    return encode
