"""Option symbols in the 21-character form: root padded to 6, yymmdd, P or C,
strike with five integer and three decimal digits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse(symbol: Column) -> dict[str, Column]:
    strike = F.concat(F.substring(symbol, 14, 5), F.lit("."), F.substring(symbol, 19, 3))
    return {
        "underlying": F.trim(F.substring(symbol, 1, 6)),
        "expiration_date": F.try_to_date(
            F.concat(F.lit("20"), F.substring(symbol, 7, 6)), "yyyyMMdd"),
        "put_call": F.substring(symbol, 13, 1),
        "strike": strike.try_cast("decimal(22,9)"),
    }


def format_symbol(underlying: Column, expiry: Column, put_call: Column, strike: Column) -> Column:
    thousandths = (strike * F.lit(1000)).cast("bigint").cast("string")
    return F.concat(F.rpad(underlying, 6, " "), F.date_format(expiry, "yyMMdd"), put_call,
                    F.lpad(thousandths, 8, "0"))


def to_struct(symbol: Column) -> Column:
    parts = parse(symbol)
    return F.struct(
        parts["underlying"].alias("underlying"),
        F.date_format(parts["expiration_date"], "yyyyMMdd").alias("expiration_date"),
        parts["put_call"].alias("put_call"),
        parts["strike"].cast("double").alias("strike"),
        symbol.alias("symbol"))


def dotted_part(name: Column, part: int) -> Column:
    return F.split_part(name, F.lit("."), F.lit(part))
