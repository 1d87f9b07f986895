"""Registered queries with the SQL that states the expected result.

Results leave the registry in a plain form, so that two engines can be compared
by value: decimals and dates as text, instants as epoch microseconds, arrays
joined by ``|``, bytes in hex.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _plain(name: str, dtype: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(dtype, (T.DecimalType, T.DateType)):
        return value.cast("string").alias(name)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value).alias(name)
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StringType):
        return F.array_join(value, "|").alias(name)
    if isinstance(dtype, T.ArrayType):
        return F.array_join(F.transform(value, lambda e: e.cast("string")), "|").alias(name)
    if isinstance(dtype, T.BinaryType):
        return F.hex(value).alias(name)
    return value.alias(name)


def plain(df: DataFrame) -> DataFrame:
    return df.select(*[_plain(f.name, f.dataType) for f in df.schema.fields])


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is the equivalent SQL, when there is one."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(build(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register
