"""Rules to reasons: one pass marks every record, two outputs share it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Rules = dict[str, Column]


def with_reasons(records: DataFrame, rules: Rules, column: str = "reason",
                 failed: str | None = None) -> DataFrame:
    """Add the array of failed rules. ``rules`` maps a reason to the column that
    is true when the record fails; null counts as not failed. ``failed`` names a
    column that says already whether any rule failed; it is dropped."""
    marks = [F.when(broken, F.lit(reason)) for reason, broken in rules.items()]
    any_failed = F.col(failed) if failed else reduce(
        lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in rules.values()])
    # The array is built for failing records only; most records have no reason.
    reasons = F.when(any_failed, F.filter(F.array(*marks), lambda r: r.isNotNull())).otherwise(
        F.array().cast("array<string>"))
    marked = records.withColumn(column, reasons)
    return marked.drop(failed) if failed else marked


def settled(records: DataFrame, mark: str) -> DataFrame:
    """The records with ``mark`` as the output of a generator, which a filter on it
    does not cross.

    The filter would otherwise move below the projection that parses the values and
    take a second copy of every parsing expression with it. The other columns pass
    beside the generator, so those that a query does not read are not computed.
    """
    return records.withColumn(mark, F.explode(F.array(mark)))


def valid(records: DataFrame, column: str = "reason") -> DataFrame:
    return records.where(F.size(column) == 0).drop(column)


def quarantine(records: DataFrame, column: str = "reason") -> DataFrame:
    return records.where(F.size(column) > 0)


def write_routed(records: DataFrame, path: str, column: str = "reason", mode: str = "append") -> None:
    """Both outputs in one pass: folders ``status=valid`` and ``status=quarantine``."""
    status = F.when(F.size(column) == 0, "valid").otherwise("quarantine")
    records.withColumn("status", status).write.mode(mode).partitionBy("status").parquet(path)
