"""Many-to-one lookups and as-of joins that hold up under skewed keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ticktide.functions import times
from ticktide.session import BROADCAST_LIMIT_BYTES, estimated_bytes

SALTS = 32
FINEST = 100_000  # most parts of a crowded cell of an as-of join


def lookup(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "left",
           limit: int = BROADCAST_LIMIT_BYTES, salts: int = SALTS) -> DataFrame:
    """Join facts to a dimension with one row per key.

    The dimension is broadcast only while Catalyst's estimate of it is below
    ``limit``. Beyond that the join is shuffled and salted: each dimension row
    is repeated once per salt, so that one hot key spreads over ``salts`` tasks.
    """
    size = estimated_bytes(dim)
    if size is not None and size <= limit:
        return facts.join(F.broadcast(dim), on, how)
    return salted_lookup(facts, dim, on, how, salts)


def salted_lookup(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "left",
                  salts: int = SALTS) -> DataFrame:
    """The shuffled form of ``lookup``. The salt is a hash of the row, not a
    random number: a task that runs again after a lost executor sends every row
    to the same place. Exact copies share a salt, so de-duplicate before."""
    spread = F.pmod(F.xxhash64(*[facts[c] for c in facts.columns if c not in on] or [F.lit(0)]),
                    F.lit(salts)).cast("int")
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (facts.withColumn("_salt", spread)
            .join(copies, [*on, "_salt"], how).drop("_salt"))


def last_id_by_symbol(providers: DataFrame) -> DataFrame:
    """Inverse of the provider map; a symbol listed twice keeps the highest id."""
    return providers.groupBy("provider").agg(F.max("provider_id").alias("provider_id"))


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str,
                  values: list[str], bucket: int, limit: int = 4_000_000,
                  right_ties: list[str] | None = None, seen: dict[str, DataFrame] | None = None) -> DataFrame:
    """For each left row the latest right row with the same key at or before it.

    Both sides are cut into (key, time bucket) cells, so a hot key is shared by
    as many tasks as it has buckets. The value a cell starts with is carried in
    from the latest earlier cell of the key that has a right row; that step
    works on one row per key and cell. A cell with more than ``limit`` rows, left
    and right together, is cut into finer cells by time, each with a carry of its
    own. Where more than ``limit`` left rows still meet, all at one moment, they
    are spread over several groups, each with its own copy of the right rows.

    Of right rows with equal times the one with the highest ``right_ties`` counts,
    then that with the highest ``values``.

    ``seen`` gets, as "rows", what the last window orders, to look at its groups.
    ``bucket`` is in units of the (integer) time columns. Columns ``values`` come
    from the right; ``matched_ts`` is the right row's time.
    """
    cell_key = [*by, "_cell"]
    cell = lambda ts: times.floor_div(F.col(ts), bucket)
    ties = [F.col(c).alias(f"_tie_{c}") for c in right_ties or []]
    payload = F.struct(F.col(right_ts).alias("matched_ts"), *ties, *values)
    rows = left.select(*by, cell(left_ts).alias("_cell"), F.col(left_ts).alias("_ts"),
                       F.lit(2).alias("_rank"), F.struct(*left.columns).alias("_left"))
    points = right.select(*by, cell(right_ts).alias("_cell"), F.col(right_ts).alias("_ts"),
                          F.lit(0).alias("_rank"), payload.alias("_right"))

    # Crowded cells are few: at most the number of rows over the limit.
    sizes = rows.select(*cell_key).unionByName(points.select(*cell_key)).groupBy(*cell_key).agg(F.count("*").alias("_n"))
    crowded = sizes.where(F.col("_n") > limit).select(
        *cell_key, F.least(F.ceil(F.col("_n") * 2 / F.lit(limit)), F.lit(FINEST)).cast("bigint").alias("_parts"))

    def finer(side: DataFrame) -> DataFrame:
        """Cell numbers with room for ``FINEST`` parts each, in the order of time."""
        inside = (F.col("_ts") - F.col("_cell") * bucket) * F.coalesce("_parts", F.lit(1).cast("bigint"))
        return lookup(side, crowded, cell_key).withColumn(
            "_cell", F.col("_cell") * FINEST + times.floor_div(inside, bucket)).drop("_parts")

    rows, points = finer(rows), finer(points)

    # Last right row of every cell, then the last one of any earlier cell.
    closing = points.groupBy(*cell_key).agg(F.max("_right").alias("_closing"))
    cells = rows.groupBy(*cell_key).agg(F.count("*").alias("_n")).select(
        *cell_key, F.ceil(F.col("_n") / F.lit(limit)).cast("int").alias("_groups"))
    history = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (cells.join(closing, cell_key, "full")
              .withColumn("_right", F.last("_closing", ignorenulls=True).over(history))
              .where(F.col("_right").isNotNull())
              .select(*cell_key, F.col("_right.matched_ts").alias("_ts"), F.lit(1).alias("_rank"),
                      "_right"))

    crowded = cells.where(F.col("_groups") > 1)
    groups = F.coalesce("_groups", F.lit(1))
    known = points.unionByName(starts)
    copies = lookup(known, crowded, cell_key).withColumn(
        "_group", F.explode(F.sequence(F.lit(0), groups - 1))).drop("_groups")
    dealt = lookup(rows, crowded, cell_key).withColumn(
        "_group", F.pmod(F.xxhash64("_left"), groups).cast("int")).drop("_groups")

    # A carried row is older than anything in its cell, so time order places it first.
    order = Window.partitionBy(*cell_key, "_group").orderBy("_ts", "_rank", "_right")
    met = copies.unionByName(dealt, allowMissingColumns=True)
    if seen is not None:
        seen["rows"] = met
    matched = met.withColumn(
        "_match", F.last("_right", ignorenulls=True).over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return matched.where(F.col("_rank") == 2).select(
        "_left.*", *[F.col(f"_match.{v}").alias(v) for v in values],
        F.col("_match.matched_ts").alias("matched_ts"))


def entitled(records: DataFrame, levels: DataFrame, user_level: int | Column) -> DataFrame:
    """Rows whose entitlement is at or below the user's level; ``none`` is public."""
    bound = F.lit(user_level) if isinstance(user_level, int) else user_level
    return (lookup(records, levels, ["entitlement"], "inner")
            .where(F.col("level") <= bound).drop("level"))
