"""Quality rules: base rules and robust multivariate outliers per language and source.

A text that passes the base rules is described by four transformed statistics:
the logarithm of its mean word length, and the arcsine of the square root of its
shares of symbols, repeated lines and repeated words. For each language and
source, the minimum-covariance-determinant estimate of their location and
scatter is found by concentration steps: from the medians and median deviations,
the `core` share of texts nearest to the centre gives the next centre and
scatter, `steps` times, and a last step weighs in all texts near to it. A text
whose squared Mahalanobis distance exceeds the chi-squared quantile `keep` is
rejected. Most clean texts have no symbols or repeats at all, so the scatter of
any core would be singular; each statistic has a least deviation, `FLOORS`. That
of a share is how finely it can be told, 1 / (2 sqrt(n)) after the transform, where
n is what the shortest texts allow: some 11 lines, 50 / 3 windows of words side by
side, 400 characters; that of the mean word length is a twentieth. At the cut-off
`keep` a text in the tightest pool goes with 38 % repeated words, 51 % repeated
lines or 1.8 % symbols and nothing else.

Sources with fewer than `least` texts of a language are pooled, and languages
with fewer than that in the pool again; estimates are sums over all texts of a
group, combined in the tasks first. Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ticktide.llm.tables import checkpointed

SPACE = r"[\x20\x09-\x0D]+"
VECTOR = ("word_length", "symbol_share", "line_share", "repeat_share")
FLOORS = (0.05, 0.025, 0.15, 0.1225)
MOST_POOLS = 100_000   # one row a pool is sent to all tasks up to so many pools
COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def chi2_share(x: float, degrees: int) -> float:
    """Distribution function of chi squared for an even number of degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))


def chi2_quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_share(middle, degrees) < share else (low, middle)
    return high


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source") -> DataFrame:
    """The base statistics of each row, with its text's hash, language, source and vector."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", SPACE, -1), ""))
    # Windows by hash; `words` is a column of its own, so each is split once.
    n = F.size("words")
    windows = F.transform(
        F.slice("words", F.lit(1), F.greatest(n - 2, F.lit(0))),
        lambda word, i: F.xxhash64(word, F.get("words", i + 1), F.get("words", i + 2)))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id", "lang", "source", F.xxhash64("text").alias("text_hash"),
        n.cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.alias("lines"), windows.alias("windows"))
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.select(
        "doc_id", "lang", "source", "text_hash", "n_words", "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeated, ordered).alias("ordered"))
    # Equal windows are neighbours; each covers three words.
    hit = F.transform("ordered", lambda w, k: F.when(
        (F.get("ordered", k - 1)["h"] == w["h"]) | (F.get("ordered", k + 1)["h"] == w["h"]), w["i"]))
    covered = F.array_distinct(F.flatten(F.transform(
        F.filter(hit, lambda i: i.isNotNull()), lambda i: F.array(i, i + 1, i + 2))))
    rows = rows.withColumn("n_repeat_words", F.when(
        F.col("ordered").isNotNull(), F.size(covered)).otherwise(0).cast("long")).drop("ordered")

    def share(part: Column, whole: Column) -> Column:
        return F.asin(F.sqrt(F.least(F.lit(1.0), part / F.greatest(whole, F.lit(1)))))

    return rows.select(
        "*", ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        F.log(F.greatest(F.lit(1.0), F.col("word_chars") / F.greatest("n_words", F.lit(1)))).alias("word_length"),
        share(F.col("n_symbols"), F.col("word_chars")).alias("symbol_share"),
        share(F.col("n_dup_lines"), F.col("n_lines")).alias("line_share"),
        share(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_share"))


def grouped(rows: DataFrame, least: int) -> DataFrame:
    """Adds ``pool``: language and source, the language's pool, or the pool of the rest."""
    passing = rows.filter(~F.col("base_failed"))
    sizes = passing.groupBy("lang", "source").agg(F.count("*").alias("n"))
    rest = sizes.filter(F.col("n") < least).groupBy("lang").agg(F.sum("n").alias("n_rest"))
    pools = sizes.join(rest, "lang", "left").select(
        "lang", "source",
        F.when(F.col("n") >= least, F.to_json(F.array("lang", "source")))
        .when(F.col("n_rest") >= least, F.to_json(F.array("lang"))).otherwise("[]").alias("pool"))
    return rows.join(pools, ["lang", "source"], "left")


def _moments(rows: DataFrame, scale: float) -> DataFrame:
    """Location and the Cholesky factor of the scatter of each pool."""
    sums = [F.avg(v).alias(f"m{i}") for i, v in enumerate(VECTOR)]
    sums += [F.avg(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"p{i}{j}")
             for i in range(len(VECTOR)) for j in range(i + 1)]
    table = rows.groupBy("pool").agg(*sums)
    size = len(VECTOR)
    for j in range(size):
        for i in range(j, size):
            scatter = scale * (F.col(f"p{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}"))
            for k in range(j):
                scatter = scatter - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            if i == j:
                # Rounding may leave a hair below zero.
                factor = F.sqrt(F.greatest(scatter, F.lit(0.0)) + FLOORS[i] ** 2)
            else:
                factor = scatter / F.col(f"l{j}{j}")
            table = table.withColumn(f"l{i}{j}", factor)
    return table.select("pool", *[f"m{i}" for i in range(size)],
                        *[f"l{i}{j}" for i in range(size) for j in range(i + 1)])


def _by_pool(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` with the row of their pool from a checkpointed table.

    A source may hold a third of all rows, so these do not move: a pool stands for
    `least` texts, and the table is sent to all tasks after its rows are counted.
    """
    return rows.join(F.broadcast(table) if table.count() <= MOST_POOLS else table, "pool")


def with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Adds ``distance``, the squared Mahalanobis distance from the pool's centre."""
    keep = rows.columns
    rows = _by_pool(rows, estimates)
    for i in range(len(VECTOR)):
        rest = F.col(VECTOR[i]) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"z{k}")
        rows = rows.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    return rows.select(*keep, sum(F.col(f"z{i}") ** 2 for i in range(len(VECTOR))).alias("distance"))


def _nearest(rows: DataFrame, core: float) -> DataFrame:
    cuts = checkpointed(rows.groupBy("pool").agg(F.percentile_approx("distance", core, 10_000).alias("cut")))
    return _by_pool(rows, cuts).filter(F.col("distance") <= F.col("cut")).drop("cut")


def estimates(rows: DataFrame, core: float = 0.75, steps: int = 4) -> DataFrame:
    """Minimum-covariance-determinant estimates of each pool."""
    size = len(VECTOR)
    rows = rows.select("pool", *VECTOR)
    scale = core / chi2_share(chi2_quantile(core, size), size + 2)
    centre = checkpointed(rows.groupBy("pool").agg(
        *[F.percentile_approx(v, 0.5, 10_000).alias(f"c{i}") for i, v in enumerate(VECTOR)]))
    off = _by_pool(rows, centre).select(
        "pool", *VECTOR, *[F.abs(F.col(v) - F.col(f"c{i}")).alias(f"o{i}") for i, v in enumerate(VECTOR)])
    spread = checkpointed(off.groupBy("pool").agg(
        *[F.percentile_approx(f"o{i}", 0.5, 10_000).alias(f"s{i}") for i in range(size)]))
    first = _by_pool(off, spread).select("pool", *VECTOR, sum(
        (F.col(f"o{i}") / (1.4826 * F.col(f"s{i}") + FLOORS[i])) ** 2 for i in range(size)).alias("distance"))
    found = checkpointed(_moments(_nearest(first, core), scale))
    for _ in range(steps):
        found = checkpointed(_moments(_nearest(with_distance(rows, found), core), scale))
    near = with_distance(rows, found).filter(F.col("distance") <= chi2_quantile(0.975, size))
    final = checkpointed(_moments(near, 1.0))
    # A pool whose texts are all far from its own centre keeps the last estimate.
    return checkpointed(final.unionByName(found.join(final, "pool", "left_anti")))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source", keep: float = 0.99999, core: float = 0.75, steps: int = 4,
           least: int = 100) -> DataFrame:
    rows = checkpointed(statistics(docs, id_col, text_col, lang_col, source_col))
    rows = checkpointed(grouped(rows, least))
    passing = rows.filter(~F.col("base_failed"))
    kept = with_distance(passing, estimates(passing, core, steps)).withColumn(
        "kept", F.col("distance") <= chi2_quantile(keep, len(VECTOR)))
    failed = rows.filter("base_failed").withColumns({"distance": F.lit(None).cast("double"), "kept": F.lit(False)})
    return kept.unionByName(failed)


def quality(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance.

    A null or empty text has no words and fails. Null languages and sources form
    their own group. Texts that fail the base rules take no part in the estimates
    and have no distance. Repeated rows are judged each; other columns are not
    looked at; an empty table gives an empty table.
    """
    return judged(docs, **options).select(*COLUMNS, "distance")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Only the keys of rejected rows, an id and a text's hash, meet the texts.
    """
    rejected = judged(docs, id_col, text_col, **options).filter(~F.col("kept")).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.join(rejected, F.col(f"`{id_col}`").eqNullSafe(F.col("__id"))
                     & (F.xxhash64(text) == F.col("__hash")), "left_anti")
