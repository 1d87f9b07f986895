"""Document fingerprints: a homomorphic multiset hash of paragraphs.

Each paragraph hashes to a wide vector; the fingerprint is the sum of the vectors
of all paragraphs, lane by lane, modulo 2**16, with their number modulo 2**32
before it. The sum does not depend on the order of the paragraphs; inserting or
deleting one adds or subtracts its vector (`with_paragraph`, `without_paragraph`).

Lane j takes part of a paragraph's hash with probability 2**-(j % 8). The eight
lanes that always do make equal fingerprints of unequal multisets improbable; the
sparse ones differ the more seldom the fewer paragraphs two texts do not share,
so the number of differing lanes tells the size of the symmetric difference of
two multisets from a handful up to thousands of paragraphs. The likeness is one
minus that size over the size of both.

Only DataFrame functions are used; no Python runs in the tasks.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window, functions as F

LANES, STRATA, MODULUS = 64, 8, 1 << 16
COUNT_MODULUS = 1 << 32
SEGMENTS, BUCKET_ROWS = 128, 4096
SENT_RANGES = 250_000  # 4 MB of range heads; some billion documents


def _entries(paragraph_hash: Column, sums: Column, sign: int = 1) -> Column:
    """Lane sums plus (or minus) the vector of one paragraph."""
    def lane(value: Column, j: Column) -> Column:
        mixed = F.xxhash64(paragraph_hash, j)
        taken = mixed.bitwiseAND(_mask(j)) == 0
        entry = F.shiftrightunsigned(mixed, 48)
        added = value + F.when(taken, sign * entry).otherwise(0)
        return F.pmod(added, F.lit(MODULUS)).cast("int")

    return F.transform(sums, lane)


def _mask(j: Column) -> Column:
    return F.element_at(F.array(*[F.lit((1 << s) - 1).cast("long") for s in range(STRATA)]),
                        F.pmod(j, F.lit(STRATA)) + 1)


def paragraphs(text: Column) -> Column:
    """Lines with a character that is no ASCII white space."""
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^ \t-\r]"))


def fingerprint(text: Column) -> Column:
    """Struct (n, lanes) of a text; a null text counts as empty."""
    zero = F.struct(F.lit(0).cast("long").alias("n"),
                    F.array_repeat(F.lit(0).cast("int"), LANES).alias("lanes"))

    def add(state: Column, line: Column) -> Column:
        return F.struct((F.pmod(state["n"] + 1, F.lit(COUNT_MODULUS))).alias("n"),
                        _entries(line, state["lanes"]).alias("lanes"))

    hashes = F.transform(paragraphs(F.coalesce(text, F.lit(""))), lambda line: F.xxhash64(line))
    return F.aggregate(hashes, zero, add)


def with_paragraph(state: Column, line: Column, sign: int = 1) -> Column:
    """A fingerprint after the insertion of a paragraph."""
    return F.struct(F.pmod(state["n"] + sign, F.lit(COUNT_MODULUS)).alias("n"),
                    _entries(F.xxhash64(line), state["lanes"], sign).alias("lanes"))


def without_paragraph(state: Column, line: Column) -> Column:
    """A fingerprint after the deletion of a paragraph."""
    return with_paragraph(state, line, -1)


def as_text(state: Column) -> Column:
    """Hex digits: 8 of the number of paragraphs, then 4 a lane."""
    lanes = F.transform(state["lanes"], lambda v: F.substring(F.hex(v.cast("long") + MODULUS), 2, 4))
    return F.lower(F.concat(F.substring(F.hex(state["n"] + COUNT_MODULUS), 2, 8), F.array_join(lanes, "")))


def _difference_sizes() -> list[float]:
    """Size of the difference that makes so many lanes differ on average, for 0 to LANES lanes."""
    sizes = [0.0] + [2 ** (k / 16) for k in range(-16 * 2, 16 * 20)]
    expected = [sum(1 - (1 - 2.0 ** -(j % STRATA)) ** d for j in range(LANES)) for d in sizes]
    return [sizes[min(bisect_left(expected, lanes), len(sizes) - 1)] for lanes in range(LANES)] + [sizes[-1]]


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from two fingerprints alone; 1 for equal ones, two empty ones among them."""
    differ = F.aggregate(F.zip_with(a["lanes"], b["lanes"], lambda x, y: (x != y).cast("int")),
                         F.lit(0), lambda n, d: n + d)
    size = F.element_at(F.array(*[F.lit(d) for d in _difference_sizes()]), differ + 1)
    # The two numbers of paragraphs bound the difference from both sides.
    size = F.greatest(size, F.abs(a["n"] - b["n"]).cast("double"))
    both = F.greatest(a["n"] + b["n"], F.lit(1))
    return F.when(differ == 0, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - size / both))


def _buckets(docs: DataFrame) -> tuple[Column, int]:
    """A bucket number that rises with the key, and how many there can be.

    Segments are cut at approximate quantiles, each into equal ranges of ids, so
    that buckets hold some BUCKET_ROWS rows whatever the ids look like.
    """
    shares = [i / SEGMENTS for i in range(1, SEGMENTS)]
    row = docs.agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"),
                   F.percentile_approx("key", shares, 10_000).alias("cuts")).first()
    if not row["n"]:
        return F.lit(0).cast("long"), 1
    cuts = sorted({row["low"], *row["cuts"]})
    ends = [*cuts[1:], row["high"] + 1]
    per = max(1, -(-row["n"] // (SEGMENTS * BUCKET_ROWS)))
    inner = F.array(*[F.lit(c).cast("long") for c in cuts])
    # The last cut at or below the key.
    segment = F.size(F.filter(inner, lambda c: c <= F.col("key")))
    low = F.element_at(inner, segment)
    width = F.element_at(F.array(*[F.lit(float(e) - float(c)) for c, e in zip(cuts, ends)]), segment)
    share = (F.col("key").cast("double") - low.cast("double")) / width
    part = F.least(F.lit(per - 1), F.floor(share * per)).cast("long")
    return (segment - 1) * per + part, len(cuts) * per


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half replaced by the start of the next document
    in descending order of id; after the last comes the first. Null ids come
    last, equal ids are ordered by their text. A null text is empty. One row
    alone is its own next document. Other columns are not looked at.

    Rows are dealt to ranges of ids with one shuffle; the first row of a range
    also goes to the range before it, as its last row's next document.
    """
    least = -(1 << 63)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(least).cast("long")))
    bucket, most = _buckets(rows)
    # One row per range: its largest key, and the range that comes before it.
    ranges = rows.select(bucket.alias("bucket"), "key").groupBy("bucket").agg(F.max("key").alias("key"))
    order = Window.orderBy(F.desc("bucket"))
    heads = ranges.select("key", F.coalesce(
        F.lag("bucket").over(order),
        F.min("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ).alias("guest_of"))
    # At most one row of two numbers per range, whose number is known here; with
    # too many of them to send, Spark chooses the join.
    heads = F.broadcast(heads) if most <= SENT_RANGES else heads
    dealt = (rows.withColumn("own", bucket).join(heads, "key", "left")
             .withColumn("print", fingerprint(F.col("text")))
             .withColumn("place", F.explode(F.when(F.col("guest_of").isNull(), F.array(
                 F.struct(F.col("own").alias("bucket"), F.lit(False).alias("guest"))))
                 .otherwise(F.array(
                     F.struct(F.col("own").alias("bucket"), F.lit(False).alias("guest")),
                     F.struct(F.col("guest_of").alias("bucket"), F.lit(True).alias("guest")))))))
    follow = Window.partitionBy("place.bucket").orderBy("place.guest", F.desc("key"), F.xxhash64("text"), "text")
    paired = (dealt.withColumn("next", F.lead(F.struct("text", "print")).over(follow))
              .filter(~F.col("place.guest")))
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = paired.select(
        "doc_id", n.cast("long").alias("n_chars"), "print", "next",
        F.concat(F.substring("text", F.lit(1), n - half),
                 F.substring("next.text", F.lit(1), half)).alias("edited"))
    edited = edited.withColumn("edited_print", fingerprint(F.col("edited")))
    return edited.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next.print")).alias("near_next"))
