"""Tags, side, bias and sentiment score of a trade."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Words that carry side or bias and leave the tag list; fixed values.
SIDE_AND_BIAS_WORDS = ("BEARISH", "BULLISH", "NEUTRAL", "ASK_SIDE", "BID_SIDE", "NO_SIDE", "MID_SIDE")
# Notional and premium thresholds; fixed values.
WHALE_NOTIONAL = 1_000_000
MILLIONAIRE_PREMIUM = 1_000_000


def keep_set(*tags: Column) -> Column:
    """Array of the tags that apply, in order. No lambda, which Spark would interpret."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(tag.isNotNull(), F.array(tag)).otherwise(none) for tag in tags])


def above_ask(price: Column, ask: Column) -> Column:
    return F.when(price > ask, F.lit("ABOVE_ASK"))


def below_bid(price: Column, bid: Column) -> Column:
    return F.when(price < bid, F.lit("BELOW_BID"))


def outside_book(price: Column, bid: Column, ask: Column) -> Column:
    """At most one of the two book tags; a price above the ask wins."""
    return placed_tag(price < bid, price > ask)


def placed_tag(below: Column, above: Column) -> Column:
    """The book tag from comparisons that are made already."""
    return F.when(above, F.lit("ABOVE_ASK")).when(below, F.lit("BELOW_BID"))


def whale(price: Column, qty: Column) -> Column:
    return F.when(price * qty.cast("decimal(10,0)") > F.lit(WHALE_NOTIONAL), F.lit("WHALE"))


def raw_whale(fixed_price: Column, qty: Column) -> Column:
    """The feed's historic test on the unscaled price, kept for comparison."""
    notional = fixed_price.cast("decimal(20,0)") * qty.cast("decimal(10,0)")
    return F.when(notional > F.lit(WHALE_NOTIONAL), F.lit("WHALE"))


def joined(*sources: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.concat(*[F.coalesce(s, empty) for s in sources])


def upper(words: Column) -> Column:
    return F.transform(words, F.upper)


def raw_tags(*sources: Column) -> Column:
    """Upper-cased concatenation; order and duplicates stay."""
    return upper(joined(*sources))


def side(tags: Column) -> Column:
    return (F.when(F.array_contains(tags, "ASK_SIDE"), "A")
            .when(F.array_contains(tags, "BID_SIDE"), "B").otherwise("N"))


def bias(tags: Column) -> Column:
    return (F.when(F.array_contains(tags, "BEARISH"), "R")
            .when(F.array_contains(tags, "BULLISH"), "B").otherwise("N"))


def without_side_and_bias(tags: Column) -> Column:
    """A filter, not a set difference: repeated tags are kept."""
    return F.filter(tags, lambda tag: ~tag.isin(*SIDE_AND_BIAS_WORDS))


def bull_bear_score(price: Column, bid: Column, ask: Column, bias_code: Column) -> Column:
    """-1 below the bid, 1 above the ask, else a sigmoid of the distance from
    the mid price whose sign follows the bias. Comparisons are exact."""
    doubles = [c.cast("double") for c in (price, bid, ask)]
    return placed_score(price < bid, price > ask, ask == bid, *doubles, bias_code)


def placed_score(below: Column, above: Column, locked: Column, p: Column, b: Column, a: Column,
                 bias_code: Column) -> Column:
    """The score from comparisons that are made already, and prices as doubles."""
    half_range = F.nullif((a - b) / 2, F.lit(0.0))
    x = (p - (b + a) / 2) / half_range
    magnitude = F.abs(F.lit(2.0) / (F.lit(1.0) + F.exp(-x)) - 1)
    signed = F.when(bias_code == "R", -magnitude).otherwise(magnitude)
    return (F.when(below, F.lit(-1.0)).when(above, F.lit(1.0))
            .when(locked, F.lit(0.0)).otherwise(signed))
