"""Black-76 prices, closed-form Greeks and implied volatility as columns."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

RISK_FREE_RATE = 0.05

# Rational approximation of the normal distribution function after Hart, in the
# form published by West (2005). Fixed values, highest power first.
_HART_TOP = (0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383,
             112.079291497871, 221.213596169931, 220.206867912376)
_HART_BOTTOM = (0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461,
                296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)
_HART_LIMIT = 7.07106781186547


def _horner(x: Column, coefficients: tuple[float, ...]) -> Column:
    return reduce(lambda acc, c: acc * x + c, coefficients[1:], coefficients[0])


def normal_cdf(x: Column) -> Column:
    size = F.abs(x)
    bell = F.exp(-size * size / 2)
    near = bell * _horner(size, _HART_TOP) / _horner(size, _HART_BOTTOM)
    tail = size + F.lit(0.65)
    for k in (4, 3, 2, 1):
        tail = size + F.lit(float(k)) / tail
    far = bell / tail / F.lit(2.506628274631)
    upper = F.when(size > 37, F.lit(0.0)).when(size < _HART_LIMIT, near).otherwise(far)
    # Written so that the polynomials occur once.
    return F.when(x > 0, F.lit(1.0)).otherwise(F.lit(0.0)) + F.when(x > 0, F.lit(-1.0)).otherwise(F.lit(1.0)) * upper


def normal_pdf(x: Column) -> Column:
    return F.exp(-x * x / 2) / F.lit(math.sqrt(2 * math.pi))


def with_d1_d2(contracts: DataFrame, spot: Column, strike: Column, years: Column, sigma: Column) -> DataFrame:
    """Adds the arguments ``d1`` and ``d2`` of the distribution function, as columns.

    Prices mention them dozens of times. As columns of their own they are computed
    once a row: the optimizer merges no projection whose costly columns are used
    several times. Hand them to `black_76` and `greeks` as ``d``.
    """
    d1, _ = _d1_d2(spot, strike, years, sigma)
    return contracts.withColumns({"d1": d1}).withColumns(
        {"d2": F.col("d1") - sigma * F.sqrt(years)})


def _d1_d2(spot: Column, strike: Column, years: Column, sigma: Column) -> tuple[Column, Column]:
    # Zero or negative inputs give null instead of an arithmetic error.
    ok = (spot > 0) & (strike > 0) & (years > 0) & (sigma > 0)
    s, k = F.when(ok, spot), F.when(ok, strike)
    spread = F.when(ok, sigma * F.sqrt(years))
    d1 = (F.ln(s / k) + sigma * sigma / 2 * years) / spread
    return d1, d1 - spread


def black_76(spot: Column, strike: Column, years: Column, sigma: Column, is_call: Column,
             rate: float = RISK_FREE_RATE, d: tuple[Column, Column] | None = None) -> Column:
    d1, d2 = d or _d1_d2(spot, strike, years, sigma)
    sign = F.when(is_call, F.lit(1.0)).otherwise(F.lit(-1.0))
    forward = spot * normal_cdf(sign * d1) - strike * normal_cdf(sign * d2)
    return F.exp(years * F.lit(-rate)) * sign * forward


def greeks(spot: Column, strike: Column, years: Column, sigma: Column, is_call: Column,
           rate: float = RISK_FREE_RATE, d: tuple[Column, Column] | None = None) -> dict[str, Column]:
    """Derivatives of ``black_76``: per unit of spot, volatility, year and rate."""
    d1, _ = d = d or _d1_d2(spot, strike, years, sigma)
    discount = F.exp(years * F.lit(-rate))
    price = black_76(spot, strike, years, sigma, is_call, rate, d)
    density = discount * normal_pdf(d1)
    return {
        "delta": F.when(is_call, discount * normal_cdf(d1)).otherwise(-discount * normal_cdf(-d1)),
        "gamma": density / (spot * sigma * F.sqrt(years)),
        "vega": spot * density * F.sqrt(years),
        "theta": F.lit(rate) * price - spot * density * sigma / (F.lit(2.0) * F.sqrt(years)),
        "rho": -years * price,
    }


STEPS = 5


def with_implied_volatility(contracts: DataFrame, target: Column, spot: Column, strike: Column, years: Column,
                            is_call: Column, name: str = "sigma", rate: float = RISK_FREE_RATE,
                            low: float = 0.0001, high: float = 5.0, steps: int = STEPS) -> DataFrame:
    """Adds the volatility at which ``black_76`` gives the price ``target``.

    Prices are turned into b, the out-of-the-money price over the root of spot times
    strike, a function of x = -|ln(spot / strike)| and s = volatility times the root of
    the years. At s = sqrt(2 |x|) b turns from convex to concave. Below that point the
    steps go after 1 / ln b, which is almost a straight line in s squared; above it after
    ln(exp(x / 2) - b), whose distance to the upper limit it measures. First guesses are
    closed forms; then come ``steps`` Halley steps, which triple the right digits.

    Each step is a few columns that the next one mentions often, so that the optimizer
    leaves them as projections and every distribution function is computed once.
    Null where an input is not positive, the price has no value beyond the intrinsic one
    or lies outside what ``low`` and ``high`` give.
    """
    col = lambda n: F.col(f"_iv_{n}")
    sign = F.when(is_call, F.lit(1.0)).otherwise(F.lit(-1.0))
    usable = (spot > 0) & (strike > 0) & (years > 0)
    extra = target * F.exp(years * F.lit(rate)) - F.greatest(sign * (spot - strike), F.lit(0.0))
    steady = contracts.withColumns({
        "_iv_x": F.when(usable, -F.abs(F.ln(spot / strike))),
        "_iv_root": F.when(usable, F.sqrt(years)),
        "_iv_b": F.when(usable & (extra > 0), extra / F.sqrt(spot * strike))})
    x, b = col("x"), col("b")
    turn = F.sqrt(F.abs(x) * 2)
    top = F.exp(x / 2)
    steady = steady.withColumns({"_iv_top": top, "_iv_turn": turn, "_iv_b": F.when(b < top, b)}).withColumn(
        "_iv_at", col("top") / 2 - normal_cdf(-col("turn")) / col("top"))
    below = b < col("at")
    # With x = 0 there is nothing below the turning point, and its share of 0 / 0 is null.
    under = F.sqrt(x * x * 2 / (F.abs(x) - F.ln(b / col("at")) * 4))
    over = col("turn") + (b - col("at")) / col("top") * F.lit(math.sqrt(2 * math.pi))
    solved = steady.withColumn("_iv_below", below).withColumn("_iv_s", F.when(col("below"), under).otherwise(over))

    # The same expressions over the columns of the step before, whose names do not change.
    s, now, slope, bend, move = (col(n) for n in ("s", "now", "slope", "bend", "move"))
    rest, log, wanted = col("top") - now, F.ln(now), F.ln(b)
    ends = {"_iv_h": x / s + s / 2, "_iv_l": x / s - s / 2}
    values = {
        "_iv_now": col("top") * normal_cdf(col("h")) - normal_cdf(col("l")) / col("top"),
        "_iv_slope": F.exp(-x * x / (s * s * 2) - s * s / 8) / F.lit(math.sqrt(2 * math.pi)),
        "_iv_bend": x * x / (s * s * s) - s / 4}
    halley = {
        "_iv_move": F.when(col("below"), (wanted - log) * log / wanted * now / slope).otherwise(
            F.ln(rest / (col("top") - b)) * rest / slope),
        "_iv_curve": F.when(col("below"), bend - slope / now * (F.lit(1.0) + F.lit(2.0) / log)).otherwise(
            bend + slope / rest)}
    after = {"_iv_s": F.greatest(F.coalesce(
        s + move / F.greatest(F.lit(1.0) + move * col("curve") / 2, F.lit(0.25)), s), s / 4)}
    for _ in range(steps):
        for columns in (ends, values, halley, after):
            solved = solved.withColumns(columns)
    sigma = col("s") / col("root")
    inside = sigma.between(low, high)
    return solved.withColumn(name, F.when(inside, sigma)).select(*contracts.columns, name)
