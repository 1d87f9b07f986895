"""Golden values and properties of the column functions."""

import math
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ticktide.functions import checks, decimals, messages, pricing, symbols, tags, times

c = F.col


def test_coerce_down_cuts_toward_zero(one):
    row = one("a string, b string, x string", ("123.4567", "-123.4567", "1234.5"),
              a=decimals.coerce_down(c("a").cast("decimal(38,18)"), 5, 2),
              b=decimals.coerce_down(c("b").cast("decimal(38,18)"), 5, 2),
              x=decimals.coerce_down(c("x").cast("decimal(38,18)"), 5, 2))
    assert row == {"a": Decimal("123.45"), "b": Decimal("-123.45"), "x": None}


def test_half_even_and_half_up(one):
    row = one("a decimal(18,6)", (Decimal("0.125"),),
              even=decimals.coerce_half_even(c("a"), 4, 2), up=decimals.half_up_cents(c("a")))
    assert row["even"] == Decimal("0.12") and row["up"] == Decimal("0.13")


@pytest.mark.parametrize("value, cents", [("123.456789", "123.46"), ("123.454", "123.45")])
def test_half_up_golden(one, value, cents):
    assert one("a decimal(18,6)", (Decimal(value),), y=decimals.half_up_cents(c("a")))["y"] == Decimal(cents)


def test_currency_text(one):
    row = one("a decimal(18,6)", (Decimal("1234.567"),),
              usd=decimals.currency_text(c("a"), F.lit("USD")), chf=decimals.currency_text(c("a"), F.lit("CHF")))
    assert row == {"usd": "$1,234.57", "chf": "CHF1,234.57"}


def test_undefined_price_is_null(one):
    row = one("a bigint, b bigint", (decimals.UNDEF_PRICE, 1_960_000_000),
              a=decimals.feed_price(c("a")), b=decimals.feed_price(c("b")))
    assert row == {"a": None, "b": Decimal("1.960000000")}


def test_fixed_point_and_byte_forms_round_trip(spark):
    rng = random.Random(7)
    numbers = [0, 1, -1, 127, 128, -128, -129, 255, 256] + [
        rng.randrange(-10 ** 17, 10 ** 17) for _ in range(500)]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    x = decimals.from_fixed(c("n"), 6)
    raw = decimals.to_signed_bytes(x, 6)
    rows = df.select("n", decimals.to_fixed(x, 6).alias("back"), raw.alias("raw"),
                     decimals.from_signed_bytes(raw, 6).alias("decoded"), x.alias("x"),
                     decimals.from_wide_signed_bytes(6)(raw).alias("wide"),
                     decimals.to_wide_signed_bytes(6)(x).alias("wide_raw")).collect()
    for r in rows:
        width = (abs(r.n).bit_length() + 8) // 8
        assert r.back == r.n and bytes(r.raw) == r.n.to_bytes(width, "big", signed=True)
        assert r.decoded == r.x == r.wide and r.wide_raw == r.raw


def test_bytes_beyond_eight_round_trip(spark):
    numbers = [10 ** 25, -(10 ** 25), 2 ** 80 - 1, -(2 ** 80)]
    df = spark.createDataFrame([(Decimal(n).scaleb(-6),) for n in numbers], "x decimal(38,6)")
    raw = decimals.to_wide_signed_bytes(6)(c("x"))
    rows = df.select("x", decimals.from_wide_signed_bytes(6)(raw).alias("y"),
                     decimals.from_signed_bytes(raw, 6).alias("narrow")).collect()
    assert all(r.x == r.y and r.narrow is None for r in rows)


def test_detected_resolutions_agree(one):
    values = (1672531200, 1672531200000, 1672531200000000, 1672531200000000000, 19358)
    for v in values:
        row = one("v bigint", (v,), ms=times.any_to_millis(c("v")))
        assert row["ms"] == 1672531200000


def test_event_millis_needs_exact_digit_counts(one):
    row = one("a bigint, b bigint, d bigint", (1734094801744190849, 1734094801, 17340948017),
              a=times.event_millis(c("a")), b=times.event_millis(c("b")), d=times.event_millis(c("d")))
    assert row == {"a": 1734094801744, "b": 1734094801000, "d": None}


@pytest.mark.parametrize("seconds, words", [
    (179, "just now"), (180, "3 minutes ago"), (3700, "1 hours 1 minutes ago"),
    (43200, "12 hours ago"), (86400, "yesterday"), (86400 * 3, "3 days ago"), (-5, "just now")])
def test_friendly_delta(one, seconds, words):
    start = 1672531200000
    assert one("a bigint, b bigint", (start, start + seconds * 1000),
               w=times.friendly_delta(c("a"), c("b")))["w"] == words


def test_floor_division_is_exact_for_nanoseconds(spark):
    rng = random.Random(3)
    numbers = [rng.randrange(-2 ** 62, 2 ** 62) for _ in range(300)]
    rows = spark.createDataFrame([(n,) for n in numbers], "n bigint").select(
        "n", times.floor_div(c("n"), 1_000_000).alias("q")).collect()
    assert all(r.q == r.n // 1_000_000 for r in rows)


@pytest.mark.parametrize("price, bias, score", [
    ("95", "R", -1.0), ("115", "B", 1.0), ("105", "B", 0.0), ("107", "B", 0.197375), ("107", "R", -0.197375)])
def test_bull_bear_score(one, price, bias, score):
    row = one("p decimal(12,2), b decimal(12,2), a decimal(12,2), k string",
              (Decimal(price), Decimal(100), Decimal(110), bias),
              s=F.round(tags.bull_bear_score(c("p"), c("b"), c("a"), c("k")), 6))
    assert row["s"] == pytest.approx(score, abs=1e-9)


def test_score_of_a_locked_book(one):
    row = one("p decimal(12,2)", (Decimal(5),), s=tags.bull_bear_score(c("p"), c("p"), c("p"), F.lit("B")))
    assert row["s"] == 0.0


def test_tag_filter_keeps_repeats(one):
    row = one("t array<string>", (["sweep", "ask_side", "sweep", "bullish"],),
              t=tags.without_side_and_bias(tags.raw_tags(c("t"))))
    assert row["t"] == ["SWEEP", "SWEEP"]


def test_symbol_round_trip(spark):
    rng = random.Random(5)
    rows = [("".join(rng.choices("ABCDEFGXYZ", k=rng.randint(1, 6))),
             date(2000 + rng.randrange(100), rng.randint(1, 12), rng.randint(1, 28)),
             rng.choice("PC"), Decimal(rng.randrange(1, 99_999_999)) / 1000) for _ in range(300)]
    df = spark.createDataFrame(rows, "u string, e date, pc string, k decimal(22,9)")
    symbol = symbols.format_symbol(c("u"), c("e"), c("pc"), c("k"))
    parts = symbols.parse(symbol)
    for r in df.select("*", symbol.alias("s"), *[v.alias(f"_{n}") for n, v in parts.items()]).collect():
        assert len(r.s) == 21
        assert (r._underlying, r._expiration_date, r._put_call, r._strike) == (r.u, r.e, r.pc, r.k)


def test_symbol_golden(one):
    row = one("k decimal(22,9)", (Decimal("48.50"),), s=symbols.format_symbol(
        F.lit("AAPL"), F.lit(date(2024, 12, 18)), F.lit("C"), c("k")))
    assert row["s"] == "AAPL  241218C00048500"


def _black(s, k, t, v, call, r=0.05):
    cdf = lambda x: 0.5 * (1 + math.erf(x / math.sqrt(2)))
    d1 = (math.log(s / k) + v * v / 2 * t) / (v * math.sqrt(t))
    d2, cp = d1 - v * math.sqrt(t), 1 if call else -1
    return math.exp(-r * t) * cp * (s * cdf(cp * d1) - k * cdf(cp * d2))


def test_black_76_greeks_and_implied_volatility(spark):
    rng = random.Random(11)
    rows = [(rng.uniform(50, 150), rng.uniform(60, 140), rng.uniform(0.05, 2), rng.uniform(0.1, 0.9),
             rng.random() < 0.5) for _ in range(200)]
    df = spark.createDataFrame(rows, "s double, k double, t double, v double, call boolean")
    model = [c(n) for n in ("s", "k", "t", "v", "call")]
    price = pricing.black_76(*model)
    priced = df.select("*", price.alias("p"), *[g.alias(n) for n, g in pricing.greeks(*model).items()])
    out = pricing.with_implied_volatility(priced, c("p"), c("s"), c("k"), c("t"), c("call"), "iv").collect()
    h = 1e-5
    for r in out:
        a = (r.s, r.k, r.t, r.v, r.call)
        assert r.p == pytest.approx(_black(*a), abs=1e-9)
        bump = lambda i, d: _black(*[x + (d if j == i else 0) for j, x in enumerate(a[:4])], r.call)
        assert r.delta == pytest.approx((bump(0, h) - bump(0, -h)) / (2 * h), abs=1e-5)
        assert r.vega == pytest.approx((bump(3, h) - bump(3, -h)) / (2 * h), abs=1e-4)
        assert r.theta == pytest.approx(-(bump(2, h) - bump(2, -h)) / (2 * h), abs=1e-4)
        if r.vega > 0.5:
            assert r.iv == pytest.approx(r.v, abs=1e-6)


def test_implied_volatility_over_the_whole_range(spark):
    """Every volatility that a price can tell is found again, without Python workers."""
    rows = [(100.0, 100.0 * math.exp(m), t, v, call) for m in (-1.5, -0.4, -0.02, 0.0, 1e-9, 0.1, 0.7, 2.0)
            for t in (0.003, 0.1, 1.0, 4.0) for v in (0.02, 0.08, 0.3, 1.0, 2.5, 4.9) for call in (True, False)]
    df = spark.createDataFrame(rows, "s double, k double, t double, v double, call boolean")
    model = [c(n) for n in ("s", "k", "t", "v", "call")]
    priced = df.withColumn("p", pricing.black_76(*model)).withColumn("vega", pricing.greeks(*model)["vega"])
    solved = pricing.with_implied_volatility(priced, c("p"), c("s"), c("k"), c("t"), c("call"))
    assert "Python" not in solved._jdf.queryExecution().executedPlan().toString()
    told = [r for r in solved.collect() if r.vega > 1e-4 and r.v * math.sqrt(r.t) < 6]
    assert len(told) > 200
    for r in told:
        assert r.sigma == pytest.approx(r.v, abs=1e-9 / min(r.vega, 1)), r


def test_implied_volatility_without_an_answer_is_null(spark):
    rows = [(5.0, 100.0, 100.0, 0.0, True), (0.0, 100.0, 100.0, 1.0, True), (-1.0, 100.0, 100.0, 1.0, True),
            (101.0, 100.0, 100.0, 1.0, True), (9.0, 110.0, 100.0, 1.0, True), (None, 100.0, 100.0, 1.0, True),
            (5.0, 100.0, -1.0, 1.0, False), (1e-12, 100.0, 100.0, 1.0, True), (99.9999, 100.0, 100.0, 1.0, True)]
    df = spark.createDataFrame(rows, "p double, s double, k double, t double, call boolean")
    solved = pricing.with_implied_volatility(df, c("p"), c("s"), c("k"), c("t"), c("call"), rate=0.0)
    assert [r.sigma for r in solved.collect()] == [None] * len(rows)


def test_black_76_without_time_or_volatility_is_null(one):
    row = one("t double, v double", (0.0, 0.2), a=pricing.black_76(
        F.lit(1.0), F.lit(1.0), c("t"), c("v"), F.lit(True)))
    assert row["a"] is None


def test_normal_tail(one):
    row = one("x double", (-8.0,), far=pricing.normal_cdf(c("x")), one=pricing.normal_cdf(c("x") * -6))
    assert row["far"] == pytest.approx(6.22096057427e-16, rel=1e-6) and row["one"] == 1.0


def test_frames(one):
    good = messages.frame(F.lit(258), F.lit("body").cast("binary"))
    parts = messages.split_frame(c("f"))
    row = one("x int", (1,), f=good)
    assert bytes(row["f"]) == b"\x00\x00\x00\x01\x02body"
    assert one("f binary", (bytearray(row["f"]),), **{n: v for n, v in parts.items()}) == {
        "schema_id": 258, "payload": bytearray(b"body"), "reason": None}
    assert one("f binary", (bytearray(b"\x00\x00\x00\x00\x01"),), r=parts["reason"])["r"] == "frame too short"
    assert one("f binary", (bytearray(b"\x07\x00\x00\x00\x01x"),), r=parts["reason"])["r"] == "unexpected magic byte"


def test_headers_leave_out_nulls(one):
    built = messages.headers({"a": F.lit("1"), "b": F.lit(None).cast("string"), "c": F.lit(3)})
    row = one("x int", (1,), keys=F.transform(built, lambda h: h["key"]),
              found=messages.header_value(built, "c"), none=messages.header_value(built, "b"))
    assert row == {"keys": ["a", "c"], "found": "3", "none": None}


@pytest.mark.parametrize("text, ok", [
    ("abc", True), ("a b", True), ("", False), ("  ", False), ("a\tb", False), ("a b", False), (None, False)])
def test_printable_text(one, text, ok):
    assert one("t string", (text,), ok=checks.printable_text(c("t")))["ok"] is ok


def test_market_wall_time_follows_daylight_saving(one):
    row = one("a date, b date", (date(2023, 3, 10), date(2023, 3, 13)),
              a=times.market_wall_to_utc(c("a"), F.lit(570), "America/New_York"),
              b=times.market_wall_to_utc(c("b"), F.lit(570), "America/New_York"))
    assert row == {"a": datetime(2023, 3, 10, 14, 30), "b": datetime(2023, 3, 13, 13, 30)}
