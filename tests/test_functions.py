"""Codecs and value functions against Python's own integers and dates."""

from datetime import datetime
from decimal import Context, Decimal, localcontext

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rowtide.functions import (
    capitalise,
    decode_decimal,
    encode_decimal,
    from_micros,
    from_millis,
    money,
    to_micros,
    to_millis,
    uniform_int,
)

FITTING = [
    0, 1, -1, 127, 128, -127, -128, -129, 255, 256, -12345, 9999999999, -9999999999,
    2**63 - 1, 2**63, -(2**63), -(2**63) - 1, 10**19, -(10**19), 10**20 - 1, -(10**20) + 1,
]
TOO_LARGE = [10**20, -(10**20), 2**100, -(2**100), 2**127 - 1, 2**200]


def shortest(n: int) -> bytes:
    return n.to_bytes((n if n >= 0 else ~n).bit_length() // 8 + 1, "big", signed=True)


def decoded(spark, values, **how):
    rows = [(i, None if v is None else bytearray(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, raw binary")
    out = df.select("i", decode_decimal(F.col("raw"), **how).alias("d")).collect()
    return [r.d for r in sorted(out)]


def test_decode_fitting_values(spark):
    expected = [Decimal(n).scaleb(-2) for n in FITTING]
    assert decoded(spark, [shortest(n) for n in FITTING]) == expected


def test_decode_empty_null_and_padded(spark):
    padded = [(-5).to_bytes(4, "big", signed=True), (-5).to_bytes(24, "big", signed=True),
              (300).to_bytes(40, "big", signed=True)]
    got = decoded(spark, [b"", None, *padded])
    assert got == [Decimal("0.00"), None, Decimal("-0.05"), Decimal("-0.05"), Decimal("3.00")]


def test_decode_overflow_to_null(spark):
    got = decoded(spark, [shortest(n) for n in TOO_LARGE], on_overflow="null")
    assert got == [None] * len(TOO_LARGE)


@pytest.mark.parametrize("n", TOO_LARGE)
def test_decode_overflow_fails(spark, n):
    with pytest.raises(PySparkException, match="does not fit"):
        decoded(spark, [shortest(n)])


def test_decode_takes_scale_from_the_column(spark):
    assert decoded(spark, [shortest(12345)], precision=12, scale=4) == [Decimal("1.2345")]


def test_encode_is_shortest(spark):
    numbers = [*FITTING, 10**37, -(10**37), 2**64, -(2**64), 2**64 - 1]
    df = spark.createDataFrame([(Decimal(n),) for n in numbers], "d decimal(38,0)")
    got = [bytes(r[0]) for r in df.select(encode_decimal(F.col("d"), 0)).collect()]
    assert got == [shortest(n) for n in numbers]


def numbers_of(precision):
    largest = 10**precision - 1
    return st.one_of(st.integers(-largest, largest), st.sampled_from([0, 1, -1, largest, -largest]))


@pytest.mark.parametrize(("precision", "scale"), [
    (38, 0), (38, 2), (38, 8), (38, 10), (38, 18), (38, 38), (30, 17), (20, 2), (18, 18), (18, 0), (9, 9), (1, 0)
])
@settings(max_examples=4, deadline=None)
@given(data=st.data())
def test_codec_is_exact_at_every_precision_and_scale(spark, precision, scale, data):
    numbers = data.draw(st.lists(numbers_of(precision), min_size=1, max_size=60))
    with localcontext(Context(prec=60)):
        amounts = [Decimal(n).scaleb(-scale) for n in numbers]
    rows = [(i, a, bytearray(shortest(n))) for i, (a, n) in enumerate(zip(amounts, numbers))]
    df = spark.createDataFrame(rows, f"i int, d decimal({precision},{scale}), raw binary")
    encoded, decoded = (
        [r[1] for r in sorted(df.select("i", c).collect())]
        for c in (encode_decimal(F.col("d"), scale, precision), decode_decimal(F.col("raw"), precision, scale))
    )
    assert [bytes(e) for e in encoded] == [shortest(n) for n in numbers]
    assert decoded == amounts


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-(10**18) + 1, 10**18 - 1), min_size=1, max_size=50))
def test_codec_round_trip(spark, numbers):
    amounts = [Decimal(n).scaleb(-2) for n in numbers]
    df = spark.createDataFrame([(a,) for a in amounts], "d decimal(20,2)")
    for precision in (38, 18):
        raw = encode_decimal(F.col("d"), 2, precision)
        assert [r[0] for r in df.select(decode_decimal(raw)).collect()] == amounts


def test_micros(spark):
    micros = [1700000000123456, -1500000, 1, -1, None]
    df = spark.createDataFrame([(m,) for m in micros], "m long")
    second = [r[0] for r in df.select(from_micros(F.col("m")).cast("timestamp_ntz")).collect()]
    assert second == [
        datetime(2023, 11, 14, 22, 13, 20), datetime(1969, 12, 31, 23, 59, 59),
        datetime(1970, 1, 1), datetime(1970, 1, 1), None,
    ]
    exact = df.select(from_micros(F.col("m"), "micro").cast("timestamp_ntz")).collect()
    assert exact[0][0] == datetime(2023, 11, 14, 22, 13, 20, 123456)
    assert exact[1][0] == datetime(1969, 12, 31, 23, 59, 58, 500000)


def test_micros_keep_the_instant_where_clocks_are_set_back(spark):
    """One hour apart, the same wall clock: no text in between, so they stay apart."""
    df = spark.createDataFrame([(1698539400000000,), (1698543000000000,)], "m long")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Warsaw")
    try:
        got = df.select(F.unix_micros(from_micros(F.col("m")))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r[0] for r in got] == [1698539400000000, 1698543000000000]


def test_millis(spark):
    df = spark.createDataFrame([(1700000000123,), (-1,)], "m long")
    got = [r[0] for r in df.select(from_millis(F.col("m")).cast("timestamp_ntz")).collect()]
    assert got[0] == datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert got[1] == datetime(1969, 12, 31, 23, 59, 59, 999000)


def test_to_epoch(spark):
    times = [datetime(1969, 12, 31, 23, 59, 58, 999999), datetime(9999, 12, 31, 23, 59, 59, 999999), datetime(1, 1, 1)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    for column, zoneless in ((F.col("t"), True), (F.col("t").cast("timestamp"), False)):
        got = df.select(to_micros(column, zoneless), to_millis(column, zoneless)).collect()
        assert [tuple(r) for r in got] == [
            (-1000001, -1001), (253402300799999999, 253402300799999), (-62135596800000000, -62135596800000)
        ]


def test_unknown_options():
    with pytest.raises(ValueError):
        decode_decimal(F.lit(b""), on_overflow="wrap")
    with pytest.raises(ValueError):
        from_micros(F.lit(1), "hour")


def test_generator_functions(spark):
    df = spark.createDataFrame([("hELLO", 10.126, 0.0), ("", 499.994, 0.999)], "w string, x double, u double")
    got = df.select(
        capitalise(F.col("w")), money(F.col("x")), uniform_int(1, 3, F.col("u"))
    ).collect()
    assert [tuple(r) for r in got] == [
        ("Hello", Decimal("10.13"), 1), ("", Decimal("499.99"), 3)
    ]


def test_wide_decimals_take_their_own_digits(spark):
    """Small, negative, longest and rounded numbers, and those of another scale than they are encoded at."""
    texts = ["0", "-0.000000000000000001", "0.000001", "-0.000000999999999999", "1.5", "12345678901234567890.123456789012345678", "-99999999999999999999.999999999999999999"]
    table = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("v", F.col("t").cast("decimal(38,18)"))
    for text, raw in table.select("t", encode_decimal(F.col("v"), 18, 38)).collect():
        number = int(Decimal(text).scaleb(18).to_integral_exact()) if len(text) < 25 else int(text.replace(".", ""))
        assert int.from_bytes(raw, "big", signed=True) == number
    odd = spark.sql("SELECT CAST(2.5 AS DECIMAL(38,1)) AS v")
    assert [int.from_bytes(odd.select(encode_decimal(F.col("v"), s, 38)).first()[0], "big") for s in (0, 1, 3)] == [3, 25, 2500]


def test_decimal_scales_evaluates_no_generator(spark, sf_dir):
    from rowtide.plans import QUERIES

    plan = QUERIES["decimal_scales"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("Project") >= 6
