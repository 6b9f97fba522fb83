from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopfloor.functions.numeric import percent, percent_half_even, ratio, row_ratio
from shopfloor.functions.ordering import pg_asc, pg_desc


def rounded(value: Fraction, places: int, mode) -> Decimal:
    units = Fraction(value * 10**places)
    whole = abs(units.numerator) // units.denominator
    rest = abs(units) - whole
    half = Fraction(1, 2)
    up = rest > half or (rest == half and (mode == ROUND_HALF_UP or whole % 2 == 1))
    whole += up
    return Decimal(-whole if value < 0 else whole).scaleb(-places)


# Both sides of the bound up to which 64-bit arithmetic is used.
whole = st.one_of(st.integers(-1000, 1000), st.integers(-(10**13), 10**13))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(whole, whole), min_size=40, max_size=80))
def test_ratio_is_exact_half_up(spark, pairs):
    pairs = pairs + [(1, 8), (-1, 8), (1, -8), (-1, -8), (5, 0), (0, 5), (2, 3), (10**12, 3), (10**12 + 1, 3), (10**13, -7), (10**17, 10**15 + 1)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = df.select(
        "n", "d", ratio(F.col("n"), F.col("d")).alias("a"), ratio(F.col("n"), F.col("d"), 0).alias("b"),
        percent(F.col("n"), F.col("d")).alias("c"),
    ).collect()
    for row in got:
        if row["d"] == 0:
            assert row["a"] is None and row["b"] is None and row["c"] is None
        else:
            value = Fraction(row["n"], row["d"])
            assert row["a"] == rounded(value, 2, ROUND_HALF_UP)
            assert row["b"] == rounded(value, 0, ROUND_HALF_UP)
            assert row["c"] == rounded(value * 100, 2, ROUND_HALF_UP)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-(2**31), 2**31 - 1), st.integers(-(2**31), 2**31 - 1)), min_size=40, max_size=80))
def test_row_ratio_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame(pairs + [(1, 0), (2, 3), (1, 800)], "n int, d int")
    for row in df.select("n", "d", row_ratio(F.col("n"), F.col("d"), percent=True).alias("a")).collect():
        expected = None if row["d"] == 0 else rounded(Fraction(row["n"] * 100, row["d"]), 2, ROUND_HALF_UP)
        assert row["a"] == expected


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**9)), min_size=40, max_size=80))
def test_percent_half_even(spark, pairs):
    pairs = pairs + [(1, 2000), (3, 2000), (1, 800), (3, 800)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    for row in df.select("n", "d", percent_half_even(F.col("n"), F.col("d")).alias("a")).collect():
        assert row["a"] == rounded(Fraction(row["n"] * 100, row["d"]), 1, ROUND_HALF_EVEN)


def test_ratio_does_not_round_twice(spark):
    df = spark.createDataFrame([(49_999_999, 10_000_000_000)], "n bigint, d bigint")
    assert df.select(ratio(F.col("n"), F.col("d")).alias("a")).first()["a"] == Decimal("0.00")


def test_null_inputs_give_null(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (None, None)], "n bigint, d bigint")
    assert [r[0] for r in df.select(ratio(F.col("n"), F.col("d"))).collect()] == [None] * 3


def test_null_order_is_postgresql_order(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    assert [r.v for r in df.orderBy(pg_desc("v")).collect()] == [None, 2, 1]
    assert [r.v for r in df.orderBy(pg_asc("v")).collect()] == [1, 2, None]
