from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodgelake.functions.numeric import avg_exact, pct_change, ratio_pct, round_ratio


def exact(num: Decimal, den: int) -> Decimal:
    q = num / Decimal(den)
    return abs(q).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) * (1 if q >= 0 else -1)


def test_half_cent_rounds_away_from_zero(spark):
    df = spark.createDataFrame([("2969167.03", 2), ("-3.31", 2), ("1.00", 0), (None, 3)], "n string, d long")
    out = df.select(round_ratio(F.col("n").cast("decimal(20,2)"), "d").alias("r")).collect()
    assert [r.r for r in out] == [Decimal("1484583.52"), Decimal("-1.66"), None, None]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**9)), min_size=1, max_size=20))
def test_round_ratio_matches_exact_decimal(spark, pairs):
    rows = [(str(Decimal(n) / 100), d) for n, d in pairs]
    df = spark.createDataFrame(rows, "n string, d long")
    got = [r.r for r in df.select(round_ratio(F.col("n").cast("decimal(20,2)"), "d").alias("r")).collect()]
    assert got == [exact(Decimal(n), d) for n, d in rows]


def test_avg_rounds_once(spark):
    # mean 0.004999...: one rounding gives 0.00; rounding a 6-digit quotient first gives 0.01
    n = 20001
    df = spark.range(n).select(F.when(F.col("id") < 10000, F.lit("0.01")).otherwise(F.lit("0.00"))
                               .cast("decimal(14,2)").alias("x"))
    assert df.agg(avg_exact("x").alias("a")).first().a == Decimal("0.00")


def test_ratio_and_pct_change(spark):
    df = spark.createDataFrame([(2, 3, None), (0, 2, 2), (3, 0, 0), (3, 3, 2)], "a long, b long, prev long")
    out = df.select(ratio_pct("a", "b").alias("r"), pct_change("a", "prev").alias("p")).collect()
    assert [r.r for r in out] == [Decimal("66.67"), Decimal("0.00"), None, Decimal("100.00")]
    assert [r.p for r in out] == [None, Decimal("-100.00"), None, Decimal("50.00")]
