"""Column functions: LLR, sampler, text helpers (hand-worked cases)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from affinity.functions.llr import independent, llr
from affinity.functions.sampling import keep_sampled, sample_hash
from affinity.functions.text import category_of_path, tokens


def _llr(spark, k11, a, b, n):
    row = spark.range(1).select(
        llr(F.lit(k11), F.lit(a), F.lit(b), F.lit(n)).alias("l"),
        independent(F.lit(k11), F.lit(a), F.lit(b), F.lit(n)).alias("ind")).first()
    return row.l, row.ind


def _entropy_llr(k11, k12, k21, k22):
    def xlx(x):
        return 0.0 if x == 0 else x * math.log(x)
    n = k11 + k12 + k21 + k22
    row = xlx(n) - xlx(k11 + k12) - xlx(k21 + k22)
    col = xlx(n) - xlx(k11 + k21) - xlx(k12 + k22)
    mat = xlx(n) - xlx(k11) - xlx(k12) - xlx(k21) - xlx(k22)
    return max(0.0, 2.0 * (row + col - mat))


def test_llr_perfect_association(spark):
    # (k11, k12, k21, k22) = (10, 0, 0, 10): a = b = 10, N = 20 -> 40 ln 2
    val, ind = _llr(spark, 10, 10, 10, 20)
    assert round(val, 5) == 27.72589
    assert abs(val - 40 * math.log(2)) < 1e-9
    assert not ind


def test_llr_independent_table_is_zero_and_flagged(spark):
    # (25, 25, 25, 25): a = b = 50, N = 100
    val, ind = _llr(spark, 25, 50, 50, 100)
    assert abs(val) < 1e-9
    assert ind


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 40), st.integers(0, 40), st.integers(0, 40), st.integers(1, 400))
def test_llr_ratio_form_equals_entropy_form(spark, k11, k12, k21, k22):
    a, b, n = k11 + k12, k11 + k21, k11 + k12 + k21 + k22
    val, _ = _llr(spark, k11, a, b, n)
    assert abs(val - _entropy_llr(k11, k12, k21, k22)) < 1e-7 * max(1.0, val)


def test_sampler_is_repeatable_and_rate_bounded(spark):
    df = spark.range(20000).select(F.lit("cart").alias("event"), (F.col("id") % 97).alias("u"),
                                   F.col("id").alias("i"))
    kept = lambda seed: df.where(keep_sampled(
        F.lit(0.3), sample_hash(F.col("event"), F.col("u"), F.col("i"), seed))).count()
    a, b = kept(1024), kept(1024)
    assert a == b
    assert 0.27 * 20000 < a < 0.33 * 20000
    assert df.where(keep_sampled(F.lit(1.0), F.lit(2**32 - 1))).count() == 20000


def test_category_of_path(spark):
    rows = spark.createDataFrame([("12",), ("12-34-56",), ("12-",), ("",), ("-5",)], "p string")
    got = [r.c for r in rows.select(category_of_path(F.col("p")).alias("c")).collect()]
    assert got == ["12", "34", "12", "", "5"]


def test_tokens_drop_trailing_blanks_only(spark):
    rows = spark.createDataFrame([("Red  Bolt ",), ("ring",)], "t string")
    got = [r.w for r in rows.select(tokens(F.col("t")).alias("w")).collect()]
    assert got == [["red", "", "bolt"], ["ring"]]
