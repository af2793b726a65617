from decimal import Decimal

from pyspark.sql import functions as F

from finmart.functions import (date_key, guarded_ratio, money_round_two_step, surrogate_key,
                               year_month_key)


def test_two_step_rounding(spark):
    # 29.99 * 0.0005 = 0.014995 -> 0.0150 -> 0.02 (one-step rounding would give 0.01)
    df = spark.createDataFrame([(Decimal("29.99"), Decimal("0.0005"))],
                               "p decimal(12,2), r decimal(5,4)")
    out = df.select(money_round_two_step(F.col("p") * F.col("r")).alias("x")).first()["x"]
    assert out == Decimal("0.02")


def test_surrogate_key_null_safe_and_ordered(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, 2), (2, 1)], "a long, b long")
    keys = [r["k"] for r in df.select(surrogate_key("a", "b").alias("k")).collect()]
    assert len(set(keys)) == 4 and all(len(k) == 32 for k in keys)


def test_date_keys(spark):
    df = spark.createDataFrame([("1995-03-07",), (None,)], "d string").select(
        F.col("d").cast("date").alias("d"))
    rows = df.select(date_key("d").alias("k"), year_month_key("d").alias("m")).collect()
    assert (rows[0]["k"], rows[0]["m"]) == (19950307, 199503)
    assert rows[1]["k"] is None


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("3.00")), (Decimal("1.00"), Decimal("0.00")),
                                (Decimal("1.00"), Decimal("-2.00"))], "n decimal(22,2), d decimal(22,2)")
    out = [r["r"] for r in df.select(guarded_ratio("n", "d").alias("r")).collect()]
    assert out == [Decimal("0.333333"), None, None]
