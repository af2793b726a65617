import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from finmart.operators.ranking import global_ntile, global_rank
from finmart.plans.gold import customer_tiers


def test_global_ntile_matches_window(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 40)) for i in range(1, 302)]
    df = spark.createDataFrame(rows, "id long, v long").repartition(5)
    order = [F.col("v").desc(), F.col("id").asc()]
    got = {r["id"]: r["t"] for r in global_ntile(df, 3, order, "t").collect()}
    exp = {r["id"]: r["t"] for r in df.select("id", F.ntile(3).over(Window.orderBy(*order))
                                              .alias("t")).collect()}
    assert got == exp


def test_global_rank_with_ties(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([None, 1, 2, 2, 3, 5, 5, 5, 8])) for i in range(1, 120)]
    df = spark.createDataFrame(rows, "id long, v long").repartition(4)
    got = {r["id"]: r["rk"] for r in global_rank(df, ["v"], [F.col("v").desc_nulls_last()], "rk",
                                                 tie_break=[F.col("id")]).collect()}
    w = Window.orderBy(F.col("v").desc_nulls_last())
    exp = {r["id"]: r["rk"] for r in df.select("id", F.rank().over(w).alias("rk")).collect()}
    assert got == exp


def test_tiers_watch_tercile_lapsed(spark):
    rows = [(1, Decimal("-0.01"), True), (2, Decimal("0.00"), True), (3, None, True),
            (4, Decimal("50.00"), True), (5, Decimal("50.00"), True), (6, Decimal("10.00"), True),
            (7, Decimal("99.00"), False)]
    df = spark.createDataFrame(rows, "customer_id long, account_balance decimal(12,2), is_current boolean")
    t = {r["customer_id"]: r["customer_tier"] for r in customer_tiers(df).collect()}
    # non-negative balances 50, 50, 10, 0 -> terciles (ties broken by id): 4,5 | 6 | 2
    assert t == {1: "Watch", 2: "Maintain", 3: None, 4: "Strategic", 5: "Strategic", 6: "Growth"}
