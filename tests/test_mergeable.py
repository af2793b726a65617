"""Distinct counts as bitmaps, key filters, and checks on new rows only."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from finmart.operators import checks as C
from finmart.operators.distinct_bitmaps import distinct_bitmaps, distinct_counts, rolling_months
from finmart.operators.key_filter import blocks_for, key_filter, let_through, merged_filters
from finmart.streaming.landing import LandingLog
from finmart.streaming.new_row_checks import NewRowRelationships, NewRowUnique


def folder():
    return "file://" + tempfile.mkdtemp(prefix="finmart-merge-")


def test_bitmaps_count_distinct_ids_of_any_union(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice([202011, 202012, 202101, 202103]),
             rng.choice([None, 0, 1, -5, 32767, 32768, 32769, 10**12, rng.randrange(200)])) for _ in range(900)]
    df = spark.createDataFrame(rows, "g string, order_year_month_key int, id bigint")
    stored = distinct_bitmaps(df, ["g", "order_year_month_key"], "id").checkpoint()
    for keys in (["g", "order_year_month_key"], ["g"], ["order_year_month_key"], []):
        want = df.groupBy(*keys).agg(F.count_distinct("id").alias("n_distinct"))
        assert sorted(map(str, distinct_counts(stored, keys).select(*keys, "n_distinct").collect())) == \
            sorted(map(str, want.collect()))
    index = {202011: 0, 202012: 1, 202101: 2, 202102: 3, 202103: 4}
    got = {(r.g, r.order_year_month_key): r.n_distinct for r in rolling_months(stored, ["g"], 3).collect()}
    assert got == {(g, m): len({i for h, n, i in rows if h == g and i is not None and 0 <= at - index[n] <= 2})
                   for g in "ab" for m, at in index.items()}
    assert distinct_counts(distinct_bitmaps(df.limit(0), [], "id"), []).first()[0] == 0


def test_key_filter_has_no_false_negatives_and_few_false_positives(spark):
    a = spark.range(0, 20_000).select(F.col("id").alias("k"), F.concat(F.lit("x"), "id").alias("l"))
    b = spark.range(50_000, 60_000).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("l"))
    blocks, key = blocks_for(30_000), ["k", "l"]
    stored = merged_filters(key_filter(a, key, blocks), key_filter(b, key, blocks)).checkpoint()
    assert stored.count() <= blocks
    for rows in (a, b):
        assert let_through(rows, key, stored, blocks).count() == rows.count()
    other = spark.range(100_000, 120_000).select(F.col("id").alias("k"), F.concat(F.lit("x"), "id").alias("l"))
    assert let_through(other, key, stored, blocks).count() < 400


@pytest.mark.parametrize("key", [["order_id"], ["order_id", "line"]])
def test_unique_on_new_rows_fails_as_the_full_check(spark, key):
    log = LandingLog(spark, folder(), "order_id", buckets=16)
    check = NewRowUnique(spark, folder(), log, key, expected_keys=5000)
    batches = [
        spark.range(0, 1000).selectExpr("id order_id", "cast(id % 3 as int) line"),
        spark.range(1000, 1500).selectExpr("id order_id", "cast(null as int) line")
        .union(spark.sql("select * from values (7L, 1), (7L, 1), (8L, 9), (null, 1), (1400L, null) t(order_id, line)")),
        spark.range(2000, 2100).selectExpr("id order_id", "1 line")
        .union(spark.sql("select * from values (7L, 1), (1400L, null), (1400L, 4), (2000L, 1) t(order_id, line)")),
    ]
    so_far = None
    for i, rows in enumerate(batches):
        log.land(i, rows)
        check.follow(i)
        check.follow(i)  # nothing new
        so_far = rows if so_far is None else so_far.union(rows)
        want = (C.unique(so_far, key[0]).withColumnRenamed("unique_field", key[0]) if len(key) == 1
                else C.unique_combination(so_far, key)).select(*key, "n_records")
        assert sorted(map(str, check.failures().select(*key, "n_records").collect())) == sorted(map(str, want.collect()))
    assert check.failures().count() >= 2
    assert check.state()["read_history"] < 16  # few buckets held what the filter let through
    with pytest.raises(ValueError):
        NewRowUnique(spark, folder(), log, ["line"])


def test_relationships_on_new_rows_fail_as_the_full_check(spark):
    orders = LandingLog(spark, folder(), "order_id", buckets=4)
    customers = LandingLog(spark, folder(), "customer_id", buckets=4)
    check = NewRowRelationships(spark, folder(), orders, "customer_id", customers, "customer_id")

    def kids(*ids):
        return spark.createDataFrame([(i, c) for i, c in enumerate(ids)], "order_id bigint, customer_id bigint")

    def folks(*ids):
        return spark.createDataFrame([(i,) for i in ids], "customer_id bigint")

    steps = [(kids(1, 2, 2, 3, None, -4), folks(1, 3)), (kids(40_000, 2, 5), None), (None, folks(2, 40_000)),
             (kids(-4, 99, 5, 1), folks(-4, 1, None))]
    children, parents = kids(), folks()
    for i, (kid, folk) in enumerate(steps):
        if kid is not None:
            orders.land(i, kid)
            children = children.union(kid)
        if folk is not None:
            customers.land(i, folk)
            parents = parents.union(folk)
        check.follow(i)
        full = C.relationships(children, "customer_id", parents, "customer_id").groupBy("customer_id").count()
        assert sorted((r.value, r.n) for r in check.failures().collect()) == sorted(tuple(r) for r in full.collect())
    assert sorted((r.value, r.n) for r in check.failures().collect()) == [(5, 2), (99, 1)]
