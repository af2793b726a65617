"""A customer holding a third of all orders: the order-grain as-of join must
be split by AQE (no single task owns the hot key) and stay exact.

The hot-key fixture is derived from the delivered orders (every third order
re-assigned to customer 1) and spread over several map tasks — AQE splits a
skewed reduce partition along map-output boundaries.
"""

from pyspark.sql import functions as F

from paths import SF_SMALL
from finmart.plans.gold import resolved_orders
from finmart.plans.pipeline import BuildOptions, Models

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


def test_hot_customer_asof_join_is_split_and_exact(spark):
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        m = Models(spark, SF_SMALL, BuildOptions(standin_costs=True))
        dc, geo = m["dim_customer"].checkpoint(), m["dim_geography"].checkpoint()
        hot = (m["orders"].withColumn("customer_id",
                                      F.when(F.col("order_id") % 3 == 0, F.lit(1))
                                       .otherwise(F.col("customer_id")))
                          .repartition(6).checkpoint())
        r = resolved_orders(hot, dc, geo)
        rows = r.collect()
        plan = r._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true) [customer_id" in plan
        assert len(rows) == hot.count()
        assert all(x["customer_key"] is not None for x in rows)
        hot_keys = {x["customer_key"] for x in rows if x["customer_id"] == 1}
        assert len(hot_keys) == 1
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
