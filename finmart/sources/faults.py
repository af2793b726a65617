"""Relations with planted faults, derived from the clean ones: what the data
checks and the quarantine are shown to catch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.plans.catalogue import Check

#: Checks over ``faulty_orders``; every kind fails somewhere, one only warns,
#: one passes.
FAULT_CHECKS = [
    Check("orders", "order_date", "not_null"),
    Check("orders", "order_date", "not_null", severity="warn"),
    Check("orders", "order_id", "not_null"),
    Check("orders", "order_status_code", "accepted_values", {"values": ["F", "O", "P"]}),
    Check("orders", "customer_id", "relationships", {"to": "customer", "field": "customer_id"}),
    Check("orders", "order_id", "unique"),
    Check("orders", None, "unique_combination", {"columns": ["order_id", "order_date"]},
          where="order_status_code = 'F'"),
    Check("orders", None, "expression_is_true", {"expression": "order_total_price > 0 OR order_id < 0"}),
    Check("orders", "order_total_price", "expression_is_true", {"expression": ">= 0"}),
    Check("orders", "order_total_price", "positive_value"),
    Check("orders", "order_total_price", "positive_value", {"allow_zero": True}),
]


def faulty_orders(orders: DataFrame) -> DataFrame:
    """Silver orders with orphans, foreign codes, bad prices, missing dates and
    repeated rows."""
    of = lambda n: F.col("order_id") % n == 0
    rows = orders.select("order_id", "customer_id", "order_status_code", "order_total_price", "order_date")
    price = F.when(of(60), -1).when(of(61), 0).otherwise(F.col("order_total_price"))
    rows = rows.withColumns({
        "customer_id": F.when(of(50), -F.col("order_id")).otherwise(F.col("customer_id")),
        "order_status_code": F.when(of(40), "X").otherwise(F.col("order_status_code")),
        "order_total_price": price.cast("decimal(18,2)"),
        "order_date": F.when(~of(70), F.col("order_date"))})
    return rows.union(rows.filter(of(9)))


def faulty_lineitem(lineitem: DataFrame) -> DataFrame:
    """Bronze lines of which some break the hygiene rules of the silver layer."""
    of = lambda n: F.col("l_orderkey") % n == 0
    return lineitem.withColumns({
        "l_quantity": F.when(of(31), -F.col("l_quantity")).otherwise(F.col("l_quantity")),
        "l_discount": F.when(of(37), F.lit(1.5).cast(lineitem.schema["l_discount"].dataType))
                       .otherwise(F.col("l_discount")),
        "l_tax": F.when(~of(41), F.col("l_tax")),
        "l_linenumber": F.when(~of(43), F.col("l_linenumber"))})


def faulty_customers(customer: DataFrame) -> DataFrame:
    """A customer extract with missing keys (53), keys that come with different
    rows (59) and rows that are repeated as they are (61)."""
    of = lambda n: F.col("c_custkey") % n == 0
    other = customer.filter(of(59)).withColumn("c_name", F.concat("c_name", F.lit(" (2)")))
    rows = customer.unionByName(other).unionByName(customer.filter(of(61)))
    return rows.withColumn("c_custkey", F.when(~of(53), F.col("c_custkey")))


def faulty_order_ids(orders: DataFrame) -> DataFrame:
    """Raw order identifiers as text, some too long, with letters, or missing."""
    of = lambda n: F.col("o_orderkey") % n == 0
    key = F.col("o_orderkey").cast("string")
    return orders.select(
        F.when(of(97), F.concat(F.lit("9999999999999"), key)).when(of(89), F.concat(key, F.lit("x")))
         .when(~of(83), F.concat(F.lit(" "), key)).alias("order_id"),
        F.when(of(79), F.lit("")).otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(of(73), F.lit("Clerk#7a")).otherwise(
            F.concat(F.lit("Clerk#"), F.lpad((F.col("o_orderkey") % 1000).cast("string"), 9, "0")))
         .alias("clerk_id"))


def unknown_margins(fact: DataFrame, dim_cust: DataFrame, dim_prt: DataFrame) -> DataFrame:
    """The fact without the costs of every fiftieth customer and of every part whose
    id is divisible by 5: some customers have no known margin at all."""
    customers = dim_cust.select("customer_key", (F.col("customer_id") % 50 == 0).alias("_no_cost"))
    parts = dim_prt.select("part_key", (F.col("part_id") % 5 == 0).alias("_no_part"))
    rows = fact.join(customers, "customer_key", "left").join(parts, "part_key", "left")
    gap = F.coalesce("_no_cost", F.lit(False)) | F.coalesce("_no_part", F.lit(False))
    return rows.withColumns({c: F.when(~gap, F.col(c)) for c in ("supply_cost", "gross_margin", "margin_rate")}) \
        .select(*fact.columns)


def older_parts(part: DataFrame) -> DataFrame:
    """An older state of the silver parts: all named otherwise, and as many again that
    are gone since."""
    gone = part.withColumn("part_id", -F.col("part_id") - 1)
    return part.unionByName(gone).withColumn("part_name", F.concat(F.lit("before: "), F.coalesce("part_name", F.lit(""))))
