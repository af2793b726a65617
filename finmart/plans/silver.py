"""Silver: typed, renamed and cleaned entities.

Hygiene filters run on the raw source columns, before the casts, so Catalyst
pushes them into the parquet scan.  Money is DECIMAL from here on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.functions.decimals import MONEY, QTY, RATE, money_round_two_step
from finmart.functions.metadata import META_COLUMNS

# Fixed value: the first version of every customer is back-dated to this
# instant so facts older than the first snapshot still resolve.
BEGINNING_OF_TIME = "1900-01-01 00:00:00"


def _trim(c: str):
    return F.trim(F.col(c)).cast("string")


def silver_orders(b: DataFrame) -> DataFrame:
    od = F.col("o_orderdate")
    return (b.filter(F.col("o_orderkey").isNotNull() & F.col("o_custkey").isNotNull() & od.isNotNull())
             .select(F.col("o_orderkey").cast("long").alias("order_id"),
                     F.col("o_custkey").cast("long").alias("customer_id"),
                     F.col("o_orderstatus").cast("string").alias("order_status_code"),
                     F.col("o_totalprice").cast(MONEY).alias("order_total_price"),
                     od.cast("date").alias("order_date"),
                     _trim("o_orderpriority").alias("order_priority"),
                     _trim("o_clerk").alias("clerk_id"),
                     F.col("o_shippriority").cast("int").alias("ship_priority"),
                     _trim("o_comment").alias("order_comment"),
                     F.year(od).cast("int").alias("order_year"),
                     F.month(od).cast("int").alias("order_month"),
                     F.quarter(od).cast("int").alias("order_quarter"),
                     *META_COLUMNS))


def derived_amounts() -> dict[str, Column]:
    """The amounts of a line that follow from its price and rates."""
    price, disc, tax = F.col("extended_price"), F.col("discount_rate"), F.col("tax_rate")
    return {"discount_amount": money_round_two_step(price * disc),
            "net_revenue": money_round_two_step(price * (F.lit(1) - disc)),
            "tax_amount": money_round_two_step(price * tax)}


def silver_lineitem(b: DataFrame) -> DataFrame:
    hygiene = (F.col("l_orderkey").isNotNull() & F.col("l_linenumber").isNotNull()
               & (F.col("l_quantity") > 0) & (F.col("l_extendedprice") > 0)
               & F.col("l_discount").between(0, 1) & F.col("l_tax").between(0, 1))
    typed = b.filter(hygiene).select(
        F.col("l_orderkey").cast("long").alias("order_id"),
        F.col("l_linenumber").cast("int").alias("line_number"),
        F.col("l_partkey").cast("long").alias("part_id"),
        F.col("l_suppkey").cast("long").alias("supplier_id"),
        F.col("l_quantity").cast(QTY).alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("extended_price"),
        F.col("l_discount").cast(RATE).alias("discount_rate"),
        F.col("l_tax").cast(RATE).alias("tax_rate"),
        _trim("l_returnflag").alias("return_flag"),
        _trim("l_linestatus").alias("line_status"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_commitdate").cast("date").alias("commit_date"),
        F.col("l_receiptdate").cast("date").alias("receipt_date"),
        _trim("l_shipinstruct").alias("ship_instruction"),
        _trim("l_shipmode").alias("ship_mode"),
        _trim("l_comment").alias("line_comment"),
        *META_COLUMNS)
    # Derived amounts go last: discount_amount, net_revenue, tax_amount.
    return typed.withColumns(derived_amounts())


def silver_part(b: DataFrame) -> DataFrame:
    return (b.filter(F.col("p_partkey").isNotNull())
             .select(F.col("p_partkey").cast("long").alias("part_id"),
                     _trim("p_name").alias("part_name"),
                     _trim("p_mfgr").alias("manufacturer"),
                     F.upper(F.trim(F.col("p_brand"))).cast("string").alias("brand"),
                     _trim("p_type").alias("part_type"),
                     F.col("p_size").cast("int").alias("part_size"),
                     _trim("p_container").alias("container"),
                     F.col("p_retailprice").cast(MONEY).alias("retail_price"),
                     _trim("p_comment").alias("part_comment"),
                     *META_COLUMNS))


def silver_supplier(b: DataFrame) -> DataFrame:
    return (b.filter(F.col("s_suppkey").isNotNull())
             .select(F.col("s_suppkey").cast("long").alias("supplier_id"),
                     _trim("s_name").alias("supplier_name"),
                     _trim("s_address").alias("supplier_address"),
                     F.col("s_nationkey").cast("long").alias("nation_id"),
                     _trim("s_phone").alias("supplier_phone"),
                     F.col("s_acctbal").cast(MONEY).alias("account_balance"),
                     _trim("s_comment").alias("supplier_comment"),
                     *META_COLUMNS))


def silver_partsupp(b: DataFrame) -> DataFrame:
    # NULL cost fails ">= 0" and is dropped; zero cost is kept.
    return (b.filter(F.col("ps_partkey").isNotNull() & F.col("ps_suppkey").isNotNull()
                     & (F.col("ps_supplycost") >= 0))
             .select(F.col("ps_partkey").cast("long").alias("part_id"),
                     F.col("ps_suppkey").cast("long").alias("supplier_id"),
                     F.col("ps_availqty").cast("int").alias("available_quantity"),
                     F.col("ps_supplycost").cast(MONEY).alias("supply_cost_per_unit"),
                     _trim("ps_comment").alias("partsupp_comment"),
                     *META_COLUMNS))


def silver_nation(b: DataFrame) -> DataFrame:
    return b.select(F.col("n_nationkey").cast("long").alias("nation_id"),
                    _trim("n_name").alias("nation_name"),
                    F.col("n_regionkey").cast("long").alias("region_id"),
                    _trim("n_comment").alias("nation_comment"),
                    *META_COLUMNS)


def silver_region(b: DataFrame) -> DataFrame:
    return b.select(F.col("r_regionkey").cast("long").alias("region_id"),
                    _trim("r_name").alias("region_name"),
                    _trim("r_comment").alias("region_comment"),
                    *META_COLUMNS)


def silver_customer(snapshot: DataFrame) -> DataFrame:
    """Typed SCD2 rows from the customer snapshot (no load metadata).

    The first version of each customer is back-dated.  "First" is found with
    a grouped min joined back on the key (map-side combined, so a customer
    with very many versions is not one window task).
    """
    first = (snapshot.groupBy(F.col("c_custkey").alias("_fk"))
                     .agg(F.min("scd_valid_from").alias("_first_from")))
    s = snapshot.join(first, snapshot["c_custkey"].eqNullSafe(first["_fk"]), "inner")
    vf = F.col("scd_valid_from")
    return s.select(
        F.col("c_custkey").cast("long").alias("customer_id"),
        _trim("c_name").alias("customer_name"),
        _trim("c_address").alias("customer_address"),
        F.col("c_nationkey").cast("long").alias("nation_id"),
        _trim("c_phone").alias("customer_phone"),
        F.col("c_acctbal").cast(MONEY).alias("account_balance"),
        _trim("c_mktsegment").alias("market_segment"),
        _trim("c_comment").alias("customer_comment"),
        F.col("scd_id").cast("string").alias("scd_version_id"),
        F.when(vf == F.col("_first_from"), F.lit(BEGINNING_OF_TIME).cast("timestamp_ntz"))
         .otherwise(vf).cast("timestamp_ntz").alias("valid_from"),
        F.col("scd_valid_to").cast("timestamp_ntz").alias("valid_to"),
        F.col("scd_valid_to").isNull().alias("is_current"))
