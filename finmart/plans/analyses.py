"""The twelve analyst queries over the gold layer.

Joins from the (large) fact to a large dimension are preceded by a partial
aggregation on the join key — sums and counts are decomposable, so only one
row per key meets the dimension instead of every line.  Every top-k has a
total order (natural keys appended) so the cut is deterministic.  Ratios the
queries leave uncast are published as DECIMAL(18,6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from finmart.functions.decimals import SUM_MONEY, guarded_ratio
from finmart.operators.ranking import global_rank
from finmart.plans.reports import rpt_segment_margin_concentration

RATE_OUT = DecimalType(18, 6)


def largest_first(c: str, nulls: str = "first"):
    """Descending order of a measure.  ``nulls``: "first" as in the model's warehouse
    (an unknown measure counts as the greatest value), or "last"."""
    return F.col(c).desc_nulls_first() if nulls == "first" else F.col(c).desc_nulls_last()


def _sum(c: str, alias: str | None = None):
    return F.sum(c).cast(SUM_MONEY).alias(alias or c)


def a01_headline(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("lineitem_rows"),
        F.count_distinct("order_id").alias("distinct_orders"),
        _sum("net_revenue", "total_net_revenue"),
        _sum("gross_margin", "total_gross_margin"),
        _sum("discount_amount", "total_discount"),
    ).withColumn("portfolio_margin_rate",
                 guarded_ratio("total_gross_margin", "total_net_revenue", RATE_OUT))


def a02_top_customers_90d(rpt90: DataFrame, k: int = 25, nulls: str = "first") -> DataFrame:
    cols = ["customer_id", "customer_name", "market_segment", "customer_tier", "region_name",
            "is_lapsed", "order_count", "lineitem_count", "total_net_revenue",
            "total_gross_margin", "margin_rate", "discount_rate_effective"]
    return (rpt90.select(*cols)
                 .orderBy(largest_first("total_gross_margin", nulls), "customer_id")
                 .limit(k))


def a03_latest_month_concentration(fact: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """The concentration report of the latest month that a known customer has
    bought in.  That month is one maximum over two columns; with it, the report
    is made from a single month's folder of the fact."""
    known = fact.join(dim_cust.select("customer_key"), "customer_key", "left_semi")
    latest = known.select(F.max("order_year_month_key")).scalar()
    month = fact.filter(F.col("order_year_month_key") == latest)
    return (rpt_segment_margin_concentration(month, dim_cust)
            .select("order_year_month_key", "market_segment", "total_net_revenue",
                    "total_gross_margin", "margin_rate", "revenue_share", "margin_share",
                    "margin_concentration_index")
            .orderBy(F.col("total_net_revenue").desc_nulls_last(), "market_segment"))


def _by_customer_key(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_key").agg(
        F.sum("net_revenue").alias("_nr"), F.sum("gross_margin").alias("_gm"))


def _customer_totals(fact: DataFrame, dim_cust: DataFrame, attrs: list[str]) -> DataFrame:
    pre = _by_customer_key(fact)
    dc = dim_cust.select(F.col("customer_key").alias("_dc_key"), "customer_id", *attrs)
    j = pre.join(dc, pre["customer_key"] == dc["_dc_key"], "inner")
    return j.groupBy("customer_id").agg(
        *[F.max(a).alias(a) for a in attrs],
        F.sum("_nr").cast(SUM_MONEY).alias("total_net_revenue"),
        F.sum("_gm").cast(SUM_MONEY).alias("total_gross_margin"))


def a04_top_customers_all_time(fact: DataFrame, dim_cust: DataFrame, k: int = 20,
                               nulls: str = "first") -> DataFrame:
    attrs = ["customer_name", "market_segment", "customer_tier", "region_name"]
    t = _customer_totals(fact, dim_cust, attrs)
    return (t.select("customer_id", *attrs, "total_net_revenue", "total_gross_margin",
                     guarded_ratio("total_gross_margin", "total_net_revenue", RATE_OUT)
                     .alias("margin_rate"))
             .orderBy(largest_first("total_gross_margin", nulls), "customer_id")
             .limit(k))


def a05_rank_gap(fact: DataFrame, dim_cust: DataFrame, min_gap: int = 10, k: int = 20,
                 nulls: str = "first") -> DataFrame:
    """Customers whose all-time margin rank and revenue rank differ by more
    than ``min_gap``.  Both ranks are distributed global ranks; unknown measures
    share the rank that ``nulls`` gives them."""
    t = _customer_totals(fact, dim_cust, [])
    r = global_rank(t, ["total_net_revenue"], [largest_first("total_net_revenue", nulls)],
                    "revenue_rank", tie_break=[F.col("customer_id")])
    r = global_rank(r, ["total_gross_margin"], [largest_first("total_gross_margin", nulls)],
                    "margin_rank", tie_break=[F.col("customer_id")])
    gap = F.col("margin_rank") - F.col("revenue_rank")
    return (r.select("customer_id", "total_net_revenue", "total_gross_margin", "revenue_rank",
                     "margin_rank", gap.alias("rank_gap"))
             .filter(F.abs(F.col("rank_gap")) > min_gap)
             .orderBy(F.abs(F.col("rank_gap")).desc(), "customer_id")
             .limit(k))


def a06_bill_geography(fact: DataFrame, dim_geo: DataFrame) -> DataFrame:
    # The geography dimension has one row per nation; Catalyst broadcasts it
    # and the aggregation is partially combined right after the join.
    g = dim_geo.select("geography_key", "region_name", "nation_name")
    j = fact.join(g, fact["bill_geography_key"] == g["geography_key"], "inner")
    return (j.groupBy("region_name", "nation_name")
             .agg(_sum("net_revenue", "total_net_revenue"),
                  _sum("gross_margin", "total_gross_margin"))
             .orderBy(F.col("total_gross_margin").desc_nulls_last(), "region_name", "nation_name"))


def a07_order_priority(fact: DataFrame) -> DataFrame:
    t = fact.groupBy("order_priority").agg(
        F.count(F.lit(1)).alias("lines"),
        _sum("net_revenue", "total_net_revenue"),
        _sum("gross_margin", "total_gross_margin"),
        _sum("extended_price", "_gross"),
        _sum("discount_amount", "_disc"))
    return (t.select("order_priority", "lines", "total_net_revenue", "total_gross_margin",
                     guarded_ratio("total_gross_margin", "total_net_revenue", RATE_OUT)
                     .alias("margin_rate"),
                     guarded_ratio("_disc", "_gross", RATE_OUT).alias("effective_discount_rate"))
             .orderBy("order_priority"))


def a08_margin_erosion(fact: DataFrame, dim_prt: DataFrame, min_discount: float = 0.07,
                       max_margin_rate: float = 0.20, k: int = 30) -> DataFrame:
    f = fact.filter((F.col("discount_rate") >= min_discount) & F.col("margin_rate").isNotNull()
                    & (F.col("margin_rate") < max_margin_rate))
    p = dim_prt.select(F.col("part_key").alias("_p_key"), "part_type")
    j = f.join(p, f["part_key"] == p["_p_key"], "inner")
    cols = ["order_id", "line_number", "order_date", "part_type", "discount_rate",
            "net_revenue", "gross_margin", "margin_rate"]
    return (j.select(*cols)
             .orderBy(F.col("net_revenue").desc_nulls_last(), "order_id", "line_number",
                      "part_type", "discount_rate", "gross_margin", "margin_rate", "order_date")
             .limit(k))


def a09_month_trend(fact: DataFrame, dim_dt: DataFrame) -> DataFrame:
    d = dim_dt.select("date_key", "year_number", "month_number", "month_long_name")
    j = fact.join(d, fact["order_date_key"] == d["date_key"], "inner")
    return (j.groupBy("year_number", "month_number", "month_long_name")
             .agg(_sum("net_revenue", "total_net_revenue"),
                  _sum("gross_margin", "total_gross_margin"))
             .orderBy("year_number", "month_number"))


def a10_product_mix(fact: DataFrame, dim_prt: DataFrame, k: int = 30,
                    nulls: str = "first") -> DataFrame:
    pre = fact.groupBy("part_key").agg(F.sum("net_revenue").alias("_nr"),
                                       F.sum("gross_margin").alias("_gm"))
    p = dim_prt.select(F.col("part_key").alias("_p_key"), "part_type", "brand")
    j = pre.join(p, pre["part_key"] == p["_p_key"], "inner")
    return (j.groupBy("part_type", "brand")
             .agg(F.sum("_nr").cast(SUM_MONEY).alias("total_net_revenue"),
                  F.sum("_gm").cast(SUM_MONEY).alias("total_gross_margin"))
             .filter(F.col("total_net_revenue") > 0)
             .orderBy(largest_first("total_gross_margin", nulls), "part_type", "brand")
             .limit(k))


def a11_customer_tier(fact: DataFrame, dim_cust: DataFrame) -> DataFrame:
    pre = fact.groupBy("customer_key").agg(F.count(F.lit(1)).alias("_n"),
                                           F.sum("net_revenue").alias("_nr"),
                                           F.sum("gross_margin").alias("_gm"))
    dc = dim_cust.select(F.col("customer_key").alias("_dc_key"), "customer_tier")
    j = pre.join(dc, pre["customer_key"] == dc["_dc_key"], "inner")
    return (j.groupBy("customer_tier")
             .agg(F.sum("_n").cast("long").alias("lineitem_rows"),
                  F.sum("_nr").cast(SUM_MONEY).alias("total_net_revenue"),
                  F.sum("_gm").cast(SUM_MONEY).alias("total_gross_margin"))
             .orderBy(F.col("total_gross_margin").desc_nulls_last(), "customer_tier"))


def a12_scd2_footprint(dim_cust: DataFrame, k: int = 20) -> DataFrame:
    return (dim_cust.groupBy("customer_id").agg(F.count(F.lit(1)).alias("scd2_versions"))
                    .filter(F.col("scd2_versions") > 1)
                    .orderBy(F.col("scd2_versions").desc(), "customer_id")
                    .limit(k))


ANALYSES = {
    "a01_headline": (a01_headline, ["fct_sales_lineitem"]),
    "a02_top_customers_90d": (a02_top_customers_90d, ["rpt_customer_profitability_90d"]),
    "a03_latest_month_concentration": (a03_latest_month_concentration,
                                       ["fct_sales_lineitem", "dim_customer"]),
    "a04_top_customers_all_time": (a04_top_customers_all_time, ["fct_sales_lineitem", "dim_customer"]),
    "a05_rank_gap": (a05_rank_gap, ["fct_sales_lineitem", "dim_customer"]),
    "a06_bill_geography": (a06_bill_geography, ["fct_sales_lineitem", "dim_geography"]),
    "a07_order_priority": (a07_order_priority, ["fct_sales_lineitem"]),
    "a08_margin_erosion": (a08_margin_erosion, ["fct_sales_lineitem", "dim_part"]),
    "a09_month_trend": (a09_month_trend, ["fct_sales_lineitem", "dim_date"]),
    "a10_product_mix": (a10_product_mix, ["fct_sales_lineitem", "dim_part"]),
    "a11_customer_tier": (a11_customer_tier, ["fct_sales_lineitem", "dim_customer"]),
    "a12_scd2_footprint": (a12_scd2_footprint, ["dim_customer"]),
}


def run_analysis(name: str, models) -> DataFrame:
    fn, inputs = ANALYSES[name]
    return fn(*[models[i] for i in inputs])
