"""Reports over the fact: rolling customer profitability and monthly segment
margin concentration."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finmart.functions.decimals import INDEX, RATIO, SUM_MONEY, guarded_ratio, share

MEASURES = ["quantity", "extended_price", "discount_amount", "net_revenue", "supply_cost",
             "gross_margin"]


def window_bounds(fact: DataFrame, days: int = 90, as_of: dt.date | str | None = None):
    """(start, end) of the report window as Columns: end = the fact's latest
    order date — a scalar subquery, so the report stays a view that is
    recomputed at read — or ``as_of`` (e.g. today's date for a live source)."""
    if as_of is not None:
        end = F.lit(str(as_of)).cast("date")
    else:
        if "order_year_month_key" in fact.columns:  # only the newest month's folder is read for it
            newest = fact.select(F.max("order_year_month_key")).scalar()
            fact = fact.filter(F.col("order_year_month_key") == newest)
        end = fact.select(F.max("order_date")).scalar()
    return F.date_sub(end, days), end


def windowed_fact(fact: DataFrame, days: int = 90, as_of=None) -> DataFrame:
    """Fact rows with order_date in [end - days, end] (inclusive both ends).

    The redundant month-key range lets a month-partitioned fact prune
    directories at run time (partition filters may hold scalar subqueries);
    the date range is pushed into the parquet scan as a runtime filter.
    """
    start, end = window_bounds(fact, days, as_of)
    cond = F.col("order_date").between(start, end)
    if "order_year_month_key" in fact.columns:
        ym = lambda d: F.year(d) * 100 + F.month(d)
        cond = cond & F.col("order_year_month_key").between(ym(start), ym(end))
    return fact.filter(cond)


def latest_customer(dim_cust: DataFrame) -> DataFrame:
    """Attributes of the latest version (max valid_from) of each customer_id.

    A grouped max over a struct (valid_from first, customer_key breaking ties)
    instead of row_number over a window: map-side combined, so a customer with
    many versions never lands whole in one task.
    """
    attrs = ["customer_name", "market_segment", "customer_tier", "nation_name",
             "region_name", "is_current"]
    latest = F.max(F.struct("valid_from", "customer_key", *attrs)).alias("_l")
    return dim_cust.groupBy("customer_id").agg(latest).select(
        "customer_id", *[F.col(f"_l.{a}").alias(a) for a in attrs])


def rpt_customer_profitability_90d(fact: DataFrame, dim_cust: DataFrame, days: int = 90,
                                   as_of=None) -> DataFrame:
    w = windowed_fact(fact, days, as_of).select("customer_key", "order_id", *MEASURES)
    keys = dim_cust.select(F.col("customer_key").alias("_dc_key"), "customer_id")
    fc = w.join(keys, w["customer_key"] == keys["_dc_key"], "inner")
    by_customer = fc.groupBy("customer_id").agg(
        F.sum("quantity").cast(SUM_MONEY).alias("total_quantity"),
        F.sum("extended_price").cast(SUM_MONEY).alias("total_gross_revenue"),
        F.sum("discount_amount").cast(SUM_MONEY).alias("total_discount"),
        F.sum("net_revenue").cast(SUM_MONEY).alias("total_net_revenue"),
        F.sum("supply_cost").cast(SUM_MONEY).alias("total_supply_cost"),
        F.sum("gross_margin").cast(SUM_MONEY).alias("total_gross_margin"),
        F.count_distinct("order_id").alias("order_count"),
        F.count(F.lit(1)).alias("lineitem_count"))
    return customer_profitability(by_customer, dim_cust)


def customer_profitability(by_customer: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """The report from the totals of each customer."""
    j = by_customer.join(latest_customer(dim_cust), "customer_id", "inner")
    return j.select(
        "customer_id", "customer_name", "market_segment", "customer_tier", "nation_name",
        "region_name", (~F.col("is_current")).alias("is_lapsed"),
        "order_count", "lineitem_count", "total_quantity", "total_gross_revenue",
        "total_discount", "total_net_revenue", "total_supply_cost", "total_gross_margin",
        guarded_ratio("total_gross_margin", "total_net_revenue", RATIO).alias("margin_rate"),
        guarded_ratio("total_discount", "total_gross_revenue", RATIO).alias("discount_rate_effective"),
    ).orderBy(F.col("total_gross_margin").desc_nulls_last())


def rpt_segment_margin_concentration(fact: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """Per (month, market segment): totals, margin rate, revenue and margin
    share of the month, and margin share / revenue share.

    The fact is first summed per (month, customer_key) — map-side combined on
    a fact clustered by month and customer — so only those partial sums meet
    the customer dimension.  Month totals re-aggregate the small per-segment
    result (a window over months × segments rows).
    """
    m = ["extended_price", "discount_amount", "net_revenue", "gross_margin"]
    pre = fact.groupBy("order_year_month_key", "customer_key").agg(
        *[F.sum(c).alias(c) for c in m])
    seg = dim_cust.select(F.col("customer_key").alias("_dc_key"), "market_segment")
    fj = pre.join(seg, pre["customer_key"] == seg["_dc_key"], "inner")
    bs = fj.groupBy("order_year_month_key", "market_segment").agg(
        F.sum("extended_price").cast(SUM_MONEY).alias("total_gross_revenue"),
        F.sum("discount_amount").cast(SUM_MONEY).alias("total_discount"),
        F.sum("net_revenue").cast(SUM_MONEY).alias("total_net_revenue"),
        F.sum("gross_margin").cast(SUM_MONEY).alias("total_gross_margin"))
    month = Window.partitionBy("order_year_month_key")
    t = bs.withColumns({
        "_grand_nr": F.sum("total_net_revenue").over(month),
        "_grand_gm": F.sum("total_gross_margin").over(month),
    })
    nr, gnr = F.col("total_net_revenue"), F.col("_grand_nr")
    r14 = share("total_net_revenue", "_grand_nr", out=None)
    m14 = share("total_gross_margin", "_grand_gm", out=None)
    positive = ((nr > 0) & (gnr > 0)) | ((nr < 0) & (gnr < 0))
    return t.select(
        "order_year_month_key", "market_segment", "total_gross_revenue", "total_discount",
        "total_net_revenue", "total_gross_margin",
        guarded_ratio("total_gross_margin", "total_net_revenue", RATIO).alias("margin_rate"),
        share("total_net_revenue", "_grand_nr", RATIO).alias("revenue_share"),
        share("total_gross_margin", "_grand_gm", RATIO).alias("margin_share"),
        F.when(positive & (r14 != 0), (m14 / r14).cast(INDEX)).alias("margin_concentration_index"),
    ).orderBy("order_year_month_key", F.col("total_gross_margin").desc_nulls_last())
