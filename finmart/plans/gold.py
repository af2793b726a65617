"""Gold: conformed dimensions and the line-grain sales fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.functions import dates as D
from finmart.functions.decimals import COST, RATIO
from finmart.functions.keys import date_key, surrogate_key, year_month_key
from finmart.operators.asof import asof_left_join
from finmart.operators.ranking import global_ntile
from finmart.plans.silver import derived_amounts

# Default calendar range [start, end) and the open-version end.
CALENDAR_START = "1990-01-01"
CALENDAR_END = "2001-01-01"
END_OF_TIME = "9999-12-31 00:00:00"
# Tier labels by balance tercile (1 = highest balances).
TIER_NEGATIVE = "Watch"
TIER_BY_TERCILE = {1: "Strategic", 2: "Growth", 3: "Maintain"}
TIER_NO_CURRENT = "Lapsed"


# ---- dim_date -----------------------------------------------------------

#: Dates from here on (such as 9999-12-31) are sentinels: no calendar row.
CALENDAR_HORIZON = "2200-01-01"


def calendar_bounds(spark, start: str = CALENDAR_START, end: str | None = CALENDAR_END,
                    cover: list[DataFrame] | None = None) -> DataFrame:
    """One row (start, end_exclusive).

    With ``end=None`` the calendar covers the dates found in the ``cover``
    frames (date columns only, before ``CALENDAR_HORIZON``): from ``start``, or
    the year of the earliest date if that is before, up to the end of the year
    of the latest.  Each frame is one map-side-combined aggregation of all its
    columns.
    """
    if end is not None:
        return spark.range(1).select(F.lit(start).cast("date").alias("start"),
                                     F.lit(end).cast("date").alias("end"))

    def ends(df: DataFrame) -> DataFrame:
        known = [F.when(F.col(c) < F.lit(CALENDAR_HORIZON).cast("date"), F.col(c)) for c in df.columns]
        least, most = [f(*[g(c) for c in known]) if len(known) > 1 else g(known[0])
                       for f, g in ((F.least, F.min), (F.greatest, F.max))]
        return df.agg(least.alias("lo"), most.alias("hi"))

    both = reduce(DataFrame.unionByName, [ends(df) for df in cover]).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    first = F.lit(start).cast("date")
    return both.select(F.least(first, F.trunc("lo", "year")).alias("start"),
                       F.coalesce(F.make_date(F.year("hi") + 1, F.lit(1), F.lit(1)),
                                  F.lit(CALENDAR_END).cast("date")).alias("end"))


def dim_date(bounds: DataFrame) -> DataFrame:
    """Day calendar over [start, end) — its size is the number of days, not
    a function of the data volume."""
    spine = bounds.select(F.explode(F.sequence(F.col("start"), F.date_sub(F.col("end"), 1)))
                          .alias("date_value"))
    d = F.col("date_value")
    return spine.select(
        d,
        date_key(d).alias("date_key"),
        F.year(d).cast("int").alias("year_number"),
        F.quarter(d).cast("int").alias("quarter_number"),
        F.month(d).cast("int").alias("month_number"),
        D.month_short_name(d).alias("month_short_name"),
        D.month_long_name(d).alias("month_long_name"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        D.day_of_week_sunday0(d).alias("day_of_week"),
        D.day_short_name(d).alias("day_short_name"),
        D.day_long_name(d).alias("day_long_name"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        D.is_weekday(d).alias("is_weekday"),
        year_month_key(d).alias("year_month_key"),
        D.year_quarter_key(d).alias("year_quarter_key"))


# ---- geography / supplier / part ----------------------------------------

def _nation_region(nation: DataFrame, region: DataFrame) -> DataFrame:
    n = nation.select("nation_id", "nation_name", "region_id")
    r = region.select(F.col("region_id").alias("_r_id"), "region_name")
    return (n.join(r, n["region_id"] == r["_r_id"], "left")
             .select("nation_id", "nation_name", F.col("_r_id").alias("region_id"),
                     "region_name", F.col("region_id").alias("_n_region_id")))


def dim_geography(nation: DataFrame, region: DataFrame) -> DataFrame:
    g = _nation_region(nation, region)
    return g.select(surrogate_key("nation_id").alias("geography_key"),
                    "nation_id", "nation_name", "region_id", "region_name")


def dim_supplier(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    g = _nation_region(nation, region).select(
        F.col("nation_id").alias("_g_nation"), "nation_name", "region_id", "region_name")
    s = supplier.join(g, supplier["nation_id"] == g["_g_nation"], "left")
    return s.select(surrogate_key("supplier_id").alias("supplier_key"),
                    "supplier_id", "supplier_name", "supplier_address", "supplier_phone",
                    "account_balance", "nation_id", "nation_name", "region_id", "region_name")


def dim_part(part: DataFrame) -> DataFrame:
    return part.select(surrogate_key("part_id").alias("part_key"),
                       "part_id", "part_name", "manufacturer", "brand", "part_type",
                       "part_size", "container", "retail_price")


# ---- dim_customer --------------------------------------------------------

def customer_tiers(customer: DataFrame) -> DataFrame:
    """(customer_id, customer_tier) for every current version.

    Negative balance → Watch; non-negative balances are split into terciles
    by balance descending (customer_id breaks ties) → Strategic / Growth /
    Maintain; a NULL balance gets no tier.  The tercile is a distributed
    global ntile (no single-partition window).
    """
    current = customer.filter(F.col("is_current")).select("customer_id", "account_balance")
    active = current.filter(F.col("account_balance") >= 0)
    terciles = global_ntile(active, 3, [F.col("account_balance").desc(), F.col("customer_id").asc()],
                            "balance_tercile").select(F.col("customer_id").alias("_t_id"),
                                                      "balance_tercile")
    t = F.col("balance_tercile")
    tier = F.when(F.col("account_balance") < 0, F.lit(TIER_NEGATIVE))
    for k, label in TIER_BY_TERCILE.items():
        tier = tier.when(t == k, F.lit(label))
    return (current.join(terciles, current["customer_id"] == terciles["_t_id"], "left")
                   .select("customer_id", tier.alias("customer_tier")))


def dim_customer(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One row per customer version, with geography and the current tier."""
    g = _nation_region(nation, region).select(
        F.col("nation_id").alias("_g_nation"), "nation_name",
        F.col("_n_region_id").alias("region_id"), "region_name")
    wg = customer.join(g, customer["nation_id"] == g["_g_nation"], "left")
    tiers = customer_tiers(customer).select(F.col("customer_id").alias("_tl_id"), "customer_tier")
    out = wg.join(tiers, wg["customer_id"] == tiers["_tl_id"], "left")
    return out.select(
        surrogate_key("scd_version_id").alias("customer_key"),
        "customer_id", "customer_name", "customer_address", "customer_phone", "customer_comment",
        "account_balance", "market_segment", "nation_id", "nation_name", "region_id", "region_name",
        F.coalesce(F.col("customer_tier"), F.lit(TIER_NO_CURRENT)).alias("customer_tier"),
        "valid_from",
        F.coalesce(F.col("valid_to"), F.lit(END_OF_TIME).cast("timestamp_ntz")).alias("valid_to"),
        "is_current")


# ---- fct_sales_lineitem --------------------------------------------------

def resolved_orders(orders: DataFrame, dim_cust: DataFrame, dim_geo: DataFrame,
                    as_of_join=asof_left_join) -> DataFrame:
    """Orders with the customer version valid at the order date and the bill
    geography — resolved at order grain (orders are ~1/4 of the lines, and the
    customer's dimension is joined once per order instead of once per line).
    ``as_of_join``: ``asof_carry_join`` where customers have many versions."""
    o = orders.select("order_id", "customer_id", "order_date", "order_status_code",
                      "order_priority", "ship_priority")
    dc = dim_cust.select("customer_id", "valid_from", "valid_to", "customer_key",
                         F.col("nation_id").alias("bill_nation_id"))
    o = as_of_join(o, dc, "customer_id", "customer_id",
                   F.col("order_date").cast("timestamp_ntz"))
    bill = dim_geo.select(F.col("nation_id").alias("_bill_nation"),
                          F.col("geography_key").alias("bill_geography_key"))
    return (o.join(bill, o["bill_nation_id"] == bill["_bill_nation"], "left")
             .drop("_bill_nation", "bill_nation_id"))


def part_supplier_roles(lineitem: DataFrame, partsupp: DataFrame, dim_sup: DataFrame,
                        dim_prt: DataFrame, dim_geo: DataFrame) -> DataFrame:
    """Unit cost, known supplier and part and ship nation of every (part, supplier)
    pair that the lines have.  The three lookups meet the pairs, which are never
    more than the lines, so the lines themselves are shuffled for one lookup
    instead of three.  Supplier and geography come one after the other: Spark takes
    a join of the two for too large to broadcast, whatever they hold."""
    pairs = lineitem.select(F.col("part_id").alias("_part"), F.col("supplier_id").alias("_supplier")).distinct()
    ps = partsupp.select(F.col("part_id").alias("_ps_part"), F.col("supplier_id").alias("_ps_supp"),
                         "supply_cost_per_unit")
    x = pairs.join(ps, (pairs["_part"] == ps["_ps_part"]) & (pairs["_supplier"] == ps["_ps_supp"]), "left")
    ds = dim_sup.select("supplier_id", F.col("nation_id").alias("_ship_nation"))
    x = x.join(ds, x["_supplier"] == ds["supplier_id"], "left")
    ship = dim_geo.select(F.col("nation_id").alias("ship_nation_id"))
    x = x.join(ship, x["_ship_nation"] == ship["ship_nation_id"], "left")
    dp = dim_prt.select(F.col("part_id").alias("_dp_part"))
    x = x.join(dp, x["_part"] == dp["_dp_part"], "left")
    return x.select("_part", "_supplier", "supply_cost_per_unit", "ship_nation_id",
                    F.col("supplier_id").isNotNull().alias("_has_supplier"),
                    F.col("_dp_part").isNotNull().alias("_has_part"))


def priced_lines(lineitem: DataFrame, partsupp: DataFrame, dim_sup: DataFrame,
                 dim_prt: DataFrame, dim_geo: DataFrame) -> DataFrame:
    """The lines with cost and roles of their part and supplier (NULL id: the dimension lacks it)."""
    li = lineitem.select("order_id", "line_number", "part_id", "supplier_id", "quantity",
                         "extended_price", "discount_rate", "tax_rate", "return_flag", "line_status",
                         "ship_date", "commit_date", "receipt_date", "ship_mode", "ship_instruction")
    pairs = part_supplier_roles(li, partsupp, dim_sup, dim_prt, dim_geo)
    x = li.join(pairs, li["part_id"].eqNullSafe(pairs["_part"])
                & li["supplier_id"].eqNullSafe(pairs["_supplier"]), "left")
    x = x.withColumns({"part_id": F.when(F.col("_has_part"), F.col("part_id")),
                       "supplier_id": F.when(F.col("_has_supplier"), F.col("supplier_id"))})
    return x.drop("_part", "_supplier", "_has_part", "_has_supplier")


def priced_shares(lineitem: DataFrame, partsupp: DataFrame, dim_sup: DataFrame,
                  dim_prt: DataFrame, dim_geo: DataFrame, n: int) -> list[DataFrame]:
    """``priced_lines`` in ``n`` shares by part, each line in one.  A share shuffles its own
    lines, pairs, costs and parts only."""
    part = F.pmod(F.xxhash64(F.col("part_id").cast("bigint")), F.lit(n))

    def share(df: DataFrame, i: int) -> DataFrame:
        return df.filter(part == i) if n > 1 else df

    return [priced_lines(share(lineitem, i), share(partsupp, i), dim_sup, share(dim_prt, i), dim_geo)
            for i in range(n)]


def fact_rows(priced: DataFrame, orders: DataFrame, dim_cust: DataFrame,
              dim_geo: DataFrame, as_of_join=asof_left_join) -> DataFrame:
    """What has to be looked up for the line fact: ``priced_lines`` ⋈ resolved orders.
    These rows hold natural ids (NULL: the dimension lacks it) and measures; all that
    follows from them, such as the surrogate keys and the derived amounts, is left to
    ``fact_columns``, so no shuffle carries it.  The lines meet their pair first and
    their order last, so that the order's columns are shuffled at order grain only.
    """
    x = priced.join(resolved_orders(orders, dim_cust, dim_geo, as_of_join), "order_id", "inner")
    return x.drop("customer_id").withColumn("order_year_month_key", year_month_key("order_date"))


def fact_columns(rows: DataFrame) -> DataFrame:
    """The line fact from its ``fact_rows``.

    Missing unit cost keeps supply_cost, gross_margin and margin_rate NULL
    (never 0) so sums skip the line.
    """
    def known_key(c: str):  # the key that the dimension gives this id
        return F.when(F.col(c).isNotNull(), surrogate_key(c))

    rows = rows.withColumns(derived_amounts())
    cost_qty = F.col("supply_cost_per_unit") * F.col("quantity")
    margin_exact = F.col("net_revenue") - cost_qty
    return rows.select(
        surrogate_key("order_id", "line_number").alias("sales_lineitem_key"),
        "customer_key", known_key("supplier_id").alias("supplier_key"), known_key("part_id").alias("part_key"),
        known_key("ship_nation_id").alias("ship_geography_key"), "bill_geography_key",
        "order_year_month_key",
        date_key("order_date").alias("order_date_key"),
        date_key("ship_date").alias("ship_date_key"),
        date_key("commit_date").alias("commit_date_key"),
        date_key("receipt_date").alias("receipt_date_key"),
        "order_id", "line_number", "order_status_code", "order_priority", "ship_priority",
        "return_flag", "line_status", "ship_mode", "ship_instruction",
        "order_date", "ship_date", "commit_date", "receipt_date",
        "quantity", "extended_price", "discount_amount", "tax_amount", "net_revenue",
        cost_qty.cast(COST).alias("supply_cost"),
        margin_exact.cast(COST).alias("gross_margin"),
        "discount_rate", "tax_rate",
        F.when(F.col("net_revenue") > 0, (margin_exact / F.col("net_revenue")).cast(RATIO))
         .alias("margin_rate"))


def fct_sales_lineitem(lineitem: DataFrame, orders: DataFrame, dim_cust: DataFrame,
                       partsupp: DataFrame, dim_sup: DataFrame, dim_prt: DataFrame,
                       dim_geo: DataFrame, as_of_join=asof_left_join, spread=None) -> DataFrame:
    """Line fact: lines ⋈ resolved orders, ⟕ cost and keys of the line's part and supplier.
    ``spread`` (``sinks.spread_fact``) deals the rows to tasks before the keys are made."""
    priced = priced_lines(lineitem, partsupp, dim_sup, dim_prt, dim_geo)
    rows = fact_rows(priced, orders, dim_cust, dim_geo, as_of_join)
    return fact_columns(spread(rows) if spread else rows)
