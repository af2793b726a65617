"""The declared data checks, as data.

Each entry: (relation, column or None for table-level, kind, arguments,
severity, where).  Relations are model names (``src_<t>`` = raw source,
``tpch_<t>`` = bronze, bare names = silver, ``dim_/fct_/rpt_`` = gold).
Kinds: not_null, unique, accepted_values(values), relationships(to, field),
unique_combination(columns), expression_is_true(expression),
positive_value(allow_zero).
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Check:
    relation: str
    column: str | None
    kind: str
    args: dict = field(default_factory=dict, hash=False, compare=False)
    severity: str = "error"
    where: str | None = None

    @property
    def label(self) -> str:
        return f"{self.kind}:{self.relation}.{self.column or '*'}"


def _nn(rel, col, where=None):
    return Check(rel, col, "not_null", where=where)


def _uq(rel, col):
    return Check(rel, col, "unique")


def _pk(rel, col):
    return [_uq(rel, col), _nn(rel, col)]


def _rel(rel, col, to, fld, where=None):
    return Check(rel, col, "relationships", {"to": to, "field": fld}, where=where)


def _av(rel, col, values):
    return Check(rel, col, "accepted_values", {"values": list(values)})


def _pos(rel, col, allow_zero=False):
    return Check(rel, col, "positive_value", {"allow_zero": allow_zero})


def _combo(rel, cols, where=None):
    return Check(rel, None, "unique_combination", {"columns": list(cols)}, where=where)


def _expr(rel, col, expression, severity="error"):
    return Check(rel, col, "expression_is_true", {"expression": expression}, severity)


def _meta(rel):
    return [_nn(rel, c) for c in ("_ingested_at", "_source_system", "_batch_id")]


# Accepted value lists of the model.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
ORDER_STATUSES = ["F", "O", "P"]
ORDER_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TIERS = ["Strategic", "Growth", "Maintain", "Watch", "Lapsed"]
CURRENT_ONLY = "is_current = true"

SOURCE_CHECKS = [
    *_pk("src_customer", "c_custkey"),
    *_pk("src_orders", "o_orderkey"),
    _nn("src_orders", "o_custkey"), _rel("src_orders", "o_custkey", "src_customer", "c_custkey"),
    _nn("src_lineitem", "l_orderkey"),
    _rel("src_lineitem", "l_orderkey", "src_orders", "o_orderkey"),
    *_pk("src_part", "p_partkey"),
    *_pk("src_supplier", "s_suppkey"),
    *_pk("src_nation", "n_nationkey"),
    *_pk("src_region", "r_regionkey"),
]

BRONZE_CHECKS = [
    *_pk("tpch_customer", "c_custkey"), *_meta("tpch_customer"),
    *_pk("tpch_orders", "o_orderkey"), _nn("tpch_orders", "o_custkey"),
    _rel("tpch_orders", "o_custkey", "tpch_customer", "c_custkey"), *_meta("tpch_orders"),
    _nn("tpch_lineitem", "l_orderkey"),
    _rel("tpch_lineitem", "l_orderkey", "tpch_orders", "o_orderkey"),
    _nn("tpch_lineitem", "l_linenumber"), *_meta("tpch_lineitem"),
    *_pk("tpch_part", "p_partkey"), *_meta("tpch_part"),
    *_pk("tpch_supplier", "s_suppkey"), *_meta("tpch_supplier"),
    _nn("tpch_partsupp", "ps_partkey"), _nn("tpch_partsupp", "ps_suppkey"), *_meta("tpch_partsupp"),
    *_pk("tpch_nation", "n_nationkey"), *_meta("tpch_nation"),
    *_pk("tpch_region", "r_regionkey"), *_meta("tpch_region"),
]

SILVER_CHECKS = [
    _nn("customer", "customer_id"),
    _nn("customer", "nation_id"), _rel("customer", "nation_id", "nation", "nation_id"),
    _nn("customer", "market_segment"), _av("customer", "market_segment", SEGMENTS),
    *_pk("customer", "scd_version_id"),
    _nn("customer", "valid_from"), _nn("customer", "is_current"),
    _combo("customer", ["customer_id", "is_current"], where=CURRENT_ONLY),

    *_pk("orders", "order_id"),
    _nn("orders", "customer_id"),
    _rel("orders", "customer_id", "customer", "customer_id", where="customer_id is not null"),
    _av("orders", "order_status_code", ORDER_STATUSES),
    _pos("orders", "order_total_price"),
    _nn("orders", "order_date"),
    _av("orders", "order_priority", ORDER_PRIORITIES),

    _nn("lineitem", "order_id"), _rel("lineitem", "order_id", "orders", "order_id"),
    _nn("lineitem", "line_number"),
    _nn("lineitem", "part_id"), _rel("lineitem", "part_id", "part", "part_id"),
    _nn("lineitem", "supplier_id"), _rel("lineitem", "supplier_id", "supplier", "supplier_id"),
    _pos("lineitem", "quantity"), _pos("lineitem", "extended_price"),
    _nn("lineitem", "discount_rate"), _expr("lineitem", "discount_rate", "between 0 and 1"),
    _nn("lineitem", "tax_rate"), _expr("lineitem", "tax_rate", "between 0 and 1"),
    _pos("lineitem", "net_revenue"),
    _pos("lineitem", "discount_amount", allow_zero=True),
    _pos("lineitem", "tax_amount", allow_zero=True),
    _combo("lineitem", ["order_id", "line_number"]),
    _expr("lineitem", None, "abs(net_revenue - (extended_price - discount_amount)) < 0.02",
          severity="warn"),

    *_pk("part", "part_id"), _nn("part", "brand"), _pos("part", "retail_price"),

    *_pk("supplier", "supplier_id"),
    _nn("supplier", "nation_id"), _rel("supplier", "nation_id", "nation", "nation_id"),

    _nn("partsupp", "part_id"), _rel("partsupp", "part_id", "part", "part_id"),
    _nn("partsupp", "supplier_id"), _rel("partsupp", "supplier_id", "supplier", "supplier_id"),
    _pos("partsupp", "supply_cost_per_unit", allow_zero=True),
    _combo("partsupp", ["part_id", "supplier_id"]),

    *_pk("nation", "nation_id"), *_pk("nation", "nation_name"),
    _nn("nation", "region_id"), _rel("nation", "region_id", "region", "region_id"),

    *_pk("region", "region_id"), *_pk("region", "region_name"),
]

GOLD_CHECKS = [
    *_pk("dim_date", "date_key"), *_pk("dim_date", "date_value"), _nn("dim_date", "year_number"),

    *_pk("dim_geography", "geography_key"), *_pk("dim_geography", "nation_id"),
    _nn("dim_geography", "nation_name"), _nn("dim_geography", "region_id"),

    *_pk("dim_customer", "customer_key"), _nn("dim_customer", "customer_id"),
    _nn("dim_customer", "market_segment"), _av("dim_customer", "market_segment", SEGMENTS),
    _nn("dim_customer", "nation_id"),
    _rel("dim_customer", "nation_id", "dim_geography", "nation_id"),
    _nn("dim_customer", "customer_tier"), _av("dim_customer", "customer_tier", TIERS),
    _nn("dim_customer", "valid_from"), _nn("dim_customer", "is_current"),
    _combo("dim_customer", ["customer_id", "is_current"], where=CURRENT_ONLY),

    *_pk("dim_supplier", "supplier_key"), *_pk("dim_supplier", "supplier_id"),
    _nn("dim_supplier", "nation_id"),
    _rel("dim_supplier", "nation_id", "dim_geography", "nation_id"),

    *_pk("dim_part", "part_key"), *_pk("dim_part", "part_id"), _nn("dim_part", "brand"),
    _pos("dim_part", "retail_price"),

    *_pk("fct_sales_lineitem", "sales_lineitem_key"),
    _nn("fct_sales_lineitem", "customer_key"),
    _rel("fct_sales_lineitem", "customer_key", "dim_customer", "customer_key"),
    _nn("fct_sales_lineitem", "supplier_key"),
    _rel("fct_sales_lineitem", "supplier_key", "dim_supplier", "supplier_key"),
    _nn("fct_sales_lineitem", "part_key"),
    _rel("fct_sales_lineitem", "part_key", "dim_part", "part_key"),
    _nn("fct_sales_lineitem", "ship_geography_key"),
    _rel("fct_sales_lineitem", "ship_geography_key", "dim_geography", "geography_key"),
    _nn("fct_sales_lineitem", "bill_geography_key"),
    _rel("fct_sales_lineitem", "bill_geography_key", "dim_geography", "geography_key"),
    _nn("fct_sales_lineitem", "order_year_month_key"),
    _nn("fct_sales_lineitem", "order_date_key"),
    _rel("fct_sales_lineitem", "order_date_key", "dim_date", "date_key"),
    _pos("fct_sales_lineitem", "quantity"), _pos("fct_sales_lineitem", "extended_price"),
    _pos("fct_sales_lineitem", "net_revenue"),
    _pos("fct_sales_lineitem", "supply_cost", allow_zero=True),
    _combo("fct_sales_lineitem", ["order_id", "line_number"]),
    _expr("fct_sales_lineitem", None, "abs(gross_margin - (net_revenue - supply_cost)) < 0.01"),

    *_pk("rpt_customer_profitability_90d", "customer_id"),
    _nn("rpt_customer_profitability_90d", "is_lapsed"),

    _nn("rpt_segment_margin_concentration", "order_year_month_key"),
    _nn("rpt_segment_margin_concentration", "market_segment"),
    _combo("rpt_segment_margin_concentration", ["order_year_month_key", "market_segment"]),
]

# The cross-model reconciliation (fact window total vs report total).
RECONCILIATION = Check("fct_sales_lineitem", "gross_margin", "margin_reconciliation",
                       {"report": "rpt_customer_profitability_90d", "days": 90,
                        "tolerance": 0.01})

CATALOGUE: list[Check] = [*SOURCE_CHECKS, *BRONZE_CHECKS, *SILVER_CHECKS, *GOLD_CHECKS,
                          RECONCILIATION]
LAYER_OF = {**{c.relation: "source" for c in SOURCE_CHECKS},
            **{c.relation: "bronze" for c in BRONZE_CHECKS},
            **{c.relation: "silver" for c in SILVER_CHECKS},
            **{c.relation: "gold" for c in GOLD_CHECKS}}
