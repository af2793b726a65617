"""DuckDB oracle: every model re-stated as SQL over the raw source views.

Used by ``__spark_entry__.oracle_sql`` (the correctness gate) and by the
local harness in ``tests/``.  The SQL is written independently of the Spark
code: plain CTEs, a generic SCD2 merge written as UNION ALL of its cases,
window functions where the Spark side uses distributed operators.

DuckDB divides decimals in DOUBLE, so every published ratio is computed
here with exact integer arithmetic and rounded half-up once (``xdiv``).
"""

from __future__ import annotations

import os

# Fixed values shared with the Spark side (same meaning, restated here so
# the oracle stays independent of the library code).
NULL_PART = "__null__"
FIXED_INGESTED_AT = "2024-01-01 00:00:00"
FIXED_BATCH_ID = "batch-0001"
SOURCE_SYSTEM = "TPCH_SF1"
HISTORY_RUNS = ["1995-01-01 00:00:00", "1998-01-01 00:00:00", "2000-01-01 00:00:00"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SAMPLE_DIR = os.environ.get("FINMART_ORACLE_SAMPLE", "/root/testdata/sf0.01")

SOURCE = {
    "customer": [("c_custkey", "BIGINT"), ("c_name", "VARCHAR"), ("c_address", "VARCHAR"),
                 ("c_nationkey", "BIGINT"), ("c_phone", "VARCHAR"), ("c_acctbal", "DECIMAL(12,2)"),
                 ("c_mktsegment", "VARCHAR"), ("c_comment", "VARCHAR")],
    "orders": [("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderstatus", "VARCHAR"),
               ("o_totalprice", "DECIMAL(12,2)"), ("o_orderdate", "DATE"),
               ("o_orderpriority", "VARCHAR"), ("o_clerk", "VARCHAR"), ("o_shippriority", "INTEGER"),
               ("o_comment", "VARCHAR")],
    "lineitem": [("l_orderkey", "BIGINT"), ("l_partkey", "BIGINT"), ("l_suppkey", "BIGINT"),
                 ("l_linenumber", "INTEGER"), ("l_quantity", "DECIMAL(10,2)"),
                 ("l_extendedprice", "DECIMAL(12,2)"), ("l_discount", "DECIMAL(5,4)"),
                 ("l_tax", "DECIMAL(5,4)"), ("l_returnflag", "VARCHAR"), ("l_linestatus", "VARCHAR"),
                 ("l_shipdate", "DATE"), ("l_commitdate", "DATE"), ("l_receiptdate", "DATE"),
                 ("l_shipinstruct", "VARCHAR"), ("l_shipmode", "VARCHAR"), ("l_comment", "VARCHAR")],
    "part": [("p_partkey", "BIGINT"), ("p_name", "VARCHAR"), ("p_mfgr", "VARCHAR"),
             ("p_brand", "VARCHAR"), ("p_type", "VARCHAR"), ("p_size", "INTEGER"),
             ("p_container", "VARCHAR"), ("p_retailprice", "DECIMAL(12,2)"), ("p_comment", "VARCHAR")],
    "supplier": [("s_suppkey", "BIGINT"), ("s_name", "VARCHAR"), ("s_address", "VARCHAR"),
                 ("s_nationkey", "BIGINT"), ("s_phone", "VARCHAR"), ("s_acctbal", "DECIMAL(12,2)"),
                 ("s_comment", "VARCHAR")],
    "partsupp": [("ps_partkey", "BIGINT"), ("ps_suppkey", "BIGINT"), ("ps_availqty", "INTEGER"),
                 ("ps_supplycost", "DECIMAL(12,2)"), ("ps_comment", "VARCHAR")],
    "nation": [("n_nationkey", "BIGINT"), ("n_name", "VARCHAR"), ("n_regionkey", "BIGINT"),
               ("n_comment", "VARCHAR")],
    "region": [("r_regionkey", "BIGINT"), ("r_name", "VARCHAR"), ("r_comment", "VARCHAR")],
}
TABLES = list(SOURCE)


def _present(table: str) -> set[str] | None:
    """Columns delivered in the sample parquet (None: table absent)."""
    path = os.path.join(SAMPLE_DIR, f"{table}.parquet")
    if not os.path.exists(path):
        return None
    import pyarrow.parquet as pq
    return set(pq.read_schema(path).names)


# ---- expression helpers ---------------------------------------------------

def skey(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{NULL_PART}')" for c in cols]
    return f"md5({parts[0]})" if len(parts) == 1 else f"md5(concat_ws('-', {', '.join(parts)}))"


def xdiv(a: str, b: str, sa: int, sb: int, s: int, p: int) -> str:
    """Exact round-half-up of a / b to DECIMAL(p, s); NULL when b = 0.
    ``a`` and ``b`` are decimals of scale ``sa`` / ``sb``."""
    A = f"CAST(({a}) * {10 ** sa} AS HUGEINT)"
    B = f"CAST(({b}) * {10 ** sb} AS HUGEINT)"
    e = s + sb - sa
    N = f"({A} * {10 ** e})" if e >= 0 else A
    D = B if e >= 0 else f"({B} * {10 ** (-e)})"
    q = f"(sign({N}) * sign({D}) * ((2 * abs({N}) + abs({D})) // (2 * abs({D}))))"
    return (f"(CASE WHEN ({b}) = 0 THEN NULL ELSE CAST(CAST({q} AS DECIMAL(38,0)) * "
            f"CAST({1 / 10 ** s:.{s}f} AS DECIMAL(18,{s})) AS DECIMAL({p},{s})) END)")


def guarded(a: str, b: str, s: int = 6, p: int = 7, sa: int = 2, sb: int = 2) -> str:
    return f"(CASE WHEN ({b}) > 0 THEN {xdiv(a, b, sa, sb, s, p)} END)"


def dkey(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def ymkey(d: str) -> str:
    return f"CAST(year({d}) * 100 + month({d}) AS INTEGER)"


def two_step(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(12,4)), 2) AS DECIMAL(12,2))"


META = (f"TIMESTAMP '{FIXED_INGESTED_AT}' AS _ingested_at, '{SOURCE_SYSTEM}' AS _source_system, "
        f"'{FIXED_BATCH_ID}' AS _batch_id")
META_COLS = "_ingested_at, _source_system, _batch_id"


# ---- model CTEs -----------------------------------------------------------

def _source_select(t: str) -> str:
    present = _present(t)
    if present is None and t == "partsupp":
        return ("SELECT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey, NULL::INTEGER AS ps_availqty, "
                "CAST(CAST((l_partkey * 31 + l_suppkey * 17) % 9901 + 100 AS DECIMAL(18,0)) * "
                "CAST(0.01 AS DECIMAL(18,2)) AS DECIMAL(12,2)) AS ps_supplycost, "
                "NULL::VARCHAR AS ps_comment FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)")
    cols = [c if (present is None or c in present) else f"NULL::{ty} AS {c}" for c, ty in SOURCE[t]]
    return f"SELECT {', '.join(cols)} FROM {t}"


def _scd2_merge(prev: str, cur: str, as_of: str) -> str:
    cols = ["c_custkey", "c_name", "c_address", "c_nationkey", "c_phone", "c_acctbal",
            "c_mktsegment", "c_comment"]
    checks = ["c_mktsegment", "c_acctbal", "c_nationkey", "c_address"]
    same = " AND ".join(f"o.{c} IS NOT DISTINCT FROM c.{c}" for c in checks)
    ts = f"TIMESTAMP '{as_of}'"
    new_cols = ", ".join(f"c.{c}" for c in cols)
    new_scd = (f"md5(CAST(c.c_custkey AS VARCHAR) || '|' || '{as_of}') AS scd_id, {ts} AS scd_updated_at, "
               f"{ts} AS scd_valid_from, NULL::TIMESTAMP AS scd_valid_to")
    if prev is None:
        return f"SELECT {new_cols}, {new_scd} FROM {cur} c"
    old_cols = ", ".join(f"o.{c}" for c in cols)
    return f"""
    SELECT * FROM {prev} WHERE scd_valid_to IS NOT NULL
    UNION ALL
    SELECT {old_cols}, o.scd_id, o.scd_updated_at, o.scd_valid_from,
           CASE WHEN c.c_custkey IS NULL OR NOT ({same}) THEN {ts} ELSE o.scd_valid_to END
    FROM (SELECT * FROM {prev} WHERE scd_valid_to IS NULL) o
    LEFT JOIN {cur} c ON o.c_custkey = c.c_custkey
    UNION ALL
    SELECT {new_cols}, {new_scd}
    FROM {cur} c LEFT JOIN (SELECT * FROM {prev} WHERE scd_valid_to IS NULL) o
      ON o.c_custkey = c.c_custkey
    WHERE o.c_custkey IS NULL OR NOT ({same})"""


def model_ctes(history: bool = False) -> list[tuple[str, str, list[str]]]:
    """[(name, sql, deps)] in dependency order."""
    out = []
    for t in TABLES:
        out.append((f"src_{t}", _source_select(t), ["lineitem"] if t == "partsupp" else []))
        out.append((f"tpch_{t}", f"SELECT *, {META} FROM src_{t}", [f"src_{t}"]))

    snap_cols = ("c_custkey, c_name, c_address, c_nationkey, c_phone, c_acctbal, c_mktsegment, "
                 "c_comment")
    if not history:
        out.append(("snap_extract_1", f"SELECT {snap_cols} FROM tpch_customer", ["tpch_customer"]))
        out.append(("snap_customer_scd2", _scd2_merge(None, "snap_extract_1", HISTORY_RUNS[0]),
                    ["snap_extract_1"]))
    else:
        nxt = " ".join(f"WHEN c_mktsegment = '{a}' THEN '{b}'"
                       for a, b in zip(SEGMENTS, SEGMENTS[1:] + SEGMENTS[:1]))
        moved = (f"SELECT c_custkey, c_name, c_address, c_nationkey, c_phone, c_acctbal, "
                 f"CASE WHEN c_custkey % 7 = 0 THEN (CASE {nxt} ELSE c_mktsegment END) "
                 f"ELSE c_mktsegment END AS c_mktsegment, c_comment FROM tpch_customer")
        out.append(("snap_extract_1", f"SELECT {snap_cols} FROM tpch_customer", ["tpch_customer"]))
        out.append(("snap_moved", moved, ["tpch_customer"]))
        out.append(("snap_extract_2", "SELECT * FROM snap_moved WHERE c_custkey % 11 <> 0",
                    ["snap_moved"]))
        out.append(("snap_extract_3",
                    "SELECT * FROM snap_moved WHERE c_custkey % 11 <> 0 OR c_custkey % 22 = 0",
                    ["snap_moved"]))
        out.append(("snap_run_1", _scd2_merge(None, "snap_extract_1", HISTORY_RUNS[0]),
                    ["snap_extract_1"]))
        out.append(("snap_run_2", _scd2_merge("snap_run_1", "snap_extract_2", HISTORY_RUNS[1]),
                    ["snap_run_1", "snap_extract_2"]))
        out.append(("snap_customer_scd2", _scd2_merge("snap_run_2", "snap_extract_3", HISTORY_RUNS[2]),
                    ["snap_run_2", "snap_extract_3"]))

    out += [
        ("silver_customer", f"""
        SELECT CAST(c_custkey AS BIGINT) AS customer_id, trim(c_name) AS customer_name,
               trim(c_address) AS customer_address, CAST(c_nationkey AS BIGINT) AS nation_id,
               trim(c_phone) AS customer_phone, CAST(c_acctbal AS DECIMAL(12,2)) AS account_balance,
               trim(c_mktsegment) AS market_segment, trim(c_comment) AS customer_comment,
               scd_id AS scd_version_id,
               CASE WHEN scd_valid_from = min(scd_valid_from) OVER (PARTITION BY c_custkey)
                    THEN TIMESTAMP '1900-01-01 00:00:00' ELSE scd_valid_from END AS valid_from,
               scd_valid_to AS valid_to, scd_valid_to IS NULL AS is_current
        FROM snap_customer_scd2""", ["snap_customer_scd2"]),
        ("silver_orders", f"""
        SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS customer_id,
               CAST(o_orderstatus AS VARCHAR) AS order_status_code,
               CAST(o_totalprice AS DECIMAL(12,2)) AS order_total_price,
               CAST(o_orderdate AS DATE) AS order_date, trim(o_orderpriority) AS order_priority,
               trim(o_clerk) AS clerk_id, CAST(o_shippriority AS INTEGER) AS ship_priority,
               trim(o_comment) AS order_comment, CAST(year(o_orderdate) AS INTEGER) AS order_year,
               CAST(month(o_orderdate) AS INTEGER) AS order_month,
               CAST(quarter(o_orderdate) AS INTEGER) AS order_quarter, {META_COLS}
        FROM tpch_orders
        WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_orderdate IS NOT NULL""",
         ["tpch_orders"]),
        ("silver_lineitem_typed", f"""
        SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(l_linenumber AS INTEGER) AS line_number,
               CAST(l_partkey AS BIGINT) AS part_id, CAST(l_suppkey AS BIGINT) AS supplier_id,
               CAST(l_quantity AS DECIMAL(10,2)) AS quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS extended_price,
               CAST(l_discount AS DECIMAL(5,4)) AS discount_rate,
               CAST(l_tax AS DECIMAL(5,4)) AS tax_rate,
               trim(l_returnflag) AS return_flag, trim(l_linestatus) AS line_status,
               CAST(l_shipdate AS DATE) AS ship_date, CAST(l_commitdate AS DATE) AS commit_date,
               CAST(l_receiptdate AS DATE) AS receipt_date, trim(l_shipinstruct) AS ship_instruction,
               trim(l_shipmode) AS ship_mode, trim(l_comment) AS line_comment, {META_COLS}
        FROM tpch_lineitem
        WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND l_quantity > 0
          AND l_extendedprice > 0 AND l_discount BETWEEN 0 AND 1 AND l_tax BETWEEN 0 AND 1""",
         ["tpch_lineitem"]),
        ("silver_lineitem", f"""
        SELECT *, {two_step('extended_price * discount_rate')} AS discount_amount,
                  {two_step('extended_price * (1 - discount_rate)')} AS net_revenue,
                  {two_step('extended_price * tax_rate')} AS tax_amount
        FROM silver_lineitem_typed""", ["silver_lineitem_typed"]),
        ("silver_part", f"""
        SELECT CAST(p_partkey AS BIGINT) AS part_id, trim(p_name) AS part_name,
               trim(p_mfgr) AS manufacturer, upper(trim(p_brand)) AS brand, trim(p_type) AS part_type,
               CAST(p_size AS INTEGER) AS part_size, trim(p_container) AS container,
               CAST(p_retailprice AS DECIMAL(12,2)) AS retail_price, trim(p_comment) AS part_comment,
               {META_COLS}
        FROM tpch_part WHERE p_partkey IS NOT NULL""", ["tpch_part"]),
        ("silver_supplier", f"""
        SELECT CAST(s_suppkey AS BIGINT) AS supplier_id, trim(s_name) AS supplier_name,
               trim(s_address) AS supplier_address, CAST(s_nationkey AS BIGINT) AS nation_id,
               trim(s_phone) AS supplier_phone, CAST(s_acctbal AS DECIMAL(12,2)) AS account_balance,
               trim(s_comment) AS supplier_comment, {META_COLS}
        FROM tpch_supplier WHERE s_suppkey IS NOT NULL""", ["tpch_supplier"]),
        ("silver_partsupp", f"""
        SELECT CAST(ps_partkey AS BIGINT) AS part_id, CAST(ps_suppkey AS BIGINT) AS supplier_id,
               CAST(ps_availqty AS INTEGER) AS available_quantity,
               CAST(ps_supplycost AS DECIMAL(12,2)) AS supply_cost_per_unit,
               trim(ps_comment) AS partsupp_comment, {META_COLS}
        FROM tpch_partsupp
        WHERE ps_partkey IS NOT NULL AND ps_suppkey IS NOT NULL AND ps_supplycost >= 0""",
         ["tpch_partsupp"]),
        ("silver_nation", f"""
        SELECT CAST(n_nationkey AS BIGINT) AS nation_id, trim(n_name) AS nation_name,
               CAST(n_regionkey AS BIGINT) AS region_id, trim(n_comment) AS nation_comment, {META_COLS}
        FROM tpch_nation""", ["tpch_nation"]),
        ("silver_region", f"""
        SELECT CAST(r_regionkey AS BIGINT) AS region_id, trim(r_name) AS region_name,
               trim(r_comment) AS region_comment, {META_COLS}
        FROM tpch_region""", ["tpch_region"]),
        ("calendar_end", """
        SELECT make_date(CAST(year(max(d)) + 1 AS BIGINT), 1, 1) AS end_excl FROM (
            SELECT order_date AS d FROM silver_orders
            UNION ALL SELECT ship_date FROM silver_lineitem
            UNION ALL SELECT commit_date FROM silver_lineitem
            UNION ALL SELECT receipt_date FROM silver_lineitem)""",
         ["silver_orders", "silver_lineitem"]),
        ("dim_date", f"""
        SELECT date_value, {dkey('date_value')} AS date_key,
               CAST(year(date_value) AS INTEGER) AS year_number,
               CAST(quarter(date_value) AS INTEGER) AS quarter_number,
               CAST(month(date_value) AS INTEGER) AS month_number,
               strftime(date_value, '%b') AS month_short_name,
               strftime(date_value, '%B') AS month_long_name,
               CAST(day(date_value) AS INTEGER) AS day_of_month,
               CAST(dayofweek(date_value) AS INTEGER) AS day_of_week,
               strftime(date_value, '%a') AS day_short_name,
               strftime(date_value, '%A') AS day_long_name,
               CAST(week(date_value) AS INTEGER) AS week_of_year,
               dayofweek(date_value) NOT IN (0, 6) AS is_weekday,
               {ymkey('date_value')} AS year_month_key,
               CAST(year(date_value) * 10 + quarter(date_value) AS INTEGER) AS year_quarter_key
        FROM (SELECT CAST(gs AS DATE) AS date_value
              FROM calendar_end, generate_series(DATE '1990-01-01', end_excl - 1, INTERVAL 1 DAY) t(gs))""",
         ["calendar_end"]),
        ("dim_geography", f"""
        SELECT {skey('n.nation_id')} AS geography_key, n.nation_id, n.nation_name, r.region_id,
               r.region_name
        FROM silver_nation n LEFT JOIN silver_region r ON n.region_id = r.region_id""",
         ["silver_nation", "silver_region"]),
        ("customer_current", """
        SELECT customer_id, account_balance FROM silver_customer WHERE is_current""",
         ["silver_customer"]),
        ("customer_tier_lookup", """
        SELECT cc.customer_id,
               CASE WHEN cc.account_balance < 0 THEN 'Watch'
                    WHEN t.tercile = 1 THEN 'Strategic' WHEN t.tercile = 2 THEN 'Growth'
                    WHEN t.tercile = 3 THEN 'Maintain' END AS customer_tier
        FROM customer_current cc LEFT JOIN (
            SELECT customer_id,
                   ntile(3) OVER (ORDER BY account_balance DESC, customer_id) AS tercile
            FROM customer_current WHERE account_balance >= 0) t
          ON cc.customer_id = t.customer_id""", ["customer_current"]),
        ("dim_customer", f"""
        SELECT {skey('c.scd_version_id')} AS customer_key, c.customer_id, c.customer_name,
               c.customer_address, c.customer_phone, c.customer_comment, c.account_balance,
               c.market_segment, c.nation_id, n.nation_name, n.region_id, r.region_name,
               coalesce(tl.customer_tier, 'Lapsed') AS customer_tier, c.valid_from,
               coalesce(c.valid_to, TIMESTAMP '9999-12-31 00:00:00') AS valid_to, c.is_current
        FROM silver_customer c
        LEFT JOIN silver_nation n ON c.nation_id = n.nation_id
        LEFT JOIN silver_region r ON n.region_id = r.region_id
        LEFT JOIN customer_tier_lookup tl ON c.customer_id = tl.customer_id""",
         ["silver_customer", "silver_nation", "silver_region", "customer_tier_lookup"]),
        ("dim_supplier", f"""
        SELECT {skey('s.supplier_id')} AS supplier_key, s.supplier_id, s.supplier_name,
               s.supplier_address, s.supplier_phone, s.account_balance, s.nation_id, n.nation_name,
               r.region_id, r.region_name
        FROM silver_supplier s
        LEFT JOIN silver_nation n ON s.nation_id = n.nation_id
        LEFT JOIN silver_region r ON n.region_id = r.region_id""",
         ["silver_supplier", "silver_nation", "silver_region"]),
        ("dim_part", f"""
        SELECT {skey('part_id')} AS part_key, part_id, part_name, manufacturer, brand, part_type,
               part_size, container, retail_price
        FROM silver_part""", ["silver_part"]),
        ("fct_base", """
        SELECT li.order_id, li.line_number, li.part_id, li.supplier_id, li.quantity,
               li.extended_price, li.discount_rate, li.discount_amount, li.tax_rate, li.tax_amount,
               li.net_revenue, li.return_flag, li.line_status, li.ship_date, li.commit_date,
               li.receipt_date, li.ship_mode, li.ship_instruction, o.customer_id, o.order_date,
               o.order_status_code, o.order_priority, o.ship_priority, dc.customer_key,
               dc.nation_id AS bill_nation_id, ps.supply_cost_per_unit, ds.supplier_key,
               sg.geography_key AS ship_geography_key, bg.geography_key AS bill_geography_key,
               dp.part_key
        FROM silver_lineitem li
        JOIN silver_orders o ON li.order_id = o.order_id
        LEFT JOIN dim_customer dc ON o.customer_id = dc.customer_id
             AND CAST(o.order_date AS TIMESTAMP) >= dc.valid_from
             AND CAST(o.order_date AS TIMESTAMP) < dc.valid_to
        LEFT JOIN silver_partsupp ps ON li.part_id = ps.part_id AND li.supplier_id = ps.supplier_id
        LEFT JOIN dim_supplier ds ON li.supplier_id = ds.supplier_id
        LEFT JOIN dim_part dp ON li.part_id = dp.part_id
        LEFT JOIN dim_geography sg ON ds.nation_id = sg.nation_id
        LEFT JOIN dim_geography bg ON dc.nation_id = bg.nation_id""",
         ["silver_lineitem", "silver_orders", "dim_customer", "silver_partsupp", "dim_supplier",
          "dim_part", "dim_geography"]),
        ("fct_sales_lineitem", f"""
        SELECT {skey('order_id', 'line_number')} AS sales_lineitem_key, customer_key, supplier_key,
               part_key, ship_geography_key, bill_geography_key,
               {ymkey('order_date')} AS order_year_month_key, {dkey('order_date')} AS order_date_key,
               {dkey('ship_date')} AS ship_date_key, {dkey('commit_date')} AS commit_date_key,
               {dkey('receipt_date')} AS receipt_date_key, order_id, line_number, order_status_code,
               order_priority, ship_priority, return_flag, line_status, ship_mode, ship_instruction,
               order_date, ship_date, commit_date, receipt_date, quantity, extended_price,
               discount_amount, tax_amount, net_revenue,
               CAST(supply_cost_per_unit * quantity AS DECIMAL(14,2)) AS supply_cost,
               CAST(net_revenue - supply_cost_per_unit * quantity AS DECIMAL(14,2)) AS gross_margin,
               discount_rate, tax_rate,
               {guarded('net_revenue - supply_cost_per_unit * quantity', 'net_revenue', 6, 7, 4, 2)}
                 AS margin_rate
        FROM fct_base""", ["fct_base"]),
        ("rpt_window", """
        SELECT max(order_date) AS window_end, max(order_date) - INTERVAL 90 DAY AS window_start
        FROM fct_sales_lineitem""", ["fct_sales_lineitem"]),
        ("rpt_by_customer", """
        SELECT dc.customer_id,
               CAST(sum(f.quantity) AS DECIMAL(38,2)) AS total_quantity,
               CAST(sum(f.extended_price) AS DECIMAL(38,2)) AS total_gross_revenue,
               CAST(sum(f.discount_amount) AS DECIMAL(38,2)) AS total_discount,
               CAST(sum(f.net_revenue) AS DECIMAL(38,2)) AS total_net_revenue,
               CAST(sum(f.supply_cost) AS DECIMAL(38,2)) AS total_supply_cost,
               CAST(sum(f.gross_margin) AS DECIMAL(38,2)) AS total_gross_margin,
               count(DISTINCT f.order_id) AS order_count, count(*) AS lineitem_count
        FROM fct_sales_lineitem f CROSS JOIN rpt_window w
        JOIN dim_customer dc ON f.customer_key = dc.customer_key
        WHERE f.order_date BETWEEN w.window_start AND w.window_end
        GROUP BY dc.customer_id""", ["fct_sales_lineitem", "rpt_window", "dim_customer"]),
        ("latest_customer", """
        SELECT customer_id, customer_name, market_segment, customer_tier, nation_name, region_name,
               is_current
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                                           ORDER BY valid_from DESC, customer_key DESC) AS rn
              FROM dim_customer) WHERE rn = 1""", ["dim_customer"]),
        ("rpt_customer_profitability_90d", f"""
        SELECT lc.customer_id, lc.customer_name, lc.market_segment, lc.customer_tier,
               lc.nation_name, lc.region_name, NOT lc.is_current AS is_lapsed, bc.order_count,
               bc.lineitem_count, bc.total_quantity, bc.total_gross_revenue, bc.total_discount,
               bc.total_net_revenue, bc.total_supply_cost, bc.total_gross_margin,
               {guarded('bc.total_gross_margin', 'bc.total_net_revenue')} AS margin_rate,
               {guarded('bc.total_discount', 'bc.total_gross_revenue')} AS discount_rate_effective
        FROM rpt_by_customer bc JOIN latest_customer lc ON bc.customer_id = lc.customer_id""",
         ["rpt_by_customer", "latest_customer"]),
        ("seg_by_segment", """
        SELECT f.order_year_month_key, dc.market_segment,
               CAST(sum(f.extended_price) AS DECIMAL(38,2)) AS total_gross_revenue,
               CAST(sum(f.discount_amount) AS DECIMAL(38,2)) AS total_discount,
               CAST(sum(f.net_revenue) AS DECIMAL(38,2)) AS total_net_revenue,
               CAST(sum(f.gross_margin) AS DECIMAL(38,2)) AS total_gross_margin
        FROM fct_sales_lineitem f JOIN dim_customer dc ON f.customer_key = dc.customer_key
        GROUP BY f.order_year_month_key, dc.market_segment""", ["fct_sales_lineitem", "dim_customer"]),
        ("seg_shares", f"""
        SELECT bs.*, t.grand_nr, t.grand_gm,
               {xdiv('bs.total_net_revenue', 't.grand_nr', 2, 2, 14, 24)} AS r14,
               {xdiv('bs.total_gross_margin', 't.grand_gm', 2, 2, 14, 24)} AS m14
        FROM seg_by_segment bs JOIN (
            SELECT order_year_month_key, sum(total_net_revenue) AS grand_nr,
                   sum(total_gross_margin) AS grand_gm
            FROM seg_by_segment GROUP BY order_year_month_key) t
          ON bs.order_year_month_key = t.order_year_month_key""", ["seg_by_segment"]),
        ("rpt_segment_margin_concentration", f"""
        SELECT order_year_month_key, market_segment, total_gross_revenue, total_discount,
               total_net_revenue, total_gross_margin,
               {guarded('total_gross_margin', 'total_net_revenue')} AS margin_rate,
               {xdiv('total_net_revenue', 'grand_nr', 2, 2, 6, 7)} AS revenue_share,
               {xdiv('total_gross_margin', 'grand_gm', 2, 2, 6, 7)} AS margin_share,
               CASE WHEN ((total_net_revenue > 0 AND grand_nr > 0)
                          OR (total_net_revenue < 0 AND grand_nr < 0)) AND r14 <> 0
                    THEN {xdiv('m14', 'r14', 14, 14, 4, 7)} END AS margin_concentration_index
        FROM seg_shares""", ["seg_shares"]),
    ]
    return out


def with_models(select: str, needs: list[str], history: bool = False) -> str:
    """``WITH <needed CTEs> <select>``."""
    ctes = model_ctes(history)
    deps = {n: d for n, _, d in ctes}
    want, stack = set(), list(needs)
    while stack:
        n = stack.pop()
        if n in want or n not in deps:
            continue
        want.add(n)
        stack.extend(deps[n])
    parts = [f"{n} AS ({sql})" for n, sql, _ in ctes if n in want]
    return ("WITH " + ",\n".join(parts) + "\n" + select) if parts else select


# ---- checks -----------------------------------------------------------------

def cte_name(relation: str) -> str:
    silver = {"customer", "orders", "lineitem", "part", "supplier", "partsupp", "nation", "region"}
    return f"silver_{relation}" if relation in silver else relation


def _scoped(rel: str, where: str | None, extra: str | None = None) -> str:
    conds = [c for c in (f"({where})" if where else None, extra) if c]
    return f"SELECT * FROM {rel}" + (f" WHERE {' AND '.join(conds)}" if conds else "")


def check_failing_rows_sql(c) -> str:
    """Failing rows of one catalogue check (same shapes as the Spark side)."""
    rel = cte_name(c.relation)
    col = c.column
    if c.kind == "not_null":
        return _scoped(rel, c.where, f"{col} IS NULL")
    if c.kind == "unique":
        return (f"SELECT {col} AS unique_field, count(*) AS n_records FROM ({_scoped(rel, c.where)}) "
                f"WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1")
    if c.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in c.args["values"])
        return (f"SELECT {col} AS value_field, count(*) AS n_records FROM ({_scoped(rel, c.where)}) "
                f"WHERE {col} NOT IN ({vals}) GROUP BY {col}")
    if c.kind == "relationships":
        parent, fld = cte_name(c.args["to"]), c.args["field"]
        return (f"SELECT * FROM ({_scoped(rel, c.where)}) ch WHERE ch.{col} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {parent} p WHERE p.{fld} = ch.{col})")
    if c.kind == "unique_combination":
        cols = ", ".join(c.args["columns"])
        return (f"SELECT {cols}, count(*) AS n_records FROM ({_scoped(rel, c.where)}) "
                f"GROUP BY {cols} HAVING count(*) > 1")
    if c.kind == "expression_is_true":
        text = f"{col} {c.args['expression']}" if col else c.args["expression"]
        return _scoped(rel, c.where, f"NOT ({text})")
    if c.kind == "positive_value":
        op = "<" if c.args.get("allow_zero") else "<="
        return _scoped(rel, c.where, f"{col} IS NOT NULL AND {col} {op} 0")
    if c.kind == "margin_reconciliation":
        days, tol = c.args["days"], c.args["tolerance"]
        return f"""
        SELECT fwt.t AS fact_windowed_total, rpt.t AS rpt_total, abs(fwt.t - rpt.t) AS discrepancy
        FROM (SELECT CAST(sum(f.gross_margin) AS DECIMAL(38,2)) AS t
              FROM {rel} f,
                   (SELECT max(order_date) AS e, max(order_date) - INTERVAL {days} DAY AS s FROM {rel}) w
              WHERE f.order_date BETWEEN w.s AND w.e) fwt,
             (SELECT CAST(sum(total_gross_margin) AS DECIMAL(38,2)) AS t
              FROM {cte_name(c.args['report'])}) rpt
        WHERE abs(fwt.t - rpt.t) > {tol}"""
    raise ValueError(c.kind)


def check_needs(c) -> list[str]:
    needs = [cte_name(c.relation)]
    if c.kind == "relationships":
        needs.append(cte_name(c.args["to"]))
    if c.kind == "margin_reconciliation":
        needs.append(cte_name(c.args["report"]))
    return needs


def summary_sql(catalogue, layer_of, history: bool = False) -> str:
    selects, needs = [], set()
    for i, c in enumerate(catalogue, start=1):
        if c.kind == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in c.args["values"])
            count = (f"(SELECT count(DISTINCT {c.column}) FROM "
                     f"({_scoped(cte_name(c.relation), c.where)}) WHERE {c.column} NOT IN ({vals}))")
        else:
            count = f"(SELECT count(*) FROM ({check_failing_rows_sql(c)}))"
        col = f"'{c.column}'" if c.column else "NULL::VARCHAR"
        layer = layer_of.get(c.relation, "gold")
        selects.append(
            f"SELECT {i} AS check_id, '{layer}' AS layer, '{c.relation}' AS relation, "
            f"{col} AS column_name, '{c.kind}' AS check_name, '{c.severity}' AS severity, "
            f"CAST({count} AS BIGINT) AS failures")
        needs.update(check_needs(c))
    body = "\nUNION ALL\n".join(selects)
    final = (f"SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
             f"ELSE 'fail' END AS status FROM ({body}) s")
    return with_models(final, sorted(needs), history)
