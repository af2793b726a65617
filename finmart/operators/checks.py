"""Data checks.  Each check returns the DataFrame of its failing rows — an
empty result is a pass — exactly what a failure store keeps.

Row-level checks (not_null, accepted_values, expression_is_true,
positive_value) are also available as boolean *failure conditions*, so a
runner can evaluate all of them for one relation in a single aggregation
pass instead of one scan per check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _scope(df: DataFrame, where: str | Column | None) -> DataFrame:
    if where is None:
        return df
    return df.filter(F.expr(where) if isinstance(where, str) else where)


# ---- failure conditions (row level) -------------------------------------

def not_null_fails(column: str) -> Column:
    return F.col(column).isNull()


def accepted_values_fails(column: str, values: list) -> Column:
    # NULL passes: NOT IN over a NULL is NULL, which is not a failure.
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def expression_fails(expression: str, column: str | None = None) -> Column:
    # The column form prefixes the column: "<col> <expression>".  A NULL
    # result is not a failure (pair with not_null where that matters).
    text = f"{column} {expression}" if column else expression
    return F.coalesce(~F.expr(text), F.lit(False))


def positive_value_fails(column: str, allow_zero: bool = False) -> Column:
    c = F.col(column)
    return c.isNotNull() & ((c < 0) if allow_zero else (c <= 0))


# ---- failing-row checks --------------------------------------------------

def not_null(df: DataFrame, column: str, where=None) -> DataFrame:
    return _scope(df, where).filter(not_null_fails(column))


def unique(df: DataFrame, column: str, where=None) -> DataFrame:
    """Non-null values occurring more than once, with their count."""
    return (_scope(df, where).filter(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: list, where=None) -> DataFrame:
    """Distinct values outside the list, with their count."""
    return (_scope(df, where).filter(accepted_values_fails(column, values))
            .groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def relationships(df: DataFrame, column: str, parent: DataFrame, field: str,
                  where=None) -> DataFrame:
    """Child rows whose non-null key has no parent row (anti join).

    An anti join never multiplies child rows, so the parent keys are not
    de-duplicated first (that would cost a shuffle); Catalyst broadcasts the
    parent key column when small and sort-merges otherwise.
    """
    keys = parent.select(F.col(field).alias("_parent_key"))
    child = _scope(df, where).filter(F.col(column).isNotNull())
    return child.join(keys, child[column] == keys["_parent_key"], "left_anti")


def unique_combination(df: DataFrame, columns: list[str], where=None) -> DataFrame:
    """Column tuples occurring more than once."""
    return (_scope(df, where).groupBy(*columns)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None,
                       where=None) -> DataFrame:
    return _scope(df, where).filter(expression_fails(expression, column))


def positive_value(df: DataFrame, column: str, allow_zero: bool = False,
                   where=None) -> DataFrame:
    """Non-null values <= 0 (or < 0 with allow_zero)."""
    return _scope(df, where).filter(positive_value_fails(column, allow_zero))


def margin_reconciliation(fact: DataFrame, report: DataFrame, days: int = 90,
                          tolerance: float = 0.01) -> DataFrame:
    """Σ gross_margin of the fact inside the report window vs Σ of the report.

    One row (fact_windowed_total, rpt_total, discrepancy) when they differ
    by more than ``tolerance``; a NULL difference passes.  The window is the
    report's: [max(order_date) - days, max(order_date)], inclusive.
    """
    from finmart.plans.reports import windowed_fact
    # Both totals in one aggregation over a tagged union (no join needed).
    sides = (windowed_fact(fact, days)
             .select(F.col("gross_margin").cast("decimal(38,2)").alias("_v"), F.lit(1).alias("_s"))
             .unionByName(report.select(F.col("total_gross_margin").cast("decimal(38,2)")
                                        .alias("_v"), F.lit(2).alias("_s"))))
    both = sides.agg(
        F.sum(F.when(F.col("_s") == 1, F.col("_v"))).cast("decimal(38,2)").alias("fact_windowed_total"),
        F.sum(F.when(F.col("_s") == 2, F.col("_v"))).cast("decimal(38,2)").alias("rpt_total"))
    diff = F.abs(F.col("fact_windowed_total") - F.col("rpt_total"))
    return (both.select("fact_windowed_total", "rpt_total", diff.alias("discrepancy"))
                .filter(F.col("discrepancy") > F.lit(tolerance)))
