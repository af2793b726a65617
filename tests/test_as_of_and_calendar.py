"""The report as of a date in all its columns, and the fixed calendar keyed to orders."""

import pytest
from harness import compare, duck

import __spark_entry__ as E
from paths import SF_SMALL


@pytest.mark.parametrize("name", ["rpt_customer_profitability_as_of_full",
                                  "rpt_customer_profitability_as_of_full_history",
                                  "dim_date_fixed_range_orders"])
def test_matches_sql(spark, name):
    query, sql = E.queries()[name], E.oracle_sql()[name]
    rows, problems = compare(spark, duck(SF_SMALL), SF_SMALL, name, query, sql)
    assert not problems and rows > 0
    columns = query(spark, SF_SMALL).columns
    if name.startswith("rpt"):
        assert columns == E.queries()["rpt_customer_profitability_90d"](spark, SF_SMALL).columns
    else:
        orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
        assert query(spark, SF_SMALL).agg({"order_count": "sum"}).first()[0] == orders
