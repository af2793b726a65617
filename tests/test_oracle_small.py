"""A sample of registered queries against their DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from paths import SF_SMALL
from harness import compare, duck

SAMPLE = ["silver_lineitem", "snapshot_history", "dim_date", "dim_customer_history",
          "fct_sales_lineitem", "rpt_segment_margin_concentration", "a05_rank_gap",
          "a08_margin_erosion", "check_margin_reconciliation_history"]


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, name):
    # The oracle reads column lists from the sf0.01 sample; sf0.001 has the same columns.
    n, problems = compare(spark, duck(SF_SMALL), SF_SMALL, name, E.queries()[name],
                          E.oracle_sql()[name])
    assert not problems, problems
