from collections import Counter

from finmart.plans.catalogue import (BRONZE_CHECKS, CATALOGUE, GOLD_CHECKS, SILVER_CHECKS,
                                     SOURCE_CHECKS)


def test_catalogue_shape():
    assert (len(SOURCE_CHECKS), len(BRONZE_CHECKS), len(SILVER_CHECKS), len(GOLD_CHECKS)) == \
        (16, 43, 60, 62)
    assert len(CATALOGUE) == 182 and CATALOGUE[-1].kind == "margin_reconciliation"
    kinds = Counter(c.kind for c in CATALOGUE)
    assert kinds["not_null"] == 101 and kinds["unique"] == 31
    assert kinds["relationships"] == 21 and kinds["unique_combination"] == 6
    assert kinds["accepted_values"] == 5 and kinds["expression_is_true"] == 4
    assert kinds["positive_value"] == 13
    assert [c.severity for c in CATALOGUE].count("warn") == 1
    assert sum(1 for c in CATALOGUE if c.where) == 3
