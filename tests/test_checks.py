from decimal import Decimal

from finmart.operators import checks as C


def test_positive_value(spark):
    df = spark.createDataFrame([(Decimal("0"),), (Decimal("-1"),), (None,), (Decimal("2"),)],
                               "x decimal(12,2)")
    assert C.positive_value(df, "x").count() == 2
    assert C.positive_value(df, "x", allow_zero=True).count() == 1


def test_relationships_orphan_fails_null_passes(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "fk long")
    parent = spark.createDataFrame([(1,)], "id long")
    assert [r["fk"] for r in C.relationships(child, "fk", parent, "id").collect()] == [2]


def test_unique_and_accepted_values_ignore_null(spark):
    df = spark.createDataFrame([(1, "A"), (1, None), (None, "Z"), (None, None)], "k long, v string")
    assert [r["unique_field"] for r in C.unique(df, "k").collect()] == [1]
    assert [r["value_field"] for r in C.accepted_values(df, "v", ["A"]).collect()] == ["Z"]


def test_expression_null_is_not_failure_and_where(spark):
    df = spark.createDataFrame([(Decimal("0.5"), True), (None, True), (Decimal("2"), False)],
                               "r decimal(5,4), cur boolean")
    assert C.expression_is_true(df, "between 0 and 1", "r").count() == 1
    assert C.expression_is_true(df, "between 0 and 1", "r", where="cur = true").count() == 0
    assert C.unique_combination(df, ["cur"], where="cur = true").count() == 1


def test_relationships_summary_matches_rows(spark):
    from finmart.plans.catalogue import Check
    from finmart.plans.quality import run_checks
    child = spark.createDataFrame([(1, True), (2, True), (2, True), (None, True), (3, False)],
                                  "fk long, keep boolean")
    parent = spark.createDataFrame([(1,), (1,)], "id long")
    checks = [Check("child", "fk", "relationships", {"to": "parent", "field": "id"}),
              Check("child", "fk", "relationships", {"to": "parent", "field": "id"}, where="keep")]
    rows = run_checks({"child": child, "parent": parent}, checks).orderBy("check_id").collect()
    assert [r.failures for r in rows] == [3, 2]
    assert C.relationships(child, "fk", parent, "id").count() == 3


def test_accepted_values_counts_bad_values(spark):
    from finmart.plans.catalogue import Check
    from finmart.plans.quality import run_checks
    df = spark.createDataFrame([("a",), ("x",), ("x",), ("y",), (None,)], "v string")
    checks = [Check("t", "v", "accepted_values", {"values": ["a"]}), Check("t", "v", "not_null")]
    rows = run_checks({"t": df}, checks).orderBy("check_id").collect()
    assert [r.failures for r in rows] == [2, 1]


def test_fused_uniqueness_matches_individual_checks(spark):
    from pyspark.sql import functions as F

    from finmart.plans.catalogue import Check
    from finmart.plans.quality import _fused_uniqueness
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "c"), (None, "c"),
                                (None, None), (None, None)], "x long, y string")
    checks = [(1, Check("t", "x", "unique")), (2, Check("t", "y", "unique")),
              (3, Check("t", None, "unique_combination", {"columns": ["x", "y"]})),
              (4, Check("t", "x", "unique"))]
    out, covered = _fused_uniqueness(df, checks)
    got = {r["check_id"]: r["n"] for r in out.groupBy("check_id").agg(F.sum("n").alias("n"))
           .collect()}
    assert covered == [1, 2, 4, 3]
    # unique x: value 1 (NULLs ignored); unique y: a and c; combination: (NULL,c), (NULL,NULL)
    assert got == {1: 1, 4: 1, 2: 2, 3: 2}
    assert C.unique(df, "x").count() == 1 and C.unique(df, "y").count() == 2
    assert C.unique_combination(df, ["x", "y"]).count() == 2
