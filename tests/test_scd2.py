import datetime as dt
import os
from decimal import Decimal

from finmart.operators.scd2 import scd2_snapshot

SCHEMA = ("c_custkey long, c_name string, c_address string, c_nationkey long, c_phone string, "
          "c_acctbal decimal(12,2), c_mktsegment string, c_comment string")
CHECK = ["c_mktsegment", "c_acctbal", "c_nationkey", "c_address"]


def _cust(k, seg="BUILDING", bal="1.00", addr=None, phone="1"):
    return (k, f"C{k}", addr, 1, phone, Decimal(bal), seg, None)


def _snap(prev, rows, spark, as_of):
    cur = spark.createDataFrame(rows, SCHEMA)
    return scd2_snapshot(prev, cur, "c_custkey", CHECK, as_of).cache()


def _by_key(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["c_custkey"], []).append(r)
    return {k: sorted(v, key=lambda r: r["scd_valid_from"]) for k, v in out.items()}


def test_first_run_all_open(spark):
    s = _by_key(_snap(None, [_cust(1), _cust(2)], spark, "1995-01-01 00:00:00"))
    assert all(len(v) == 1 and v[0]["scd_valid_to"] is None for v in s.values())
    assert s[1][0]["scd_valid_from"] == dt.datetime(1995, 1, 1)


def test_change_delete_reappear_and_noop(spark):
    s1 = _snap(None, [_cust(1), _cust(2), _cust(3), _cust(4, addr=None), _cust(5)], spark,
               "1995-01-01 00:00:00")
    # 1 changes segment; 2 phone only (no new version); 3 deleted;
    # 4 address NULL -> value (a change); 5 unchanged
    run2 = [_cust(1, seg="MACHINERY"), _cust(2, phone="999"), _cust(4, addr="x"), _cust(5)]
    s2 = _snap(s1, run2, spark, "1998-01-01 00:00:00")
    b = _by_key(s2)
    assert len(b[1]) == 2 and b[1][0]["scd_valid_to"] == dt.datetime(1998, 1, 1)
    assert b[1][1]["c_mktsegment"] == "MACHINERY" and b[1][1]["scd_valid_to"] is None
    assert len(b[2]) == 1 and b[2][0]["c_phone"] == "1"  # unchecked column not refreshed
    assert len(b[3]) == 1 and b[3][0]["scd_valid_to"] == dt.datetime(1998, 1, 1)
    assert len(b[4]) == 2 and len(b[5]) == 1
    # 3 re-appears: a new open version after a gap
    s3 = _snap(s2, run2 + [_cust(3)], spark, "2000-01-01 00:00:00")
    b3 = _by_key(s3)
    assert len(b3[3]) == 2 and b3[3][1]["scd_valid_from"] == dt.datetime(2000, 1, 1)
    # re-running with the same extract is a no-op
    s4 = _snap(s3, run2 + [_cust(3)], spark, "2001-01-01 00:00:00")
    key = lambda r: (r["c_custkey"], r["scd_id"], r["scd_valid_to"])
    assert sorted(map(key, s4.collect())) == sorted(map(key, s3.collect()))


def test_null_to_null_is_not_a_change(spark):
    s1 = _snap(None, [_cust(1, addr=None)], spark, "1995-01-01 00:00:00")
    s2 = _snap(s1, [_cust(1, addr=None)], spark, "1998-01-01 00:00:00")
    assert s2.count() == 1


def test_rows_without_a_clear_key_are_set_aside(spark):
    from finmart.operators.scd2 import scd2_snapshot, set_aside
    one = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "n")], "k int, v string")
    two = spark.createDataFrame([(1, "x"), (1, "z"), (2, "b"), (None, "n"), (3, "c"), (3, "d")],
                                "k int, v string")
    first = scd2_snapshot(None, one, "k", ["v"], "2020-01-01")
    again = scd2_snapshot(first, one, "k", ["v"], "2020-02-01")
    for snap in (first, again):
        assert sorted((r.k, r.v) for r in snap.collect()) == [(1, "a"), (2, "b")]
    later = scd2_snapshot(again, two, "k", ["v"], "2020-03-01")
    assert sorted((r.k, r.v, r.scd_valid_to is None) for r in later.collect()) == [
        (1, "a", True), (2, "b", True)]
    assert sorted((str(r.k), r.v, r.reason) for r in set_aside(two, "k").collect()) == [
        ("1", "x", "key_repeated"), ("1", "z", "key_repeated"), ("3", "c", "key_repeated"),
        ("3", "d", "key_repeated"), ("None", "n", "key_null")]


def test_build_stores_what_the_snapshot_leaves_out(spark, tmp_path):
    from paths import SF_SMALL
    from finmart.plans.pipeline import BuildOptions
    from finmart.run import build
    from finmart.sources import sinks
    from finmart.sources.faults import faulty_customers
    customer = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    data, wh = tmp_path / "data", f"{tmp_path}/wh"
    data.mkdir()
    for p in os.listdir(SF_SMALL):
        if p.endswith(".parquet") and p != "customer.parquet":
            os.symlink(f"{SF_SMALL}/{p}", data / p)
    faulty_customers(customer).write.parquet(f"file://{data}/customer.parquet")
    o = BuildOptions(standin_costs=True)
    for _ in range(2):  # the version is published already the second time
        left = build(spark, str(data), wh, o, layer="snapshot")[sinks.SET_ASIDE].collect()
    keys = [r.c_custkey for r in customer.select("c_custkey").collect()]
    null, twice = [k for k in keys if k % 53 == 0], [k for k in keys if k % 59 == 0 and k % 53]
    assert sum(r.reason == "key_null" for r in left) == len(null) + sum(k % 59 == 0 for k in null) + sum(
        k % 61 == 0 for k in null)
    assert {r.c_custkey for r in left if r.reason == "key_repeated"} == set(twice)
    assert os.listdir(f"{wh}/quarantine/{sinks.SET_ASIDE}") == [sinks.version_tag(o.as_of)]
