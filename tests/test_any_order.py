"""Change logs and snapshot extracts in any order; the as-of join that carries
versions forward."""

import datetime as dt
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from finmart.operators.asof import asof_left_join
from finmart.operators.asof_carry import asof_carry_join
from finmart.operators.scd2 import scd2_snapshot
from finmart.streaming.change_log import ChangeTable
from finmart.streaming.late_snapshots import LateSnapshots


def folder():
    return "file://" + tempfile.mkdtemp(prefix="finmart-order-")


# ---- change log

LOG = "op string, seq bigint, changed array<string>, k int, a string, b int"


def made_log(rng, keys=12, size=120):
    out = []
    for seq in range(size):
        op = rng.choices(["I", "U", "D"], [2, 5, 1])[0]
        changed = rng.choice([None, ["a"], ["b"], ["a", "b"]]) if op == "U" else None
        out.append((op, seq, changed, rng.randrange(keys), rng.choice(["x", "y", None]), rng.randrange(99)))
    return out


def plain(log):
    """The changes one after the other; an update may come before its insert."""
    table, unset = {}, object()
    for op, _, changed, k, a, b in sorted(log, key=lambda r: r[1]):
        if op == "D":
            table.pop(k, None)
            continue
        row = table.setdefault(k, {"a": None, "b": None})
        for c, v in (("a", a), ("b", b)):
            if op == "I" or changed is None or c in changed:
                row[c] = v
    return sorted((k, r["a"], r["b"]) for k, r in table.items())


def rows_of(table):
    return sorted((tuple(r) for r in table.rows().collect()), key=lambda r: r[0])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_cut_of_a_log_ends_in_the_same_table(spark, seed):
    rng = random.Random(seed)
    log = made_log(rng)
    want = sorted(plain(log), key=lambda r: r[0])
    parts = [[] for _ in range(rng.randrange(2, 5))]
    for change in log:
        rng.choice(parts).append(change)
        if rng.random() < 0.2:
            rng.choice(parts).append(change)  # comes twice
    for p in parts:
        rng.shuffle(p)
    table = ChangeTable(spark, folder(), ["k"], buckets=3)
    assert table.rows() is None
    for p in parts:
        table.apply(spark.createDataFrame(p, LOG))
    assert rows_of(table) == want
    table.apply(spark.createDataFrame(parts[0], LOG))  # a batch again
    assert rows_of(table) == want
    table.vacuum()
    assert rows_of(table) == want


def test_rejects_deletes_and_forgetting(spark):
    table = ChangeTable(spark, folder(), ["k"], buckets=2)
    table.apply(spark.createDataFrame(
        [("I", 1, None, 1, "x", 1), ("D", 5, None, 1, None, None), ("I", 2, None, 2, "y", 2),
         ("I", 3, None, None, "z", 3), ("U", None, None, 2, "z", 3), ("M", 4, None, 2, "z", 3),
         (None, 4, None, 2, "z", 3), ("D", 2, None, 3, None, None), ("U", 2, None, 3, "tie", 3)], LOG))
    assert rows_of(table) == [(2, "y", 2)]
    assert sorted(r.reason for r in table.rejected().collect()) == ["key_null", "op_unknown", "op_unknown", "seq_null"]
    table.apply(spark.createDataFrame([("U", 4, None, 1, "late", 9)], LOG))  # older than the delete
    assert rows_of(table) == [(2, "y", 2)]
    table.forget(6)
    assert rows_of(table) == [(2, "y", 2)] and table._read(table.state()).count() == 1
    table.apply(spark.createDataFrame([("I", 9, None, 1, "new", 1)], LOG))
    assert rows_of(table) == [(1, "new", 1), (2, "y", 2)]
    with pytest.raises(ValueError):
        table.apply(spark.createDataFrame([("I", 9, 1)], "op string, seq bigint, k int"))


def test_two_keys_and_no_list_of_changed_columns(spark):
    table = ChangeTable(spark, folder(), ["k", "l"], buckets=2)
    schema = "op string, seq bigint, k int, l string, v double"
    table.apply(spark.createDataFrame([("I", 1, 1, "a", 1.0), ("I", 1, 1, "b", 2.0), ("I", 2, 1, None, 2.0)], schema))
    table.apply(spark.createDataFrame([("U", 2, 1, "a", None)], schema))
    assert sorted((r.l, r.v) for r in table.rows().collect()) == [("a", None), ("b", 2.0)]
    assert table.rejected().count() == 1


# ---- extracts in any order

RUNS = [f"20{10 + i}-01-01 00:00:00" for i in range(5)]


def made_extracts(seed, keys=40):
    """Five extracts: keys come and go, checked and other columns change, some keys
    are unclear (two different rows) or missing."""
    rng = random.Random(seed)
    state, out = {}, []
    for _ in RUNS:
        for k in range(keys):
            roll = rng.random()
            if roll < 0.25:
                state[k] = (rng.choice(["s", "t", None]), rng.randrange(3))
            elif roll < 0.35:
                state.pop(k, None)
            elif roll < 0.6 and k in state:
                state[k] = (state[k][0], rng.randrange(9))  # the unchecked column
        rows = [(k, *v) for k, v in state.items()]
        rows += [(k, "other", 99) for k in rng.sample(sorted(state), 3)]  # unclear
        out.append(rows + rng.sample(rows, 2) + [(None, "n", 1)])
    return out


@pytest.mark.parametrize("seed, order", [(1, (4, 3, 2, 1, 0)), (2, (2, 0, 4, 1, 3)), (3, (1, 4, 0, 2, 3)), (4, (0, 1, 2, 3, 4))])
def test_extracts_in_any_order_give_the_history_of_the_right_order(spark, seed, order):
    schema = "k int, checked string, other int"
    frames = [spark.createDataFrame(rows, schema) for rows in made_extracts(seed)]
    want = None
    for as_of, frame in zip(RUNS, frames):
        want = scd2_snapshot(want, frame, "k", ["checked"], as_of).checkpoint()
    late = LateSnapshots(spark, folder(), "k", ["checked"])
    for i in order:
        assert late.apply(frames[i], RUNS[i])
    assert not late.apply(frames[0], "2010-01-01")  # that run is there
    late.vacuum()
    got = late.history()
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert want.filter("scd_valid_to IS NOT NULL").count() > 10  # there is a history


# ---- as-of join

def intervals(rng, keys, versions):
    """Versions of a key that don't overlap, with gaps, ends in between days and
    an open end."""
    out = []
    for k in keys:
        at = dt.datetime(2000, 1, 1) + dt.timedelta(days=rng.randrange(500))
        for i in range(versions):
            end = at + dt.timedelta(hours=rng.randrange(0, 2000))
            out.append((k, at, end if i < versions - 1 else dt.datetime(9999, 12, 31), f"{k}-{i}"))
            at = end + dt.timedelta(hours=rng.choice([0, 0, 700]))
    return out


def test_carrying_forward_gives_the_rows_of_the_interval_join(spark):
    rng = random.Random(4)
    right = spark.createDataFrame(intervals(rng, [1, 2, 3, 50, None], 25) + intervals(rng, [7], 1),
                                  "id bigint, valid_from timestamp_ntz, valid_to timestamp_ntz, v string")
    starts = [r.valid_from for r in right.collect()]
    times = starts[:40] + [dt.datetime(1999, 1, 1) + dt.timedelta(hours=rng.randrange(100_000)) for _ in range(800)] + [None]
    left = spark.createDataFrame([(rng.choice([1, 2, 3, 7, 9, None]), t, i) for i, t in enumerate(times * 2)],
                                 "id int, at timestamp_ntz, n int").withColumns(
        {c: F.lit(i) for i, c in enumerate(["k", "t", "l", "s", "o"])})
    args = ("id", "id", F.col("at"))
    want = asof_left_join(left, right, *args)
    for days in (1, 92, 100_000):
        got = asof_carry_join(left, right, *args, slice_days=days)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert want.filter("v IS NULL").count() > 50 and want.filter("v IS NOT NULL").count() > 300


def test_one_customer_with_many_versions_and_orders_is_linear(spark):
    """10^4 versions and 10^5 orders of one customer: 10^9 pairs for an interval join."""
    day = F.timestamp_add("MINUTE", (F.col("id") * 100).cast("int"), F.lit("1990-01-01").cast("timestamp_ntz"))
    right = spark.range(10_000).select(
        F.lit(1).alias("c"), day.alias("valid_from"), F.timestamp_add("MINUTE", F.lit(100), day).alias("valid_to"),
        F.col("id").alias("v"))
    at = F.timestamp_add("MINUTE", (F.col("id") * 10 + 5).cast("int"), F.lit("1990-01-01").cast("timestamp_ntz"))
    left = spark.range(100_000).select(F.lit(1).alias("c"), F.col("id").alias("n"), at.alias("t"))
    out = asof_carry_join(left, right, "c", "c", F.col("t"), right_cols={"v": "v"})
    start = time.time()
    assert out.filter("v = floor((n * 10 + 5) / 100)").count() == 100_000
    assert time.time() - start < 60
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
