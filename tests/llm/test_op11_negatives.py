import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from finmart.llm import hard_negatives as H
from llm_helpers import SMALL, as_text, oracle_rows

SCHEMA = "vec_id bigint, label int, embedding array<float>"


def plain(rows):
    """The contract over (vec_id, label, vector), by sorting all scores."""
    good = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = math.fmod(label + 1, 10) if i % 7 == 0 else label
        good.append((i, int(label), [math.floor(256 * float(x)) for x in v]))
    out = []
    for i, label, v in good:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other)
                        for j, other, w in good if j != i and len(w) == len(v))
        for p, j, _ in [s for s in scored if s[2] == label][:5]:
            near = [(n, k) for n, k, other in scored if other != label and -30 * p <= -100 * n <= -90 * p]
            out += [(i, j, r + 1, k, -p, -n) for r, (n, k) in enumerate(near[:10])]
    return sorted(out)


def vectors(seed, n=700, d=12, spread=0.3):
    """Clusters, equal vectors, ties, zero vectors and rows that take no part."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    rows = []
    for i in range(n):
        v = (centres[i % 6] + spread * rng.normal(size=d)).astype(np.float32)
        if i % 11 == 0:
            v = np.round(v * 2) / 2  # many equal scores
        if i % 50 == 3:
            v = np.zeros(d, np.float32)
        rows.append((i * 5, int(rng.integers(0, 4)), [float(x) for x in v]))
    odd = [(None, 1, [1.0] * d), (100, None, [1.0] * d), (200, 1, None), (300, 2, [None] + [1.0] * (d - 1)),
           (400, 2, [math.inf] + [1.0] * (d - 1)), (500, 2, [math.nan] + [1.0] * (d - 1)),
           (100_001, 1, [1.0] * (d + 1)), (100_100, 1, [2.0] * (d + 1)), (100_200, 3, [0.5] * (d + 1)),
           (100_300, 1, []), (100_400, 1, []), (100_401, 2, []), (-700, -5, [0.25] * d), (-3, 9, [3.0] * d)]
    return rows + odd


@pytest.mark.parametrize("seed, spread, blocks", [(1, 0.3, (1024, 65_536)), (2, 0.02, (40, 90)), (3, 3.0, (7, 20))])
def test_as_defined(llm, monkeypatch, seed, spread, blocks):
    monkeypatch.setattr(H, "BLOCK_ROWS", blocks)  # blocks of rows and of anchors
    rows = vectors(seed, spread=spread)
    df = llm.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(tuple(r) for r in H.mine(df).collect()) == plain(rows)


def test_common_vector_and_label(llm):
    rows = [(i, 1 if i % 3 else 2, [0.5, 0.5, 0.1 * (i % 9 == 0)]) for i in range(900)]
    got = H.mine(llm.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(tuple(r) for r in got) == plain(rows)


def test_bounds_hold_the_score_and_filter():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 16)) * 100
    q = np.floor(centres[rng.integers(0, 5, 400)] + rng.normal(size=(400, 16)) * 4)
    q[:3], q[3:6] = 0, q[6]
    norm = np.linalg.norm(q, axis=1)
    refs = H.chosen_references((q / H.FACTOR).tolist())[16]
    assert refs.shape == (H.REFERENCES, 16) and np.allclose(np.linalg.norm(refs, axis=1), 1)
    angles = np.arccos(np.clip(q @ refs.T / np.maximum(norm, 1)[:, None], -1, 1))
    least, most = H.score_bounds(norm[:50], angles[:50], norm, angles)
    exact = q[:50] @ q.T
    assert (least <= exact).all() and (exact <= most).all()
    # in clustered data most other clusters are ruled out for the best partners
    fifth = np.sort(least, axis=1)[:, -5]
    assert (most >= fifth[:, None])[6:].mean() < 0.5


def test_only_overlapping_pairs_are_scored(monkeypatch):
    rows = [r for r in vectors(4, spread=0.02)[:300]]
    table = pa.table({"row": range(300), "vec_id": [r[0] for r in rows], "label": [r[1] for r in rows],
                      "embedding": pa.array([r[2] for r in rows], pa.list_(pa.float64()))})
    known = H.chosen_references([r[2] for r in rows])
    side = H._Side(pa.Table.from_batches(H._prepared(known)(iter(table.to_batches()))))
    wanted = np.random.default_rng(1).random((20, 300)) < 0.05
    got = H.scores(side, slice(0, 20), side, wanted)
    exact = side.q[:20].astype(int) @ side.q.T.astype(int)
    assert (got == np.where(wanted, exact, 0)).all()
    large = np.ones((20, 300), bool)
    side.norm = side.norm * 1e8  # beyond what doubles add up exactly: integers
    assert (H.scores(side, slice(0, 20), side, large) == exact).all()


def test_large_numbers_stay_exact(llm):
    rng = random.Random(2)
    rows = [(i * 10, i % 3, [rng.uniform(2e5, 4e6) for _ in range(3)]) for i in range(120)]
    rows = [(i, lab, [float(np.float32(x)) for x in v]) for i, lab, v in rows]
    got = H.mine(llm.createDataFrame(rows, SCHEMA)).collect()
    assert got and sorted(tuple(r) for r in got) == plain(rows)
    beyond = rows + [(77, 1, [1e30, 1e30, 1e30]), (900, 1, [3e38] * 3)]
    assert sorted(H.mine(llm.createDataFrame(beyond, SCHEMA)).collect()) == sorted(got)


def test_given_embeddings_as_in_sql(llm):
    got = H.mine(llm.read.parquet(f"{SMALL}/embeddings.parquet")).toPandas()
    want = oracle_rows(H.ORACLE, SMALL, "embeddings")
    assert len(want) and as_text(got[list(want.columns)]) == as_text(want)


def test_odd_tables(llm):
    df = llm.createDataFrame(vectors(6, n=150), SCHEMA)
    for name in ("row", "q", "norm", "angles", "anchor", "positives", "place", "row_blocks"):
        df = df.withColumn(name, F.lit("x"))
    assert sorted(tuple(r) for r in H.mine(df).collect()) == plain(vectors(6, n=150))
    assert H.mine(df.limit(0)).collect() == []
    twice = llm.createDataFrame([(0, 1, [1.0, 0.0])] * 2 + [(1, 1, [1.0, 0.1])] * 2 + [(2, 2, [0.5, 0.0])] * 3, SCHEMA)
    assert len(H.mine(twice, relabel=False).collect()) == 2 * 2 * 3  # repeated rows count each
