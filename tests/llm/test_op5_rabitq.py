import math

import numpy as np

from finmart.llm import rabitq_dedup as R


def plain(rows, threshold=0.95):
    """n_links and component by brute force over all pairs."""
    ok = [i for i, (_, v) in enumerate(rows)
          if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for a in ok:
        for b in ok:
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a != b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a].add(b)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            todo += (new := links[todo.pop()] - seen)
            seen |= new
        component = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vec_id, len(links[i]), component, vec_id is not None and vec_id == component))
    return out


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 64))
    y = x + rng.normal(size=x.shape) * rng.choice([0.1, 0.5, 2], (4000, 1))
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    codes, factors = R.encode(x)
    errors, bounds = [], []
    for i in range(0, 4000, 500):
        e, b = R.estimates(codes[i:i + 500], factors[i:i + 500], y[i:i + 500])
        errors.append(np.diag(e) - np.einsum("ij,ij->i", x[i:i + 500], y[i:i + 500]))
        bounds.append(b)
    errors, bounds = np.concatenate(errors), np.concatenate(bounds)
    assert abs(errors.mean()) < 0.01
    assert (np.abs(errors) <= bounds).mean() > 0.999


def test_key_plan_grows_with_the_logarithm():
    for rows in (1, 100, 10 ** 5, 10 ** 9):
        bits, tables = R.key_plan(rows, 0.95)
        assert rows / 2 ** bits <= R.GROUP_ROWS and tables < 100
        meet = (1 - math.acos(0.95) / math.pi) ** bits
        assert (1 - meet) ** tables <= R.MISS


def test_rows_match_brute_force(llm):
    rng = np.random.default_rng(2)
    rows = []
    for g in range(30):
        c = rng.normal(size=16)
        rows += [(None, (c + rng.normal(size=16) * s).tolist()) for s in rng.choice([0.05, 0.15, 1], 12)]
    hot = rng.normal(size=16)
    rows += [(None, hot.tolist())] * 40  # equal vectors
    rows += [(None, (hot + rng.normal(size=16) * 0.02).tolist()) for _ in range(60)]  # dense group
    rows = [(i * 3 % 997, v) for i, (_, v) in enumerate(rows)]
    rows += [(5000, None), (5001, []), (5002, [0.0] * 16), (5003, [1.0, None] * 8), (5004, [float("nan")] * 16),
             (5005, [float("inf")] * 16), (5006, [1.0] * 8), (5007, [2.0] * 8), (None, [2.0] * 8),
             (None, rng.normal(size=16).tolist()), (5008, [1e-30] * 8), (5009, [1.0] * 8), (5009, [1.0] * 8)]
    df = llm.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr(
        "*", "1 AS cid", "2 AS n", "3 AS key", "4 AS first")
    got = sorted(map(tuple, R.near_duplicate_vectors(df).collect()), key=str)
    assert got == sorted(plain(rows), key=str)
    assert R.near_duplicate_vectors(df.limit(0)).count() == 0


def test_recall_at_the_threshold(llm):
    """Pairs just above the threshold, the worst case for the keys."""
    rng = np.random.default_rng(4)
    rows, angle = [], math.acos(0.953)
    for i in range(1500):
        a = rng.normal(size=32)
        a /= np.linalg.norm(a)
        b = rng.normal(size=32)
        b -= b @ a * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (math.cos(angle) * a + math.sin(angle) * b).tolist())]
    df = llm.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = R.near_duplicate_vectors(df).filter("n_links > 0").count()
    assert got >= 0.98 * 3000
