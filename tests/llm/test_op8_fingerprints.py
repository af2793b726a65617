import hashlib

import numpy as np
from pyspark.sql import functions as F

from finmart.llm import fingerprints as P


def plain_fingerprints(llm, texts):
    """SimHash by counting votes in Python, with Spark's hash of the terms."""
    terms = []
    for t in texts:
        w = t.split(" ")
        pairs = list(zip(w, w[1:])) if len(w) > 1 else [(w[0], None)] if w[0] else []
        terms.append(pairs)
    flat = sorted({p for ts in terms for p in ts}, key=str)
    df = llm.createDataFrame(flat, "a string, b string") if flat else None
    hashes = {(r.a, r.b): r.h % (1 << 64) for r in df.select("a", "b", F.xxhash64("a", "b").alias("h")).collect()}
    out = []
    for ts in terms:
        votes, total = np.zeros(64), 0
        for a, b in ts:
            weight = min(len(a) + len(b or ""), P.MAX_WEIGHT)
            votes += weight * np.array([hashes[a, b] >> j & 1 for j in range(64)])
            total += weight
        out.append(sum(1 << j for j in range(64) if 2 * votes[j] > total))
    return out


def order(rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    return sorted(set(rows), key=key)


def check(llm, docs):
    rows = [tuple(r) for r in docs.select("doc_id", F.coalesce("text", F.lit("")), F.xxhash64(
        F.coalesce("text", F.lit("")))).collect()]
    chain = order(rows)
    edited = []
    for i, (_, text, _) in enumerate(chain):
        k = len(text) // 4
        edited.append(text[:len(text) - k] + chain[(i + 1) % len(chain)][1][:k])
    fps = plain_fingerprints(llm, [r[1] for r in chain] + edited)
    n = len(chain)
    like = lambda a, b: 1 - (a ^ b).bit_count() / 64
    want = {r: (r[0], len(r[1]), hashlib.sha256(edited[i].encode()).hexdigest(), f"{fps[i]:016x}",
                f"{fps[n + i]:016x}", like(fps[i], fps[n + i]), like(fps[i], fps[(i + 1) % n]))
            for i, r in enumerate(chain)}
    got = P.fingerprinted(docs).drop("fp").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted((want[r] for r in rows), key=str)


def test_documents(llm, small_docs):
    check(llm, small_docs.filter("doc_id < 80"))


def test_odd_rows(llm, odd_docs):
    check(llm, odd_docs)
    check(llm, odd_docs.filter("doc_id = 1"))
    assert P.fingerprinted(odd_docs.limit(0)).count() == 0


def test_lanes_do_not_overflow(llm):
    text = " ".join(["averylongword"] * (3 * P.CHUNK_TERMS))
    one = llm.createDataFrame([(1, text)], "k int, t string")
    two = llm.createDataFrame([(1, "averylongword averylongword")], "k int, t string")
    assert P.signatures(one, ["k"], "t").first().fp == P.signatures(two, ["k"], "t").first().fp


def test_block_tables_find_all_within_the_radius(llm):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    fps = list(base)
    for b in base:
        for n in (1, 2, 3, 4):
            bits = rng.choice(64, n, replace=False)
            fps.append(b ^ np.uint64(sum(1 << int(x) for x in bits)))
    fps = np.array(fps, np.uint64)
    rows = llm.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    got = {tuple(r) for r in P.within_radius(rows, rows.limit(150)).collect()}
    want = set()
    for r in rows.limit(150).collect():
        q = np.array([r.fp], np.int64).view(np.uint64)
        want |= {(r.fp, int(x)) for x in fps[np.bitwise_count(fps ^ q) <= 3].view(np.int64)}
    assert got == want


def test_near_counts(llm, small_docs):
    rows = P.with_near_counts(P.fingerprinted(small_docs)).collect()
    fps = np.array([int(r.fingerprint, 16) for r in rows], np.uint64)
    for r in rows:
        own = (np.bitwise_count(fps ^ np.uint64(int(r.fingerprint, 16))) <= 3).sum() - 1
        assert r.n_near == (own if r.doc_id % 100 == 0 else None)
