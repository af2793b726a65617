import numpy as np
import xxhash

from finmart.llm import simhash_dedup as S


def plain_fingerprint(text: str) -> int:
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_labels(fps: np.ndarray) -> list:
    """Components by brute force over all pairs."""
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3):
            a, b = label[i], label[int(j)]
            if a != b:
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def plain_components(fps: np.ndarray, ids: list) -> dict:
    """Smallest id reachable."""
    best: dict = {}
    label = plain_labels(fps)
    for x, i in zip(label, ids):
        if i is not None:
            best[x] = min(best.get(x, i), i)
    return {k: best.get(x) for k, x in enumerate(label)}


def test_fingerprint_and_spark_hash_agree(llm):
    from pyspark.sql import functions as F
    for text in ("", "A b", "one Two  three\tfour\x0bfive \xa0six É", "x " * 700):
        assert S.fingerprint(text.encode()) == plain_fingerprint(text)
    assert llm.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % (1 << 64) == \
        xxhash.xxh64_intdigest(b"a b c", 42)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{i * i % 113}" for i in range(500)).encode()
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "PIECE_WORDS", 7)
    assert S.fingerprint(text) == whole


def test_chains_lose_no_link():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    flips = np.zeros(4000, np.uint64)
    for _ in range(3):
        flips |= np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)
    found = np.zeros(4000, bool)
    for start in range(8):
        found |= S._within_chains(a, a ^ flips, start)
    assert found.all()


def test_components_match_brute_force(llm):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = [int(c) for c in centres]
    for c in centres:
        for _ in range(30):
            bits = rng.choice(64, rng.integers(1, 6), replace=False)
            fps.append(int(c) ^ sum(1 << int(b) for b in bits))
    dense = int(centres[0])  # one group whose members all share most blocks
    fps += [dense ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)]
    values = np.array(fps, np.uint64)
    ids = list(range(len(fps)))
    rows = llm.createDataFrame([(i, int(v)) for i, v in zip(ids, values.view(np.int64))],
                               "doc_id bigint, fp bigint")
    label = {r.fp: r.component for r in S.component_of(rows).collect()}
    want = plain_components(values, ids)
    of_label: dict = {}
    for i, v in enumerate(values.view(np.int64)):
        of_label.setdefault(label[int(v)], set()).add(want[i])
    assert all(len(s) == 1 for s in of_label.values())
    assert len(of_label) == len(set(want.values()))


def test_odd_rows(llm, odd_docs):
    got = [tuple(r) for r in S.near_duplicates(odd_docs).collect()]
    rows = odd_docs.select("doc_id", "text").collect()
    fps = np.array([plain_fingerprint(r.text or "") for r in rows], np.uint64)
    want = plain_components(fps, [r.doc_id for r in rows])
    assert sorted(got, key=str) == sorted(
        [(r.doc_id, f"{int(fps[i]):016x}", want[i]) for i, r in enumerate(rows)], key=str)
    kept = S.keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len(set(plain_labels(fps)))
    assert kept.filter("doc_id = 1").count() == 1 and kept.filter("doc_id = 7").count() == 0
    assert S.near_duplicates(odd_docs.limit(0)).count() == 0
    assert S.keep_one_of_each(odd_docs.limit(0)).count() == 0
