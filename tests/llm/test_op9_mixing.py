from llm_helpers import SMALL, as_text, oracle_rows

from finmart.llm import mixing as M


def plain_targets(sizes: dict) -> dict:
    """Excess over the cap is reshared by weight until no source is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(order)}
    capped: dict = {}
    while True:
        left = sum(sizes.values()) - sum(capped.values())
        total = sum(w for s, w in weight.items() if s not in capped)
        share = {s: left * w / total for s, w in weight.items() if s not in capped}
        over = [s for s in share if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3.0 * sizes[s] for s in over}


def test_small_table_matches_sql(llm, small_docs):
    got = M.mixed(small_docs).toPandas()
    assert as_text(got) == as_text(oracle_rows(M.ORACLE, SMALL, "documents"))


def test_targets_taken_and_caps(llm):
    sizes = {"a": 5, "b": 4000, "c": 10, "é": 300, "z": 2500, None: 40, "": 0}
    rows, n = [], 0
    for source, words in sizes.items():
        while words > 0:
            k = min(words, 1 + n % 9)
            rows.append((n, "w " * k, source))
            words -= k
            n += 1
    rows.append((n, "", ""))
    got = M.mixed(llm.createDataFrame(rows, "doc_id int, text string, source string")).collect()
    source_of = {r[0]: r[2] for r in rows}
    want = plain_targets(sizes)
    taken: dict = {}
    for r in got:
        s = source_of[r.doc_id]
        assert abs(r.target - want[s]) < 1e-6 and r.source_size == sizes[s]
        assert 0 <= r.taken <= 3 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    assert all(abs(taken[s] - want[s]) < 1 for s in sizes)


def test_positions_follow_the_schedule(llm, small_docs):
    order = M.plan(small_docs, keep=["doc_id", "source"]).filter("copies > 0").collect()
    for slope in M.SLOPES:
        for r in (r for r in order if r.slope == slope):
            place = min(r._before / r.target, 1)
            assert abs(r.position + slope * (r.position ** 2 - r.position) - place) < 1e-9


def test_training_order(llm, odd_docs, small_docs):
    for docs in (small_docs, odd_docs):
        out = M.training_order(docs)
        assert out.columns == docs.columns
        copies = M.plan(docs).agg({"copies": "sum"}).first()[0]
        assert out.count() == (copies or 0)
    first = [tuple(r) for r in M.training_order(small_docs).select("doc_id").collect()]
    assert first == [tuple(r) for r in M.training_order(small_docs.repartition(7)).select("doc_id").collect()]
    assert M.training_order(odd_docs.limit(0)).count() == 0 and M.mixed(odd_docs.limit(0)).count() == 0
    assert M.mixed(odd_docs).count() == odd_docs.count()
    empty = llm.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id int, text string, source string")
    assert {(r.taken, r.target) for r in M.mixed(empty).collect()} == {(0, 0.0)}
