import corpus_pipeline as P
import numpy as np
from test_op3_packing import check_rows

from finmart.llm import mixing, quality_rules, simhash_dedup, toxicity_cnn
from finmart.llm.common import scratch_table

FOLDER = "/root/testdata/sf0.01"


def test_every_stage_does_its_operators_work(llm):
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet")
    labels = llm.read.parquet(f"{FOLDER}/labels.parquet")
    columns, before, after = docs.columns, [], []
    for i, (_, stage) in enumerate(P.STAGES):
        before.append(docs)
        docs = scratch_table(stage(llm, docs, FOLDER), f"test{i}")
        after.append(docs)
        assert i == 4 or docs.columns == columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    good = quality_rules.score(before[0], quality_rules.fit(before[0], labels)).filter("predicted = 1")
    assert ids(after[0]) == ids(good)
    clean = toxicity_cnn.score(before[1], toxicity_cnn.fit(before[1], labels)).filter("predicted = 0")
    assert ids(after[1]) == ids(clean)
    groups = simhash_dedup.near_duplicates(before[2])
    assert ids(after[2]) == ids(groups.filter("doc_id = component_id"))
    copies = mixing.plan(before[3]).collect()
    assert ids(after[3]) == sorted(r.doc_id for r in copies for _ in range(r.copies))
    packed = [tuple(r) for r in after[4].collect()]
    check_rows(before[4], packed)
    # the curriculum reaches the sequences: early positions are in early sequences
    first = {r.doc_id: r.position for r in copies if r.position is not None}
    last = max(r[5] for r in packed)
    assert {r[5] for r in packed} == set(range(last + 1))
    thirds = [np.mean([r[5] / last for r in packed if r[1] == 0 and lo <= first[r[0]] < lo + 1 / 3
                       and counts[r[0]] == 1]) for counts in [{r.doc_id: r.copies for r in copies}] for lo in (0, 1 / 3, 2 / 3)]
    assert thirds[0] < thirds[1] < thirds[2]


def test_stages_on_odd_rows(llm, odd_docs):
    columns = odd_docs.columns
    docs = scratch_table(odd_docs, "odd")
    for i, (_, stage) in enumerate(P.STAGES):
        out = scratch_table(stage(llm, docs, FOLDER), f"odd{i}")  # each on all the odd rows
        if i < 4:
            assert out.columns == columns and out.count() <= (3 if i == 3 else 1) * docs.count()
        else:
            check_rows(odd_docs, [tuple(r) for r in out.collect()])
        empty = stage(llm, scratch_table(docs.limit(0), f"none{i}"), FOLDER)
        assert empty.count() == 0


def test_run_and_empty_input(llm, tmp_path):
    small = "/root/testdata/sf0.001"
    assert P.run(llm, small).columns[0] == "doc_id"
    for t in ("documents", "labels"):
        llm.read.parquet(f"{small}/{t}.parquet").limit(0).write.parquet(f"file://{tmp_path}/{t}.parquet")
    assert P.run(llm, f"file://{tmp_path}").count() == 0
