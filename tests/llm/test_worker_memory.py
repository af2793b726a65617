"""What Python workers hold: batches of a bounded size, one operator's memory, workers of one kind."""

import corpus_pipeline as P
import pyarrow as pa
import pytest

from finmart.llm import common, learning, toxicity_cnn

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
FOLDER = "/root/testdata/sf0.001"


def test_the_training_sample_needs_no_workers(llm, small_docs):
    labels = llm.read.parquet(f"{FOLDER}/labels.parquet")
    rows = learning.training_documents(small_docs, labels, "toxic", 50)
    assert rows.count() > 50 and rows.dtypes == [("doc_id", "bigint"), ("text", "string"), ("y", "int")]
    assert "PythonRDD" not in rows._jdf.queryExecution().toRdd().toDebugString()
    none = learning.training_documents(small_docs.limit(0), labels, "toxic", 50)
    assert none.count() == 0 and none.dtypes == rows.dtypes


def largest_batch(session) -> int:
    def sizes(batches):
        for b in batches:
            yield pa.record_batch({"size": pa.array([b.nbytes])})

    rows = session.range(0, 9000, 1, 1).selectExpr("repeat('x', 4000) AS text")
    return max(r.size for r in rows.mapInArrow(sizes, "size bigint").collect())


@pytest.mark.parametrize("stage", [s for _, s in P.STAGES])
def test_stages_send_small_batches(llm, small_docs, stage):
    session = llm.newSession()
    stage(session, session.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER)
    assert largest_batch(session) < 10_000_000


def test_a_session_keeps_its_own_batches(llm):
    session = llm.newSession()
    session.conf.set(BATCH, "30m")
    common.small_batches(session)
    assert session.conf.get(BATCH) == "30m" and largest_batch(session) > 20_000_000


def test_a_worker_forgets_the_operator_before(monkeypatch):
    monkeypatch.setattr(common, "_TURN", [])
    common.worker_turns_to("toxicity", toxicity_cnn._forget)
    assert toxicity_cnn._KNOWN["word"]
    common.worker_turns_to("toxicity", toxicity_cnn._forget)
    assert "word" in toxicity_cnn._KNOWN  # from task to task it stays
    common.worker_turns_to("packing")
    assert not toxicity_cnn._KNOWN
    common.worker_turns_to("quality")


def test_workers_forget_between_stages(llm, small_docs):
    """As many tasks as there are workers, each looks at what its worker has kept."""
    list(toxicity_cnn.score(small_docs, toxicity_cnn.fit(
        small_docs, llm.read.parquet(f"{FOLDER}/labels.parquet"))).collect())

    def known(batches):
        from finmart.llm import common, toxicity_cnn
        for _ in batches:
            common.worker_turns_to("test")
            yield pa.record_batch({"n": pa.array([len(toxicity_cnn._KNOWN)])})

    assert {r.n for r in llm.range(0, 8, 1, 8).mapInArrow(known, "n bigint").collect()} == {0}
