import zlib

import numpy as np

from finmart.llm import toxicity_cnn as T

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(llm):
    docs, labels = (llm.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = T.score(docs, T.fit(docs, labels)).collect()
    assert len(rows) == docs.count()
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in rows if r.held_out and toxic.get(r.doc_id) is not None]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    right = [r.predicted == toxic[r.doc_id] for r in held]
    found = [r.predicted for r in held if toxic[r.doc_id]]
    # some 350 toxic training documents of four languages, many with words of their own
    assert np.mean(right) >= 0.97 and np.mean(found) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_long_documents_are_not_judged_worse(llm):
    """Long texts are few here, so all labelled ones count, those of the training too."""
    docs, labels = (llm.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = T.score(docs, T.fit(docs, labels)).join(labels.select("doc_id", "toxic"), "doc_id").join(
        docs.selectExpr("doc_id", "length(text) AS n"), "doc_id").filter("toxic IS NOT NULL").collect()
    right = {long: np.mean([r.predicted == r.toxic for r in rows if (r.n > 12_000) == long]) for long in (False, True)}
    assert sum(r.n > 12_000 for r in rows) >= 50
    assert right[True] >= right[False] - 0.03


def test_pooled_convolution_as_a_plain_loop():
    texts = ["one two three four", "idiot", "", "a b", "der die das " * 40, "Ünï! (x) word-word ..."]
    model = T.train(texts * 10, np.array([0, 1, 0, 0, 0, 1] * 10, float))
    pooled, spoken = model.responses(texts)
    for row, counts, text in zip(pooled, spoken, texts):
        words = T.words_of(text)
        vectors = [model.embeddings[list(T.buckets_of(w))].sum(axis=0) for w in words]
        nothing = np.zeros(T.DIMENSIONS)  # what stands beyond the end
        want = []
        for f in model.filters:
            windows = [sum((vectors[i + o] if i + o < len(vectors) else nothing) @ f[o] for o in range(len(f)))
                       for i in range(len(vectors))]
            want += np.max(windows, axis=0).tolist()
        assert np.allclose(row, want, atol=1e-5)
        known = [sum(w.strip(T._EDGES) in T.FUNCTION_WORDS[x].split() for w in words) for x in T.LANGUAGES]
        assert counts.tolist() == known


def test_the_sample_is_cut_after_labels_meet_documents(llm):
    from finmart.llm.learning import held_out, training_ids
    docs = llm.range(1000, 1400).selectExpr("id AS doc_id", "repeat('x', int(id % 100)) AS text")
    labels = llm.range(0, 1400).selectExpr("id AS doc_id", "int(id % 2) AS toxic")  # most without a document
    ids = training_ids(docs, labels, "toxic", 50)
    assert len(ids) == 100 and all(i >= 1000 and y == i % 2 for i, y in ids)
    known = {r[0] for r in docs.filter(~held_out(docs.doc_id)).select("doc_id").collect()}
    assert {i for i, _ in ids} <= known
    some = training_ids(docs, labels, "toxic", 50, 1000)
    assert {y for _, y in some} == {0, 1} and all(
        sum(i % 100 for i, z in some if z == y) <= 1000 for y in (0, 1)) and len(some) < 100
    assert training_ids(docs, labels.limit(0), "toxic", 50) == []


def test_scores_do_not_depend_on_company():
    texts = ["a calm text"] * 30 + ["you idiot"] * 30 + [f"more text {i}" for i in range(60)]
    model = T.train(texts, np.array([0] * 30 + [1] * 30 + [0] * 60, float))
    many = ["", "you idiot", "x", "calm " * 500, "idiot"]
    alone = [float(model.scores([t])[0]) for t in many]
    assert np.allclose(model.scores(many), alone, atol=1e-6)
    assert alone[1] >= 0.5 and alone[4] >= 0.5 and alone[3] < 0.5 and alone[0] < 0.5


def test_odd_rows(llm, odd_docs):
    labels = llm.createDataFrame([(1, 0), (6, 1), (None, 1), (2, None), (3, 0), (7, 1), (99, 1)],
                                 "doc_id bigint, toxic int").selectExpr("*", "1 AS y", "2 AS text")
    model = T.fit(odd_docs, labels)
    rows = T.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(r.score is not None for r in rows)
    assert T.score(odd_docs.limit(0), model).count() == 0
    kept = T.keep_clean(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in rows)
    none = T.fit(odd_docs, labels.limit(0))
    assert none is None and {r.score for r in T.score(odd_docs, none).collect()} == {0.0}
    assert T.keep_clean(odd_docs, none).count() == odd_docs.count()
