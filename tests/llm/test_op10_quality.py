import zlib

import numpy as np

from finmart.llm import quality_rules as Q

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy_and_compiled_rules(llm):
    docs, labels = (llm.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = Q.fit(docs, labels)
    assert 0 < len(model.rules) < 200  # sparse
    rows = Q.score(docs, model).collect()
    quality = {r.doc_id: r.quality for r in labels.collect()}
    held = [r for r in rows if r.held_out and quality.get(r.doc_id) is not None]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == quality[r.doc_id] for r in held]) >= 0.97
    some = docs.filter("doc_id % 7 = 3").collect()
    x = np.array([Q.statistics((r.text or "").encode()) for r in some])
    by_id = {r.doc_id: r.score for r in rows}
    assert np.allclose(model.predict(x), [by_id[r.doc_id] for r in some])


def test_statistics():
    row = dict(zip(Q.STATISTICS, Q.statistics("Aé b b!! | %%%\nNO 12.\nNO 12.".encode())))
    assert row["n_chars"] == 28 and row["n_words"] == 9 and row["n_lines"] == 3
    assert row["distinct_lines"] == 2 / 3 and row["words_in_capitals"] == 2 / 9
    assert row["bars"] > 0 and row["excited"] > 0 and row["words_with_symbols"] == 1 / 9
    assert Q.statistics(b"") == [0.0] * len(Q.STATISTICS)


def test_lasso_drops_useless_rules():
    rng = np.random.default_rng(0)
    z = rng.integers(0, 2, (2000, 12)).astype(float)
    y = ((z[:, 0] + z[:, 1]) > 1).astype(float)
    w, _ = Q.lasso_logistic(z, y, penalty=0.02)
    assert (np.abs(w[:2]) > 0.3).all() and (np.abs(w[2:]) < 0.05).all()


def test_odd_rows(llm, odd_docs):
    labels = llm.createDataFrame([(1, 0), (6, 1), (None, 1), (2, None), (3, 0), (7, 1), (99, 1)],
                                 "doc_id bigint, quality int").selectExpr("*", "1 AS y", "2 AS text")
    model = Q.fit(odd_docs, labels)
    rows = Q.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    kept = Q.keep_good(odd_docs, model)
    assert kept.dtypes == odd_docs.dtypes
    assert kept.count() == sum(r.predicted for r in rows)
    assert Q.score(odd_docs.limit(0), model).count() == 0 and Q.keep_good(odd_docs.limit(0), model).count() == 0
    assert Q.fit(odd_docs, labels.limit(0)).constant == 1.0
    assert Q.score(odd_docs, Q.fit(odd_docs, labels.limit(0))).filter("score = 1").count() == odd_docs.count()
