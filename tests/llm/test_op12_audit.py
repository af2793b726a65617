import random
import re
from collections import Counter, defaultdict

import pytest

from finmart.llm import source_audit as S
from llm_helpers import SMALL, as_text, oracle_rows

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, ranks):
    """The audit by the definition, term by term; rows are (lang, source, text)."""
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = _TERM.findall((text or "").translate(_LOWER))
        groups[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: {t: c[t] for t in kept} for (g, s), c in groups.items() if g == lang}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}

        def shares(counts):
            total = sum(counts.values()) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 5) // total for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(whole)
        for s in own:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in own if o != s)
            out += [(lang, s, "pair", o.decode(), -v, i + 1) for i, (v, o) in enumerate(pairs)]
            more = sorted((q[t] - p[s][t], t.encode()) for t in kept if own[s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t.decode(), -v, i + 1) for i, (v, t) in enumerate(more[:ranks])]
    return sorted(out)


def made_rows(seed, size=300):
    rng = random.Random(seed)
    words = ["the", "The", "THE", "naïve", "Ünï", "ünï", "日本", "\U0001f600x", "a\x00b", "x1y", "it's", "z", "Z"] + \
        [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = []
    for i in range(size):
        lang = rng.choice(["en", "en", "en", "de", "", None])
        source = rng.choice(["s1", "s1", "s1", "s1", "s2", "s3", "é", "", None])
        text = " ".join(rng.choice(words[:rng.randrange(5, len(words))]) for _ in range(rng.randrange(0, 40)))
        rows.append((lang, source, rng.choice([text, text, text, "", None])))
    rows += [("fr", f"f{i}", "!? 12") for i in range(3)]  # groups without terms, no kept term
    rows += [("en", "silent", None), ("it", "alone", "ciao ciao")] + [("es", "t", "uno dos dos")] * 40
    return rows + [("es", "u", "dos"), ("es", "v", "")]


SCHEMA = "lang string, source string, text string"


@pytest.mark.parametrize("seed, least, ranks", [(1, 30, 50), (2, 5, 50), (3, 1, 4), (4, 10_000, 50)])
def test_as_defined(llm, seed, least, ranks):
    rows = made_rows(seed)
    got = S.source_divergence(llm.createDataFrame(rows, SCHEMA).repartition(7), least, ranks).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, least, ranks)


def test_counts_handed_on_early_and_texts_in_pieces(llm, monkeypatch):
    rows = made_rows(5)
    monkeypatch.setattr(S, "PIECE_BYTES", 7)
    assert [w for p in S.pieces("Ab cd--日本 efghijklmno p".encode()) for w in p] == [
        b"ab", b"cd", "日本".encode(), b"efghijklmno", b"p"]
    monkeypatch.setattr(S, "HELD_TERMS", 10)
    monkeypatch.setattr(S, "MATRIX_CELLS", 3)
    import pyarrow as pa
    batch = pa.table({"lang": [r[0] or "" for r in rows], "source": [r[1] or "" for r in rows],
                      "text": [(r[2] or "").encode() for r in rows]})
    n, docs = Counter(), Counter()
    for out in S._counted(iter(batch.to_batches(max_chunksize=9))):
        for r in out.to_pylist():
            if r["term"] is not None:
                n[r["lang"], r["source"], r["term"].decode()] += r["n"]
                docs[r["lang"], r["term"].decode()] += r["docs"]
    want, want_docs = Counter(), Counter()
    for lang, source, text in rows:
        words = _TERM.findall((text or "").translate(_LOWER))
        want.update((lang or "", source or "", w) for w in words)
        want_docs.update((lang or "", w) for w in set(words))
    assert (n, docs) == (want, want_docs)


def test_terms_in_common_in_small_matrices(monkeypatch):
    """The correction for common terms does not depend on how a task cuts its terms."""
    import pyarrow as pa
    rng = random.Random(3)
    users = [[{"source": s, "p": rng.randrange(1, 10**9), "z": 10 + i} for i, s in enumerate("abcd")
              if rng.random() < .7] for _ in range(50)]
    batch = pa.record_batch({"lang": pa.array(["x", "y"] * 25), "users": pa.array(users)})
    whole = [b.to_pydict() for b in S._in_common(iter([batch]))]
    monkeypatch.setattr(S, "MATRIX_CELLS", 9)
    assert sorted(map(str, whole)) == sorted(str(b.to_pydict()) for b in S._in_common(iter([batch])))
    assert whole


def test_given_documents_as_in_sql(llm, small_docs):
    got = S.source_divergence(small_docs).toPandas()
    want = oracle_rows(S.ORACLE, SMALL, "documents")
    assert len(want) > 1000 and as_text(got[list(want.columns)]) == as_text(want)


def test_odd_rows(llm, odd_docs):
    got = S.source_divergence(odd_docs, least_documents=2).collect()
    rows = [(r.lang, r.source, r.text) for r in odd_docs.collect()]
    assert sorted(tuple(r) for r in got) == plain(rows, 2, S.RANKS)
    assert S.source_divergence(odd_docs.limit(0)).collect() == []
