import public_tokenizers
from tokenizers import Tokenizer

from finmart.llm import token_counts as T

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["it's we're I'll 'd ab'rx", "Ångström Σας ΣΑΣ été naïve", "été café", "日本語テキスト",
         "a<|endoftext|>b <|startoftext|>", "x\tY z\x1cq  w\n\nk", "", " ", "%%%&&&123 4567,,", "İstanbul",
         "ab''s '''s", "😀👨‍👩 ok", "supercalifragilisticexpialidocious" * 4]


def test_every_prefix_has_the_librarys_count(small_docs):
    library, counter = Tokenizer.from_file(PATH), T.PrefixCounter(PATH)
    for text in TEXTS + [r.text[:300] for r in small_docs.limit(40).collect()]:
        want = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]
        assert counter.text_counts(text).tolist() == want, text


def test_small_tables_give_the_same(monkeypatch, small_docs):
    texts = [r.text for r in small_docs.limit(30).collect()] + TEXTS
    want = [T.PrefixCounter(PATH).text_counts(t).tolist() for t in texts]
    monkeypatch.setattr(T, "CACHE_ENTRIES", 20)
    monkeypatch.setattr(T, "SHARED_PREFIX", 3)
    counter = T.PrefixCounter(PATH)
    assert [counter.text_counts(t).tolist() for t in texts] == want


def test_counts_and_questions(llm, odd_docs, small_docs):
    library = Tokenizer.from_file(PATH)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for docs in (odd_docs, small_docs):
        rows = T.token_counts(docs, PATH, 100).collect()
        want = [(r.doc_id, len((r.text or "").encode()), count(r.text or ""), count(r.text or "") > 100)
                for r in docs.select("doc_id", "text").collect()]
        assert sorted((tuple(r)[:4] for r in rows), key=str) == sorted(want, key=str)
    assert T.token_counts(odd_docs.limit(0), PATH, 9).count() == 0
    table = T.prefix_table(small_docs, PATH)
    asked = table.select("doc_id", "n_tokens", T.tokens_in_first(50).alias("t"),
                         T.longest_within(20).alias("c")).collect()
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    for r in asked[:60]:
        text = texts[r.doc_id]
        assert r.t == count(text[:50]) and count(text[:r.c]) <= 20
        assert r.c == len(text) or count(text[:r.c + 1]) > 20
        assert r.n_tokens == count(text)
