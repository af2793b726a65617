import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from finmart.llm.packing import UnitEncoder, packed, packing_plan

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_are_the_librarys(small_docs):
    texts = ["it's  we're\n\n I'll", "a   b\n\nc \n d\t\te ", "日本語 x　y", "a<|endoftext|>b <|endoftext|> c",
             "x\tY z\x1cq!\x1c  w", "", " ", "   ", "\n", "\xa0\xa0a \xa0b", "word.word! (x)", "end. "]
    texts += [r.text for r in small_docs.collect()]
    library, own = Tokenizer.from_file(PATH), UnitEncoder(PATH)
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def check_plan(histogram: dict) -> int:
    runs, sequences = packing_plan(histogram)
    used, places = {}, {}
    for length, rank, items, start, offset in runs:
        assert rank == used.get(length, 0)
        used[length] = rank + items
        for i in range(items):
            places.setdefault(start + i, []).append((offset, length))
    assert used == {n: c for n, c in histogram.items() if c}
    assert sorted(places) == list(range(sequences))
    for rows in places.values():
        end = 0
        for offset, length in sorted(rows):
            assert offset == end
            end += length
        assert end <= 1024
    return sequences


def test_plans_are_valid_and_near_the_bound():
    rng = random.Random(3)
    for _ in range(20):
        histogram: dict = {}
        for _ in range(rng.choice([1, 10, 300, 3000])):
            n = min(1024, max(1, int(rng.lognormvariate(rng.choice([4, 5.5, 6.5]), 1))))
            histogram[n] = histogram.get(n, 0) + 1
        check_plan(histogram)
    many = {n: 50 for n in range(1, 1025)}
    assert check_plan(many) <= 1.01 * sum(n * c for n, c in many.items()) / 1024 + 1
    assert check_plan({}) == 0
    assert check_plan({1: 5000}) == 5
    assert check_plan({600: 4, 424: 4, 400: 3}) == 6


def check_rows(docs, rows) -> None:
    library = Tokenizer.from_file(PATH)
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        first = (len(ids) - 1) % 1024 + 1
        for i, at in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[at:first if i == 0 else at + 1024]
            want.append((r.doc_id, i, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((r[:5] for r in rows), key=str) == sorted(want, key=str)
    places: dict = {}
    for r in rows:
        places.setdefault(r[5], []).append((r[6], r[3]))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024


def test_pieces_round_trip(llm, small_docs, odd_docs):
    for docs in (small_docs, odd_docs):
        check_rows(docs, [tuple(r) for r in packed(docs, PATH).collect()])
    assert packed(odd_docs.limit(0), PATH).count() == 0


def test_sequences_follow_the_order_of_training(llm, small_docs, odd_docs):
    from pyspark.sql import functions as F

    from finmart.llm.common import scratch_table
    from finmart.llm.packing import in_file_order, numbered
    docs = scratch_table(small_docs.orderBy(F.xxhash64("doc_id")), "ordered")
    placed, name = in_file_order(docs)
    place = {r.doc_id: r.position for r in numbered(placed.withColumnRenamed(name, "position")).collect()}
    want = [r.doc_id for r in small_docs.orderBy(F.xxhash64("doc_id")).collect()]
    assert [i for i, _ in sorted(place.items(), key=lambda x: x[1])] == want
    assert sorted(place.values()) == list(range(len(want)))
    rows = [tuple(r) for r in packed(placed, PATH, position=name).collect()]
    check_rows(docs, rows)
    least: dict = {}
    for r in rows:
        least[r[5]] = min(least.get(r[5], len(want)), place[r[0]])
    assert sorted(least) == list(range(len(least)))  # numbers without a gap
    assert [least[s] for s in sorted(least)] == sorted(least.values())
    plain = packed(docs, PATH).select("sequence_id").distinct().count()
    assert len(least) == plain  # no sequence more
    # the pieces of the first half of training are in the first half of the sequences
    early = [r[5] for r in rows if place[r[0]] < len(want) / 2 and r[1] == 0]
    late = [r[5] for r in rows if place[r[0]] >= len(want) / 2 and r[1] == 0]
    assert np.mean(early) < 0.6 * np.mean(late)
    made = llm.createDataFrame([(1, "x")], "doc_id bigint, text string")
    assert in_file_order(made)[1] is None
    odd, name = in_file_order(scratch_table(odd_docs, "odd"))
    assert odd.drop(name).columns == odd_docs.columns
    check_rows(odd_docs, [tuple(r) for r in packed(odd, PATH, position=name).collect()])
