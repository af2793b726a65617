"""Near-duplicate documents by SimHash fingerprints and pigeonring filtering.

A fingerprint bit is set where more than half of the shingle hashes have it.
Copies are near when their fingerprints differ in at most ``RADIUS`` of 64 bits.

Candidates come from the pigeonring principle: cut the 64 bits into a ring of 8
segments; two fingerprints within the radius have a segment from which *every*
chain of consecutive segments stays within its proportional share of the radius
(chain of l: floor(l * 3 / 8) differing bits).  So from that segment on the
first two segments are equal, the first five differ in one bit at most, hence
two of the segments 3 to 5 are equal as well: 8 starts times 3 choices make 24
keys of 32 bits.  Rows that share a key are checked chain by chain, and the
whole Hamming distance is the last chain.  Equal fingerprints are one row
before any of this, and pairs are never listed: a block gives the edges that
connect it.

Defined results: a null text counts as empty, an empty text has fingerprint
zero and is linked like any other; a row without doc_id takes part, and the
component takes its smallest doc_id that is there (null if none is);
repeated rows are linked to each other; extra columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.llm.blocks import compare_groups, linked_stars, paired_chunks
from finmart.llm.common import checkpointed, only_columns, worker_turns_to
from finmart.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3
SEGMENTS = 8
SEGMENT_BITS = 8
#: Differing bits allowed in a chain of 1, 2 ... 8 segments.
BUDGETS = [n * RADIUS // SEGMENTS for n in range(1, SEGMENTS + 1)]
#: Shingles hashed at once (bounds the list of a very long text).
PIECE_WORDS = 200_000


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of one UTF-8 text (an unsigned 64-bit number)."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    w = min(shingle_words, len(words))
    votes, total = np.zeros(64, np.int64), len(words) - w + 1
    for at in range(0, total, PIECE_WORDS):
        piece = words[at:min(at + PIECE_WORDS, total) + w - 1]
        joined = b" ".join(piece)
        lengths = np.fromiter(map(len, piece), np.int64, len(piece))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        shingles = [joined[a:b] for a, b in zip(starts[:len(piece) - w + 1].tolist(),
                                                ends[w - 1:].tolist())]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)),
                             np.uint64, len(shingles))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * votes > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``fp`` (the fingerprint's bits as a signed long) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_turns_to("fingerprints")
        for batch in batches:
            texts = batch.column("text")
            fps = np.fromiter((fingerprint(t.as_py() or b"") for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(fps.view(np.int64))], [*keep, "fp"])

    docs = docs.select(*keep, F.col("text").cast("binary").alias("text"))
    kept = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in docs.schema[:-1])
    return docs.mapInArrow(run, f"{kept}fp bigint")


def _texts(docs: DataFrame) -> DataFrame:
    return only_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))


def _ring_keys(fp: Column) -> Column:
    """The 24 block keys of a fingerprint: start and choice above 32 bits."""
    keys = []
    for start in range(SEGMENTS):
        shift = start * SEGMENT_BITS
        turned = fp if not shift else F.shiftrightunsigned(fp, shift).bitwiseOR(
            F.shiftleft(fp, 64 - shift))
        for free in (2, 3, 4):
            mask = sum(0xFF << (SEGMENT_BITS * s) for s in range(5) if s != free)
            keys.append(turned.bitwiseAND(F.lit(mask)).bitwiseXOR(
                F.lit(((start * 3 + free - 2) << 48))))
    return F.array(*keys)


def _within_chains(a: np.ndarray, b: np.ndarray, start: int) -> np.ndarray:
    """Which pairs keep all the budgets from segment ``start`` on; the last
    chain is the whole ring, so its budget is the Hamming radius."""
    diff = a ^ b
    if start:
        shift = np.uint64(start * SEGMENT_BITS)
        diff = (diff >> shift) | (diff << (np.uint64(64) - shift))
    ok = np.bitwise_count(diff & np.uint64((1 << 40) - 1)) <= BUDGETS[4]
    for n in (6, 7, 8):
        if not ok.any():
            break
        mask = np.uint64((1 << (SEGMENT_BITS * n)) - 1)
        ok &= np.bitwise_count(diff & mask) <= BUDGETS[n - 1]
    return ok


def _linked(batch: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Edges that connect each group of fingerprints."""
    fps = batch.column("fp").to_numpy().view(np.uint64)
    side = batch.column("_side").to_numpy()
    tables = (batch.column("key").to_numpy() >> 48) // 3
    bounds = np.append(starts, len(fps)) if starts[-1] != len(fps) else starts
    left, right = [], []
    sizes = np.diff(bounds)
    # pairs of rows at each distance, over all the small groups at once
    group = np.repeat(np.arange(len(sizes)), sizes)
    small = (sizes <= 16)[group]
    for step in range(1, 16):
        at = np.flatnonzero((group[step:] == group[:-step]) & small[step:])
        if not len(at):
            break
        for start in range(SEGMENTS):
            here = at[tables[at] == start]
            if len(here):
                here = here[_within_chains(fps[here], fps[here + step], start)]
                left.append(fps[here])
                right.append(fps[here + step])
    for i in np.flatnonzero(sizes > 16):
        lo, hi = bounds[i], bounds[i + 1]
        own, start = fps[lo:hi], int(tables[lo])
        links = np.zeros((hi - lo, hi - lo), bool)
        cut = int(np.searchsorted(side[lo:hi], 1))
        if cut in (0, hi - lo):
            links[:] = _within_chains(own[:, None], own[None, :], start)
            np.fill_diagonal(links, False)
        else:
            links[:cut, cut:] = _within_chains(own[:cut, None], own[None, cut:], start)
            links |= links.T
        edges = linked_stars(links)
        left.append(own[[a for a, _ in edges]])
        right.append(own[[b for _, b in edges]])
    a, b = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (left, right))
    yield pa.record_batch({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within the radius; ``fps``
    holds distinct values in column ``fp``."""
    keyed = fps.select("fp", F.explode(_ring_keys(F.col("fp"))).alias("key"))
    groups = paired_chunks(keyed, "key", "fp")
    return compare_groups(groups, "key", "fp", _linked, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    rows = checkpointed(fingerprints(_texts(docs), "doc_id"))
    known = component_of(rows)
    firsts = known.join(rows, "fp").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    known = checkpointed(known.join(firsts, "component").drop("component"))
    hex_digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(known, "fp").select("doc_id", hex_digits.alias("fingerprint"), "component_id")


def component_of(rows: DataFrame) -> DataFrame:
    """(fp, component) of every distinct fingerprint; a component is named by
    its smallest fingerprint."""
    distinct = checkpointed(rows.select("fp").distinct())
    linked = components(fingerprint_links(distinct)).withColumnRenamed("node", "fp")
    return checkpointed(distinct.join(linked, "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component")))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns: the one with the
    smallest doc_id (rows without id come last; the text's hash breaks ties)."""
    key = [F.col("doc_id").isNull().alias("_none"),
           F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("_id"),
           F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash")]
    names = ["_none", "_id", "_hash"]
    docs = docs.select(F.struct("*").alias("row"), "text", *key)  # no name can clash
    rows = checkpointed(fingerprints(docs.select(*names, "text"), *names))
    first = (rows.join(component_of(rows), "fp").groupBy("component")
             .agg(F.min(F.struct(*names)).alias("first")))
    first = checkpointed(first.select("first.*"))
    return docs.drop("text").dropDuplicates(names).join(first, names, "left_semi").select("row.*")
