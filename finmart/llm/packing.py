"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents are tokenised once, where they are read.  A longer document is cut
into full pieces, which are sequences by themselves, after a first piece with
the rest; so every document is one item of 1 to ``CAPACITY`` tokens.  Items of
one length are interchangeable, so the packing is made for the histogram of
lengths (at most ``CAPACITY`` rows, whatever the corpus): at most two items
above a third of the capacity fit together, so these are matched greedily, the
longest with the longest that still fits; smaller lengths, from the longest
down, go where the gap is smallest.  The plan says which ranks of a length go
to which range of sequences, and every document looks its own rank up.

Ranks within a length are counted per hash bucket and offset by the totals of
the buckets before, so a length that a third of all documents have is no
single task's.

Where the documents have a place in training (``position``), items of one length
take their ranks in that order, and sequences are numbered by the least place of
their documents, so reading the sequences by number goes through the documents in
their order, as nearly as the packing allows.

Defined results: a null text counts as empty and is the end token alone; any
doc_id, null included, is passed through, repeated rows are packed each; extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finmart.llm.common import byte_symbols, checkpointed, text_slices, worker_turns_to
from finmart.operators.ranking import with_global_position

CAPACITY = 1024
END_ID = 2
#: Units a worker remembers in each of two generations.
CACHE_ENTRIES = 250_000
#: Documents per hash bucket when ranks are counted.
BUCKET_ROWS = 20_000

#: White space as the tokenizer's pattern knows it (Unicode White_Space).
_SPACE = r"[\t-\r \x85\xa0  -     　]"
_DOUBLE = re.compile(_SPACE + "{2}")
_UNIT = re.compile(rf"{_SPACE}*{_SPACE.replace('[', '[^')}+|{_SPACE}+")


#: Fixed value: how byte-level vocabularies of this kind cut a text (the
#: pattern is built into the tokenizers library, not written in the file).
_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


_MARKS = frozenset(".,;:!?")


class UnitEncoder:
    """Token ids of texts for a byte-level vocabulary file of the tokenizers
    library, the same ids as it gives.  Its tokens begin, but never go on, with
    white space, so a text is its units (white space and what follows) one by
    one, and each distinct unit is encoded once while a worker remembers it.
    The merges of a unit are run by tiktoken from the same vocabulary, which
    takes a tenth of the time for such short strings."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items()
                 if t not in special}
        self.library = tiktoken.Encoding("units", pat_str=_PATTERN, mergeable_ranks=ranks,
                                         special_tokens=special)
        self.special = list(special)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def units(text: str) -> list[str]:
        if _DOUBLE.search(text):
            return _UNIT.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + r for r in rest]] if rest else [first]

    def _ids(self, unit: str) -> bytes:
        if unit[-1:] in _MARKS and unit[-2:-1].isalpha():  # the mark is a token of its own
            word = unit[:-1]
            return (self.known.get(word) or self.older.get(word) or self._ids(word)) + self._ids(unit[-1])
        if "<" in unit and any(s in unit for s in self.special):
            ids = self.library.encode(unit, allowed_special="all", disallowed_special=())
        else:
            ids = self.library.encode_ordinary(unit)
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.known) > CACHE_ENTRIES:
            self.known, self.older = {}, self.known
        units = [self.units(t) for t in texts]
        known, older = self.known, self.older
        for u in set().union(*units).difference(known):
            known[u] = older.get(u) or self._ids(u)
        return [b"".join(map(known.__getitem__, u)) for u in units]


_ENCODERS: dict[str, UnitEncoder] = {}


def in_file_order(docs: DataFrame) -> tuple[DataFrame, str | None]:
    """Documents read from files that were written in an order, with the file and the
    row each comes from, and that column's name; documents from elsewhere as they
    are, and None."""
    place = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        return docs.select(*[F.col(f"`{c}`") for c in docs.columns], place.alias("_place")), "_place"
    except AnalysisException:
        return docs, None


def numbered(rows: DataFrame) -> DataFrame:
    """``position`` as the number of the row over all files (from 0).  Rows are counted
    per file, not sorted; they are thin by now, the texts don't travel."""
    number = lambda p: F.try_to_number(F.nullif(F.regexp_extract("_file", p, 1), F.lit("")), F.lit("9" * 18))
    rows = rows.withColumns({"_file": F.col("position.file"), "_row": F.col("position.row")})
    files = checkpointed(rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")))
    before = Window.orderBy(number(r"^part-(\d+)").asc_nulls_last(), number(r"\.?-?c(\d+)\.").asc_nulls_last(),
                            "_file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    starts = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return rows.join(starts, "_file").withColumn("position", F.col("_start") + F.col("_row")).drop(
        "_file", "_row", "_start")


def tokenized(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
              end_id: int = END_ID, position: str | None = None) -> DataFrame:
    """doc_id, ``first`` (tokens of the first piece), ``crcs`` of all pieces, and
    the position (null without one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_turns_to("packing")
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = UnitEncoder(tokenizer)
        encoder = _ENCODERS[tokenizer]
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            for at, texts in text_slices(batch.column("text")):
                firsts, crcs = [], []
                for ids in encoder.encode(texts):
                    ids += end
                    n = len(ids) // 4
                    first = (n - 1) % capacity + 1
                    cuts = [0, *range(4 * first, len(ids) + 1, 4 * capacity)]
                    firsts.append(first)
                    crcs.append([zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])])
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(at, len(texts)),
                    "position": batch.column("position").slice(at, len(texts)),
                    "first": pa.array(firsts, pa.int32()),
                    "crcs": pa.array(crcs, pa.list_(pa.int64()))})

    place = F.col(f"`{position}`") if position else F.lit(None).cast("bigint")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", place.alias("position"))
    kind = docs.schema["position"].dataType.simpleString()
    rows = docs.mapInArrow(run, f"doc_id bigint, position {kind}, first int, crcs array<bigint>")
    return numbered(checkpointed(rows)) if kind.startswith("struct") else rows


class _Gaps:
    """Sequences by the room that is left in them, as ranges of numbers."""

    def __init__(self, capacity: int):
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def put(self, gap: int, start: int, count: int) -> None:
        self.ranges[gap].append((start, count))

    def take(self, gap: int, most: int) -> Iterator[tuple[int, int]]:
        """Ranges of at most ``most`` sequences with this gap, and no longer there."""
        ranges = self.ranges[gap]
        while most and ranges:
            start, count = ranges.pop()
            if count > most:
                ranges.append((start + most, count - most))
                count = most
            most -= count
            yield start, count


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Runs (length, first rank, items, first sequence, offset), and the number
    of sequences, for so many items of each length."""
    left = {n: c for n, c in histogram.items() if c}
    used = dict.fromkeys(left, 0)
    runs: list[tuple] = []
    gaps = _Gaps(capacity)
    sequences = 0

    def place(length: int, items: int, start: int, offset: int) -> None:
        runs.append((length, used[length], items, start, offset))
        used[length] += items
        left[length] -= items

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            mate = next((m for m in large if m <= min(n, capacity - n) and left[m] > (m == n)), None)
            if mate is None:
                items = left[n]
                place(n, items, sequences, 0)
                gaps.put(capacity - n, sequences, items)
            else:
                items = left[n] // 2 if mate == n else min(left[n], left[mate])
                place(n, items, sequences, 0)
                place(mate, items, sequences, n)
                gaps.put(capacity - n - mate, sequences, items)
            sequences += items
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        gap = n
        while left[n] and gap <= capacity:
            moved = list(gaps.take(gap, left[n]))
            for start, count in moved:
                place(n, count, start, capacity - gap)
                gaps.put(gap - n, start, count)
            # what is left of these gaps may be the best fit for the next ones
            gap = gap - n if moved and gap - n >= n else gap + 1
        fits = capacity // n
        full, rest = divmod(left[n], fits)
        for i in range(fits if full else 0):
            place(n, full, sequences, i * n)
        if full:
            gaps.put(capacity - fits * n, sequences, full)
            sequences += full
        for i in range(rest):
            place(n, 1, sequences, i * n)
        if rest:
            gaps.put(capacity - rest * n, sequences, 1)
            sequences += 1
    return runs, sequences


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
           end_id: int = END_ID, position: str | None = None) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    ``position``: a column with the documents' places in training (0, 1 ..., or as
    ``in_file_order`` gives them)."""
    items = checkpointed(tokenized(docs, tokenizer, capacity, end_id, position)
                         .withColumn("_uid", F.monotonically_increasing_id()))
    full = F.size("crcs") - 1
    lengths = items.groupBy("first").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum(full).alias("full")).orderBy("first").collect()
    runs, sequences = packing_plan({r["first"]: r["n"] for r in lengths}, capacity)
    runs.sort()
    at = np.array([r[0] << 40 | r[1] for r in runs], np.int64)
    to, offset, rank0 = (np.array([r[i] for r in runs], np.int64) for i in (3, 4, 1))

    # full pieces are numbered after the packed sequences, by length and bucket
    before, numbers = sequences, []
    for r in lengths:
        numbers.append((r["first"], before))
        before += r["full"]
    buckets = max(64, min(1 << 16, sum(r["n"] for r in lengths) // BUCKET_ROWS))
    if position:  # buckets are stretches of the training order
        span = 1 + (items.agg(F.max("position")).first()[0] or 0)
        bucket = F.floor(F.col("position") / span * buckets)
    else:
        bucket = F.pmod(F.xxhash64("_uid"), F.lit(buckets))
    items = items.withColumn("_b", bucket.cast("int"))
    groups = items.groupBy("first", "_b").agg(F.count(F.lit(1)).alias("_n"),
                                              F.sum(full).alias("_full"))
    prior = Window.partitionBy("first").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    groups = checkpointed(groups.select(
        "first", "_b", F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_rank"),
        F.coalesce(F.sum("_full").over(prior), F.lit(0)).alias("_number")))
    within = Window.partitionBy("first", "_b").orderBy("position", "_uid")
    ranked = items.join(groups, ["first", "_b"]).select(
        "doc_id", "position", "first", "crcs",
        (F.col("_rank") + F.row_number().over(within) - 1).alias("_rank"),
        (F.col("_number") + F.coalesce(F.sum(full).over(
            within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_number"))
    number_of = dict(numbers)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column("first").to_numpy().astype(np.int64)
            rank = batch.column("_rank").to_numpy()
            run = np.searchsorted(at, first << 40 | rank, side="right") - 1
            base = np.array([number_of[f] for f in first.tolist()], np.int64)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "position": batch.column("position"),
                "first": batch.column("first"),
                "crcs": batch.column("crcs"),
                "_sequence": pa.array(to[run] + rank - rank0[run]),
                "_offset": pa.array(offset[run]),
                "_number": pa.array(base + batch.column("_number").to_numpy())})

    placed = ranked.mapInArrow(look_up, "doc_id bigint, position bigint, first int, crcs array<bigint>, "
                                        "_sequence bigint, _offset bigint, _number bigint")
    pieces = placed.select("doc_id", "position", "first", "_sequence", "_offset", "_number",
                           F.posexplode("crcs").alias("piece", "ids_crc32"))
    is_first = F.col("piece") == 0
    long = lambda c: c.cast("bigint")
    rows = pieces.select(
        "doc_id", "position", "piece",
        long(F.when(is_first, 0).otherwise(F.col("first") + (F.col("piece") - 1) * capacity)).alias("start"),
        long(F.when(is_first, F.col("first")).otherwise(capacity)).alias("length"), "ids_crc32",
        F.when(is_first, F.col("_sequence")).otherwise(F.col("_number") + F.col("piece") - 1).alias("sequence_id"),
        F.when(is_first, F.col("_offset")).otherwise(F.lit(0)).alias("offset"))
    if not position:
        return rows.drop("position")
    rows = checkpointed(rows)
    least = rows.groupBy("sequence_id").agg(F.min("position").alias("_least"), F.min("piece").alias("_piece"))
    numbered = with_global_position(least, [F.col("_least"), F.col("_piece"), F.col("sequence_id")], "_number")
    return rows.join(numbered.select("sequence_id", (F.col("_number") - 1).alias("_number")), "sequence_id").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("_number").alias("sequence_id"), "offset")
