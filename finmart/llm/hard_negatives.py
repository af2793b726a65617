"""Hard negatives by angular triangle filtering.

Each vector becomes integers (``floor(256 * x)``); its norm and its angles to a
few reference directions are stored.  For two vectors with angles s and t to
the same direction, the angle between them lies within |s - t| and s + t, so
every direction gives an interval of the cosine, and their intersection times
both norms, widened by more than the rounding can be, bounds the integer score.
Positives: the fifth largest lower bound of a block is one that the fifth best
score reaches, rows whose upper bound is below it are out.  Negatives: a row
stays for an anchor if its interval overlaps one of the windows that the
positives open (30 to 90 % of their score).  Only what is left is scored, in
exact integers; scores alone decide.

The references are far apart (each next one the vector of a bounded sample that
is farthest from those before), so they follow the data; they only decide how
much is filtered, never what comes out.

Anchors (a stated query set: every id divisible by 100) meet all rows block by
block: rows and anchors are dealt to blocks of bounded size by a hash of the
row, and each pair of blocks is a group of its own.  Positives meet within their
label only; a label that holds a third of all rows is many blocks.  A group
hands on its best few per anchor and window.

Defined results: a row without id, label or vector, or with a null, infinite or
NaN component takes no part, nor one whose integer vector is 2**31 long or
longer (its scores need not fit a long); vectors of different lengths don't
meet, empty vectors score 0; repeated rows count each, rows with the anchor's
own id are neither positives nor negatives of it; ties go to the smaller id; a
negative positive score opens no window; extra columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finmart.llm.common import checkpointed, only_columns

ANCHOR_EVERY = 100
POSITIVES, NEGATIVES = 5, 10
#: A negative's score is from 30 to 90 hundredths of the positive's.
LEAST, MOST, WHOLE = 30, 90, 100
# Ids divisible by this move on by one of so many labels; the
# factor of the integer components.
RELABEL_EVERY, LABELS, FACTOR = 7, 10, 256

REFERENCES = 8
#: Rows from which the references are chosen.
SAMPLE_ROWS = 1024
LONGEST = 2.0 ** 31
#: Rows of a block at least and at most; a thirty-second of all in between.
BLOCK_ROWS = (1024, 65_536)
#: Pairs whose bounds a task holds at once.
PAIRS = 1_000_000
SEED = 11

_ROW = "row bigint, vec_id bigint, label bigint, q array<int>, norm double, angles array<double>"


def _integers(flat: np.ndarray) -> np.ndarray:
    return np.floor(FACTOR * flat)


def chosen_references(vectors: list[list[float]], number: int = REFERENCES) -> dict[int, np.ndarray]:
    """Reference directions by vector length: of the sample's commonest length
    the vectors far apart; other lengths get random directions where needed."""
    lengths = [len(v) for v in vectors]
    if not lengths:
        return {}
    d = max(sorted(set(lengths)), key=lengths.count)
    m = _integers(np.array([v for v in vectors if len(v) == d], float).reshape(-1, d))
    norms = np.linalg.norm(m, axis=1)
    m = m[(norms > 0) & np.isfinite(norms)] / norms[(norms > 0) & np.isfinite(norms)][:, None]
    if not len(m):
        return {}
    picked = [0]
    while len(picked) < min(number, len(m)):
        picked.append(int(np.argmin((m @ m[picked].T).max(axis=1))))
    return {d: m[picked]}


def _references(known: dict[int, np.ndarray], d: int) -> np.ndarray:
    if d not in known:
        m = np.random.default_rng([SEED, d]).normal(size=(REFERENCES, d))
        known[d] = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    return known[d]


def _prepared(known: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            sizes = vectors.value_lengths().to_numpy()
            flat = _integers(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            starts = np.cumsum(sizes) - sizes
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                m = flat[starts[at][:, None] + np.arange(d)].reshape(len(at), d)
                largest = np.maximum(np.abs(m).max(axis=1, initial=0), 1)
                norm = np.linalg.norm(m / largest[:, None], axis=1) * largest
                fits = norm < LONGEST
                at, m, norm = at[fits], m[fits], norm[fits]
                along = m @ _references(known, d).T / np.maximum(norm, 1)[:, None]
                part = batch.take(pa.array(at))
                yield pa.record_batch({
                    **{c: part.column(c) for c in ("row", "vec_id", "label")},
                    "q": _lists(m.astype(np.int32), pa.int32()), "norm": pa.array(norm),
                    "angles": _lists(np.arccos(np.clip(along, -1, 1)), pa.float64())})
    return run


def _lists(m: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(m.ravel(), kind))


def score_bounds(norm: np.ndarray, angles: np.ndarray, other_norm: np.ndarray,
                 other_angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each vector with each other one."""
    least = np.full((len(norm), len(other_norm)), -1.0)
    most = np.ones_like(least)
    cos, sin, other_cos, other_sin = np.cos(angles), np.sin(angles), np.cos(other_angles), np.sin(other_angles)
    for r in range(angles.shape[1]):
        straight = np.outer(cos[:, r], other_cos[:, r])
        across = np.outer(sin[:, r], other_sin[:, r])
        np.minimum(most, straight + across, out=most)     # cos(s - t)
        np.maximum(least, straight - across, out=least)   # cos(s + t)
    scale = np.outer(norm, other_norm)
    wider = 1e-6 * scale + 1
    return least * scale - wider, most * scale + wider


class _Side:
    """One side of a group: vectors of one length, in the order of their ids."""

    def __init__(self, table: pa.Table):
        self.table = table.combine_chunks()
        column = lambda c: self.table.column(c).to_numpy()
        self.row, self.id, self.label, self.norm = (column(c) for c in ("row", "vec_id", "label", "norm"))
        self.q, self.angles = self._matrix("q"), self._matrix("angles")

    def _matrix(self, name: str) -> np.ndarray:
        flat = self.table.column(name).combine_chunks().flatten().to_numpy()
        return flat.reshape(len(self.table), -1) if len(flat) else np.zeros((len(self.table), 0), flat.dtype)

    def __len__(self) -> int:
        return len(self.row)


def scores(a: _Side, rows: slice, b: _Side, wanted: np.ndarray) -> np.ndarray:
    """Exact integer scores of the wanted pairs; those of other pairs mean nothing."""
    small = a.norm[rows].max(initial=0) * b.norm.max(initial=0) < 2.0 ** 52
    kind = np.float64 if small else np.int64  # products of such doubles add up exactly
    out = np.zeros(wanted.shape, np.int64)
    if wanted.mean() < 1 / 8:
        i, j = np.nonzero(wanted)
        for at in range(0, len(i), PAIRS):
            p, r = i[at:at + PAIRS], j[at:at + PAIRS]
            out[p, r] = np.einsum("ij,ij->i", a.q[rows][p].astype(kind), b.q[r].astype(kind)).astype(np.int64)
        return out
    some = np.flatnonzero(wanted.any(axis=0))
    out[:, some] = (a.q[rows].astype(kind) @ b.q[some].astype(kind).T).astype(np.int64)
    return out


def best(score: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The first k of the places ``at`` (in id order) by score, ties by place."""
    if len(at) > k:
        least = np.partition(score[at], len(at) - k)[len(at) - k]
        at = at[score[at] >= least]
    return at[np.argsort(-score[at], kind="stable")][:k]


def _sides(group: pa.Table) -> Iterator[tuple[_Side, _Side]]:
    """Anchors and rows of a group, vectors of one length at a time."""
    group = group.sort_by("vec_id").combine_chunks()
    length = group.column("q").combine_chunks().value_lengths().to_numpy() if len(group) else np.array([])
    anchor = group.column("anchor").to_numpy(zero_copy_only=False).astype(bool)
    for d in np.unique(length):
        a, b = (group.take(pa.array(np.flatnonzero((length == d) & which))) for which in (anchor, ~anchor))
        if len(a) and len(b):
            yield _Side(a), _Side(b)


def _slices(a: _Side, b: _Side) -> Iterator[slice]:
    step = max(1, PAIRS // len(b))
    return (slice(i, min(i + step, len(a))) for i in range(0, len(a), step))


_POSITIVE = "row bigint, anchor_id bigint, positive_id bigint, positive_score bigint"


def _positives(group: pa.Table) -> pa.Table:
    out = {name: [] for name in ("row", "anchor_id", "positive_id", "positive_score")}
    for a, b in _sides(group):
        for rows in _slices(a, b):
            least, most = score_bounds(a.norm[rows], a.angles[rows], b.norm, b.angles)
            other = a.id[rows][:, None] != b.id
            if len(b) > POSITIVES:  # what the fifth best score reaches
                low = np.where(other, least, -np.inf)
                reached = np.partition(low, len(b) - POSITIVES, axis=1)[:, len(b) - POSITIVES]
                other &= most >= reached[:, None]
            score = scores(a, rows, b, other)
            for i in range(len(other)):
                at = best(score[i], np.flatnonzero(other[i]), POSITIVES)
                out["row"] += [int(a.row[rows][i])] * len(at)
                out["anchor_id"] += [int(a.id[rows][i])] * len(at)
                out["positive_id"] += b.id[at].tolist()
                out["positive_score"] += score[i][at].tolist()
    return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})


def window(positive: int) -> tuple[int, int]:
    """Least and greatest score of a negative (none if they cross)."""
    return -(-LEAST * positive // WHOLE), MOST * positive // WHOLE


_NEGATIVE = ("row bigint, place int, anchor_id bigint, positive_id bigint, negative_id bigint, "
             "positive_score bigint, negative_score bigint")


def _negatives(group: pa.Table) -> pa.Table:
    out = {name: [] for name in ("row", "place", "anchor_id", "positive_id", "negative_id",
                                 "positive_score", "negative_score")}
    for a, b in _sides(group):
        opened = [[(p["place"], p["id"], p["score"], *window(p["score"])) for p in ps]
                  for ps in a.table.column("positives").to_pylist()]
        for rows in _slices(a, b):
            least, most = score_bounds(a.norm[rows], a.angles[rows], b.norm, b.angles)
            differs = (a.label[rows][:, None] != b.label) & (a.id[rows][:, None] != b.id)
            wanted = np.zeros_like(differs)
            for i, windows in enumerate(opened[rows]):
                for *_, low, high in windows:
                    if low <= high:
                        wanted[i] |= (most[i] >= low) & (least[i] <= high)
            wanted &= differs
            score = scores(a, rows, b, wanted)
            for i, windows in enumerate(opened[rows]):
                candidates = np.flatnonzero(wanted[i])
                of = score[i][candidates]
                for place, positive, value, low, high in windows:
                    at = best(score[i], candidates[(of >= low) & (of <= high)], NEGATIVES)
                    n = len(at)
                    out["row"] += [int(a.row[rows][i])] * n
                    out["place"] += [place] * n
                    out["anchor_id"] += [int(a.id[rows][i])] * n
                    out["positive_id"] += [positive] * n
                    out["positive_score"] += [value] * n
                    out["negative_id"] += b.id[at].tolist()
                    out["negative_score"] += score[i][at].tolist()
    return pa.table({c: pa.array(v, pa.int32() if c == "place" else pa.int64()) for c, v in out.items()})


def _blocks(rows: Column) -> Column:
    """Number of blocks of so many rows."""
    size = F.greatest(F.lit(BLOCK_ROWS[0]), F.least(F.lit(BLOCK_ROWS[1]), F.ceil(rows / 32)))
    return F.greatest(F.lit(1), F.ceil(rows / size)).cast("int")


def _grouped(rows: DataFrame, anchors: DataFrame, key: list[str]) -> DataFrame:
    """Every block of rows with every block of anchors (of the same key); both
    sides come with ``row_blocks`` and ``anchor_blocks``, their numbers."""
    row_of = F.pmod(F.xxhash64("row"), "row_blocks").cast("int").alias("row_block")
    anchor_of = F.pmod(F.xxhash64("row"), "anchor_blocks").cast("int").alias("anchor_block")
    all_of = lambda n: F.explode(F.expr(f"sequence(0, {n}s - 1)")).alias(n)
    one = rows.select("*", row_of).select("*", all_of("anchor_block"), F.lit(False).alias("anchor"))
    two = anchors.select("*", anchor_of).select("*", all_of("row_block"), F.lit(True).alias("anchor"))
    both = one.unionByName(two, allowMissingColumns=True).drop("row_blocks", "anchor_blocks")
    # dealt by the whole key, so a label's blocks go to many tasks
    return both.repartition(*key, "anchor_block", "row_block").groupBy(*key, "anchor_block", "row_block")


def mine(vectors: DataFrame, anchor_every: int = ANCHOR_EVERY, relabel: bool = True) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    label = F.col("label").cast("bigint")
    if relabel:
        label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (only_columns(vectors, "vec_id", "label", "embedding")
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), "label",
                    F.col("embedding").cast("array<double>").alias("embedding"))
            .select("vec_id", label.alias("label"), "embedding")
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(good, F.lit(False))))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "embedding").limit(SAMPLE_ROWS)
    known = chosen_references([r[0] for r in sample.select("embedding").collect()])
    rows = checkpointed(rows.withColumn("row", F.monotonically_increasing_id())
                        .mapInArrow(_prepared(known), _ROW))
    is_anchor = F.col("vec_id") % anchor_every == 0

    labels = checkpointed(rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                                    F.count_if(is_anchor).alias("a"))
                          .filter("a > 0").select("label", _blocks(F.col("n")).alias("row_blocks"),
                                                  _blocks(F.col("a")).alias("anchor_blocks")))
    mates = rows.join(labels, "label")
    found = _grouped(mates, mates.filter(is_anchor), ["label"]).applyInArrow(_positives, _POSITIVE)
    first = Window.partitionBy("row").orderBy(F.col("positive_score").desc(), "positive_id")
    found = found.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= POSITIVES)
    positives = checkpointed(found.groupBy("row").agg(F.collect_list(F.struct(
        "place", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives")))

    n, a = rows.agg(F.count(F.lit(1)), F.count_if(is_anchor)).first()
    blocks = [_blocks(F.lit(c)).alias(name) for c, name in ((n, "row_blocks"), (a, "anchor_blocks"))]
    anchors = rows.filter(is_anchor).join(positives, "row")
    found = _grouped(rows.select("*", *blocks), anchors.select("*", *blocks), []).applyInArrow(
        _negatives, _NEGATIVE)
    in_order = Window.partitionBy("row", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") <= NEGATIVES)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                         "positive_score", "negative_score")


#: The same rows in DuckDB SQL: all anchors against all rows.
ORACLE = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
                  [floor({FACTOR} * CAST(x AS DOUBLE)) for x in embedding] AS q
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
             CAST(list_dot_product(a.q, v.q) AS BIGINT) AS score
      FROM v a JOIN v ON a.vec_id <> v.vec_id AND len(a.q) = len(v.q) WHERE a.vec_id % {ANCHOR_EVERY} = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
     AND {LEAST} * positive_score <= {WHOLE} * score AND {WHOLE} * score <= {MOST} * positive_score
QUALIFY rank <= {NEGATIVES}"""
