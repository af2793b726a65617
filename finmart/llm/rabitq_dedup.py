"""Near-duplicate embeddings by randomised-rotation binary codes.

A vector is brought to unit length and rotated by a random orthogonal matrix;
its code is the signs of the rotated coordinates, and its correction factor is
the inner product of the vector with its own code.  The inner product of one
vector's code with another rotated vector, divided by the factor, is an unbiased
estimate of their cosine with a known error bound.  A pair is recomputed exactly
(double precision) only where the estimate plus its bound reaches the threshold;
only exact cosines make links.

Which pairs are looked at: further random rotations give every vector a short
sign key in each of several tables, and pairs that share a key meet.  Key
length grows with the logarithm of the number of vectors, so a key's group
stays small, and the number of tables follows from the wanted recall at the
threshold (``MISS``; pairs above the threshold are missed far less often).
Equal vectors are one class before any of this (told by a digest).

Only ids and codes travel to the tables.  There the differing bits of two codes
estimate their angle; a vector stays in a group if some other one is, within the
spread of that estimate (``SPREAD``), as near as the threshold.  Vectors are
fetched for those that stay, and the estimates above decide on their pairs.  Groups
of any size are split into pairs of chunks; each chunk pair adds up its vectors'
links and gives the edges that connect them, never the pairs.  A pair that meets in
several tables counts in the first of them.

Defined results: a vector that is null, empty, zero or holds null or non-finite
components links with nothing and is its own component, kept; vectors of
different lengths don't link; vec_id null: the row takes part, its component is
the smallest id there, it is never kept; repeated rows link to each other; extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.llm.blocks import compare_groups, linked_stars, paired_chunks
from finmart.llm.common import checkpointed, only_columns
from finmart.llm.components import components

THRESHOLD = 0.95
#: Chance that a pair just at the threshold shares no key.
MISS = 0.005
#: Mean size of a key's group that the key length aims at.
GROUP_ROWS = 64
#: Standard deviations of the estimate's error that the bound allows for.
BOUND = 4.0
#: Standard deviations of differing bits, at the threshold, that two codes may be off.
SPREAD = 5.0
SEED = 20_24


@functools.lru_cache(maxsize=64)
def rotation(dimensions: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is asked for."""
    rng = np.random.default_rng([SEED, dimensions, number])
    q, r = np.linalg.qr(rng.normal(size=(dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign codes and correction factors of unit vectors (rows)."""
    turned = unit @ rotation(unit.shape[1], 0)
    factor = np.abs(turned).sum(axis=1) / math.sqrt(unit.shape[1])
    return np.packbits(turned > 0, axis=1), factor


def estimates(codes: np.ndarray, factors: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines (coded rows by real rows), and the bound of each coded row."""
    d = unit.shape[1]
    signs = np.unpackbits(codes, axis=1, count=d).astype(np.float32) * 2 - 1
    turned = (unit @ rotation(d, 0)).astype(np.float32)
    spread = np.sqrt(np.maximum(1 - factors ** 2, 0)) / factors / math.sqrt(max(d - 1, 1))
    return signs @ turned.T / (math.sqrt(d) * factors[:, None]), BOUND * spread


def key_plan(rows: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Bits of a key and number of tables for so many vectors."""
    bits = max(1, min(30, math.ceil(math.log2(max(rows / GROUP_ROWS, 1))) or 1))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - meet))


def keys(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The key of each row in each table, the table's number above 32 bits."""
    d = unit.shape[1]
    turns = math.ceil(bits * tables / d)
    signs = np.concatenate([unit @ rotation(d, 1 + t) for t in range(turns)], axis=1) > 0
    signs = signs[:, :bits * tables].reshape(len(unit), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64)) | np.arange(tables, dtype=np.int64) << 32


def _units(vectors: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit vectors by length: (row numbers, matrix)."""
    lengths = np.diff(vectors.offsets.to_numpy())
    out = []
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        m = flat[starts[rows][:, None] + np.arange(d)]
        m = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow in the squares
        out.append((rows, m / np.linalg.norm(m, axis=1, keepdims=True)))
    return out


def _coded(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, unit in _units(batch.column("embedding")):
                codes, factors = encode(unit)
                own = keys(unit, bits, tables) ^ (unit.shape[1] << 48)
                part = batch.take(pa.array(rows))
                yield pa.record_batch({
                    "cid": part.column("cid"),
                    "code": pa.array([c.tobytes() for c in codes], pa.binary()),
                    "factor": pa.array(factors),
                    "keys": pa.array(list(own), pa.list_(pa.int64()))})
    return run


def differing_bits(dimensions: int, threshold: float) -> float:
    """As many bits of two codes may differ at the threshold: each does with the
    chance of the angle by pi."""
    p = math.acos(threshold) / math.pi
    return dimensions * p + SPREAD * math.sqrt(dimensions * p * (1 - p))


def _near(threshold: float):
    """(cid, key) of the rows of a group whose code is near that of another one."""
    def run(batch: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = batch.num_rows
        bounds = np.append(starts, n) if starts[-1] != n else starts
        side, cid, key = (batch.column(c).to_numpy() for c in ("_side", "cid", "key"))
        code = batch.column("code")
        stays = np.zeros(n, bool)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if hi - lo < 2:
                continue
            d = int(key[lo] >> 48)  # of a key's group all vectors have one length
            codes = np.frombuffer(b"".join(code.slice(lo, hi - lo).to_pylist()), np.uint8).reshape(hi - lo, -1)
            signs = np.unpackbits(codes, axis=1, count=d).astype(np.float32) * 2 - 1
            least = d - 2 * differing_bits(d, threshold)
            cut = int(np.searchsorted(side[lo:hi], 1))
            if cut in (0, hi - lo):
                close = signs @ signs.T
                np.fill_diagonal(close, -np.inf)
                stays[lo:hi] |= close.max(axis=1) >= least
            else:
                close = signs[:cut] @ signs[cut:].T
                stays[lo:lo + cut] |= close.max(axis=1) >= least
                stays[lo + cut:hi] |= close.max(axis=0) >= least
        yield pa.record_batch({"cid": pa.array(cid[stays]), "key": pa.array(key[stays])})
    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of each vector's numbers (0.0 and -0.0 are one number)."""
    for batch in batches:
        vectors = batch.column("embedding")
        sizes = vectors.value_lengths().to_numpy()
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
        ends = np.cumsum(sizes)
        names = [hashlib.blake2b(flat[a:b].tobytes(), digest_size=16).digest() for a, b in zip(ends - sizes, ends)]
        yield pa.record_batch({"vec_id": batch.column("vec_id"), "digest": pa.array(names, pa.binary()),
                               "embedding": vectors})


def _linked(bits: int, tables: int, threshold: float):
    def run(batch: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = batch.num_rows
        bounds = np.append(starts, n) if starts[-1] != n else starts
        side = batch.column("_side").to_numpy()
        cid, weight = batch.column("cid").to_numpy(), batch.column("n").to_numpy()
        own_table = (batch.column("key").to_numpy() >> 32) & 0xFFFF
        factor = batch.column("factor").to_numpy()
        code = batch.column("code")
        ids, others, counts = [], [], []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if hi - lo < 2:
                continue
            (_, unit), = _units(batch.column("embedding").slice(lo, hi - lo))
            codes = np.frombuffer(b"".join(code.slice(lo, hi - lo).to_pylist()), np.uint8)
            codes = codes.reshape(hi - lo, -1)
            cut = int(np.searchsorted(side[lo:hi], 1))
            within = cut in (0, hi - lo)
            a, b = (slice(None), slice(None)) if within else (slice(0, cut), slice(cut, None))
            close, bound = estimates(codes[a], factor[lo:hi][a], unit[b])
            i, j = np.nonzero(close + bound[:, None] >= threshold)
            if not within:
                j = j + cut
            else:  # each pair once, whichever of the two estimates lets it through
                i, j = np.minimum(i, j), np.maximum(i, j)
                i, j = np.divmod(np.unique(i[i != j] * (hi - lo) + j[i != j]), hi - lo)
            if not len(i):
                continue
            exact = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
            i, j = i[exact], j[exact]
            table_keys = keys(unit, bits, tables)
            first = (table_keys[i] == table_keys[j]).argmax(axis=1) == own_table[lo]
            i, j = i[first], j[first]
            links = np.zeros((hi - lo, hi - lo), bool)
            links[i, j] = links[j, i] = True
            total = links @ weight[lo:hi]
            some = np.flatnonzero(total)
            ids += (cid[lo:hi][some]).tolist()
            others += [None] * len(some)
            counts += total[some].tolist()
            for x, y in linked_stars(links):
                ids.append(int(cid[lo + x]))
                others.append(int(cid[lo + y]))
                counts.append(0)
        yield pa.record_batch({"a": pa.array(ids, pa.int64()), "b": pa.array(others, pa.int64()),
                               "links": pa.array(counts, pa.int64())})
    return run


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" \
        else "array<double>"
    rows = only_columns(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    good = rows.filter(valid).mapInArrow(_digests, f"vec_id bigint, digest binary, embedding {kind}")
    classes = checkpointed(
        good.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"),
                                   F.first("embedding").alias("embedding"))
        .withColumn("cid", F.monotonically_increasing_id()))
    bits, tables = key_plan(classes.count(), threshold)
    coded = checkpointed(classes.select("cid", "embedding").mapInArrow(
        _coded(bits, tables), "cid bigint, code binary, factor double, keys array<bigint>"))
    keyed = coded.select("cid", "code", F.explode("keys").alias("key"))
    near = checkpointed(compare_groups(paired_chunks(keyed, "key", "cid"), "key", "cid", _near(threshold),
                                       "cid bigint, key bigint").distinct())
    fetched = (near.join(coded.select("cid", "code", "factor"), "cid")
               .join(classes.select("cid", "n", "embedding"), "cid"))
    found = checkpointed(compare_groups(
        paired_chunks(fetched, "key", "cid"), "key", "cid", _linked(bits, tables, threshold),
        "a bigint, b bigint, links bigint"))
    linked = checkpointed(components(found.filter("b IS NOT NULL").select("a", "b"))
                          .withColumnRenamed("node", "cid"))
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    firsts = classes.select("cid", "first").join(linked, "cid").groupBy("component").agg(
        F.min("first").alias("component_id"))
    known = checkpointed(
        classes.select("cid", "digest", "n", "first").join(counts, "cid", "left").join(linked, "cid", "left")
        .join(firsts, "component", "left")
        .select("digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("component_id", "first").alias("component_id")))
    done = good.select("vec_id", "digest").join(known, "digest").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~valid).select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                                       F.col("vec_id").alias("component_id"))
    return done.union(alone).select(
        "vec_id", "n_links", "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
