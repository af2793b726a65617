"""Document fingerprints: SimHash over weighted terms, in Spark SQL functions only.

A term is two neighbouring words (a lone word by itself), its weight its length
up to ``MAX_WEIGHT``.  Every term's 64-bit hash votes with its weight on each
bit; a bit is set if more than half of all weight is for it.  The votes are
plain sums: sixteen sums of four 16-bit lanes hold all 64 counters, so a text
of any length is one generator and one hash aggregation (lanes are emptied
every ``CHUNK_TERMS`` terms, before they could overflow).

``within_radius`` finds all fingerprints within a Hamming radius by permuted
block tables: the bits are cut into blocks, and for each choice of blocks that
could be free of differences there is a table keyed by those blocks.

The neighbour of a document in id order is found on ids and lengths alone: a
range sort numbers the rows, neighbours differ by one, and only the ends of the
partitions are matched apart.  Texts then travel once, plus the part that a
neighbour needs.

Defined results: a null text counts as empty, with fingerprint zero; rows that
repeat id and text are one document, each gets its result; several texts of one
id follow each other by text hash; rows without id come last; the only document
of a table is its own neighbour; extra columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finmart.llm.common import checkpointed

MAX_WEIGHT = 15
CHUNK_TERMS = 2048  # times MAX_WEIGHT stays below 32768, so the top lane keeps the sign
RADIUS = 3
BLOCKS = 6
#: Which rows ask for their neighbours in ``op8``'s digest.
QUERY_STEP = 100

_KEY = ["_none", "_id", "_hash"]
_LANES = 0x0001000100010001


def signatures(texts: DataFrame, keep: list[str], text: str) -> DataFrame:
    """``keep`` (which tells the rows apart) and ``fp``, the fingerprint's bits
    as a long.  Rows already partitioned by some of ``keep`` aren't shuffled."""
    words = texts.select(*keep, F.split(F.col(text), " ").alias("_w"))
    terms = words.select(*keep, "_w", F.posexplode("_w").alias("_p", "_a"))
    after = F.get(F.col("_w"), F.col("_p") + 1)
    # the last word is a term only where it is the only one
    is_term = after.isNotNull() | ((F.col("_p") == 0) & (F.col("_a") != ""))
    weight = F.least(F.length("_a") + F.coalesce(F.length(after), F.lit(0)), F.lit(MAX_WEIGHT))
    terms = terms.select(
        *keep, F.shiftright("_p", CHUNK_TERMS.bit_length() - 1).alias("_chunk"),
        F.xxhash64("_a", after).alias("_h"),
        F.when(is_term, weight).otherwise(0).cast("bigint").alias("_weight"))
    lanes = [F.sum(F.shiftrightunsigned("_h", k).bitwiseAND(F.lit(_LANES)) * F.col("_weight"))
             .alias(f"_s{k}") for k in range(16)]
    chunks = terms.groupBy(*keep, "_chunk").agg(*lanes, F.sum("_weight").alias("_all"))
    votes = [F.sum(F.shiftrightunsigned(f"_s{j % 16}", 16 * (j // 16)).bitwiseAND(F.lit(0xFFFF)))
             .alias(f"_v{j}") for j in range(64)]
    total = chunks.groupBy(*keep).agg(*votes, F.sum("_all").alias("_all"))
    fp = F.lit(0).cast("bigint")
    for j in range(64):
        bit = (1 << j) - (1 << 64 if j == 63 else 0)
        fp = fp.bitwiseOR(F.when(F.col(f"_v{j}") * 2 > F.col("_all"), F.lit(bit)).otherwise(0))
    return total.select(*keep, fp.cast("bigint").alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64.0


def hex_digits(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _block_keys(fp: str, radius: int) -> Column:
    """Keys of a fingerprint in all the permuted tables (table number mixed in)."""
    edges = [round(i * 64 / BLOCKS) for i in range(BLOCKS + 1)]
    masks = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(BLOCKS)]
    keys = []
    for n, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - radius)):
        mask = sum(masks[i] for i in chosen)
        mask -= 1 << 64 if mask >> 63 else 0
        keys.append(F.struct(F.lit(n).cast("smallint").alias("t"),
                             F.col(fp).bitwiseAND(F.lit(mask)).alias("k")))
    return F.array(*keys)


def within_radius(fps: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query_fp, fp) for every distinct fingerprint of ``queries`` (column
    ``fp``) and every distinct one of ``fps`` within ``radius`` of it."""
    tables = fps.select("fp").distinct().select("fp", F.explode(_block_keys("fp", radius)).alias("key"))
    asked = queries.select(F.col("fp").alias("query_fp")).distinct().select(
        "query_fp", F.explode(_block_keys("query_fp", radius)).alias("key"))
    near = F.bit_count(F.col("query_fp").bitwiseXOR(F.col("fp"))) <= radius
    return asked.join(tables, (asked["key"] == tables["key"]) & near).select("query_fp", "fp").distinct()


def _previous(order: DataFrame) -> DataFrame:
    """The row before each one in id order (before the first: the last).
    ``order`` holds ``_KEY``, n_chars and ``_m``, the row's number within its
    range-sorted partition, the partition's number above 33 bits."""
    columns = [*_KEY, "n_chars"]
    before = [F.col(f"p.{c}").alias(f"_before_{c}") for c in columns]
    inner = order.alias("a").join(order.alias("p"), F.col("a._m") == F.col("p._m") + 1).select(
        *[F.col(f"a.{c}") for c in _KEY], *before)
    row = F.struct("_m", *columns)
    ends = order.groupBy(F.shiftright("_m", 33).alias("_part")).agg(
        F.min(row).alias("a"), F.max(row).alias("z"))  # a row per partition
    parts = Window.orderBy("_part")
    whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("a", F.coalesce(F.lag("z").over(parts), F.last("z").over(whole)).alias("p"))
    return inner.union(ends.select(*[F.col(f"a.{c}") for c in _KEY], *before))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text (the last quarter
    replaced by the beginning of the next document), and their likeness."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(F.col("doc_id").isNull().alias("_none"),
                       F.coalesce("doc_id", F.lit(0)).alias("_id"),
                       F.xxhash64("text").alias("_hash"), "text")
    order = rows.groupBy(*_KEY).agg(F.max(F.length("text").cast("bigint")).alias("n_chars"))
    order = checkpointed(order.orderBy(*_KEY).withColumn("_m", F.monotonically_increasing_id()))
    previous = checkpointed(_previous(order))

    # the filter keeps both uses of the texts alike, so that they are shuffled once
    texts = rows.groupBy(*_KEY).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("_copies"))
    texts = texts.filter("_copies > 0")
    pieces = texts.join(previous, _KEY).select(
        *[F.col(f"_before_{c}").alias(c) for c in _KEY],
        F.expr("left(text, int(_before_n_chars div 4))").alias("_piece"))
    n = F.length("text").cast("bigint")
    pairs = texts.join(pieces, _KEY).select(
        *_KEY, "_copies", n.alias("n_chars"), "text",
        F.concat(F.expr("left(text, length(text) - length(text) div 4)"), "_piece").alias("_edited"))
    both = pairs.select(
        *_KEY, "_copies", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("text")),
                          F.struct(F.lit(1).alias("which"), F.col("_edited").alias("text")))).alias("_t"))
    kept = [*_KEY, "_copies", "n_chars", "edited_sha256"]
    signed = signatures(both.select(*kept, "_t.which", F.col("_t.text").alias("_text")),
                        [*kept, "which"], "_text")
    found = checkpointed(signed.groupBy(*kept).agg(
        F.max(F.when(F.col("which") == 0, F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("which") == 1, F.col("fp"))).alias("edited_fp")))

    following = found.select(*_KEY, F.col("fp").alias("_next_fp")).join(previous, _KEY).select(
        *[F.col(f"_before_{c}").alias(c) for c in _KEY], "_next_fp")
    return found.join(following, _KEY).withColumn("_copy", F.explode(F.expr(
        "sequence(1, int(_copies))"))).select(
        F.when(~F.col("_none"), F.col("_id")).alias("doc_id"), "n_chars", "edited_sha256",
        hex_digits("fp").alias("fingerprint"), hex_digits("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("_next_fp")).alias("near_next"), "fp")


def with_near_counts(found: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Adds ``n_near`` for the asking rows (id divisible by ``QUERY_STEP``): how
    many other documents have a fingerprint within the radius; null elsewhere."""
    found = checkpointed(found)
    sizes = checkpointed(found.groupBy("fp").agg(F.count(F.lit(1)).alias("_n")))
    asks = F.col("doc_id") % QUERY_STEP == 0
    near = within_radius(sizes, found.filter(asks), radius)
    counts = near.join(sizes, "fp").groupBy(F.col("query_fp").alias("fp")).agg(
        (F.sum("_n") - 1).alias("_near"))
    return found.join(counts, "fp", "left").select(
        *[c for c in found.columns if c != "fp"], F.when(asks, F.col("_near")).alias("n_near"))
