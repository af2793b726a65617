"""Source divergence audit by count cells: how far the word use of each source
of a language is from the other sources and from the language as a whole.

Terms are counted once per task and source and combined before the shuffle.  A
term's smoothed share is an exact integer that depends on nothing but its count
and totals, so terms with the same (group count, lang count) form a cell: the
difference is evaluated once a cell, cells are ranked by their cumulative
multiplicity, cells of equal value are merged, and only the cells that reach
the wanted ranks are expanded to terms, in UTF-8 order.

For two sources the sum over all kept terms comes from cells too.  With z the
share of a term that a source lacks, a term that neither has gives |z - z'|, and
a term that only one has gives |p - z'|: both follow from how often each count
occurs in a source.  Terms that two sources have in common add a correction,
summed as a matrix of sources inside a task, never as a row per pair and term.

Defined results: null text, lang and source are ''; a group without terms has
the shares of count 0; a language without kept terms has value 0 for all its
pairs and no ``term`` rows; a group alone in its language has no ``pair`` rows;
repeated rows count each; extra columns are ignored; an empty table gives an
empty table.  Texts of any length are read whole, in pieces.  The pairs of a
language's sources are part of the result, so their number is taken to be one
that can be listed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finmart.llm.common import checkpointed

#: A language keeps the terms of at least this many of its documents.
LEAST_DOCUMENTS = 30
#: Last rank of a group's ``term`` rows.
RANKS = 50
# Scale of a share and what is added to each count.
SCALE, ADDED = 1_000_000_000, 5

#: Terms that a task holds before it hands its counts on.
HELD_TERMS = 300_000
#: Bytes of a text that are split into words at once.
PIECE_BYTES = 4_000_000
#: Cells of the term by source matrix that a task fills at once.
MATRIX_CELLS = 2_000_000

# A-Z in lower case, a-z and all bytes of non-ASCII characters; else a blank.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def pieces(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some millions of bytes at a time."""
    data = data.translate(_TERM_BYTES)
    start = 0
    while start < len(data):
        stop = start + PIECE_BYTES
        if stop < len(data):
            stop = data.find(b" ", stop)
            stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict = {}
    held = 0
    for batch in batches:
        langs, sources = (batch.column(c).to_pylist() for c in ("lang", "source"))
        for lang, source, text in zip(langs, sources, batch.column("text")):
            if (lang, source) not in groups:
                groups[lang, source] = Counter(), Counter()
            counts, documents = groups[lang, source]
            before, seen = len(counts), set()
            for words in pieces(text.as_py()):
                counts.update(words)
                seen.update(words)
            documents.update(seen)
            held += len(counts) - before
        if held > HELD_TERMS:
            yield from _handed_on(groups)
            groups, held = {}, 0
    yield from _handed_on(groups)


def _handed_on(groups: dict) -> Iterator[pa.RecordBatch]:
    """The counts of each group; the group itself is a row without a term."""
    for (lang, source), (counts, documents) in groups.items():
        terms = [None, *counts]
        yield pa.record_batch({
            "lang": pa.array([lang] * len(terms), pa.string()),
            "source": pa.array([source] * len(terms), pa.string()),
            "term": pa.array(terms, pa.binary()),
            "n": pa.array([0, *counts.values()], pa.int64()),
            "docs": pa.array([0, *(documents[t] for t in counts)], pa.int64())})


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with the term);
    a row without a term for every group that occurs."""
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in ("lang", "source")],
                       F.coalesce(F.col("`text`"), F.lit("")).cast("binary").alias("text"))
    counted = rows.mapInArrow(_counted, "lang string, source string, term binary, n bigint, docs bigint")
    return counted.withColumn("term", F.col("term").cast("string")).groupBy(
        "lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + ADDED) / (total + ADDED * terms)), exact; null
    where there is nothing to divide by."""
    return F.expr(f"1 + ({SCALE} * cast({count} + {ADDED} as decimal(20,0))) "
                  f"div nullif({total} + {ADDED} * {terms}, 0)").cast("bigint")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    return rows.select("lang", "source", F.lit(part).alias("part"), "item",
                       F.col("value").cast("bigint").alias("value"), F.col("rank").cast("int").alias("rank"))


def distinctive_terms(rows: DataFrame, groups: DataFrame, ranks: int = RANKS) -> DataFrame:
    """The terms that a group uses more than its language does, by cells."""
    cell = ["lang", "source", "n", "lang_n"]
    cells = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("terms")).join(groups, ["lang", "source"])
    value = share("n", "total", "v") - share("lang_n", "lang_total", "v")
    cells = checkpointed(cells.select(*cell, "terms", value.alias("value")).filter("value > 0"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    # a value stands for a term at least, so the wanted ranks lie in as many values
    values = (cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
              .withColumn("place", F.row_number().over(by_value)).filter(F.col("place") <= ranks))
    before = F.coalesce(F.sum("terms").over(by_value.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = values.withColumn("before", before).filter(F.col("before") < ranks)
    reached = checkpointed(cells.join(reached.select("lang", "source", "value", "before"),
                                      ["lang", "source", "value"]).drop("terms"))
    in_order = Window.partitionBy("lang", "source", "value").orderBy("term")
    expanded = (rows.join(reached, cell).withColumn("place", F.row_number().over(in_order))
                .filter(F.col("place") <= ranks).withColumn("rank", F.col("before") + F.col("place"))
                .filter(F.col("rank") <= ranks))
    return _ranked(expanded.withColumn("item", F.col("term")), "term")


_IN_COMMON = "lang string, source string, item string, common decimal(38,0)"


def _in_common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the terms that two sources have: |p - p'| - |p - z'| - |p' - z| +
    |z - z'|, summed per pair of sources of a language."""
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lang in set(langs.tolist()):
            users = batch.column("users").take(pa.array(np.flatnonzero(langs == lang)))
            flat = users.flatten()
            names, at = np.unique(np.array(flat.field("source").to_pylist(), object), return_inverse=True)
            p, z_all = (flat.field(f).to_numpy() for f in ("p", "z"))
            z = np.zeros(len(names), np.int64)
            z[at] = z_all
            sizes = users.value_lengths().to_numpy()
            term = np.repeat(np.arange(len(users)), sizes)
            step = max(1, MATRIX_CELLS // len(names))
            total = np.zeros((len(names), len(names)), np.int64)
            for first in range(0, len(users), step):
                here = slice(*np.searchsorted(term, [first, first + step]))
                shares = np.zeros((min(step, len(users) - first), len(names)), np.int64)
                has = np.zeros(shares.shape, bool)
                shares[term[here] - first, at[here]] = p[here]
                has[term[here] - first, at[here]] = True
                for g in range(len(names)):
                    rows = has[:, g]
                    other, own = shares[rows], shares[rows, g][:, None]
                    part = np.abs(own - other) - np.abs(own - z) - np.abs(other - z[g]) + np.abs(z[g] - z)
                    total[g] += np.where(has[rows], part, 0).sum(axis=0)
            a, b = np.nonzero(total)
            yield pa.record_batch({
                "lang": pa.array([lang] * len(a), pa.string()), "source": pa.array(names[a], pa.string()),
                "item": pa.array(names[b], pa.string()),
                "common": pa.array(total[a, b]).cast(pa.decimal128(38, 0))})


def source_distances(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Every other source of the language, the farthest first."""
    known = groups.select("lang", "source", "total", "v", "z", "own")
    others = known.select("lang", F.col("source").alias("item"), F.col("z").alias("item_z"),
                          F.col("own").alias("item_own"))
    pairs = known.join(others, "lang").filter("source <> item")
    counts = rows.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("terms")).join(
        known, ["lang", "source"]).select("lang", "source", "terms", share("n", "total", "v").alias("p"))
    # a source's terms against the share that the other has of a term it lacks
    apart = checkpointed(
        counts.join(others, "lang").filter("source <> item").groupBy("lang", "source", "item")
        .agg(F.sum(F.abs(F.col("p") - F.col("item_z")) * F.col("terms").cast("decimal(20,0)")).alias("apart")))
    users = rows.join(known, ["lang", "source"]).groupBy("lang", "term").agg(F.collect_list(
        F.struct("source", share("n", "total", "v").alias("p"), "z")).alias("users")).filter("size(users) > 1")
    common = users.select("lang", "users").mapInArrow(_in_common, _IN_COMMON).groupBy(
        "lang", "source", "item").agg(F.sum("common").alias("common"))
    key = ["lang", "source", "item"]
    back = apart.select("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                        F.col("apart").alias("back"))
    neither = (F.col("v") - F.col("own") - F.col("item_own")) * F.abs(F.col("z") - F.col("item_z")).cast("decimal(20,0)")
    value = sum(F.coalesce(c, F.lit(0)) for c in (F.col("apart"), F.col("back"), F.col("common"), neither))
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return _ranked(pairs.join(apart, key, "left").join(back, key, "left").join(common, key, "left")
                   .withColumn("value", value.cast("bigint")).withColumn("rank", F.row_number().over(by_value)),
                   "pair")


def source_divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS,
                      ranks: int = RANKS) -> DataFrame:
    """lang, source, part (pair, term), item, value and rank."""
    counts = checkpointed(term_counts(docs))
    kept = checkpointed(
        counts.filter("term IS NOT NULL").groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= least_documents).select("lang", "term", "lang_n"))
    rows = checkpointed(counts.drop("docs").join(kept, ["lang", "term"]))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("own"))
    groups = (counts.filter("term IS NULL").select("lang", "source")
              .join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0))
    groups = checkpointed(groups.withColumn("z", share("0", "total", "v")))
    return source_distances(rows, groups).union(distinctive_terms(rows, groups, ranks))


#: The same rows in DuckDB SQL, term by term.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term HAVING sum(docs) >= {LEAST_DOCUMENTS}),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS (SELECT lang, source, sum(coalesce(n, 0)) AS n
      FROM (SELECT lang, source, 0 AS n FROM d
            UNION ALL SELECT c.lang, c.source, c.n FROM c SEMI JOIN k ON c.lang = k.lang AND c.term = k.term) x
      GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + {ADDED})) // (g.n + {ADDED} * l.v) AS p,
             1 + ({SCALE}::HUGEINT * (k.n + {ADDED})) // (l.n + {ADDED} * l.v) AS q
      FROM g JOIN l ON g.lang = l.lang JOIN k ON g.lang = k.lang
      LEFT JOIN c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON a.lang = s.lang AND a.source = s.source AND b.source = s.item
      UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= {RANKS}"""
