"""Secret scans with an incremental ledger of blobs.

Every version of every file is addressed by its content (SHA-256 of the text's
UTF-8 bytes).  The ledger holds, per blob, the rules it was scanned with
("name@version") and the spans found.  A run looks at the addresses alone
first: blobs that the ledger knows under all current rules are not read again,
a new rule or a new version of one rule is run alone over the known blobs, and
a text that occurs at many paths or in many versions is scanned once.  Findings
are then joined back from the blobs to all versions and paths.

A run of the ledger is a folder that counts from the moment its ``_SUCCESS``
marker is there; a run that dies halfway is ignored and its blobs are scanned
again.  Entries are never changed: a later run only adds blobs and rules.

Which texts travel: distinct ones, combined before the shuffle (so thousands of
copies of one text are one row per task), and in later runs only those of
unseen blobs.  A hot blob is one row on the side of the findings, and the
addresses that join it are thin rows, whose partition Spark can split.

Defined results: a null text is the empty text; it and texts without letters
have no spans; null, repeated or clashing paths are kept, a row of ``versions``
is a row of the result; equal rows give equal rows; extra columns are kept and
may have any name; texts of any length are read whole; an empty table gives an
empty table.  Spans are in code points, the end exclusive.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.llm.common import checkpointed
from finmart.session import ensure_checkpoint_dir
from finmart.sources.storage import child_names, path_exists

#: Unseen blobs up to this number are sent to all tasks (32 bytes and a short
#: list each, below 10 MB); beyond it the texts are shuffled to them.
BROADCAST_BLOBS = 100_000

Spans = list[tuple[int, int]]


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``find`` gives byte spans in UTF-8 bytes; ``version``
    grows whenever the rule finds something else than before."""
    name: str
    version: int
    find: Callable[[bytes], Spans]

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# The patterns of the base kinds and their least lengths.
_ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                     rb"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ASSIGN_LEAST = 6
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_ACCESS_LEAST = 20
_HEX_LEAST = 24
_HEX_RUN = re.compile(rb"x{%d,}" % _HEX_LEAST)
_HEX_TABLE = bytes(0x78 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))


def find_assign(data: bytes) -> Spans:
    lower = data.lower()  # ASCII letters only
    if not any(w in lower for w in _ASSIGN_WORDS):
        return []
    return [m.span() for m in _ASSIGN.finditer(data) if m.end(1) - m.start(1) >= _ASSIGN_LEAST]


def find_access(data: bytes) -> Spans:
    return [m.span() for m in _ACCESS.finditer(data) if m.end() - m.start() >= _ACCESS_LEAST]


def find_hex(data: bytes) -> Spans:
    marked = data.translate(_HEX_TABLE)
    return [m.span() for m in _HEX_RUN.finditer(marked)] if b"x" * _HEX_LEAST in marked else []


#: The base kinds, in the order in which equal starts are listed.
RULES = (Rule("assign", 1, find_assign), Rule("access", 1, find_access), Rule("hex", 1, find_hex))

_ENTRY = "blob string, scanned array<string>, spans array<struct<rule:string,start:bigint,`end`:bigint>>"
_SPAN = pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def code_points(data: bytes, spans: Spans) -> Spans:
    """Byte spans as code-point spans (spans sorted by start, not overlapping)."""
    if not spans or data.isascii():
        return spans
    out, at, chars = [], 0, 0
    for start, end in spans:
        chars += _length(data[at:start])
        first = chars
        chars += _length(data[start:end])
        at = end
        out.append((first, chars))
    return out


def _length(data: bytes) -> int:
    """Code points of UTF-8 bytes: all bytes but the continuation bytes."""
    return len(data) - len(data.translate(None, _STARTS))


_STARTS = bytes(b for b in range(256) if b & 0xC0 != 0x80)
# deleting the first bytes leaves the continuation bytes, whose number is taken off


def _scanner(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_key = {r.key: r for r in rules}
        for batch in batches:
            found = []
            for text, todo in zip(batch.column("text"), batch.column("todo").to_pylist()):
                data = text.as_py() or b""
                found.append([{"rule": key, "start": a, "end": b} for key in todo
                              for a, b in code_points(data, by_key[key].find(data))])
            yield pa.record_batch({"blob": batch.column("blob"), "scanned": batch.column("todo"),
                                   "spans": pa.array(found, pa.list_(_SPAN))})
    return run


def address(text: Column) -> Column:
    """The content address of a text (null: the empty text)."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


class BlobLedger:
    """The ledger under ``root`` (default: a new one in the shared folder)."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        base = ensure_checkpoint_dir(spark).rstrip("/")
        self.spark = spark
        self.root = (root or f"{base}/llm-ledger-{uuid.uuid4().hex}").rstrip("/")

    def runs(self) -> list[str]:
        """Folders of the finished runs."""
        folders = [f"{self.root}/{n}" for n in child_names(self.spark, self.root)]
        return [f for f in folders if path_exists(self.spark, f"{f}/_SUCCESS")]

    def entries(self) -> DataFrame | None:
        runs = self.runs()
        return self.spark.read.schema(_ENTRY).parquet(*runs) if runs else None

    def unseen(self, blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """(blob, todo): the blobs that lack a current rule, with the rules they
        lack.  ``blobs`` may repeat a blob."""
        blobs = blobs.select("blob").distinct()
        current = F.array(*[F.lit(r.key) for r in rules])
        entries = self.entries()
        if entries is None:
            return blobs.withColumn("todo", current)
        known = entries.groupBy("blob").agg(F.flatten(F.collect_set("scanned")).alias("known"))
        todo = F.array_except(current, F.coalesce("known", F.array().cast("array<string>")))
        return (blobs.join(known, "blob", "left").select("blob", todo.alias("todo"))
                .filter(F.size("todo") > 0))

    def add(self, versions: DataFrame, rules: tuple[Rule, ...]) -> int:
        """Scans what is unseen of ``versions`` (blob, text) as a new run;
        the number of blobs scanned."""
        texts = versions.select("blob", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
        if not self.runs():
            work = texts.groupBy("blob").agg(F.first("text").alias("text")).withColumn(
                "todo", F.array(*[F.lit(r.key) for r in rules]))
        else:
            unseen = checkpointed(self.unseen(versions, rules))
            number = unseen.count()
            if not number:
                return 0
            if number <= BROADCAST_BLOBS:  # checked: only these texts travel
                texts = texts.join(F.broadcast(unseen.select("blob")), "blob", "left_semi")
            work = texts.groupBy("blob").agg(F.first("text").alias("text")).join(unseen, "blob")
        folder = f"{self.root}/run-{uuid.uuid4().hex}"
        work.select("blob", "text", "todo").mapInArrow(_scanner(rules), _ENTRY).write.parquet(folder)
        return self.spark.read.schema(_ENTRY).parquet(folder).count()

    def findings(self, rules: tuple[Rule, ...]) -> DataFrame:
        """(blob, spans) of blobs with findings of the current rules: spans by
        start, then in the order of the rules."""
        entries = self.entries()
        if entries is None:
            return self.spark.createDataFrame([], "blob string, spans array<struct<start:bigint,"
                                                  "kind:int,`end`:bigint,rule:string>>")
        order = F.array(*[F.lit(r.key) for r in rules])
        names = F.array(*[F.lit(r.name) for r in rules])
        span = F.explode("spans").alias("s")
        rows = entries.filter(F.size("spans") > 0).select("blob", span).withColumn(
            "kind", F.array_position(order, F.col("s.rule")).cast("int")).filter("kind > 0")
        # a blob's spans stay together as they were scanned: a few per rule
        return rows.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct(
            F.col("s.start").alias("start"), "kind", F.col("s.end").alias("end"),
            F.element_at(names, F.col("kind")).alias("rule")))).alias("spans"))


def scan(versions: DataFrame, ledger: BlobLedger, rules: tuple[Rule, ...] = RULES,
         text: str = "text") -> DataFrame:
    """All rows of ``versions`` (every historical version of every path) with
    their columns but the text, ``blob``, and ``spans`` (array of start, kind,
    end, rule; empty if nothing was found) as columns ``row``, ``blob``, ``spans``."""
    content = F.col(f"`{text}`")
    kept = [F.col(f"`{c}`") for c in versions.columns if c != text]
    row = F.struct(*kept) if kept else F.struct(F.lit(True).alias("row"))
    addresses = checkpointed(versions.select(row.alias("row"), address(content).alias("blob")))
    ledger.add(versions.select(address(content).alias("blob"), content.alias("text")), rules)
    found = checkpointed(ledger.findings(rules))
    none = F.array().cast(found.schema["spans"].dataType)
    return addresses.join(found, "blob", "left").select(
        "row", "blob", F.coalesce("spans", none).alias("spans"))


def joined(spans: Column, names: tuple[str, ...] | None = None) -> Column:
    """Spans as kind:start:end, joined by commas; of some kinds only with ``names``."""
    if names is not None:
        spans = F.filter(spans, lambda s: s["rule"].isin(*names))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def document_secrets(docs: DataFrame, ledger: BlobLedger | None = None,
                     rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, blob, the number of spans of each base kind, base_sha256 and spans."""
    ledger = ledger or BlobLedger(docs.sparkSession)
    base = tuple(r.name for r in RULES)
    rows = scan(docs.select(F.col("doc_id").alias("doc_id"), "text"), ledger, rules)
    count = lambda n: F.size(F.filter("spans", lambda s: s["rule"] == n)).cast("bigint")
    return rows.select(
        F.col("row.doc_id").alias("doc_id"), *[count(n).alias(f"n_{n}") for n in base],
        F.sha2(joined(F.col("spans"), base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def _sql_spans(kind: str, pattern: str, least: str) -> str:
    """Spans of a pattern: the pieces between matches and the matches, by length."""
    return f"""
  SELECT r, '{kind}' AS kind, {['assign', 'access', 'hex'].index(kind)} AS o, s AS start, s + len(hit) AS stop
  FROM (SELECT r, unnest(hits) AS hit, unnest(range(1, len(hits) + 1)) AS i, pieces, hits,
               list_sum([len(p) for p in pieces[1:i]]) + coalesce(list_sum([len(h) for h in hits[1:i - 1]]), 0) AS s
        FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS hits, string_split_regex(t, '{pattern}') AS pieces
              FROM d) x) y
  WHERE {least}"""


_SQL_ASSIGN = ("(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in
                                ("password", "passwd", "secret", "token", "api_?key"))
               + ")[\"'']?\\x20*[:=]\\x20*[\"'']?")

#: The same rows in DuckDB SQL (the ledger's work expressed per document).
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({_sql_spans('assign', _SQL_ASSIGN + '[A-Za-z0-9+/_.=-]+',
                  f"len(regexp_replace(hit, '^{_SQL_ASSIGN}', '')) >= {_ASSIGN_LEAST}")}
  UNION ALL {_sql_spans('access', 'AKIA[A-Z0-9]+', f'len(hit) >= {_ACCESS_LEAST}')}
  UNION ALL {_sql_spans('hex', '[0-9a-f]+', f'len(hit) >= {_HEX_LEAST}')}),
j AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, o) AS spans
      FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (r)"""
