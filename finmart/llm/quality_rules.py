"""Quality by a sparse ensemble of rules over text statistics.

Every document gets a row of statistics (length, word and line shapes, kinds of
characters, repetition) in one pass over its whole text.  Small boosted trees
on a bounded sample of labelled documents give the candidates: each path from a
root to an inner node or leaf is a conjunction of comparisons.  A logistic
regression with an L1 penalty gives each rule a weight, most of them zero.  The
rules that are left become one Spark column expression over the statistics, so
the model that scores a table can be read, and runs inside the query.

Training takes at most ``ROWS_PER_CLASS`` labelled documents of each class
(their statistics alone come to the driver); the held-out fold is never among
them.  Labels, lang, source and id are never inputs of a score.

Defined results: null and empty texts have all statistics zero and are scored
by the rules like any other; without usable labels of both classes every score
is the share of label 1 among those there are (1 if there are none); doc_id may
be null (then never held out); repeated rows are scored each; extra columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.llm.common import only_columns, worker_turns_to
from finmart.llm.learning import held_out, training_documents

ROWS_PER_CLASS = 6000
TREES = 30
DEPTH = 3
THRESHOLDS = 32  # candidate cuts per statistic
LEAST_LEAF = 20
PENALTY = 2e-3
THRESHOLD = 0.3
#: Name of the struct of statistics; apart from any column of a caller.
STATS = "_quality_statistics"

STATISTICS = (
    "n_chars", "n_words", "mean_word", "longest_word", "distinct_words", "repeated_next",
    "n_lines", "distinct_lines", "mean_line", "upper", "digits", "marks", "symbols", "bars",
    "excited", "words_with_symbols", "words_in_capitals", "sentence_ends")

_CAPITALS = re.compile(rb"(?<![A-Za-z])[A-Z]{2,}(?![a-z])")
_SYMBOLIC = re.compile(rb"[#$%&*@^~|<>=+\\]{2,}")
_ENDS = re.compile(rb"[.!?](?=\s|$)")


def _kinds() -> np.ndarray:
    kinds = np.zeros((256, 6))
    for k, chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"()-?",
                               b"#$%&*@^~<>=+\\_{}[]`/", b"|", b"!")):
        kinds[list(chars), k] = 1
    return kinds


_KINDS = _kinds()


def statistics(text: bytes) -> list[float]:
    """The statistics of one UTF-8 text, in the order of ``STATISTICS``."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = max(int(counts.sum() - counts[9:14].sum() - counts[32]), 1)  # without white space
    chars = int(counts.sum() - counts[128:192].sum())  # continuation bytes aren't characters
    kinds = counts @ _KINDS / size
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    lengths = [len(w) for w in words]
    return [chars, n, sum(lengths) / max(n, 1), max(lengths, default=0),
            len(set(words)) / n ** 0.75 if n else 0.0,
            sum(map(bytes.__eq__, words, words[1:])) / max(n - 1, 1),
            len(lines), len(set(lines)) / max(len(lines), 1), n / max(len(lines), 1),
            *kinds.tolist(), len(_SYMBOLIC.findall(text)) / max(n, 1),
            len(_CAPITALS.findall(text)) / max(n, 1), len(_ENDS.findall(text)) / max(n, 1)]


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and the struct ``STATS`` of the statistics."""
    fields = [pa.field(n, pa.float64()) for n in STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_turns_to("quality")
        for batch in batches:
            rows = np.array([statistics(t.as_py() or b"") for t in batch.column("_quality_text")],
                            np.float64).reshape(-1, len(STATISTICS))
            s = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(fields))],
                                           fields=fields)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], s], [*keep, STATS])

    texts = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("binary").alias("_quality_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema if f.name in keep)
    struct = ", ".join(f"{n}: double" for n in STATISTICS)
    return texts.mapInArrow(run, f"{kept}{', ' * bool(keep)}{STATS} struct<{struct}>")


# ---- trees -> rules -> sparse weights

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, cut) and ...


def _grow(x, cuts, residual, rows, depth, path: Rule, rules: list[Rule]) -> np.ndarray:
    """Grows a regression tree on ``rows``; collects its paths, returns its fit."""
    fit = np.full(len(rows), residual[rows].mean())
    if depth == 0 or len(rows) < 2 * LEAST_LEAF:
        return fit
    r = residual[rows]
    total, n = r.sum(), len(rows)
    best, at = 1e-9, None
    for j, values in enumerate(cuts):
        if not len(values):
            continue
        below = np.searchsorted(values, x[rows, j], side="left")  # cuts under the value
        sums = np.cumsum(np.bincount(below, r, len(values) + 1))[:-1]
        counts = np.cumsum(np.bincount(below, minlength=len(values) + 1))[:-1]
        ok = (counts >= LEAST_LEAF) & (n - counts >= LEAST_LEAF)
        gain = np.where(ok, sums ** 2 / np.maximum(counts, 1)
                        + (total - sums) ** 2 / np.maximum(n - counts, 1), 0) - total ** 2 / n
        k = int(gain.argmax())
        if gain[k] > best:
            best, at = gain[k], (j, float(values[k]))
    if at is None:
        return fit
    j, cut = at
    above = x[rows, j] > cut
    for side in (False, True):
        own = path + ((j, side, cut),)
        rules.append(own)
        fit[above == side] = _grow(x, cuts, residual, rows[above == side], depth - 1, own, rules)
    return fit


def _simplified(rule: Rule) -> Rule:
    """One bound per statistic and side, in a fixed order."""
    bounds: dict[tuple[int, bool], float] = {}
    for j, above, cut in rule:
        old = bounds.get((j, above))
        bounds[j, above] = cut if old is None else max(old, cut) if above else min(old, cut)
    return tuple(sorted((j, above, cut) for (j, above), cut in bounds.items()))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, above, cut in rule:
        out &= (x[:, j] > cut) == above
    return out


def extract_rules(x: np.ndarray, y: np.ndarray, seed: int = 3) -> list[Rule]:
    """Paths of boosted trees, each grown on half of the rows."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, THRESHOLDS + 2)[1:-1]))
            for j in range(x.shape[1])]
    rules: list[Rule] = []
    margin = np.zeros(len(x))
    for _ in range(TREES):
        residual = y - 1 / (1 + np.exp(-margin))
        rows = np.sort(rng.choice(len(x), max(len(x) // 2, 1), replace=False))
        grown: list[Rule] = []
        _grow(x, cuts, residual, rows, DEPTH, (), grown)
        rules += grown
        # the step is taken on all rows, by the leaves this tree has found
        leaves = [r for r in grown if not any(len(o) > len(r) and o[:len(r)] == r for o in grown)]
        for leaf in leaves:
            own = holds(leaf, x)
            if own.any():
                margin[own] += 2.0 * residual[own].mean()
    return sorted({_simplified(r) for r in rules})


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY,
                   steps: int = 400) -> tuple[np.ndarray, float]:
    """L1-penalised logistic weights by accelerated proximal gradient; classes
    weigh the same, the intercept is free."""
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    n = z.shape[1]
    w, b, v, c, t = np.zeros(n), 0.0, np.zeros(n), 0.0, 1.0
    rate = 4.0 / (1 + np.linalg.norm(z * np.sqrt(share)[:, None], 2) ** 2)
    for _ in range(steps):
        error = (1 / (1 + np.exp(-np.clip(z @ v + c, -30, 30))) - y) * share
        step = v - rate * (z.T @ error)
        new_w = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0)
        new_b = c - rate * error.sum()
        new_t = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return w, b


@dataclass
class Ensemble:
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    bias: float = 0.0
    constant: float | None = None

    def column(self, s: str = STATS) -> Column:
        """The score as one column expression over the struct of statistics."""
        if self.constant is not None:
            return F.lit(float(self.constant))
        total = F.lit(float(self.bias))
        for rule, weight in zip(self.rules, self.weights):
            parts = [F.col(f"{s}.{STATISTICS[j]}") > cut if above
                     else F.col(f"{s}.{STATISTICS[j]}") <= cut for j, above, cut in rule]
            match = parts[0]
            for p in parts[1:]:
                match = match & p
            total = total + F.when(match, F.lit(float(weight))).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        total = np.full(len(x), self.bias)
        for rule, weight in zip(self.rules, self.weights):
            total += weight * holds(rule, x)
        return 1 / (1 + np.exp(-total))


def train(x: np.ndarray, y: np.ndarray) -> Ensemble:
    if len(set(y.tolist())) < 2:
        return Ensemble(constant=float(y.mean()) if len(y) else 1.0)
    rules = extract_rules(x, y)
    if not rules:
        return Ensemble(constant=float(y.mean()))
    z = np.stack([holds(r, x) for r in rules], 1).astype(float)
    w, b = lasso_logistic(z, y)
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    # the threshold of use is THRESHOLD: the score there is put in the middle
    # between the classes of the training rows
    shift = np.log(THRESHOLD / (1 - THRESHOLD))
    return Ensemble([rules[i] for i in kept], [float(w[i]) for i in kept], float(b + shift))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Ensemble:
    sample = training_documents(docs, labels, label, ROWS_PER_CLASS)
    rows = with_statistics(sample, "doc_id", "y").orderBy("doc_id").collect()
    x = np.array([list(r[STATS]) for r in rows]).reshape(-1, len(STATISTICS))
    return train(x, np.array([r["y"] for r in rows], float))


def score(docs: DataFrame, model: Ensemble) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    docs = only_columns(docs, "doc_id", "text")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = with_statistics(docs, "doc_id").withColumn("score", model.column())
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Ensemble) -> DataFrame:
    """The documents of predicted quality 1, with all their columns."""
    rows = with_statistics(docs, *docs.columns)
    return rows.filter(model.column() >= THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])
