"""Toxicity by a convolutional text classifier, trained in numpy.

A word's vector is the sum of hashed embeddings of the word and of its first
letters.  Filters of several widths slide over the whole text, the largest
response of each filter goes to a logistic output.  The first embedding
coordinate starts as the log-odds of its bucket between toxic and clean
training documents, the rest at random; all of it is then trained by gradient
steps through the pooled windows.

Training takes a bounded sample of labelled documents (``ROWS_PER_CLASS`` of
each class, of at most ``CLASS_CHARS`` characters together, by a hash of the id) on
the driver; documents of the held-out fold are never among them.  A part of the
sample stays out of the gradient steps and sets a threshold per language.  The
language is guessed from the text's own function words, so labels, lang, source
and id are never inputs.  A score is the logistic of the distance from that
threshold, so 0.5 is the threshold in every language.

Scoring is one pass over whole texts, in Arrow batches, without a shuffle.

Defined results: null and empty texts are scored as a text of no words; without
usable labels every score is 0; doc_id may be null (then never held out);
repeated rows are scored each; extra columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.llm.common import only_columns, text_slices, worker_turns_to
from finmart.llm.learning import held_out, training_documents

ROWS_PER_CLASS = 2000
CLASS_CHARS = 6_000_000
BUCKETS = 1 << 16
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
HEADS = (4, 5)
EPOCHS = 2
#: Words a worker remembers the buckets of.
CACHE_ENTRIES = 100_000
#: Characters scored at once: the responses of all their windows are held meanwhile.
SCORED_CHARS = 600_000

#: Common function words, to guess a text's language.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as was on be by this are from or an at not",
    "de": "der die und das ist nicht ein eine mit von zu den im für sich auf des dem auch als",
    "fr": "le la les de et un une des est que pour dans qui sur pas au avec il ce du par",
    "es": "el la los las de y un una es que por con para se del al lo como más su no",
}
LANGUAGES = tuple(FUNCTION_WORDS)
_FLAGS: dict[str, int] = {}
for _i, _words in enumerate(FUNCTION_WORDS.values()):
    for _w in _words.split():
        _FLAGS[_w] = _FLAGS.get(_w, 0) | 1 << _i

_EDGES = ".,;:!?\"'()[]{}<>*#$%&…«»„“”‘’-–—_/|~"


def buckets_of(word: str) -> tuple[int, ...]:
    """Hash buckets whose embeddings make the vector of a word; bucket 0 is
    the zero vector."""
    word = word.strip(_EDGES)
    if not word:
        return (0,) * (1 + len(HEADS))
    parts = [word, *[f"{n}:{word[:n]}" if len(word) >= n else "" for n in HEADS]]
    return tuple(zlib.crc32(p.encode("utf-8", "replace")) % (BUCKETS - 1) + 1 if p else 0
                 for p in parts)


class _Known(dict):
    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = found = (*buckets_of(word), _FLAGS.get(word.strip(_EDGES), 0))
        return found


_KNOWN = _Known()


def _forget() -> None:
    _KNOWN.clear()


def words_of(text: str) -> list[str]:
    return text.lower().split() or [""]


@dataclass
class Model:
    embeddings: np.ndarray
    filters: list[np.ndarray]  # (width, dimensions, filters)
    bias: np.ndarray
    out: np.ndarray
    out_bias: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def responses(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pooled filter responses and function-word counts of each text."""
        words, starts, at = [], [], 0
        pad = max(WIDTHS) - 1
        gap = [""] * pad
        for t in texts:
            starts.append(at)
            found = words_of(t)
            words += found
            words += gap
            at += len(found) + pad
        local: dict[str, int] = {}
        place = np.fromiter((local.setdefault(w, len(local)) for w in words), np.int64, len(words))
        table = np.array([_KNOWN[w] for w in local], np.int64)
        vectors = self.embeddings[table[:, :-1]].sum(axis=1)
        starts = np.array(starts)
        ends = np.append(starts[1:], len(words)) - pad
        outside = (ends[:, None] + np.arange(pad)).ravel()
        pooled = []
        for f in self.filters:
            out = (vectors @ f[0])[place]
            for o in range(1, len(f)):
                out[:-o] += (vectors @ f[o])[place[o:]]
            out[outside] = -np.inf
            pooled.append(np.maximum.reduceat(out, starts, axis=0))
        flags = table[:, -1][place]
        spoken = np.stack([np.add.reduceat(flags >> i & 1, starts) for i in range(len(LANGUAGES))], 1)
        return np.concatenate(pooled, axis=1), spoken

    def logits(self, texts: list[str]) -> tuple[np.ndarray, list[str]]:
        pooled, spoken = self.responses(texts)
        logits = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        best = spoken.argmax(axis=1)
        return logits, [LANGUAGES[b] if spoken[i, b] else "" for i, b in enumerate(best)]

    def scores(self, texts: list[str]) -> np.ndarray:
        logits, languages = self.logits(texts)
        logits = logits - np.array([self.thresholds.get(x, self.thresholds[""]) for x in languages])
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def _log_odds(ids: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Of each bucket: in how many toxic and clean documents it occurs."""
    seen = np.zeros((2, BUCKETS))
    for x, label in zip(ids, y):
        seen[int(label), np.unique(x)] += 1
    rate = (seen + 0.5) / (np.bincount(y.astype(int), minlength=2)[:, None] + 1)
    odds = np.log(rate[1] / rate[0])
    odds[seen.sum(axis=0) < 3] = 0
    odds[0] = 0
    return np.clip(odds, -3, 3)


def train(texts: list[str], y: np.ndarray, seed: int = 7) -> Model | None:
    """A model from labelled texts; None where a class is missing."""
    if len(set(y.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    held = order[:len(order) // 5] if len(order) >= 50 else order
    fit = order[len(order) // 5:] if len(order) >= 50 else order
    pad = max(WIDTHS) - 1
    ids = [np.array([_KNOWN[w][:-1] for w in words_of(t)] + [(0,) * (1 + len(HEADS))] * pad)
           for t in texts]
    emb = rng.normal(0, 0.05, (BUCKETS, DIMENSIONS)).astype(np.float32)
    emb[:, 0] = _log_odds([ids[i] for i in fit], y[fit]) / 3
    emb[0] = 0
    filters = [rng.normal(0, 0.1, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[0, 0, :FILTERS // 2] += 1.0  # half of the filters start on the log-odds
    n = len(WIDTHS) * FILTERS
    model = Model(emb, filters, np.full(n, -0.3, np.float32), np.full(n, 0.1, np.float32), -1.0)
    squares = [np.full_like(p, 1e-3) for p in (emb, *filters, model.bias, model.out)]
    rate = 0.05

    def step(k: int, p: np.ndarray, at, grad: np.ndarray) -> None:
        squares[k][at] += grad * grad
        p[at] -= rate * grad / np.sqrt(squares[k][at])

    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            x = emb[ids[i]].sum(axis=1)
            last = len(x) - pad
            peaks, pooled = [], []
            for f in filters:
                out = sum(x[o:o + last] @ f[o] for o in range(len(f)))
                peaks.append(out.argmax(axis=0))
                pooled.append(out.max(axis=0))
            hidden = np.concatenate(pooled) + model.bias
            active = np.maximum(hidden, 0)
            error = 1 / (1 + np.exp(-float(active @ model.out + model.out_bias))) - y[i]
            back = (error * model.out * (hidden > 0)).astype(np.float32)
            step(len(WIDTHS) + 2, model.out, slice(None), error * active + 1e-4 * model.out)
            model.out_bias -= 0.02 * error
            step(len(WIDTHS) + 1, model.bias, slice(None), back)
            touched: dict[int, np.ndarray] = {}
            for j, f in enumerate(filters):
                g = back[j * FILTERS:(j + 1) * FILTERS]
                grad = np.zeros_like(f)
                for o in range(len(f)):
                    at = peaks[j] + o
                    grad[o] = x[at].T * g
                    for p, v in zip(at.tolist(), (f[o] * g).T):
                        for b in ids[i][p]:
                            if b:
                                touched[int(b)] = touched.get(int(b), 0) + v
                step(j + 1, f, slice(None), grad)
            for b, v in touched.items():
                step(0, emb, b, v)
    _calibrate(model, [texts[i] for i in held], y[held])
    return model


def _calibrate(model: Model, texts: list[str], y: np.ndarray) -> None:
    """The logit threshold with the best balanced accuracy, for all languages
    together and for each that has enough documents of both classes."""
    logits, languages = model.logits(texts)
    languages = np.array(languages)

    def best(z: np.ndarray, label: np.ndarray) -> float:
        values = np.unique(z)
        cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
        right = np.array([((z >= c) & (label == 1)).sum() / max((label == 1).sum(), 1)
                          + ((z < c) & (label == 0)).sum() / max((label == 0).sum(), 1) for c in cuts])
        good = cuts[right >= right.max() - 1e-9]
        return float((good[0] + good[-1]) / 2)

    model.thresholds = {"": best(logits, y)}
    for name in LANGUAGES:
        own = languages == name
        if min((own & (y == 1)).sum(), (own & (y == 0)).sum()) >= 20:
            model.thresholds[name] = best(logits[own], y[own])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model | None:
    """Trains on a bounded sample of the labelled documents."""
    rows = training_documents(docs, labels, label, ROWS_PER_CLASS, CLASS_CHARS).orderBy("doc_id").collect()
    return train([r["text"] for r in rows], np.array([r["y"] for r in rows], float))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_turns_to("toxicity", _forget)
        for batch in batches:
            for first, texts in text_slices(batch.column("text"), SCORED_CHARS):
                scores = model.scores(texts) if model else np.zeros(len(texts))
                yield pa.record_batch({"doc_id": batch.column("doc_id").slice(first, len(texts)),
                                       "score": pa.array(scores.astype(np.float64))})

    docs = only_columns(docs, "doc_id", "text")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents that aren't predicted toxic, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_turns_to("toxicity", _forget)
        for batch in batches:
            scores = [s for _, texts in text_slices(batch.column("text"), SCORED_CHARS)
                      for s in (model.scores(texts) if model else np.zeros(len(texts)))]
            yield batch.filter(pa.array([s < 0.5 for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
