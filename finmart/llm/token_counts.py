"""Exact token counts at every prefix of a text (prefix dynamic programming).

A byte-pair encoding has the property that dropping its last token leaves the
encoding of the shorter string.  So the count at a prefix is one more than the
count at the place where its last token starts, and that token is the only one
which ends there and is *compatible* with the token before it (merging the two
again gives the same two).  Word ends are their own symbols in this vocabulary,
hence two tables per word piece: ``open`` (the word goes on) and ``closed``
(the text stops here).  States are shared by all words with the same beginning.

White space never belongs to a token, so the counts of a text are the counts
of its space-separated units on top of a running total.  Truncation ("how much
of the text fits in k tokens") and budget ("how many tokens are in the first n
characters") questions are look-ups in the stored counts; nothing is encoded
again.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated
rows are counted each; any doc_id, null included, is passed through; an empty
table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.llm.common import byte_symbols, only_columns, text_slices

#: Entries of each look-up table of a worker before it starts afresh.
CACHE_ENTRIES = 900_000
#: Piece prefixes up to this length share states; longer ones use local arrays.
SHARED_PREFIX = 48


class _Units(dict):
    """Counts of the units seen, bounded; a miss computes the unit."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[unit] = counts = self.compute(unit)
        return counts


class PrefixCounter:
    """Counts for one vocabulary file; lives in a Python worker."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, self.specials)) or "(?!)")
        #: Tokens inside a word, and tokens that end one, by what they cover;
        #: None for what is only the tail of a token.
        self.inner, self.final = {}, {}
        for t in model["vocab"]:
            of, text = (self.final, t.removesuffix(self.end)) if t.endswith(self.end) else (self.inner, t)
            for i in range(1, len(text)):
                of.setdefault(text[i:], None)
            of[text] = t
        #: Of each merged token: when its merge happens, and its two halves.
        self.born, self.left, self.right, self.ranks = {}, {}, {}, {}
        for i, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.ranks[a, b] = self.born[a + b] = i
            self.left[a + b], self.right[a + b] = a, b
        self.longest = max(map(len, [*self.inner, *self.final]))
        self.symbols = dict(enumerate(byte_symbols()))
        self.follow = {s: 1 if 0xC0 <= b < 0xE0 else 2 if 0xE0 <= b < 0xF0 else 3 if b >= 0xF0
                       else -1 if b >= 0x80 else 0 for b, s in self.symbols.items()}
        self.library = Tokenizer.from_file(path)
        self.states: dict[str, tuple] = {}
        self.alone: dict[str, bool] = {}
        self.units = _Units(self._unit)
        # The tables hold no cycles: the collector need not walk them again and again.
        gc.freeze()
        gc.set_threshold(200_000, 50, 50)

    # ---- the dynamic programme over one piece
    def _compatible(self, x: str, y: str) -> bool:
        """Whether the two tokens, side by side, stay as they are.  Their merges
        are undone from the last to the first; no merge across the boundary may
        come before the one undone (equal merges go from left to right)."""
        ranks, born, limit = self.ranks, self.born, 1 << 40
        while True:
            if ranks.get((x, y), limit) < limit:
                return False
            of_x, of_y = born.get(x, -1), born.get(y, -1)
            if of_x > of_y:
                limit, x = of_x, self.right[x]
            elif of_y >= 0:
                limit, y = of_y + 1, self.left[y]
            else:
                return True

    def _reachable(self, token: str) -> bool:
        """Whether the token's own text is encoded as this token."""
        known = self.alone.get(token)
        if known is None:
            closed = token.removesuffix(self.end) or token
            parts = [*closed]
            parts[-1] += token[len(closed):]
            while len(parts) > 1:
                rank, i = min((self.ranks.get(p, 1 << 40), i) for i, p in enumerate(zip(parts, parts[1:])))
                if rank == 1 << 40:
                    break
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self.alone[token] = known = len(parts) == 1
        return known

    def _last(self, s: str, tokens: dict[str, str | None], before) -> int:
        """Where the last token of ``s`` starts: the longest that fits."""
        start, found = len(s) - 1, []
        while start >= 0:
            token = tokens.get(s[start:], "")
            if token:
                found.append((start, token))
            elif token is not None:  # not even the tail of a token
                break
            start -= 1
        while found:
            start, token = found.pop()
            if self._compatible(before(start)[0], token) if start else self._reachable(token):
                return start
        raise ValueError(f"no token ends {s!r}")

    def _extend(self, s: str, state: tuple, before) -> tuple:
        """The state after ``s``, from the one a symbol earlier: last token,
        tokens if the word goes on, bytes of its last character still to come,
        and the counts at all whole characters if the text stops there."""
        _, _, pending, closed = state
        start = self._last(s, self.inner, before)
        follow = self.follow[s[-1]]
        pending = pending - 1 if follow < 0 else follow
        if not pending:
            closed += (before(self._last(s, self.final, before))[1] + 1).to_bytes(4, "little")
        return s[start:], before(start)[1] + 1, pending, closed

    def _closed(self, s: str) -> bytes:
        """Counts ('<u4') at the characters of a piece given as byte symbols."""
        states = self.states
        known = states.get(s)
        if known is not None:
            return known[3]
        if len(states) >= CACHE_ENTRIES:
            states.clear()
        n = len(s)
        if n > SHARED_PREFIX:  # long pieces: counts and last tokens by position only
            found, closed = [("", 0, 0)], []
            for j in range(1, n + 1):
                at = max(0, j - self.longest - 1)
                *state, more = self._extend(s[at:j], (*found[-1], b""),
                                            lambda i, at=at: found[at + i])
                found.append(tuple(state))
                closed.append(more)
            return b"".join(closed)
        j = n - 1
        while j and s[:j] not in states:
            j -= 1
        state = states[s[:j]] if j else ("", 0, 0, b"")
        local = {0: ("", 0, 0, b""), j: state}

        def before(i):
            found = local.get(i)
            if found is None:
                head = s[:i]
                local[i] = found = states.get(head) or self._again(head)
            return found

        for i in range(j + 1, n + 1):
            head = s[:i]
            states[head] = local[i] = state = self._extend(head, state, before)
        return state[3]

    def _again(self, s: str) -> tuple:
        """A state that was dropped from the table."""
        self._closed(s)
        return self.states[s]

    # ---- units: text between spaces and line feeds
    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            return self._closed(piece)
        return self._closed(piece.encode("utf-8", "replace").decode("latin-1")
                            .translate(self.symbols))

    def _whole(self, text: str) -> int:
        return sum(int.from_bytes(self._piece(p)[-4:], "little")
                   for p in self.pieces.findall(text))

    def _counts(self, unit: str) -> bytes:
        """Token counts ('<u4') of ``unit[:1] ... unit``."""
        if "<" in unit and self.special.search(unit):
            return np.array([len(self.library.encode(unit[:j], add_special_tokens=False).ids)
                             for j in range(1, len(unit) + 1)], "<u4").tobytes()
        low = unit.lower() if unit.isascii() else "".join([c.lower() for c in unit])
        if len(low) != len(unit) or not unicodedata.is_normalized("NFC", unit):
            norm = self.library.normalizer.normalize_str
            return np.array([self._whole(norm(unit[:j])) for j in range(1, len(unit) + 1)],
                            "<u4").tobytes()
        if low.isascii() or max(low) < "\u0250":  # Latin: isalpha() is the pattern's letter
            if low.isalpha():
                return self._piece(low)
            if low[:-1].isalpha() and low[-1] in ".,;:!?":  # a word and its punctuation mark
                counts = self._piece(low[:-1])
                return counts + (int.from_bytes(counts[-4:], "little") + 1).to_bytes(4, "little")
        out, base, at = [], 0, 0
        for m in self.pieces.finditer(low):
            if m.start() > at:  # white space other than the separators
                out.append(base.to_bytes(4, "little") * (m.start() - at))
            piece = m[0]
            if piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():
                # a contraction shows only once it is complete
                counts = np.array([self._whole(piece[:j]) for j in range(1, len(piece) + 1)],
                                  "<u4").tobytes()
            else:
                counts = self._piece(piece)
            if base:
                out += [(base + int.from_bytes(counts[i:i + 4], "little")).to_bytes(4, "little")
                        for i in range(0, len(counts), 4)]
            else:
                out.append(counts)
            base += int.from_bytes(counts[-4:], "little")
            at = m.end()
        out.append(base.to_bytes(4, "little") * (len(low) - at))
        return b"".join(out)

    def _unit(self, unit: str) -> bytes:
        """Counts at a unit's characters and at the separator after it."""
        counts = self._counts(unit)
        return counts + (counts[-4:] or b"\0\0\0\0")

    def text_counts(self, text: str) -> np.ndarray:
        """Token counts of ``text[:1] ... text``: one number per character."""
        parts = list(map(self.units.__getitem__, text.replace("\n", " ").split(" ")))
        counts = np.frombuffer(b"".join(parts), "<u4").view(np.int32)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
        totals = counts[np.cumsum(lengths) - 1]
        before = np.cumsum(totals, dtype=np.int32) - totals
        return (counts + np.repeat(before, lengths))[:-1]


_COUNTERS: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens and ``prefix``: the token count after each
    character.  Ask it with ``tokens_in_first`` and ``longest_within``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            for first, texts in text_slices(batch.column("text")):
                counts = [counter.text_counts(t) for t in texts]
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(first, len(texts)),
                    "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                    "n_tokens": pa.array([int(c[-1]) if len(c) else 0 for c in counts], pa.int64()),
                    "prefix": pa.array(counts, pa.list_(pa.int64()))})

    return _input(docs).mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint, prefix array<bigint>")


def tokens_in_first(n: Column | int, prefix: str = "prefix") -> Column:
    """Tokens of the first ``n`` characters, from the stored counts."""
    n = F.lit(n) if isinstance(n, int) else n
    at = F.least(n.cast("int"), F.size(prefix))
    return F.when(at > 0, F.get(F.col(prefix), at - 1)).otherwise(F.lit(0).cast("bigint"))


def longest_within(tokens: int, prefix: str = "prefix") -> Column:
    """Characters of the longest prefix of at most ``tokens`` tokens."""
    fits = F.transform(F.col(prefix), lambda c, i: F.when(c <= tokens, i + 1).otherwise(0))
    return F.coalesce(F.array_max(fits), F.lit(0)).cast("bigint")


def token_counts(docs: DataFrame, tokenizer: str, limit: int) -> DataFrame:
    """Digest of the prefix counts: doc_id, n_bytes, n_tokens, ``over_limit``
    and ``fits_chars`` (the longest prefix within ``limit`` tokens).  The
    counts of one text live in the task that made them and are not shipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            for first, texts in text_slices(batch.column("text")):
                total, fits = [], []
                for text in texts:
                    counts = counter.text_counts(text)
                    total.append(int(counts[-1]) if len(counts) else 0)
                    within = np.flatnonzero(counts <= limit) if total[-1] > limit else None
                    fits.append(len(counts) if within is None
                                else int(within[-1]) + 1 if len(within) else 0)
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(first, len(texts)),
                    "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                    "n_tokens": pa.array(total, pa.int64()),
                    "over_limit": pa.array([t > limit for t in total], pa.bool_()),
                    "fits_chars": pa.array(fits, pa.int64())})

    return _input(docs).mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, fits_chars bigint")


def _input(docs: DataFrame) -> DataFrame:
    docs = only_columns(docs, "doc_id", "text")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
