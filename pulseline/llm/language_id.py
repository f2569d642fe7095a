"""Language identification by cross-parsing (operator 6).

Labelled text of each language becomes a suffix automaton. A text is parsed
into longest matches against each automaton (Ziv and Merhav's cross parsing);
the language that needs the fewest phrases, normalised by the length of its
training text, wins. Letters are compared without case; everything between
letters counts as one separator.

Many texts are parsed in lockstep: they are cut into segments (a segment
starts a phrase, in every language alike) and all segments advance one
symbol at a time. The transitions of all automata are one sparse table of rows
laid over each other (Tarjan and Yao's row displacement), so neither the
number of languages nor that of their letters bounds what is learned.

Defined results: ``und`` with score 0 for a null text and for one without a
letter, and for every text when nothing was learned. Ties go to the language
first in alphabetical order. A language without a labelled letter is unknown.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseline.llm.common import arrow_udf, row_slices, text_bytes

# training texts per language, characters of each, and symbols per language, at most
SAMPLE = 120
SAMPLE_CHARS = 4_000
SYMBOLS = 40_000
SEGMENT = 256            # symbols parsed in lockstep
SLICE = 2 << 20          # bytes of text parsed at once
EVIDENCE = 24            # symbols that the score counts at most
UNDETERMINED = "und"
UNSEEN = 1               # symbol of all letters not learned from: matches nothing, not even itself


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    letters: str                 # lower case, in symbol order
    texts: tuple[tuple[int, ...], ...]  # symbols of each language's training text


@cache
def _lower() -> np.ndarray:
    """Lower case of every code point that is a letter, 0 of the others."""
    return np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in range(0x110000)], np.int32)


def _code_points(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)


def _symbol_table(letters: str) -> np.ndarray:
    """Symbol of every code point: 0 separator, 1 unseen letter, 2… the letters."""
    symbol = np.full(0x110000, UNSEEN, np.int32)
    symbol[0] = 0
    symbol[[ord(c) for c in letters]] = np.arange(len(letters)) + 2
    return symbol[_lower()]


def _symbols(table: np.ndarray, raw: bytes) -> np.ndarray:
    """Symbols of a UTF-8 text, runs of separators as one."""
    sym = table[_code_points(raw)]
    keep = np.ones(len(sym), bool)
    keep[1:] = (sym[1:] != 0) | (sym[:-1] != 0)
    return sym[keep]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings (Blumer et al.)."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for s in symbols:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in moves[p]:
            moves[p][s] = new
            p = link[p]
        if p >= 0:
            q = moves[p][s]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = twin
                while p >= 0 and moves[p].get(s) == q:
                    moves[p][s] = twin
                    p = link[p]
        last = new
    return moves


def _overlay(size: np.ndarray, symbol: np.ndarray, target: np.ndarray, width: int):
    """Sparse rows in one table: ``base`` of each row, and ``owner`` and ``target`` of each cell.

    Row ``r`` has its entry for symbol ``s`` at ``base[r] + s``, if ``owner`` is
    ``r`` there. Long rows are placed first, at random; rows of one entry fill the gaps.
    """
    start = np.cumsum(size) - size
    owner = np.full(width + len(symbol) + len(symbol) // 4, -1, np.int32)
    base = np.zeros(len(size), np.int32)
    rng = np.random.default_rng(3)
    for k in np.unique(size[size > 1])[::-1].tolist():
        rows, poor = np.flatnonzero(size == k), 0
        while len(rows):
            at = rng.integers(0, len(owner) - width + 1, len(rows))
            slots = at[:, None] + symbol[start[rows][:, None] + np.arange(k)]
            ids = rows[:, None]
            free = (owner[slots] < 0).all(1)
            owner[slots[free]] = ids[free]
            won = free & (owner[slots] == ids).all(1)
            lost = free & ~won
            drop = owner[slots[lost]] == ids[lost]
            owner[slots[lost][drop]] = -1
            base[rows[won]] = at[won]
            poor = poor + 1 if won.sum() * 16 < len(rows) else 0
            if poor == 32:  # too full
                poor = 0
                owner = np.concatenate([owner, np.full(len(owner) // 4 + width, -1, np.int32)])
            rows = rows[~won]
    rows = np.flatnonzero(size == 1)
    gaps = np.flatnonzero(owner[width:] < 0)[:len(rows)] + width
    gaps = np.concatenate([gaps, len(owner) + np.arange(len(rows) - len(gaps))])
    base[rows] = gaps - symbol[start[rows]]
    owner = np.concatenate([owner, np.full(max(0, len(rows) + width), -1, np.int32)])[:int(base.max(initial=0)) + width]
    owner[gaps] = rows
    row = np.repeat(np.arange(len(size)), size)
    cells = np.zeros(len(owner), np.int32)
    owner[base[row] + symbol] = row
    cells[base[row] + symbol] = target
    return base, owner, cells


class Parser:
    """Automata of all languages in one sparse table; one per Python worker."""

    def __init__(self, model: Model):
        self.languages = model.languages
        self.table = _symbol_table(model.letters)
        self.width = len(model.letters) + 2
        sizes, symbols, targets, roots, at = [], [], [], [], 0
        for text in model.texts:
            moves = suffix_automaton(text)
            sizes.append(np.fromiter(map(len, moves), np.int64, len(moves)))
            n = int(sizes[-1].sum())
            symbols.append(np.fromiter(chain.from_iterable(moves), np.int32, n))
            targets.append(np.fromiter(chain.from_iterable(m.values() for m in moves), np.int32, n) + np.int32(at))
            roots.append(at)
            at += len(moves)
        none = [np.zeros(0, np.int32)]
        self.base, self.owner, self.target = _overlay(
            np.concatenate(sizes or none), np.concatenate(symbols or none), np.concatenate(targets or none), self.width)
        self.roots = np.array(roots, np.int32)
        # where a phrase that cannot go on begins anew: after the symbol, if the language has it
        cell = self.base[self.roots][:, None] + np.arange(self.width)
        own = self.roots[:, None]
        self.again = np.where(self.owner[cell] == own, self.target[cell], own) if roots else np.zeros((0, self.width), np.int32)
        self.bits = np.log2([max(2, len(t)) for t in model.texts])

    def phrases(self, rows: list[np.ndarray]) -> np.ndarray:
        """Phrases of each row in each language: array (rows, languages)."""
        k = len(self.roots)
        owner, cut = [], []
        for r, sym in enumerate(rows):
            for start in range(0, len(sym), SEGMENT):
                owner.append(r)
                cut.append(sym[start:start + SEGMENT])
        out = np.zeros((len(rows), k), np.int64)
        if not cut:
            return out
        size = np.array([len(c) for c in cut])
        order = np.argsort(-size, kind="stable")
        size = size[order]
        grid = np.zeros((int(size[0]), len(cut)), np.int32)
        for j, at in enumerate(order.tolist()):
            grid[:len(cut[at]), j] = cut[at]
        state = np.repeat(self.roots[:, None], len(cut), axis=1)
        count = np.ones((k, len(cut)), np.int64)  # the phrase that is open at the end
        live = np.searchsorted(-size, -np.arange(len(grid)), side="left")
        for t in range(len(grid)):
            n = int(live[t])
            now, sym = state[:, :n], grid[t, :n]
            cell = self.base[now] + sym
            stop = self.owner[cell] != now
            count[:, :n] += stop
            state[:, :n] = np.where(stop, self.again[:, sym], self.target[cell])
        np.add.at(out, np.array(owner)[order], count.T)
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        raw, offsets = text_bytes(texts)
        names: list[str] = []
        scores = [np.zeros(0)]
        for lo, hi in row_slices(np.diff(offsets), SLICE):
            rows = [_symbols(self.table, raw[offsets[i]:offsets[i + 1]].tobytes()) for i in range(lo, hi)]
            size = np.array([len(r) for r in rows])
            known = np.array([bool((r > 0).any()) for r in rows]) & (len(self.languages) > 0)
            if not len(self.languages):
                names += [UNDETERMINED] * len(rows)
                scores.append(np.zeros(len(rows)))
                continue
            rate = self.phrases(rows) * self.bits / np.maximum(size, 1)[:, None]  # bits per symbol
            best = rate.argmin(1)
            gap = (rate - rate.min(1, keepdims=True)) * np.minimum(size, EVIDENCE)[:, None]
            share = 1.0 / np.exp2(-np.minimum(gap, 500)).sum(1)
            names += [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), known.tolist())]
            scores.append(np.where(known, share, 0.0))
        return names, np.concatenate(scores)


def learnable(key: str = "doc_id") -> Column:
    """Rows whose language may be learned; a null id is not one of them."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 != 1, F.lit(False))


def learn(samples: dict[str, list[str]], symbols: int = SYMBOLS) -> Model:
    """A model from training texts per language, at most ``symbols`` of each."""
    letters: set[int] = set()
    for given in samples.values():
        letters.update(np.unique(_lower()[_code_points(" ".join(given).encode())]).tolist())
    chosen = "".join(map(chr, sorted(letters - {0})))
    table = _symbol_table(chosen)
    names, texts = [], []
    for name in sorted(samples):
        joined = _symbols(table, " ".join(samples[name]).encode())[:symbols]
        if (joined > 0).any():
            names.append(name)
            texts.append(tuple(joined.tolist()))
    return Model(tuple(names), chosen, tuple(texts))


def fit(docs: DataFrame, rows: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Model:
    """Learn from at most ``rows`` labelled texts per language, chosen by a hash of
    the row, of which at most ``chars`` characters each reach the driver.

    Each partition passes on only its own first ``rows`` per language, so a
    language with most of the rows does not gather in one task.
    """
    text = F.col("text").cast("string")
    known = (docs.filter(learnable() & F.col("lang").isNotNull() & (F.length(text) > 0))
                 .select(F.col("lang").cast("string").alias("lang"),
                         F.xxhash64("doc_id").alias("h"), "doc_id",
                         F.substring(text, 1, chars).alias("text")))
    order = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    found = (known.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= rows)
                  .orderBy("lang", "n").select("lang", "text").collect())
    samples: dict[str, list[str]] = {}
    for row in found:
        samples.setdefault(row.lang, []).append(row.text)
    return learn(samples)


_PARSERS: dict[int, Parser] = {}


def _parser(model: Model) -> Parser:
    key = hash(model)
    if key not in _PARSERS:
        _PARSERS[key] = Parser(model)
    return _PARSERS[key]


def detect(text: Column, model: Model) -> Column:
    """A struct of ``lang_pred`` and ``score`` from the whole text."""

    def run(texts: pa.Array) -> pa.Array:
        names, scores = _parser(model).predict(texts)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                          names=["lang_pred", "score"])

    return arrow_udf(run, "struct<lang_pred: string, score: double>")(text.cast("string"))
