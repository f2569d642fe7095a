"""Counts over whole texts: words, symbols, repeated lines and repeated windows.

Words are maximal runs without the six ASCII white-space characters. All
counts come from array operations over the bytes of many texts at once;
word and window equality is decided on 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

from pulseline.llm.common import arrow_udf, mix64, row_slices, text_bytes

# bytes of text worked on at once (a longer text makes a slice of its own)
SLICE = 1 << 20
LONG_WORD = 256

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_exclaim", "n_digits", "n_echo_words"]


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and the n+1 first-word indexes of the rows."""
    inside = ~_SPACE[raw]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    begin[cuts] = inside[cuts]
    end[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every word, eight bytes at a time."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(raw) + 1, "<u8", padded, 0, (1,))
    size = ends - starts
    out = mix64(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    at, left = starts, size
    rows = None  # all
    while len(at):
        block = eight[at] & _KEEP[np.minimum(left, 8)]
        if rows is None:
            out = mix64((out ^ block) * np.uint64(0x9E3779B97F4A7C15))
            more = np.flatnonzero((left > 8) & (left <= LONG_WORD))
            rows = more
        else:
            out[rows] = mix64((out[rows] ^ block) * np.uint64(0x9E3779B97F4A7C15))
            more = np.flatnonzero(left > 8)
            rows = rows[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(raw[starts[i]:ends[i]].tobytes())
    return out


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each row's span."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated_words(hashes: np.ndarray, first: np.ndarray, window: int = 3) -> np.ndarray:
    """Per row, the words covered by windows that occur twice or more in the row."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n = len(hashes) - window + 1
    covered = np.zeros(len(hashes), bool)
    if n > 0:
        key = hashes[:n].copy()
        for k in range(1, window):
            key = mix64(key) + hashes[k:k + n]
        key = mix64(key ^ mix64(row[:n].astype(np.uint64) + np.uint64(1)))
        same = np.flatnonzero(row[:n] == row[window - 1:])
        order = same[np.argsort(key[same], kind="stable")]
        ranked = key[order]
        twin = np.zeros(len(order), bool)
        if len(order):
            equal = ranked[1:] == ranked[:-1]
            twin[1:] |= equal
            twin[:-1] |= equal
        for k in range(window):
            covered[order[twin] + k] = True
    return _per_row(covered, first)


def _duplicate_lines(raw: np.ndarray, offsets: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Per row, the lines with a word that equal an earlier line."""
    out = np.zeros(len(offsets) - 1, np.int64)
    for i in np.flatnonzero(breaks).tolist():
        seen: set[bytes] = set()
        for line in raw[offsets[i]:offsets[i + 1]].tobytes().split(b"\n"):
            if line in seen:
                out[i] += bool(line.split())
            else:
                seen.add(line)
    return out


def count(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts named in ``COUNTS`` for every text; a null text has none."""
    raw, offsets = text_bytes(texts)
    parts: dict[str, list] = {name: [] for name in COUNTS}
    for lo, hi in row_slices(np.diff(offsets), SLICE):
        cut = offsets[lo:hi + 1]
        part, cut = raw[cut[0]:cut[-1]], cut - cut[0]
        starts, ends, first = word_bounds(part, cut)
        hashes = word_hashes(part, starts, ends)
        echo = np.zeros(len(hashes), bool)
        echo[1:] = hashes[1:] == hashes[:-1]
        heads = first[:-1]
        echo[heads[heads < len(echo)]] = False
        breaks = _per_row(part == 10, cut)
        values = {
            "n_words": np.diff(first),
            "word_chars": _per_row(~_SPACE[part] & ((part & 0xC0) != 0x80), cut),
            "n_symbols": _per_row(_SYMBOL[part], cut),
            "n_dup_lines": _duplicate_lines(part, cut, breaks),
            "n_repeat_words": _repeated_words(hashes, first),
            "n_lines": breaks + 1,
            "n_upper": _per_row((part >= 65) & (part <= 90), cut),
            "n_exclaim": _per_row(part == 33, cut),
            "n_digits": _per_row((part >= 48) & (part <= 57), cut),
            "n_echo_words": _per_row(echo, first),
        }
        for name, value in values.items():
            parts[name].append(value)
    return {name: np.concatenate(p) if p else np.zeros(0, np.int64) for name, p in parts.items()}


def text_counts(text: Column) -> Column:
    """A struct of the counts of a whole text."""

    def run(texts: pa.Array) -> pa.Array:
        values = count(texts)
        return pa.StructArray.from_arrays([pa.array(values[c].astype(np.int64)) for c in COUNTS], names=COUNTS)

    return arrow_udf(run, "struct<" + ", ".join(f"{c}: long" for c in COUNTS) + ">")(text)
