"""Fill-in-middle transformation over a learned rank index (operator 13).

A text is cut between its tokens (white space and the word after it; white
space at the end is a token of its own). The boundaries of many texts end to
end grow almost linearly with their rank, so a piecewise-linear index stands
for them: greedy line segments that stay within a fixed error of all
boundaries, and one signed byte of residual for each. A cut at a rank is the
segment's prediction put right by the residual: exact, in constant memory a
boundary, without keeping offsets.

Which cut and which form a row gets follows from a hash of its key alone, so
a lost task repeats its rows alike, and rows need no shuffle.

Defined results: a null text is an empty one; an empty text, one that holds a
marker, and a row without key stay plain, with null lengths. Rows that repeat
a key are cut by the same draws.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseline.llm.common import arrow_udf, row_slices, text_bytes
from pulseline.llm.textstats import SLICE, word_bounds

ERROR = 100        # largest distance of a boundary from its segment, so that residuals fit a byte
WINDOW = 256       # boundaries that a segment is first tried on
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass(frozen=True)
class Params:
    """Seed of the draws, and the shares (percent) of rows transformed and of those in form spm."""
    seed: int = 42
    rate: int = 50
    spm: int = 80


class RankIndex:
    """Positions by rank, as line segments and residuals.

    ``positions`` are non-decreasing integers. Every segment starts at one of
    them and takes the following ones for as long as one slope keeps all
    within ``error`` (a narrowing cone of slopes).
    """

    def __init__(self, positions: np.ndarray, error: int = ERROR):
        if not 0 <= error <= 126:
            raise ValueError("residuals are kept in a signed byte")
        first, base, slope = [], [], []
        at, n = 0, len(positions)
        while at < n:
            size, tilt = self._longest(positions[at:], error)
            first.append(at)
            base.append(int(positions[at]))
            slope.append(tilt)
            at += size
        self.first = np.array(first, np.int64)
        self.base = np.array(base, np.int64)
        self.slope = np.array(slope, float)
        predicted = self.predict(np.arange(n, dtype=np.int64))
        self.residual = (np.asarray(positions, np.int64) - predicted).astype(np.int8)

    @staticmethod
    def _longest(y: np.ndarray, error: int) -> tuple[int, float]:
        """How many positions from the first on fit one line, and its slope."""
        window, most = WINDOW, len(y)
        while True:
            part = y[1:window].astype(float) - float(y[0])
            if not len(part):
                return 1, 0.0
            step = np.arange(1.0, len(part) + 1)
            high = np.minimum.accumulate((part + error) / step)
            low = np.maximum.accumulate((part - error) / step)
            wrong = np.flatnonzero(low > high)
            if len(wrong) or window >= most:
                last = int(wrong[0]) - 1 if len(wrong) else len(part) - 1
                if last < 0:
                    return 1, 0.0
                return last + 2, float(low[last] + high[last]) / 2
            window *= 2

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        """The segments' estimate of the positions."""
        segment = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[segment] + np.rint(self.slope[segment] * (ranks - self.first[segment])).astype(np.int64)

    def position(self, ranks: np.ndarray) -> np.ndarray:
        """The exact positions at ``ranks``."""
        ranks = np.asarray(ranks, np.int64)
        return self.predict(ranks) + self.residual[ranks]


def boundaries(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions of all cuts of all rows (start, token ends), and each row's first rank."""
    _, ends, first = word_bounds(raw, offsets)
    rows = len(offsets) - 1
    words = np.diff(first)
    tail = np.zeros(rows, np.int64)           # white space after the last word
    last = np.where(words > 0, ends[np.maximum(first[1:] - 1, 0)] if len(ends) else 0, offsets[:-1])
    tail[offsets[1:] > last] = 1
    count = 1 + words + tail
    rank = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(rank[-1], np.int64)
    out[rank[1:] - 1] = offsets[1:]           # the end, which the last word's end or the start may be
    out[rank[:-1]] = offsets[:-1]
    place = np.repeat(rank[:-1] + 1 - first[:-1], words) + np.arange(len(ends))
    out[place] = ends
    return out, rank


def draws(key: Column, seed: int) -> list[Column]:
    """Four 32-bit numbers from a hash of ``seed:key``, null for a null key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def _cut(texts: pa.Array, h1: pa.Array, h2: pa.Array, form: pa.Array) -> pa.Array:
    raw, offsets = text_bytes(texts)
    one, two = (h.fill_null(0).to_numpy(zero_copy_only=False) for h in (h1, h2))
    forms = form.to_pylist()
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    n_tokens, prefix, middle, out = [], [], [], []
    for lo, hi in row_slices(np.diff(offsets), SLICE):
        cut = offsets[lo:hi + 1]
        part, cut = raw[cut[0]:cut[-1]], cut - cut[0]
        positions, rank = boundaries(part, cut)
        index = RankIndex(positions)
        del positions
        n = np.diff(rank) - 1
        a, b = one[lo:hi] % (n + 1), two[lo:hi] % (n + 1)
        left = index.position(rank[:-1] + np.minimum(a, b)).tolist()
        right = index.position(rank[:-1] + np.maximum(a, b)).tolist()
        n_tokens += n.tolist()
        for i in range(hi - lo):
            begin, end, kind = int(cut[i]), int(cut[i + 1]), forms[lo + i]
            if kind == "plain":
                out.append(part[begin:end].tobytes())
                prefix.append(None)
                middle.append(None)
                continue
            x, y, z = part[begin:left[i]], part[left[i]:right[i]], part[right[i]:end]
            prefix.append(int(np.count_nonzero((x & 0xC0) != 0x80)))
            middle.append(int(np.count_nonzero((y & 0xC0) != 0x80)))
            head = [marks[1], z.tobytes(), marks[0], x.tobytes()] if kind == "spm" else \
                [marks[0], x.tobytes(), marks[1], z.tobytes()]
            out.append(b"".join([*head, marks[2], y.tobytes()]))
    return pa.StructArray.from_arrays(
        [pa.array(n_tokens, pa.int64()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
         pa.array(out, pa.binary()).cast(pa.string())], names=["n", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """Per row: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    Forms: ``psm`` is prefix, suffix, middle, each after its marker; ``spm``
    has the suffix first; ``plain`` is the text as it is.
    """
    h = draws(F.col(key), params.seed)
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    marked = F.contains(F.col("t"), F.lit(PREFIX))
    for mark in (SUFFIX, MIDDLE):
        marked = marked | F.contains(F.col("t"), F.lit(mark))
    rows = docs.select(F.col(key).alias("doc_id"), content.alias("t"), *[x.alias(f"h{k + 1}") for k, x in enumerate(h)])
    plain = (F.col("t") == "") | marked | F.col("h3").isNull() | (F.col("h3") % 100 >= params.rate)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < params.spm, "spm").otherwise("psm")
    cut = arrow_udf(_cut, "struct<n: long, prefix_chars: long, middle_chars: long, output: string>")
    rows = rows.withColumn("form", form)
    return (rows.select("doc_id", "form", cut("t", "h1", "h2", "form").alias("c"))
                .select("doc_id", "c.n", "form", "c.prefix_chars", "c.middle_chars", "c.output"))


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from."""
    part = "(.*?)"
    return (F.when(form == "psm", F.regexp_replace(output, f"(?s)^{PREFIX}{part}{SUFFIX}{part}{MIDDLE}(.*)$", "$1$3$2"))
             .when(form == "spm", F.regexp_replace(output, f"(?s)^{SUFFIX}{part}{PREFIX}{part}{MIDDLE}(.*)$", "$2$3$1"))
             .otherwise(output))
