"""Quality score by dictionary compression (operator 8).

Two zstandard dictionaries are built from good and from bad labelled texts.
A text is compressed in blocks with each; the difference of the two sizes
per byte says which dictionary knows it better. A logistic curve over that
difference and the size per byte, fitted on labelled texts that are not in
the dictionaries, turns it into the probability of a good label.

Defined results: null and empty texts get the score of zero compressed
bytes, the same for all. With one class missing from the sample the score
is the share of good labels; without labels it is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseline.llm.common import arrow_udf, text_bytes

# labelled documents per class in the sample, at most, and their bytes, at most
SAMPLE = 2_500
SAMPLE_BYTES = 16_384
DICTIONARY = 112_640
BLOCK = 1_024
LEVEL = 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]   # intercept first; alone where nothing was learned
    level: int = LEVEL


def _compressor(content: bytes, level: int):
    made = zstandard.ZstdCompressionDict(content)
    made.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=made, write_content_size=False,
                                    write_checksum=False, write_dict_id=False).compress


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; of very few texts, their bytes as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY, texts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-DICTIONARY:] or b"\n" * 8


_LOADED: dict[int, tuple] = {}


def sizes(model: Model, texts: list[bytes]) -> np.ndarray:
    """Per text: its compressed sizes with the good and the bad dictionary, and its size."""
    key = hash((model.good, model.bad, model.level))
    if key not in _LOADED:
        _LOADED[key] = (_compressor(model.good, model.level), _compressor(model.bad, model.level))
    good, bad = _LOADED[key]
    out = np.zeros((len(texts), 3))
    for i, text in enumerate(texts):
        a = b = 0
        for at in range(0, len(text), BLOCK):
            block = text[at:at + BLOCK]
            a += len(good(block))
            b += len(bad(block))
        out[i] = a, b, len(text)
    return out


def _inputs(s: np.ndarray) -> np.ndarray:
    size = s[:, 2] + 20.0
    return np.stack([(s[:, 1] - s[:, 0]) / size, np.minimum(s[:, 0], s[:, 1]) / size, np.log(size)], axis=1)


def scores(model: Model, texts: list[bytes]) -> np.ndarray:
    if len(model.weights) == 1:
        z = np.full(len(texts), model.weights[0])
    else:
        x = (_inputs(sizes(model, texts)) - model.mean) / model.scale
        z = model.weights[0] + x @ np.array(model.weights[1:])
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Weights of a ridge logistic regression (Newton steps), intercept first."""
    a = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (y - p) - ridge * w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), grad)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def learn(texts: list[bytes], good: np.ndarray) -> Model:
    """Dictionaries from three fifths of the texts, the curve from the others."""
    share = (good.sum() + 1.0) / (len(good) + 2.0)
    prior = float(np.log(share / (1 - share)))
    if good.all() or not good.any():
        return Model(b"", b"", (), (), (prior,))
    build = np.zeros(len(good), bool)
    for side in (good, ~good):
        at = np.flatnonzero(side)
        build[at[np.arange(len(at)) % 5 < 3]] = True
    pick = lambda rows: [texts[i] for i in np.flatnonzero(rows)]
    model = Model(_dictionary(pick(build & good)), _dictionary(pick(build & ~good)), (), (), (prior,))
    fit = ~build
    if not (fit & good).any() or not (fit & ~good).any():
        fit = np.ones(len(good), bool)
    x = _inputs(sizes(model, pick(fit)))
    mean, scale = x.mean(0), x.std(0) + 1e-9
    w = _logistic((x - mean) / scale, good[fit].astype(float))
    return Model(model.good, model.bad, tuple(mean.tolist()), tuple(scale.tolist()), tuple(w.tolist()))


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never learned from; a null id is not one of them."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, max_bytes: int = SAMPLE_BYTES) -> Model:
    """Learn from at most ``rows`` labelled documents per class, chosen by a hash
    of the id among those of at most ``max_bytes`` bytes.

    The chosen labels are broadcast (bounded by ``rows``), the texts come to
    the driver (bounded by ``2 * rows * max_bytes``, about 80 MB; usually a tenth).
    """
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
                   .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.filter(F.col("quality") == q).orderBy(*order).limit(rows) for q in (0, 1)]
    texts = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
                 .filter(F.octet_length("text").between(1, max_bytes))
                 .join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id"))
    found = texts.orderBy(*order, "text").limit(2 * rows).toArrow()
    return learn([t.encode() for t in found.column("text").to_pylist()],
                 found.column("quality").to_numpy() == 1)


def score(text: Column, model: Model) -> Column:
    """Probability of a good label, from the whole text."""

    def run(texts: pa.Array) -> pa.Array:
        raw, offsets = text_bytes(texts)
        data, cut = raw.tobytes(), offsets.tolist()
        return pa.array(scores(model, [data[a:b] for a, b in zip(cut, cut[1:])]), pa.float64())

    return arrow_udf(run, "double")(text.cast("string"))


def filter_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` predicted good, all their columns unchanged."""
    names = docs.columns
    scored = docs.select(F.struct("*").alias("row"), score(F.col("text"), model).alias("score"))
    return scored.filter(F.col("score") >= threshold).select("row.*").toDF(*names)
