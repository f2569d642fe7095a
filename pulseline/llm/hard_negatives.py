"""Hard negatives by length buckets and coordinate pruning (operator 11).

Vectors are scaled to integers, so inner products are exact and ties are
real. Anchors look for their best rows of the same label (positives), then,
for each positive, for the best rows of other labels that score within a
margin below it (negatives). Both searches go through the same buckets of
rows of similar length (LEMP; Teflioudi et al., 2015). In a bucket whose
largest length is l, a row that scores s or more against anchor a has a
cosine of at least t = s / (|a| l). A bucket with t > 1 is skipped. Otherwise t bounds every coordinate of the
normalised row: for the anchor's largest coordinates (its focus) the feasible
range is looked up in the bucket's sorted coordinate lists, and only rows
inside all ranges are verified by the exact product. s is the score that a
row must reach at least: the fifth best so far, first taken from a bounded
sample, or the margin below the least positive.

Rows are dealt into slabs of a bounded number of components, by length and a
hash; anchors, themselves a share of the rows, into tiles. Each tile meets
each slab in a task of its own: no group grows with the data, and only the
few best of each anchor leave it. Of rows equal in label and vector only the
smallest ids can be among the best, so no others are searched; a hot group of
copies therefore costs a handful of rows.

Ids and labels are integers (a text id fails the cast). Defined results: rows
without id, label or vector, or with a null or non-finite component take no
part, and rows of different length never meet. Vectors may be zero or empty:
all their scores are 0. Rows that repeat an id are rows of their own; an
anchor does not meet itself. Scores are exact up to 38 digits (those beyond
count as equal); one beyond 64 bits is returned as the nearest long.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseline.llm.common import ship_package, staged

LARGEST = 10**38 - 1     # of a decimal column
SCORE = pa.decimal128(38, 0)
ANCHOR = ["row", "vec_id", "label", "dim", "length", "data"]


@dataclass(frozen=True)
class Params:
    """Positives, negatives of each, the margin (percent), and the sizes of the search.

    ``components`` bounds a slab (and a tile) as rows times vector length,
    ``buckets`` is the number of length buckets in a slab, ``focus`` the
    number of coordinates looked up, ``sample`` the rows that first
    thresholds come from, ``cuts`` the length classes.
    """
    positives: int = 5
    negatives: int = 5
    margin: int = 80
    scale: int = 256
    components: int = 1 << 19
    buckets: int = 4
    focus: int = 4
    sample: int = 4_096
    cuts: int = 64
    slack: float = 1e-9     # keeps rounding on the safe side of every bound


def sound(vector: Column) -> Column:
    """No null, NaN or infinite component."""
    inf = F.lit(float("inf"))
    return F.coalesce(F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < inf)), F.lit(False))


def scaled(vectors: list, scale: int) -> list[np.ndarray]:
    """Integer components, as doubles (the floor of a double is one)."""
    most = np.finfo(float).max
    with np.errstate(over="ignore"):
        return [np.clip(np.floor(np.array(v, float) * scale), -most, most) for v in vectors]


def _matrix(data: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(data), "<f8").reshape(len(data), -1)


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued rows and anchors.

    Doubles are exact up to 2**53; beyond that Python's integers take over.
    """
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * max(1, rows.shape[1])
    if most < 2.0**53:
        return (rows @ anchors.T).astype(np.int64)
    exact = lambda x: np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape)
    out = exact(rows).dot(exact(anchors).T)
    return np.array([[min(max(int(v), -LARGEST), LARGEST) for v in row] for row in out], object).reshape(out.shape)


class Bucket:
    """Rows of similar length with their sorted coordinate lists."""

    def __init__(self, rows: np.ndarray, length: np.ndarray):
        self.rows, self.longest = rows, float(length.max(initial=0.0))
        unit = rows / np.where(length > 0, length, 1.0)[:, None]
        self.unit = unit
        self.order = np.argsort(unit, axis=0, kind="stable").astype(np.int32)
        self.lists = np.take_along_axis(unit, self.order, 0)

    def candidates(self, anchor: np.ndarray, length: float, least: float, p: Params) -> np.ndarray | None:
        """Places of rows that can score ``least`` against the anchor; None for all of them."""
        if least <= 0 or not math.isfinite(least):
            return None
        room = length * self.longest
        bound = least / room * (1 - p.slack) if room > 0 else 2.0
        if bound > 1:
            return np.zeros(0, np.int64)
        unit = anchor / length
        focus = np.argsort(-np.abs(unit), kind="stable")[:p.focus]
        beta, gamma = np.arccos(np.clip(unit[focus], -1, 1)), math.acos(bound)
        low = np.cos(np.minimum(beta + gamma, math.pi)) - p.slack
        high = np.cos(np.maximum(beta - gamma, 0.0)) + p.slack
        begin = [int(np.searchsorted(self.lists[:, f], lo, "left")) for f, lo in zip(focus, low)]
        end = [int(np.searchsorted(self.lists[:, f], hi, "right")) for f, hi in zip(focus, high)]
        k = int(np.argmin(np.subtract(end, begin)))
        found = self.order[begin[k]:end[k], focus[k]]
        for j in range(len(focus)):
            if j != k:
                x = self.unit[found, focus[j]]
                found = found[(x >= low[j]) & (x <= high[j])]
        return found


def buckets_of(rows: np.ndarray, length: np.ndarray, count: int) -> list[tuple[np.ndarray, Bucket]]:
    """The rows by falling length, cut into buckets: (places, bucket)."""
    order = np.argsort(-length, kind="stable")
    return [(part, Bucket(rows[part], length[part])) for part in np.array_split(order, count) if len(part)]


def best(score: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest scores, ties by smaller id."""
    if len(score) > 4 * count and score.dtype != object:  # all that reach the count-th highest
        least = np.partition(score, len(score) - count)[len(score) - count]
        keep = np.flatnonzero(score >= least)
    else:
        keep = np.arange(len(score))
    rank = sorted(keep.tolist(), key=lambda i: (-int(score[i]), int(ids[i])))
    return np.array(rank[:count], np.int64)


def _scores(values: list) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], SCORE)


def _sides(group: pa.Table) -> tuple[dict, dict]:
    """Anchors and rows of a task."""
    group = group.combine_chunks()
    side = group.column("anchor").to_numpy(zero_copy_only=False)
    out = []
    for at in (np.flatnonzero(side), np.flatnonzero(~side)):
        part = group.take(pa.array(at))
        out.append({c: part.column(c).to_numpy() for c in ("row", "vec_id", "label", "length")}
                   | {"data": _matrix(part.column("data").to_pylist()) if len(at) else np.zeros((0, 0))}
                   | {"goals": part.column("goals").to_pylist(), "least": part.column("least").to_numpy()})
    return out[0], out[1]


def search_positives(p: Params):
    """Per anchor the best rows of its label in the slab."""

    def run(group: pa.Table) -> pa.Table:
        anchors, rows = _sides(group)
        out: dict[str, list] = {"row": [], "id": [], "score": []}
        found = buckets_of(rows["data"], rows["length"], p.buckets) if len(rows["row"]) else []
        for a in range(len(anchors["row"])):
            least, ids, scores = float(anchors["least"][a]), [], []
            for places, bucket in found:
                pick = bucket.candidates(anchors["data"][a], anchors["length"][a], least, p)
                at = places if pick is None else places[pick]
                at = at[(rows["label"][at] == anchors["label"][a]) & (rows["row"][at] != anchors["row"][a])]
                if not len(at):
                    continue
                s = products(rows["data"][at], anchors["data"][a][None])[:, 0]
                top = best(s, rows["vec_id"][at], p.positives)
                scores += s[top].tolist()
                ids += rows["vec_id"][at[top]].tolist()
                if len(scores) >= p.positives:
                    least = max(least, float(sorted(scores, reverse=True)[p.positives - 1]))
            out["row"] += [int(anchors["row"][a])] * len(ids)
            out["id"] += ids
            out["score"] += scores
        return pa.table({"row": pa.array(out["row"], pa.int64()), "id": pa.array(out["id"], pa.int64()),
                         "score": _scores(out["score"])})

    return run


def search_negatives(p: Params):
    """Per anchor and positive score the best rows of other labels within the margin in the slab."""

    def run(group: pa.Table) -> pa.Table:
        anchors, rows = _sides(group)
        out: dict[str, list] = {"row": [], "goal": [], "id": [], "score": []}
        found = buckets_of(rows["data"], rows["length"], p.buckets) if len(rows["row"]) else []
        for a in range(len(anchors["row"])):
            goals = sorted({int(g) for g in anchors["goals"][a] or [] if int(g) >= 0}, reverse=True)
            if not goals:
                continue
            held: dict[int, list[tuple[int, int]]] = {g: [] for g in goals}
            for places, bucket in found:
                # what a row must score to be any goal's negative: the margin, or that goal's last place so far
                least = min(float(-held[g][-1][0]) if len(held[g]) == p.negatives else p.margin * g / 100 for g in goals)
                pick = bucket.candidates(anchors["data"][a], anchors["length"][a], least * (1 - p.slack), p)
                at = places if pick is None else places[pick]
                at = at[rows["label"][at] != anchors["label"][a]]
                if not len(at):
                    continue
                s = products(rows["data"][at], anchors["data"][a][None])[:, 0]
                for g in goals:
                    fits = np.flatnonzero((s <= g) & (s >= -(-p.margin * g // 100)))
                    top = fits[best(s[fits], rows["vec_id"][at[fits]], p.negatives)]
                    held[g] = sorted(held[g] + [(-int(s[i]), int(rows["vec_id"][at[i]])) for i in top])[:p.negatives]
            for g, rest in held.items():
                out["row"] += [int(anchors["row"][a])] * len(rest)
                out["goal"] += [g] * len(rest)
                out["id"] += [i for _, i in rest]
                out["score"] += [-s for s, _ in rest]
        return pa.table({"row": pa.array(out["row"], pa.int64()), "goal": _scores(out["goal"]),
                         "id": pa.array(out["id"], pa.int64()), "score": _scores(out["score"])})

    return run


def _first_least(sample: dict, p: Params):
    """The score that an anchor's last positive has at least: that of its place in the sample."""

    def run(batches):
        for batch in batches:
            least = np.full(batch.num_rows, -np.inf)
            row, label = batch.column("row").to_numpy(), batch.column("label").to_numpy()
            data = batch.column("data").to_pylist()
            for dim, (rows, labels, ids) in sample.items():
                for i in [i for i, d in enumerate(data) if len(d) == 8 * dim]:
                    at = np.flatnonzero((labels == label[i]) & (ids != row[i]))
                    if len(at) >= p.positives:
                        s = products(rows[at], _matrix([data[i]]))[:, 0]
                        least[i] = float(sorted(s.tolist(), reverse=True)[p.positives - 1])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ANCHOR], pa.array(least)], names=[*ANCHOR, "least"])

    return run


def prepared(df: DataFrame, key: str, vector: str, label: Column, is_anchor: Column, p: Params) -> DataFrame:
    """``row, vec_id, label, anchor, dim, length, data`` of the rows that take part."""
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("vec_id"),
                     label.cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
                     F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound(F.col("v")))

    def quantise(batches):
        for batch in batches:
            vectors = scaled(batch.column("v").to_pylist(), p.scale)
            with np.errstate(over="ignore"):
                length = [float(np.sqrt((v * v).sum())) for v in vectors]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("vec_id"), batch.column("label"), batch.column("anchor"),
                 pa.array([len(v) for v in vectors], pa.int64()), pa.array(length, pa.float64()),
                 pa.array([v.tobytes() for v in vectors], pa.binary())],
                names=["row", "vec_id", "label", "anchor", "dim", "length", "data"])

    return rows.mapInArrow(quantise, "row long, vec_id long, label long, anchor boolean, dim long, "
                                     "length double, data binary")


def first_of_class(rows: DataFrame, count: int) -> DataFrame:
    """Of the rows equal in label and vector those with the smallest ids, cut in each partition before the shuffle."""
    copies = Window.partitionBy("label", "data").orderBy("vec_id", "row")
    return (rows.withColumn("n", F.row_number().over(copies)).filter(F.col("n") <= count).drop("n", "anchor"))


def _dealt(rows: DataFrame, p: Params) -> tuple[DataFrame, int]:
    """``rows`` with their ``slab``, and the number of slabs.

    Slabs are made by length class, then by hash where a class has too many
    components; the driver sees one count a class.
    """
    total, width = rows.agg(F.count(F.lit(1)), F.max("dim")).first()
    classes = max(1, min(p.cuts, -(-total * max(width or 1, 1) // p.components)))
    shares = [k / classes for k in range(1, classes)]
    cuts = rows.agg(F.percentile_approx("length", F.array(*map(F.lit, shares)), 1000)).first()[0] if shares else []
    number = F.lit(0)
    for cut in cuts:
        number = number + (F.col("length") <= F.lit(cut)).cast("int")
    rows = rows.withColumn("class", number)
    blocks, first, at = {}, {}, 0
    for r in rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim")).collect():
        blocks[r["class"]], first[r["class"]] = -(-r.n * max(r.dim, 1) // p.components), at
        at += blocks[r["class"]]
    slab = F.lit(0)
    for c in blocks:
        slab = F.when(F.col("class") == c, first[c] + F.pmod(F.xxhash64("row"), F.lit(blocks[c]))).otherwise(slab)
    return rows.withColumn("slab", slab.cast("long")).drop("class"), at


def _meet(anchors: DataFrame, rows: DataFrame, slabs: int, tiles: int, search, returns: str) -> DataFrame:
    """Every tile of anchors with every slab of rows of the same vector length, in a task each."""
    columns = [*ANCHOR, "goals", "least"]
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = anchors.select(*columns, F.lit(True).alias("anchor"), F.pmod(F.xxhash64("row"), F.lit(tiles)).alias("tile"),
                          each(slabs).alias("slab"))
    right = rows.select(*ANCHOR,
                        F.lit(None).cast(anchors.schema["goals"].dataType).alias("goals"),
                        F.lit(0.0).alias("least"), F.lit(False).alias("anchor"), "slab", each(tiles).alias("tile"))
    return left.unionByName(right).groupBy("dim", "slab", "tile").applyInArrow(search, returns)


def _ranked(found: DataFrame, by: list[str], count: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def hard_negatives(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: Column | None = None,
                   is_anchor: Column | None = None, params: Params = Params()) -> DataFrame:
    """Per anchor, positive and rank: ``anchor_id, positive_id, rank, negative_id`` and both scores.

    ``label`` and ``is_anchor`` are expressions over ``df``; by default the
    column ``label``, and every row whose key is divisible by 100.
    """
    p = params
    spark = df.sparkSession
    ship_package(spark)
    label = F.col("label") if label is None else label
    is_anchor = F.col(key).cast("long") % 100 == 0 if is_anchor is None else is_anchor
    every = staged(prepared(df, key, vector, label, is_anchor, p), "vectors")
    # one row more than the positives, as an anchor may be among the first of its class
    rows, slabs = _dealt(staged(first_of_class(every, max(p.positives + 1, p.negatives)), "classes"), p)
    total, width = every.filter("anchor").agg(F.count(F.lit(1)), F.max("dim")).first()
    tiles = max(1, -(-total * max(width or 1, 1) // p.components))

    taken = (rows.orderBy(F.xxhash64("row"), "row").limit(max(64, min(p.sample, p.components // max(width or 1, 1))))
                 .select("row", "label", "dim", "data").toArrow())
    sample = {}
    for dim in set(taken.column("dim").to_pylist()):
        part = taken.filter(pc.equal(taken.column("dim"), dim))
        sample[dim] = (_matrix(part.column("data").to_pylist()), part.column("label").to_numpy(), part.column("row").to_numpy())
    anchors = staged(every.filter("anchor").select(*ANCHOR).mapInArrow(
        _first_least(sample, p), "row long, vec_id long, label long, dim long, length double, data binary, least double"),
        "anchors")

    score = "row long, id long, score decimal(38,0)"
    no_goals = F.lit(None).cast("array<decimal(38,0)>").alias("goals")
    found = _meet(anchors.withColumn("goals", no_goals), rows, slabs, tiles, search_positives(p), score)
    positives = staged(_ranked(found, ["row"], p.positives).select("row", F.col("id").alias("positive_id"),
                                                                  F.col("score").alias("goal")), "positives")
    goals = positives.groupBy("row").agg(F.collect_set("goal").alias("goals"))
    found = _meet(anchors.join(goals, "row"), rows, slabs, tiles, search_negatives(p),
                  "row long, goal decimal(38,0), id long, score decimal(38,0)")
    negatives = _ranked(found, ["row", "goal"], p.negatives)
    least, most = F.lit(-(1 << 63)).cast("decimal(38,0)"), F.lit((1 << 63) - 1).cast("decimal(38,0)")
    as_long = lambda c: F.greatest(F.least(F.col(c), most), least).cast("long")
    return (negatives.join(positives, ["row", "goal"]).join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
                     .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                             as_long("goal").alias("positive_score"), as_long("score").alias("negative_score")))
