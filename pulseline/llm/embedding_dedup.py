"""Exact near-duplicate vectors by a metric range join (operator 9).

Unit vectors with cosine >= c lie within r = sqrt(2 - 2c) of each other.
Pivots are vectors of a sample that have others within r. A vector within r of
a pivot belongs to the cell of its nearest one; cells so tight are far apart
unless they touch. All others, in no dense region, form the rest. Cells join
independently: a cell's members meet each other, and the vectors from outside
that can have a partner in it. By the triangle inequality those are no farther
from the pivot than the cell's radius plus r; that is the boundary that is
replicated, and of two cells only the later one sends its vectors over. So a
tight group meets itself and what lies around it, nothing else. The rest meets
itself, in blocks, as pivots cannot tell vectors without near ones apart.

Cells and the rest are cut into blocks of bounded size, and a pair of blocks
is a task. Members within r/2 of their pivot, the core, are all linked with
each other by the triangle inequality, without a comparison; equal vectors are
one row with a weight. So groups of copies and near copies cost linear work,
however large. Pairs are compared in double precision, tile by tile, and only
counts and a spanning forest leave a task: memory is linear in the block.

Ids are integers (a text id fails the cast). Defined results: a vector that is
null, empty, zero, or holds a null or non-finite component links with nothing
and is its own component, like a row without id. Vectors of different length
do not link. Rows that repeat an id count as vectors of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseline.llm.common import ship_package, staged
from pulseline.llm.components import connected_components

COSINE = 0.9
# vectors that pivots are picked from, pivots, and vectors in a block, at most
SAMPLE = 8_192
PIVOTS = 4_096
BLOCK = 8_192
# and at least, as long as there are fewer than so many blocks
LEAST_BLOCK, TASKS = 1_024, 16
COMPONENTS = 1 << 20   # components that a sample (or the pivots) may have in all
TILE = 512
MARGIN = 1e-9  # keeps rounding on the safe side of every bound


def _units(data: list[bytes], dtype: str) -> np.ndarray:
    """Unit rows of equally long vectors, in double precision."""
    x = np.frombuffer(b"".join(data), dtype).reshape(len(data), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def pick_pivots(units: np.ndarray, count: int, near: float) -> np.ndarray:
    """At most ``count`` rows more than ``near`` apart, those with most others within ``near`` first.

    Rows with no other one that close are none.
    """
    least = 1 - near * near / 2
    around = np.zeros(len(units), np.int64)
    for at in range(0, len(units), TILE):
        around[at:at + TILE] = (units[at:at + TILE] @ units.T >= least).sum(1)
    order = np.argsort(-around, kind="stable")
    chosen = np.zeros((count, units.shape[1]))
    n = 0
    for x in units[order[around[order] > 1]]:
        if n == count:
            break
        if not n or (chosen[:n] @ x).max() < least:
            chosen[n] = x
            n += 1
    return chosen[:n]


class Cells:
    """Pivots by vector length. Part ids of a length: two per pivot, the core
    (within r/2) and the shell (within r), and a negative one for the rest."""

    def __init__(self, pivots: dict[int, np.ndarray], radius: float):
        self.pivots, self.radius, self.base = pivots, radius, {}
        at = 0
        for dim in sorted(pivots):
            self.base[dim] = at
            at += 2 * len(pivots[dim])

    def distances(self, units: np.ndarray) -> np.ndarray:
        p = self.pivots[units.shape[1]]
        return np.sqrt(np.maximum(2 - 2 * (units @ p.T), 0))

    def assign(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Part and distance to its pivot of every row."""
        dim = units.shape[1]
        part, far = np.full(len(units), -dim), np.full(len(units), 2.0)
        if len(self.pivots.get(dim, ())):
            for at in range(0, len(units), TILE):
                d = self.distances(units[at:at + TILE])
                near = d.argmin(1)
                least = d[np.arange(len(d)), near]
                inside = least <= self.radius
                place = self.base[dim] + 2 * near + (least > self.radius / 2 - MARGIN)
                part[at:at + TILE][inside], far[at:at + TILE][inside] = place[inside], least[inside]
        return part, far


class Blocks:
    """Blocks of the parts, and which parts of other cells a vector must visit."""

    def __init__(self, cells: Cells, stats: dict[int, tuple[int, float]], block: int):
        self.cells, self.count, self.first, self.reach, at = cells, {}, {}, {}, 0
        for part in sorted(stats):
            rows, radius = stats[part]
            self.count[part], self.first[part] = -(-rows // block), at
            self.reach[part] = radius + cells.radius + MARGIN
            at += self.count[part]

    def own(self, part: int, rep: np.ndarray) -> np.ndarray:
        spread = (rep.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return self.first[part] + (spread % np.uint64(self.count[part])).astype(np.int64)

    def visits(self, units: np.ndarray, part: int) -> list[tuple[int, np.ndarray]]:
        """Parts that rows of one ``part`` visit: (part, places of the rows).

        A shell visits its own core. Of two cells the later one visits, and
        the rest visits all cells.
        """
        dim = units.shape[1]
        if not len(self.cells.pivots.get(dim, ())):
            return []
        base, out = self.cells.base[dim], []
        last = len(self.cells.pivots[dim]) if part < 0 else (part - base) // 2
        d = self.cells.distances(units)[:, :last]
        near, far = np.nonzero(d <= 2 * self.cells.radius + MARGIN)
        for g in np.unique(far).tolist():
            rows = near[far == g]
            for host in (base + 2 * g, base + 2 * g + 1):
                if host in self.first:
                    pick = rows[d[rows, g] <= self.reach[host]]
                    if len(pick):
                        out.append((host, pick))
        if part >= 0 and (part - base) % 2 and part - 1 in self.first:
            out.append((part - 1, np.arange(len(units))))
        return out


class Links:
    """Links between two blocks (or inside one), met tile by tile: counts and groups, no pairs."""

    def __init__(self, left: int, right: int, same: bool):
        self.same, self.shift = same, 0 if same else left
        self.parent = np.arange(left + (0 if same else right))

    def _roots(self, nodes: np.ndarray) -> np.ndarray:
        up = self.parent[nodes]
        while (self.parent[up] != up).any():
            up = self.parent[up]
        return up

    def add(self, at: int, hit: np.ndarray) -> None:
        """The links of a tile of left rows from ``at`` on."""
        for i in np.flatnonzero(hit.any(1)).tolist():
            nodes = np.append(np.flatnonzero(hit[i]) + self.shift, at + i)
            roots = self._roots(nodes)
            least = roots.min()
            if (roots != least).any():
                self.parent[roots] = least
                self.parent[nodes] = least

    def heads(self, ids: np.ndarray) -> np.ndarray:
        """Smallest id of each node's group."""
        root = self._roots(np.arange(len(self.parent)))
        least = np.full(len(root), np.iinfo(np.int64).max)
        np.minimum.at(least, root, ids)
        return least[root]


def meet(left: np.ndarray, right: np.ndarray, w_left: np.ndarray, w_right: np.ndarray, same: bool,
         cosine: float) -> tuple[np.ndarray, Links]:
    """Weighted links of every left row (and, unless ``same``, every right row), and the groups."""
    n_left, n_right = np.zeros(len(left)), np.zeros(len(right))
    links = Links(len(left), len(right), same)
    for at in range(0, len(left), TILE):
        hit = left[at:at + TILE] @ right.T >= cosine
        if same:
            hit[np.arange(len(hit)), at + np.arange(len(hit))] = False
        if hit.any():
            as_number = hit.astype(float)
            n_left[at:at + TILE] = as_number @ w_right
            n_right += w_left[at:at + TILE] @ as_number
            links.add(at, hit)
    return (n_left if same else np.concatenate([n_left, n_right])).astype(np.int64), links


def _valid(vector: Column) -> Column:
    inf = F.lit(float("inf"))
    sound = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < inf))
    return F.coalesce(vector.isNotNull() & sound & F.exists(vector, lambda e: e != 0), F.lit(False))


def near_duplicate_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding",
                           cosine: float = COSINE, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id`` and ``kept``."""
    ship_package(df.sparkSession)
    single = df.schema[vector].dataType.elementType.simpleString() == "float"
    dtype, item = ("<f4", "float") if single else ("<f8", "double")
    radius = math.sqrt(2 - 2 * cosine)

    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast(f"array<{item}>").alias("v"))
    rows = rows.withColumn("ok", F.col("vec_id").isNotNull() & _valid(F.col("v")))
    marks = rows.select("vec_id", "ok", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    classes = staged(marks.filter("ok").groupBy("h1", "h2")
                          .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("w"), F.any_value("v").alias("v")), "vectors")
    width = classes.agg(F.max(F.size("v"))).first()[0] or 1
    rows = max(2, min(SAMPLE, COMPONENTS // width))
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(rows).select("v").toArrow().column("v").to_pylist()
    lengths: dict[int, list[bytes]] = {}
    for v in sample:
        lengths.setdefault(len(v), []).append(np.array(v, dtype).tobytes())
    cells = Cells({n: pick_pivots(_units(v, dtype), min(pivots, rows), radius) for n, v in lengths.items()}, radius)

    def assign(batches):
        for batch in batches:
            data = [np.array(v, dtype).tobytes() for v in batch.column("v").to_pylist()]
            cell, far = np.zeros(len(data), np.int64), np.zeros(len(data))
            length = np.array([len(d) for d in data])
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                cell[at], far[at] = cells.assign(_units([data[i] for i in at], dtype))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("w"), pa.array(cell), pa.array(far), pa.array(data, pa.binary())],
                names=["rep", "w", "cell", "far", "data"])

    placed = staged(classes.select("rep", "w", "v").mapInArrow(
        assign, "rep long, w long, cell long, far double, data binary"), "cells")
    stats = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far"),
                                       F.sum("w").alias("w"), F.min("rep").alias("head")).collect()
    blocks = Blocks(cells, {s.cell: (s.n, s.far) for s in stats},
                    min(block, max(LEAST_BLOCK, sum(s.n for s in stats) // TASKS)))

    def send(batches):
        """Rows to the blocks they visit, the earlier blocks of their own part among them."""
        for batch in batches:
            rep, cell = batch.column("rep").to_numpy(), batch.column("cell").to_numpy()
            for c in np.unique(cell).tolist():
                at = np.flatnonzero(cell == c)
                own = blocks.own(c, rep[at])
                targets = [(t, pick) for host, pick in blocks.visits(_units(batch.column("data").take(pa.array(at)).to_pylist(), dtype), c)
                           for t in range(blocks.first[host], blocks.first[host] + blocks.count[host])]
                if not _is_core(cells, c):
                    targets += [(t, np.flatnonzero(own > t)) for t in range(blocks.first[c], blocks.first[c] + blocks.count[c])]
                for t, pick in targets:
                    if len(pick):
                        src = pa.array(at[pick])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(pick), t)), pa.array(own[pick]), pa.array(np.ones(len(pick), bool)),
                             *[batch.column(x).take(src) for x in ("rep", "w", "data")]],
                            names=["host", "guest", "visits", "rep", "w", "data"])

    def home(batches):
        """Every row with its own block."""
        for batch in batches:
            rep, cell = batch.column("rep").to_numpy(), batch.column("cell").to_numpy()
            own = np.zeros(len(rep), np.int64)
            for c in np.unique(cell).tolist():
                at = np.flatnonzero(cell == c)
                own[at] = blocks.own(c, rep[at])
            core = np.array([_is_core(cells, c) for c in cell.tolist()], bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), pa.array(core), *[batch.column(x) for x in ("rep", "w", "data")]],
                names=["host", "core", "rep", "w", "data"])

    def join(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        rep, w = group.column("rep").to_numpy(), group.column("w").to_numpy().astype(float)
        visits = group.column("visits").to_numpy(zero_copy_only=False)
        units = _units(group.column("data").to_pylist(), dtype)
        a, b = np.flatnonzero(~visits), np.flatnonzero(visits)
        if group.column("host")[0].as_py() == group.column("guest")[0].as_py():
            n, links = meet(units, units, w, w, True, cosine)
            ids = rep
        else:
            n, links = meet(units[a], units[b], w[a], w[b], False, cosine)
            ids = np.concatenate([rep[a], rep[b]])
        some, head = np.flatnonzero(n), links.heads(ids)
        return pa.table({"rep": pa.array(ids[some], pa.int64()), "n": pa.array(n[some], pa.int64()),
                         "head": pa.array(head[some], pa.int64())})

    row = "rep long, w long, data binary"
    sent = staged(placed.mapInArrow(send, f"host long, guest long, visits boolean, {row}"), "visits")
    homes = placed.mapInArrow(home, f"host long, core boolean, {row}")
    columns = ["host", "guest", "visits", "rep", "w", "data"]
    pairs = sent.select("host", "guest").distinct()
    inside = homes.filter(~F.col("core")).withColumn("guest", F.col("host")).withColumn("visits", F.lit(False))
    hosts = homes.join(pairs, "host").withColumn("visits", F.lit(False))
    copies = sent.select(*columns).unionByName(hosts.select(*columns)).unionByName(inside.select(*columns))
    found = staged(copies.groupBy("host", "guest").applyInArrow(join, "rep long, n long, head long"), "found")

    spark = df.sparkSession
    core = [(s.cell, s.w, s.head) for s in stats if _is_core(cells, s.cell)]
    cores = F.broadcast(spark.createDataFrame(core, "cell long, core_w long, core_head long"))  # two rows per pivot at most
    dense = placed.select("rep", "w", "cell").join(cores, "cell")
    counts = (found.select("rep", "n").unionByName(dense.select("rep", (F.col("core_w") - F.col("w")).alias("n")))
                   .groupBy("rep").agg(F.sum("n").alias("n")))
    edges = (found.filter("rep <> head").select("rep", "head")
                  .unionByName(dense.filter("rep <> core_head").select("rep", F.col("core_head").alias("head"))))
    groups = connected_components(edges).withColumnRenamed("node", "rep")
    per_class = (classes.select("h1", "h2", "rep", "w").join(counts, "rep", "left").join(groups, "rep", "left")
                        .select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n"),
                                F.coalesce("component", "rep").alias("component"), F.lit(True).alias("ok")))
    out = marks.select("vec_id", "ok", "h1", "h2").join(per_class, ["h1", "h2", "ok"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _is_core(cells: Cells, cell: int) -> bool:
    if cell < 0:
        return False
    base = max(b for b in cells.base.values() if b <= cell)
    return (cell - base) % 2 == 0
