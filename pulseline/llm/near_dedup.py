"""Near-duplicate documents by SetSketch registers (operator 7).

A document's set is its distinct word shingles. Each register of its sketch
is a truncated minimum on an exponentially spaced scale (Ertl, 2021): equal
with a probability close to the Jaccard similarity, and mergeable by the
register-wise maximum. Runs of registers form bands; documents that share a
band are compared by the joint likelihood of their registers, and the
remaining pairs are confirmed on the full sets.

Copies: documents with equal sets are one class from the start. In a band
bucket every member is first compared with the bucket's smallest member only;
members already connected need no comparison with each other, so later only
members of different components remain. Small buckets pair those; in large ones
the members outside the largest component are compared with all others block
by block, and only links leave a task. So no bucket is expanded into all its
pairs, however many copies it holds, and no bucket is capped. Whatever the size
of a bucket, pairs with its smallest member pass the estimate before they are
confirmed, and all later pairs are compared exactly. Members of a bucket that
holds a share of all rows are not moved to one task (``join_counted``).

Defined results: a text without words (or null) has an empty set, size 0, and
links with nothing. A row without id links with nothing, its component is
null and it is kept. An id with several texts links by any of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseline.llm.common import arrow_udf, join_counted, mix64, row_slices, staged, text_bytes
from pulseline.llm.components import connected_components
from pulseline.llm.textstats import _LOWER, SLICE, word_bounds, word_hashes


SMALL = 32               # members of a bucket whose components are simply paired
BLOCK = 1_024            # members of a larger bucket compared at once, about,
BLOCK_ITEMS = 1 << 21    # and items of theirs
COLUMNS = 4_096          # items counted at once
ID_BITS = 16             # bits of the filter of candidate ids for each of them,
FILTER_BITS = 1 << 26    # and in all, at most (8 MB)


@dataclass(frozen=True)
class Params:
    """Shingle length, similarity, band layout and register scale.

    A pair at the similarity shares no band with probability
    (1 - similarity**rows)**bands: 1.3e-4 as set.
    """
    words: int = 5
    percent: int = 80
    rows: int = 7
    bands: int = 38
    base: float = 1.001
    top: int = 65_534           # q: registers lie in 0..q+1
    rate: float = 20.0          # a: scale of the exponential minima
    slack: float = 0.2          # estimates this far below the similarity are dropped (over 6 sigma)
    seed: int = 7

    @property
    def registers(self) -> int:
        return self.rows * self.bands


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its word shingles."""
    raw, offsets = text_bytes(texts)
    out: list[np.ndarray] = []
    for lo, hi in row_slices(np.diff(offsets), SLICE):
        cut = offsets[lo:hi + 1]
        part, cut = _LOWER[raw[cut[0]:cut[-1]]], cut - cut[0]
        starts, ends, first = word_bounds(part, cut)
        h = word_hashes(part, starts, ends)
        n = len(h) - words + 1
        key = h[:max(n, 0)].copy()
        for k in range(1, words):
            key = mix64(key) + h[k:k + len(key)]
        key = mix64(key)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= words:
                out.append(np.unique(key[a:b - words + 1]))
            elif b > a:  # the whole sequence as one, apart from longer shingles
                whole = np.array([b - a], np.uint64)
                for k in range(a, b):
                    whole = mix64(whole) + h[k:k + 1]
                out.append(mix64(whole))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _multipliers(p: Params) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(p.seed)
    flips = rng.integers(0, 1 << 32, p.registers, dtype=np.uint64).astype(np.uint32)
    odds = rng.integers(0, 1 << 32, p.registers, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    return flips, odds


def sketch(items: np.ndarray, p: Params) -> np.ndarray:
    """Registers of a set of 64-bit hashes (uint16).

    Register i is floor(1 - log_b(x)) within 0..q+1, x the minimum over the
    items of exponential values with rate a, drawn by hashing with seed i.
    """
    flips, odds = _multipliers(p)
    least = np.full(p.registers, 0xFFFFFFFF, np.uint32)
    h = (items >> np.uint64(32)).astype(np.uint32)
    step = max(1, (1 << 16) // p.registers)
    for at in range(0, len(h), step):
        block = (h[at:at + step, None] ^ flips) * odds
        np.minimum(least, block.min(0), out=least)
    u = (least.astype(np.float64) + 0.5) / 2.0**32
    x = -np.log1p(-u) / p.rate
    value = np.floor(1.0 - np.log(x) / math.log(p.base))
    return np.clip(value, 0, p.top + 1).astype(np.uint16)


def band_keys(registers: np.ndarray, p: Params) -> np.ndarray:
    """A 64-bit key of every band of every row of ``registers``."""
    r = registers.reshape(len(registers), p.bands, p.rows).astype(np.uint64)
    key = np.broadcast_to(mix64(np.arange(1, p.bands + 1, dtype=np.uint64)), r.shape[:2]).copy()
    for k in range(p.rows):
        key = mix64(key + r[:, :, k])
    return key


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, p: Params) -> np.ndarray:
    """Jaccard similarity of each pair by maximum joint likelihood.

    The counts of registers that are larger in one, larger in the other and
    equal are multinomial with probabilities that follow from the set sizes
    and the similarity; the likelihood is evaluated on a grid.
    """
    more = (a > b).sum(1)[:, None]
    less = (a < b).sum(1)[:, None]
    same = a.shape[1] - more - less
    u = (na / (na + nb))[:, None]
    v = 1.0 - u
    grid = np.linspace(0.0, 1.0, 201)[None, :]
    j = np.minimum(grid, np.minimum(u / v, v / u))
    log_b = lambda x: -np.log1p(-np.clip(x, 0, 1) * (p.base - 1) / p.base) / math.log(p.base)
    pa_, pb = log_b(u - v * j), log_b(v - u * j)
    tiny = 1e-12
    fit = (more * np.log(np.maximum(pa_, tiny)) + less * np.log(np.maximum(pb, tiny))
           + same * np.log(np.maximum(1 - pa_ - pb, tiny)))
    return np.take_along_axis(j, fit.argmax(1)[:, None], 1)[:, 0]


def _binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([x.tobytes() for x in arrays], pa.binary())


def signatures(text: Column, p: Params) -> Column:
    """Set size, fingerprint of the set and band keys of a whole text."""

    def run(texts: pa.Array) -> pa.Array:
        sets = shingle_sets(texts, p.words)
        regs = np.array([sketch(s, p) for s in sets], np.uint16).reshape(len(sets), p.registers)
        keys = band_keys(regs, p).view(np.int64)
        size = np.array([len(s) for s in sets], np.int64)
        total = np.array([mix64(s).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64)
        other = np.array([np.bitwise_xor.reduce(mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))) if len(s) else 0 for s in sets], np.uint64)
        ends = np.arange(len(sets) + 1, dtype=np.int32) * p.bands
        return pa.StructArray.from_arrays(
            [pa.array(size), pa.array(total.view(np.int64)), pa.array(other.view(np.int64)),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))],
            names=["n", "f1", "f2", "bands"])

    return arrow_udf(run, "struct<n: long, f1: long, f2: long, bands: array<long>>")(text)


def _full_sets(text: Column, p: Params) -> Column:
    """The set and the registers of a whole text, as binary."""

    def run(texts: pa.Array) -> pa.Array:
        sets = shingle_sets(texts, p.words)
        return pa.StructArray.from_arrays([_binary(sets), _binary([sketch(s, p) for s in sets])],
                                          names=["items", "registers"])

    return arrow_udf(run, "struct<items: binary, registers: binary>")(text)


def _similar(p: Params):
    """Whether the registers of a pair leave the similarity possible."""

    def run(a: pa.Array, b: pa.Array, na: pa.Array, nb: pa.Array) -> pa.Array:
        left = np.frombuffer(b"".join(a.to_pylist()), np.uint16).reshape(len(a), p.registers)
        right = np.frombuffer(b"".join(b.to_pylist()), np.uint16).reshape(len(b), p.registers)
        out = np.zeros(len(a), bool)
        for at in range(0, len(a), 2000):
            s = slice(at, at + 2000)
            found = estimate(left[s], right[s], na.to_numpy()[s].astype(float), nb.to_numpy()[s].astype(float), p)
            out[s] = found >= p.percent / 100 - p.slack
        return pa.array(out)

    return arrow_udf(run, "boolean")


def _shared():
    """Size of the intersection of two sorted sets."""

    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist()):
            both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
            both.sort(kind="stable")
            out.append(int((both[1:] == both[:-1]).sum()))
        return pa.array(out, pa.int64())

    return arrow_udf(run, "long")


def _estimated(pairs: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """The pairs (``a, b``) that the registers leave possible."""
    side = lambda s, *cols: sets.select(F.col("rep").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in cols])
    return (pairs.join(side("a", "n", "registers"), "a").join(side("b", "n", "registers"), "b")
                 .filter(100 * F.least("n_a", "n_b") >= p.percent * F.greatest("n_a", "n_b"))
                 .filter(_similar(p)("registers_a", "registers_b", "n_a", "n_b"))
                 .select("a", "b"))


def _confirmed(pairs: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """The pairs (``a, b``) whose similarity holds on the full sets."""
    side = lambda s, *cols: sets.select(F.col("rep").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in cols])
    full = (pairs.join(side("a", "n", "items"), "a").join(side("b", "n", "items"), "b")
                .withColumn("both", _shared()("items_a", "items_b")))
    return full.filter(100 * F.col("both") >= p.percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")


def _id_bits(ids: DataFrame, column: str, bits: int) -> np.ndarray:
    """A Bloom filter of the ids in 64-bit words: ``bits`` bits, a power of two."""
    h = F.xxhash64(column)
    spots = F.array(*[F.shiftright(h, 20 * k).bitwiseAND(bits - 1) for k in range(3)])
    words = (ids.select(F.explode(spots).alias("spot"))
                .groupBy(F.shiftright("spot", 6).alias("word"))
                .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("spot").bitwiseAND(63).cast("int"))).alias("bits"))
                .toArrow())
    out = np.zeros(bits // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def _maybe_in(words: np.ndarray, column: str) -> Column:
    """False only for values that are not among the ids."""
    bits = 64 * len(words)

    def run(hashes: pa.Array) -> pa.Array:
        found = np.ones(len(hashes), bool)
        for k in range(3):
            spot = (hashes.to_numpy() >> (20 * k)) & (bits - 1)
            found &= ((words[spot >> 6] >> (spot & 63)) & 1).astype(bool)
        return pa.array(found)

    return arrow_udf(run, "boolean")(F.xxhash64(column))


def _sets_of(rows: DataFrame, members: DataFrame, p: Params) -> DataFrame:
    """Full set, its size and the registers of the documents in ``members``.

    A Bloom filter of the ids spares most other texts the shuffle of the join;
    it is left out where they are too many for it to tell texts apart.
    """
    bits = 1 << max(20, (ID_BITS * members.count()).bit_length())
    some = rows.filter(_maybe_in(_id_bits(members, "rep", bits), "doc_id")) if bits <= FILTER_BITS else rows
    texts = (some.join(members, F.col("doc_id") == F.col("rep"), "left_semi")
                 .dropDuplicates(["doc_id", "text"]))  # repeated rows; already together
    return (texts.select(F.col("doc_id").alias("rep"), _full_sets(F.col("text"), p).alias("s"))
                 .select("rep", (F.octet_length("s.items") / 8).cast("long").alias("n"), "s.items", "s.registers"))


def block_links(sets: list[np.ndarray], component: np.ndarray, left: np.ndarray, right: np.ndarray,
                percent: int) -> list[tuple[int, int]]:
    """Pairs (i, j) of different components, i in ``left`` and j in ``right``, that
    reach the similarity; of the pairs of one i with one component, one.

    Items in one set alone cannot be shared, so only the others become columns
    of the product that counts all intersections of the block.
    """
    size = np.array([len(s) for s in sets])
    items, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    shared = np.bincount(column, minlength=len(items)) > 1
    use = shared[column]
    place = np.cumsum(shared) - 1
    column, owner = place[column[use]], owner[use]
    both = np.zeros((len(left), len(right)))
    rank_l, rank_r = np.full(len(sets), -1), np.full(len(sets), -1)
    rank_l[left], rank_r[right] = np.arange(len(left)), np.arange(len(right))
    for lo in range(0, int(shared.sum()), COLUMNS):
        part = (column >= lo) & (column < lo + COLUMNS)
        c, o = column[part] - lo, owner[part]
        a = np.zeros((len(left), COLUMNS), np.float32)
        b = np.zeros((len(right), COLUMNS), np.float32)
        in_l, in_r = rank_l[o] >= 0, rank_r[o] >= 0
        a[rank_l[o[in_l]], c[in_l]] = 1
        b[rank_r[o[in_r]], c[in_r]] = 1
        both += a @ b.T
    union = size[left][:, None] + size[right][None, :] - both
    i, j = np.nonzero((100 * both >= percent * union) & (component[left][:, None] != component[right][None, :]))
    seen, out = set(), []
    for x, y in zip(left[i].tolist(), right[j].tolist()):
        if (x, component[y]) not in seen:
            seen.add((x, component[y]))
            out.append((x, y))
    return out


def _large_bucket_links(placed: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """Links across the components of large buckets (``a, b``).

    Of each bucket the largest component is the ground, the other members are
    guests. Guests meet guests and ground in blocks of about ``BLOCK`` rows or
    ``BLOCK_ITEMS`` items, whichever is reached first.
    """
    placed = staged(placed.join(sets.select("rep", "n"), "rep"), "large")
    per = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("items"))
    blocks = lambda rows, items: F.ceil(F.greatest(rows / BLOCK, items / BLOCK_ITEMS))
    ground = per.groupBy("bucket").agg(
        F.max(F.struct("rows", "component", "items")).alias("top"), F.sum("rows").alias("rows"),
        F.sum("items").alias("items")).select(
        "bucket", F.col("top.component").alias("ground"),
        blocks(F.col("rows") - F.col("top.rows"), F.col("items") - F.col("top.items")).alias("guests"),
        blocks(F.col("top.rows"), F.col("top.items")).alias("grounds"), "rows")
    rows = join_counted(placed, staged(ground, "ground"), ["bucket"], "rows", placed.count()).withColumn("guest", F.col("component") != F.col("ground"))
    spread = F.xxhash64("rep")
    own = F.when(F.col("guest"), F.pmod(spread, F.col("guests"))).otherwise(F.pmod(spread, F.col("grounds")))
    rows = rows.withColumn("own", own)
    # (lower guest block, other block, whether the other is ground)
    to_guests = F.transform(F.sequence(F.lit(0).cast("long"), F.col("guests") - 1), lambda k: F.struct(
        F.least(k, "own").alias("i"), F.greatest(k, "own").alias("j"), F.lit(False).alias("g")))
    to_ground = F.transform(F.sequence(F.lit(0).cast("long"), F.col("grounds") - 1), lambda k: F.struct(
        F.col("own").alias("i"), k.alias("j"), F.lit(True).alias("g")))
    from_ground = F.transform(F.sequence(F.lit(0).cast("long"), F.col("guests") - 1), lambda k: F.struct(
        k.alias("i"), F.col("own").alias("j"), F.lit(True).alias("g")))
    tasks = F.when(F.col("guest"), F.concat(to_guests, to_ground)).otherwise(from_ground)
    copies = (rows.select("bucket", "rep", "component", "guest", "own", F.explode(tasks).alias("t"))
                  .select("bucket", "t.*", "rep", "component", "guest", "own")
                  .join(sets.select("rep", "items"), "rep"))

    def meet(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        rep = group.column("rep").to_numpy()
        rep, first = np.unique(rep, return_index=True)
        guest, own = group.column("guest").to_numpy()[first], group.column("own").to_numpy()[first]
        items = group.column("items").take(pa.array(first)).to_pylist()
        i, ground_task = group.column("i")[0].as_py(), group.column("g")[0].as_py()
        left = np.flatnonzero(guest & (own == i))
        right = np.flatnonzero(~guest) if ground_task else np.flatnonzero(guest)
        found = block_links([np.frombuffer(x, np.uint64) for x in items],
                            group.column("component").to_numpy()[first], left, right, p.percent)
        return pa.table({"a": pa.array([rep[x] for x, _ in found], pa.int64()),
                         "b": pa.array([rep[y] for _, y in found], pa.int64())})

    return copies.groupBy("bucket", "i", "j", "g").applyInArrow(meet, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, params: Params = Params(), key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``."""
    p = params
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = staged(rows.select("doc_id", signatures(F.col("text"), p).alias("s"))
                        .select("doc_id", "s.*"), "signatures")
    able = signed.filter("n > 0 and doc_id is not null")
    mark = ["n", "f1", "f2"]
    classes = able.groupBy(*mark).agg(F.min("doc_id").alias("rep"))

    # one row per class and band; the classes come with the bands of any of their rows
    banded = (able.groupBy(*mark).agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"))
                  .select("rep", F.explode("bands").alias("bucket")))
    heads = staged(banded.groupBy("bucket").agg(F.min("rep").alias("head"), F.max("rep").alias("last"))
                         .filter("head < last").select("bucket", "head"), "heads")
    # both sides are plain rows of one key, so that a hot bucket can be split
    buckets = staged(banded.join(heads, "bucket"), "buckets")

    stars = staged(buckets.filter("head < rep").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct(), "stars")
    members = stars.select(F.col("a").alias("rep")).unionByName(stars.select(F.col("b").alias("rep"))).distinct()
    sets = staged(_sets_of(rows, members, p), "sets")

    links = staged(_confirmed(_estimated(stars, sets, p), sets, p), "links")
    found = connected_components(links)
    # buckets whose members are not all connected yet
    placed = staged(buckets.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "bucket", "rep", F.coalesce("component", "rep").alias("component")), "placed")
    open_ = staged(placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                                F.count(F.lit(1)).alias("size"))
                         .filter("lo < hi").select("bucket", "size"), "open")
    placed = staged(join_counted(placed, open_, ["bucket"], "size", placed.count()), "members")
    small = placed.filter(F.col("size") <= SMALL)
    x = small.select("bucket", F.col("rep").alias("a"), F.col("component").alias("ca"))
    y = small.select("bucket", F.col("rep").alias("b"), F.col("component").alias("cb"))
    across = (x.join(y, "bucket").filter("ca <> cb and a < b").select("a", "b").distinct()
               .join(stars, ["a", "b"], "left_anti"))
    large = _large_bucket_links(placed.filter(F.col("size") > SMALL).drop("size"), sets, p)
    more = staged(_confirmed(across, sets, p).unionByName(large), "links")
    found = connected_components(links.unionByName(more))

    groups = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        *mark, F.coalesce("component", "rep").alias("group"))
    out = signed.select("doc_id", *mark).join(groups, mark, "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    component = F.when(linked, F.col("group")).otherwise(F.col("doc_id"))
    return (out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
               .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_copies(docs: DataFrame, params: Params = Params(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates, all columns unchanged.

    The row with the smallest id stays. Rows without id stay; of rows that
    repeat both id and text one stays. Where ids repeat with different texts,
    each of the texts is judged by itself.
    """
    named = docs.filter(F.col(key).isNotNull())
    repeats = named.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not repeats.limit(1).count():
        found = near_duplicates(docs, params, key, text).filter("not kept").select(F.col("doc_id").alias("__gone"))
        gone = staged(found.distinct(), "copies")
        return docs.join(gone, F.col(key).cast("long") == F.col("__gone"), "left_anti")
    # (id, text) pairs become the nodes; the least pair of each group stays
    node = F.xxhash64(F.col(key), F.col(text))
    nodes = staged(named.select(F.col(key).cast("long").alias("__id"), node.alias("__node")).distinct(), "nodes")
    found = near_duplicates(named.select(node.alias("doc_id"), F.col(text).alias("text")), params)
    group = found.select(F.col("doc_id").alias("__node"), F.col("component_id").alias("__group")).distinct()
    placed = staged(nodes.join(group, "__node"), "groups")
    first = placed.groupBy("__group").agg(F.min(F.struct("__id", "__node")).alias("first"))
    kept = staged(first.select("first.*"), "kept")
    out = named.dropDuplicates([key, text]).join(
        kept, (F.col(key).cast("long") == F.col("__id")) & (node == F.col("__node")), "left_semi")
    return out.unionByName(docs.filter(F.col(key).isNull()))
