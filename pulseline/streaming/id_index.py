"""Bounded stored-id lookup: an index of the ids in the event table (JN-1, STR-1).

Asking whether an id is stored must not read every stored id. The index holds
them in segments, immutable folders whose ids are laid out in shards by hash.
A segment has as many shards as keep a shard at a bounded number of ids, and
every shard has a filter: bitmaps in which each id sets a few bits. A lookup

1. reads the filters of the shards that its ids fall into,
2. keeps the ids all of whose bits are set (the stored ones and about one in a
   thousand others), and
3. reads the ids of those shards only, by partition filters, and compares.

So ``n`` ids that are new read at most ``n`` filters of a segment and next to
no ids, however many are stored. Segments are merged level by level, which
bounds their number by the logarithm of what is stored.

The index follows the event table: micro-batch partitions that it does not
cover yet are few (``recent`` of them at most are left before they are added
as one segment) and are read directly. A partition that is written again
after it was covered is taken out of the cover first, so a retried or repeated
batch never meets its own rows. What is current is one small manifest file,
replaced as a whole; a crash between two steps leaves the older one valid.
Null ids are never stored twice or found.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseline.session import list_names, read_text, write_text

SHARD_IDS = 65_536          # ids in a shard, about
RECENT = 4                  # uncovered partitions that are read directly, at most
FANOUT = 4                  # segments of a level that are merged into one
MAP_BITS = 32_768           # bits of one bitmap (fixed by ``bitmap_construct_agg``)
BITS_PER_ID = 20
PROBES = 4                  # bits that an id sets

Batch = tuple[str, int]     # source and number of a micro-batch


@dataclass(frozen=True)
class Segment:
    """One immutable part of the index: its folder name, level and layout."""
    name: str
    level: int
    ids: int
    shards: int
    maps: int

    @staticmethod
    def sized(level: int, ids: int, shard_ids: int) -> Segment:
        shards = max(1, -(-ids // shard_ids))
        maps = max(1, -(-BITS_PER_ID * ids // (shards * MAP_BITS)))
        return Segment(uuid.uuid4().hex, level, ids, shards, maps)


def _place(key: str, shards: Column, maps: Column) -> list[Column]:
    """Shard, bitmap in the shard, and bits in the bitmap of an id."""
    spots = F.xxhash64(F.lit(2), key)
    bits = F.array(*[F.shiftright(spots, 15 * k).bitwiseAND(MAP_BITS - 1) for k in range(PROBES)])
    return [F.pmod(F.xxhash64(key), shards).alias("shard"),
            F.pmod(F.xxhash64(F.lit(1), key), maps).alias("map"), bits.alias("bits")]


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.call_function("shiftright", byte, bit.bitwiseAND(7).cast("int")).bitwiseAND(1) == 1


class IdIndex:
    """Ids of an event table partitioned by ``source_id`` and ``batch_id``."""

    def __init__(self, spark: SparkSession, events: str, root: str, key: str = "event_id",
                 shard_ids: int = SHARD_IDS, recent: int = RECENT, fanout: int = FANOUT):
        self.spark, self.events, self.root, self.key = spark, events, root, key
        self.shard_ids, self.recent, self.fanout = shard_ids, recent, fanout
        self.segments: list[Segment] = []
        self.covered: set[Batch] = set()
        self.dropped: set[Batch] = set()    # covered once, written again since
        self._held: list[DataFrame] = []
        self._version = 0
        self._load()

    # -- the manifest -------------------------------------------------------

    def _load(self) -> None:
        versions = sorted((int(n.removesuffix(".json")) for n in list_names(self.spark, f"{self.root}/manifest")
                           if n.endswith(".json")), reverse=True)
        if not versions:
            return
        state = json.loads(read_text(self.spark, f"{self.root}/manifest/{versions[0]}.json"))
        self._version = versions[0]
        self.segments = [Segment(**s) for s in state["segments"]]
        self.covered = {(s, n) for s, spans in state["covered"].items() for lo, hi in spans for n in range(lo, hi + 1)}
        self.dropped = {(s, n) for s, n in state["dropped"]}

    def _save(self) -> None:
        """Commit the state as the next version of the manifest (runs of batches as spans)."""
        spans: dict[str, list[list[int]]] = {}
        for source, number in sorted(self.covered):
            of = spans.setdefault(source, [])
            if of and of[-1][1] == number - 1:
                of[-1][1] = number
            else:
                of.append([number, number])
        state = {"segments": [asdict(s) for s in self.segments], "covered": spans, "dropped": sorted(self.dropped)}
        self._version += 1
        write_text(self.spark, f"{self.root}/manifest/{self._version}.json", json.dumps(state))

    # -- which partitions the table has -------------------------------------

    def partitions(self) -> set[Batch]:
        """Micro-batch partitions of the event table (names only, no files)."""
        out = set()
        for source in list_names(self.spark, self.events):
            if source.startswith("source_id="):
                for batch in list_names(self.spark, f"{self.events}/{source}"):
                    if batch.startswith("batch_id="):
                        out.add((unquote(source.removeprefix("source_id=")), int(batch.removeprefix("batch_id="))))
        return out

    def _read_partitions(self, batches) -> DataFrame:
        field = f"{self.key} string, source_id string, batch_id long"
        escaped = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        paths = [f"{self.events}/source_id={escaped(s)}/batch_id={n}" for s, n in sorted(batches)]
        return self.spark.read.option("basePath", self.events).schema(field).parquet(*paths)

    # -- lookup -------------------------------------------------------------

    def lookup(self, ids: DataFrame, own: Batch | None = None) -> DataFrame:
        """The given ids that are stored by any batch but ``own``.

        Call ``release`` when the result is no longer needed.
        """
        ids = ids.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        uncovered = self.partitions() - self.covered - {own}
        found = ids.limit(0)
        if uncovered:
            found = ids.join(self._read_partitions(uncovered).select(self.key), self.key, "left_semi")
        if self.segments:
            found = found.unionByName(self._in_segments(ids, own)).distinct()
        return found

    def _in_segments(self, ids: DataFrame, own: Batch | None) -> DataFrame:
        layout = F.array(*[F.struct(F.lit(s.name).alias("segment"), F.lit(s.shards).alias("shards"),
                                    F.lit(s.maps).alias("maps")) for s in self.segments])
        probes = (ids.withColumn("s", F.explode(layout))
                     .select(self.key, "s.segment", *_place(self.key, F.col("s.shards"), F.col("s.maps"))))
        touched = None
        if any(s.shards > 1 for s in self.segments):
            touched = self._pairs(probes)
        filters = self._read("filters", "map long, bitmap binary, segment string, shard long", touched)
        hit = F.forall("bits", lambda b: _is_set(F.col("bitmap"), b))
        suspects = (probes.join(filters, ["segment", "shard", "map"]).filter(hit)
                          .select(self.key, "segment", "shard").persist(StorageLevel.MEMORY_AND_DISK))
        self._held.append(suspects)
        wanted = self._pairs(suspects)
        if not wanted:
            return suspects.select(self.key)
        stored = self._read("ids", f"{self.key} string, source_id string, batch_id long, segment string, shard long", wanted)
        for source, number in sorted(self.dropped | ({own} if own else set())):
            stored = stored.filter(~((F.col("source_id") == source) & (F.col("batch_id") == number)))
        on = [self.key, "segment", "shard"]
        return suspects.join(stored.select(*on), on, "left_semi").select(self.key)

    def _pairs(self, rows: DataFrame) -> dict[str, list[int]]:
        """Shards of each segment among ``rows``: at most as many as the index has."""
        out: dict[str, list[int]] = {}
        for r in rows.select("segment", "shard").distinct().collect():
            out.setdefault(r.segment, []).append(r.shard)
        return out

    def _read(self, kind: str, schema: str, shards: dict[str, list[int]] | None) -> DataFrame:
        """Rows of the wanted shards (all shards without ``shards``), by partition filters."""
        names = [s.name for s in self.segments if shards is None or s.name in shards]
        base = f"{self.root}/{kind}"
        rows = (self.spark.read.option("basePath", base).schema(schema)
                    .parquet(*[f"{base}/segment={n}" for n in names]))
        if shards is None:
            return rows
        wanted = F.lit(False)
        for s in self.segments:
            if s.name in shards:
                some = F.col("segment") == s.name
                if len(shards[s.name]) < s.shards:
                    some = some & F.col("shard").isin(sorted(shards[s.name]))
                wanted = wanted | some
        return rows.filter(wanted)

    def release(self) -> None:
        """Free what lookups have kept."""
        for df in self._held:
            df.unpersist()
        self._held.clear()

    # -- growth -------------------------------------------------------------

    def reopen(self, own: Batch) -> None:
        """Take a batch that is about to be written again out of the cover."""
        if own in self.covered:
            self.covered.discard(own)
            self.dropped.add(own)
            self._save()

    def follow(self, own: Batch | None = None) -> None:
        """Cover the partitions other than ``own`` once more than ``recent`` of them are not.

        They must be complete: earlier batches of the running source, and
        sources that are not running.
        """
        new = self.partitions() - self.covered - {own}
        if len(new) > self.recent:
            self.cover(new)

    def cover(self, batches: set[Batch]) -> None:
        """Add the ids of these partitions as one segment, then merge full levels."""
        again = batches & self.dropped
        if again:   # their former ids must not come back into the cover
            self._rewrite(self.segments, 0 if not self.segments else max(s.level for s in self.segments))
        rows = self._read_partitions(batches).filter(F.col(self.key).isNotNull())
        self._add(rows, 0)
        self.covered |= batches
        self._save()
        level = 0
        while sum(s.level == level for s in self.segments) >= self.fanout:
            self._rewrite([s for s in self.segments if s.level == level], level + 1)
            self._save()
            level += 1

    def _add(self, rows: DataFrame, level: int) -> None:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            segment = Segment.sized(level, rows.count(), self.shard_ids)
            if not segment.ids:
                return
            shard, number, bits = _place(self.key, F.lit(segment.shards), F.lit(segment.maps))
            placed = rows.select(self.key, "source_id", "batch_id", shard).repartition("shard")
            (placed.sortWithinPartitions("shard", self.key).write.partitionBy("shard")
                   .parquet(f"{self.root}/ids/segment={segment.name}"))
            spots = rows.select(shard, number, F.explode(bits).alias("bit"))
            maps = spots.groupBy("shard", "map").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
            (maps.repartition("shard").write.partitionBy("shard")
                 .parquet(f"{self.root}/filters/segment={segment.name}"))
            self.segments.append(segment)
        finally:
            rows.unpersist()

    def _rewrite(self, segments: list[Segment], level: int) -> None:
        """Merge ``segments`` into one, without ids of dropped batches."""
        if not segments:
            self.dropped.clear()
            return
        base = f"{self.root}/ids"
        rows = (self.spark.read.option("basePath", base)
                    .schema(f"{self.key} string, source_id string, batch_id long, segment string, shard long")
                    .parquet(*[f"{base}/segment={s.name}" for s in segments]))
        for source, number in sorted(self.dropped):
            rows = rows.filter(~((F.col("source_id") == source) & (F.col("batch_id") == number)))
        whole = len(segments) == len(self.segments)
        self.segments = [s for s in self.segments if s not in segments]
        self._add(rows.select(self.key, "source_id", "batch_id"), level)
        if whole:
            self.dropped.clear()


def seen_before(index: IdIndex, batch: DataFrame, own: Batch) -> DataFrame:
    """Ids of ``batch`` that other batches have stored; brings the index up to date first."""
    index.reopen(own)
    index.follow(own)
    return index.lookup(batch, own)
