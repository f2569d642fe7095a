"""Merging of micro-batch folders and expiry of old rows (STR-8, SNK-2…SNK-4).

A stream that writes one folder per micro-batch leaves many small files, and
dead letters are kept for seven days only. ``maintain`` merges folders into
segments, segments level by level, and moves the horizon behind which rows
have expired; ``vacuum`` deletes what nobody reads any more. Both may run
beside the stream and beside readers:

- the newest batch of a source may still be written again after a failure and
  is left alone, as is everything that ``settled`` does not name;
- a segment is complete before the manifest names it, and the manifest is
  replaced as a whole, so a crash in between changes nothing;
- folders are deleted a grace period after the manifest left them, so a query
  planned before that still finds its files.

One maintenance job at a time works on a table. A source that starts again
with batch 0 needs a new name, as its former batches may have been merged.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseline.schemas import DEAD_LETTER, EVENTS_TABLE, SESSION_METRICS
from pulseline.session import delete_path, list_names
from pulseline.sources.batch_table import (
    Batch, Manifest, Segment, batch_partitions, kept, load_manifest, partition_path, read_batch_table,
    read_partitions, save_manifest, segment_path, segments_path,
)
from pulseline.streaming.id_index import IdIndex
from pulseline.streaming.processor import Layout
from pulseline.streaming.replay import DEAD_LETTER_RETENTION_DAYS

MERGE_AT = 16               # settled folders that are merged into a segment
FANOUT = 4                  # segments of a level that are merged into one
FILE_ROWS = 1_000_000       # rows in a merged file, about
FULL_ROWS = 4_000_000_000   # segments that would exceed this are left as they are
GRACE_SECONDS = 24 * 3600


def settled_partitions(spark: SparkSession, path: str) -> set[Batch]:
    """The batch folders of a table without the newest one of each source."""
    found = batch_partitions(spark, path)
    newest = {}
    for source, number in found:
        newest[source] = max(number, newest.get(source, number))
    return {(s, n) for s, n in found if n < newest[s]}


def maintain(spark: SparkSession, path: str, schema: T.StructType, time_column: str,
             keep_days: int | None = None, now=None, settled: set[Batch] | None = None,
             merge_at: int = MERGE_AT, fanout: int = FANOUT, file_rows: int = FILE_ROWS) -> Manifest:
    """Merge settled folders and full levels, and expire rows older than ``keep_days``.

    ``now`` (a datetime or text, UTC) defaults to the newest time in the table.
    ``settled`` limits the folders that may be merged further: for the event
    table give the batches that its id index covers (``IdIndex.covered``).
    Every row is rewritten once per level, so a logarithmic number of times.
    """
    manifest = load_manifest(spark, path)
    before = (manifest.horizon, list(manifest.segments), set(manifest.covered))
    manifest.time = time_column
    if keep_days is not None:
        since = _horizon(spark, path, schema, time_column, keep_days, now)
        manifest.horizon = max(filter(None, (since, manifest.horizon)), default=None)   # never back
        expired = [s for s in manifest.segments if s.last is not None and manifest.horizon and s.last < manifest.horizon]
        _retire(manifest, [segment_path(path, s) for s in expired])
        manifest.segments = [s for s in manifest.segments if s not in expired]
    ripe = settled_partitions(spark, path) - manifest.covered
    if settled is not None:
        ripe &= settled
    if len(ripe) >= merge_at:
        rows = read_partitions(spark, path, schema, ripe)
        manifest.segments += _write(spark, path, kept(rows, manifest), manifest, 0, file_rows)
        manifest.covered |= ripe
        _retire(manifest, [partition_path(spark, path, b) for b in sorted(ripe)])
    level = 0
    while level <= max((s.level for s in manifest.segments), default=-1):
        alike = [s for s in manifest.segments if s.level == level]
        if len(alike) >= fanout and sum(s.rows for s in alike) <= FULL_ROWS:
            rows = spark.read.schema(schema).parquet(*[segment_path(path, s) for s in alike])
            merged = _write(spark, path, kept(rows, manifest), manifest, level + 1, file_rows)
            manifest.segments = [s for s in manifest.segments if s not in alike] + merged
            _retire(manifest, [segment_path(path, s) for s in alike])
        level += 1
    if before != (manifest.horizon, manifest.segments, manifest.covered):
        save_manifest(spark, path, manifest)
    return manifest


def vacuum(spark: SparkSession, path: str, grace_seconds: float = GRACE_SECONDS) -> int:
    """Delete folders that the manifest left more than the grace period ago; returns how many."""
    manifest = load_manifest(spark, path)
    until = int((time.time() - grace_seconds) * 1000)
    old = [folder for folder, since in manifest.retired if since <= until]
    for folder in old:
        delete_path(spark, folder)
    if old:
        manifest.retired = [(folder, since) for folder, since in manifest.retired if since > until]
        save_manifest(spark, path, manifest)
    manifests = f"{segments_path(path)}/manifest"
    for name in list_names(spark, manifests):   # a reader takes the newest; one before it may be in use
        number = name.removesuffix(".json")
        if number.isdigit() and int(number) < manifest.version - 1:
            delete_path(spark, f"{manifests}/{name}")
    return len(old)


def maintain_layout(spark: SparkSession, layout: Layout, keep_days: int = DEAD_LETTER_RETENTION_DAYS,
                    grace_seconds: float = GRACE_SECONDS, merge_at: int = MERGE_AT, now=None,
                    stopped: bool = False) -> None:
    """Maintain the tables of a processing job: events (what the id index covers), KPIs, dead letters.

    A running stream brings its id index up to date itself. ``stopped`` says
    that none is running; the index then takes up all settled folders first.
    """
    index = IdIndex(spark, layout.events, layout.ids)
    if stopped:
        fresh = settled_partitions(spark, layout.events) - index.covered
        if fresh:
            index.cover(fresh)
    indexed = index.covered
    for path, schema, at, days, settled in (
            (layout.events, EVENTS_TABLE, "ts", None, indexed),
            (layout.metrics, SESSION_METRICS, "window_end", None, None),
            (layout.dead_letters, DEAD_LETTER, "ingest_ts", keep_days, None)):
        if batch_partitions(spark, path) or load_manifest(spark, path).version:
            maintain(spark, path, schema, at, days, now, settled, merge_at)
            vacuum(spark, path, grace_seconds)


def _horizon(spark: SparkSession, path: str, schema: T.StructType, column: str, keep_days: int, now) -> str | None:
    if now is None:
        end = F.max(column)
        rows = read_batch_table(spark, path, schema)
    else:
        end = F.max(F.lit(now.isoformat(sep=" ") if hasattr(now, "isoformat") else str(now)).cast("timestamp_ntz"))
        rows = spark.range(1)
    since = rows.agg((end - F.expr(f"INTERVAL {keep_days} DAYS")).alias("since")).first().since
    return None if since is None else since.isoformat(sep=" ", timespec="microseconds")


def _retire(manifest: Manifest, folders: list[str]) -> None:
    manifest.retired += [(folder, int(time.time() * 1000)) for folder in folders]


def _write(spark: SparkSession, path: str, rows: DataFrame, manifest: Manifest, level: int,
           file_rows: int) -> list[Segment]:
    """Write rows as one segment, cut and sorted by time so that time filters skip files; none for no rows."""
    at = F.col(manifest.time)
    undated = F.max(at.isNull())
    size, last, any_undated = rows.agg(F.count(F.lit(1)), F.max(at), undated).first()
    if not size:
        return []
    # rows without time never expire, so neither does a segment that holds one
    segment = Segment(uuid.uuid4().hex, level, size,
                      None if any_undated else last.isoformat(sep=" ", timespec="microseconds"))
    files = -(-size // file_rows)
    # equal times, however many, are spread as well
    spread = rows.repartitionByRange(files, manifest.time, F.xxhash64("batch_id", *_orderable(rows)))
    (spread.sortWithinPartitions(manifest.time).write.option("maxRecordsPerFile", 2 * file_rows)
           .parquet(segment_path(path, segment)))
    return [segment]


def _orderable(rows: DataFrame) -> list[str]:
    """Columns that tell rows of one batch and time apart for the cut."""
    return [f.name for f in rows.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
