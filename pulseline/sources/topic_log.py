"""The topic as a log, read in batches bounded by records (SRC-3, STR-1, STR-2).

A log is a folder of segments; each segment holds one folder per topic
partition with files sorted by offset. ``append_log`` writes a segment in one
distributed job. The data source ``topic_log`` counts, for each topic
partition, the records read so far. A micro-batch takes at most
``maxRecords`` more over all partitions, shared out by what each still holds,
so it is bounded in records whatever the files hold. It is closed when it is
full, or, with ``lingerSeconds``, that long after its first record could be
read.

The topic can be read by several queries at once, as by the consumers of a
group: consumer ``k`` of ``n`` takes the topic partitions whose number leaves
``k`` when divided by ``n``, under a checkpoint of its own, and the bound holds
for each of its micro-batches (the poll size is one consumer's). With the
batches bounded, the rate grows with the consumers that run, up to one a
partition. ``drain_group`` runs a few of them at a time: a running query keeps
a Python process on the driver, which must report to Spark within ten seconds
of its start.

Only file footers are read to plan a batch, each once. The records are read
in tasks, by row group, as Arrow batches. A restart goes on from the offsets
in the query's checkpoint (option ``checkpoint``), so no batch is repeated or
left out beyond what Spark itself repeats.

Run it with a processing-time trigger and ``drain`` to read what is there:
``availableNow`` makes one batch of a source that bounds its own batches.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import BoundedSemaphore, Lock

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from pulseline.schemas import TOPIC
from pulseline.session import list_names

MAX_RECORDS = 1_000      # the reference's poll size
TASK_RECORDS = 5_000     # topic partitions are read together in a task up to so many records
AT_ONCE = 4              # consumers of a group that one driver runs at a time
STARTING = 2             # of them, whose Python process on the driver is being started
SCHEMA = TOPIC.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")


def append_log(records: DataFrame, path: str) -> str:
    """Append topic records to the log at ``path`` as one segment; returns the segment's folder.

    Each topic partition is range-split by offset over tasks, so a hot one is
    several files; their order is that of their smallest offsets.
    """
    spark = records.sparkSession
    taken = [int(n.removeprefix("segment-")) for n in list_names(spark, path) if n.startswith("segment-")]
    folder = f"{path}/segment-{max(taken, default=-1) + 1:012d}"
    columns = [f.name for f in TOPIC.fields]
    (records.select(*columns).repartitionByRange("partition", "offset")
            .sortWithinPartitions("partition", "offset")
            .write.partitionBy("partition").parquet(folder))
    return folder


@dataclass
class Slice(InputPartition):
    """Records that one task reads: (file, first record, end) of each file, in log order by topic partition."""
    files: list

    @property
    def records(self) -> int:
        return sum(high - low for _, low, high in self.files)


def share_out(lag: dict[int, int], most: int) -> dict[int, int]:
    """Records to take from each partition: all if they fit, else in proportion to what it holds."""
    total = sum(lag.values())
    if total <= most:
        return dict(lag)
    take = {p: n * most // total for p, n in lag.items()}
    for p in sorted(lag, key=lambda p: (-(lag[p] * most % total), p)):
        if sum(take.values()) == most:
            break
        take[p] += 1 if take[p] < lag[p] else 0
    return take


class TopicLogReader(DataSourceStreamReader):
    """Offsets are records read so far of each topic partition."""

    def __init__(self, path: str, most: int, linger: float, checkpoint: str | None,
                 consumer: int = 0, consumers: int = 1):
        self.path, self.most, self.linger, self.checkpoint = path, most, linger, checkpoint
        self.consumer, self.consumers = consumer, consumers
        self.files: dict[int, list[tuple[str, int]]] = {}    # partition -> (file, records) in log order
        self.segments: set[str] = set()
        self.reached: dict[int, int] | None = None
        self.waiting: float | None = None

    def _fs(self, path: str):
        from pyarrow import fs
        if "://" in path or path.startswith("file:"):
            return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if "://" not in path else path)
        return fs.LocalFileSystem(), path

    def _list(self, path: str) -> list[str]:
        from pyarrow import fs
        system, where = self._fs(path)
        return sorted(i.base_name for i in system.get_file_info(fs.FileSelector(where, allow_not_found=True)))

    def _follow(self) -> None:
        """Read the footers of complete segments that are not known yet."""
        import pyarrow.parquet as pq
        for segment in self._list(self.path):
            folder = f"{self.path}/{segment}"
            if not segment.startswith("segment-") or segment in self.segments:
                continue
            names = self._list(folder)
            if "_SUCCESS" not in names:
                break           # still being written; later segments wait for it
            self.segments.add(segment)
            for name in names:
                if not name.startswith("partition="):
                    continue
                if int(name.removeprefix("partition=")) % self.consumers != self.consumer:
                    continue    # another consumer's
                found = []
                for file in self._list(f"{folder}/{name}"):
                    if file.endswith(".parquet"):
                        path = f"{folder}/{name}/{file}"
                        system, where = self._fs(path)
                        meta = pq.read_metadata(where, filesystem=system)
                        column = meta.schema.names.index("offset")
                        stats = meta.row_group(0).column(column).statistics if meta.num_row_groups else None
                        found.append((stats.min if stats is not None else 0, path, meta.num_rows))
                self.files.setdefault(int(name.removeprefix("partition=")), []).extend(
                    (path, rows) for _, path, rows in sorted(found))

    def _recorded(self) -> dict[int, int]:
        """The last offsets that the query has planned, by its checkpoint."""
        if self.checkpoint:
            numbers = [int(n) for n in self._list(f"{self.checkpoint}/offsets") if n.isdigit()]
            if numbers:
                system, where = self._fs(f"{self.checkpoint}/offsets/{max(numbers)}")
                with system.open_input_stream(where) as stream:
                    last = stream.read().decode().strip().splitlines()[-1]
                return {int(p): n for p, n in json.loads(last).items()}
        return {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        self._follow()
        if self.reached is None:
            self.reached = self._recorded()
        held = {p: sum(n for _, n in files) for p, files in self.files.items()}
        lag = {p: n - self.reached.get(p, 0) for p, n in held.items() if n > self.reached.get(p, 0)}
        if not lag:
            self.waiting = None
        elif sum(lag.values()) < self.most and self.linger:
            now = time.monotonic()
            self.waiting = now if self.waiting is None else self.waiting
            if now - self.waiting < self.linger:
                lag = {}
        if lag:
            self.waiting = None
            take = share_out(lag, self.most)
            self.reached = {**self.reached, **{p: self.reached.get(p, 0) + n for p, n in take.items() if n}}
        return {str(p): n for p, n in sorted(self.reached.items())}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        if any(int(p) not in self.files for p in end):
            self._follow()      # a restarted query plans its last batch again before it asks for offsets
        out = []
        for p, stop in end.items():
            first, at, files = start.get(p, 0), 0, []
            for path, rows in self.files.get(int(p), []):
                low, high = max(first, at), min(stop, at + rows)
                if low < high:
                    files.append((path, low - at, high - at))
                at += rows
            if files:
                part = Slice(files)
                if out and out[-1].records + part.records <= TASK_RECORDS:
                    out[-1].files.extend(files)     # a task for a few records of each partition would cost more than they do
                else:
                    out.append(part)
        return out

    def read(self, partition: Slice):
        import pyarrow as pa
        import pyarrow.parquet as pq
        for path, low, high in partition.files:
            topic_partition = int(path.split("/")[-2].removeprefix("partition="))
            system, where = self._fs(path)
            with system.open_input_file(where) as source:
                file = pq.ParquetFile(source)
                at = 0
                for g in range(file.num_row_groups):
                    rows = file.metadata.row_group(g).num_rows
                    first, last = max(low - at, 0), min(high - at, rows)
                    if first < last:
                        part = file.read_row_group(g, columns=["key", "value", "offset", "timestamp"]).slice(first, last - first)
                        number = pa.array([topic_partition] * part.num_rows, pa.int32())
                        whole = pa.table({"key": part["key"], "value": part["value"], "partition": number,
                                          "offset": part["offset"], "timestamp": part["timestamp"].cast(pa.timestamp("us"))})
                        yield from whole.to_batches()
                    at += rows


class TopicLog(DataSource):
    """``spark.readStream.format("topic_log")`` over a log folder."""

    @classmethod
    def name(cls) -> str:
        return "topic_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TopicLogReader:
        option = {k.lower(): v for k, v in self.options.items()}
        return TopicLogReader(option["path"].rstrip("/"), int(option.get("maxrecords", MAX_RECORDS)),
                              float(option.get("lingerseconds", 0)), option.get("checkpoint"),
                              int(option.get("consumer", 0)), int(option.get("consumers", 1)))


# A stream's tasks are written out with the environment of its registration, which Spark changes when it starts
# a Python process for it; shared by two streams, one could be written out while the other changes it.
_REGISTERING = Lock()


def log_stream(spark: SparkSession, path: str, checkpoint: str, max_records: int = MAX_RECORDS,
               linger_seconds: float = 0, consumer: int = 0, consumers: int = 1) -> DataFrame:
    """Topic records of the log from the earliest, at most ``max_records`` in a micro-batch.

    ``checkpoint`` is the checkpoint folder of the query that will read it;
    with ``consumers`` it reads the topic partitions of the one numbered ``consumer``.
    """
    import pulseline.sources.topic_log as module
    with _REGISTERING:      # a stream keeps what was registered last when it was loaded
        cloudpickle.register_pickle_by_value(module)     # workers need not have this package
        try:
            spark.dataSource.register(TopicLog)
        finally:
            cloudpickle.unregister_pickle_by_value(module)
        return (spark.readStream.format("topic_log").option("maxRecords", str(max_records))
                     .option("lingerSeconds", str(linger_seconds)).option("checkpoint", checkpoint)
                     .option("consumer", str(consumer)).option("consumers", str(consumers)).load(path))


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait until the query has read all there is, and stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def drain_group(start: Callable[[int], StreamingQuery], consumers: int, at_once: int = AT_ONCE) -> None:
    """Drain consumers 0 to ``consumers`` - 1, each started by ``start``, ``at_once`` of them at a time.

    ``STARTING`` of them at most wait for their source to come up, so that the
    start-up of many does not hold up each one's beyond Spark's ten seconds.
    """
    starting = BoundedSemaphore(STARTING)

    def consume(k: int) -> None:
        with starting:
            query = start(k)
            while query.isActive and query.status["message"].startswith("Initializing"):
                time.sleep(0.02)
        drain(query)

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        for _ in pool.map(consume, range(consumers)):     # raises the first failure; consumers not begun are left
            pass
