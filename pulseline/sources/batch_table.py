"""Tables of micro-batch partitions, some of them merged into segments.

A table sink writes one ``source_id=<s>/batch_id=<n>`` folder per micro-batch.
``streaming.maintenance`` merges settled folders into segments, a few sorted
files in ``<path>-segments``, and says in a manifest, one small file replaced
as a whole, which batches the segments hold and since when rows are kept.
``read_batch_table`` reads the segments and the folders of all other batches,
so a row is seen once whether its folder has been merged, still lies beside
its segment, or is gone.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseline.session import list_names, read_text, write_text

Batch = tuple[str, int]     # source and number of a micro-batch


@dataclass(frozen=True)
class Segment:
    """A folder of merged rows; ``last`` is the time of its newest row (null without times)."""
    name: str
    level: int
    rows: int
    last: str | None


@dataclass
class Manifest:
    """What is current in a table: segments, the batches they hold, folders no longer read."""
    segments: list[Segment] = field(default_factory=list)
    covered: set[Batch] = field(default_factory=set)
    retired: list[tuple[str, int]] = field(default_factory=list)   # folder, epoch millis of its end
    time: str | None = None
    horizon: str | None = None                                     # rows before it have expired
    version: int = 0


def segments_path(path: str) -> str:
    return f"{path}-segments"


def segment_path(path: str, segment: Segment) -> str:
    return f"{segments_path(path)}/segment={segment.name}"


def partition_path(spark: SparkSession, path: str, batch: Batch) -> str:
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(batch[0])
    return f"{path}/source_id={escaped}/batch_id={batch[1]}"


def batch_partitions(spark: SparkSession, path: str) -> set[Batch]:
    """Micro-batch folders of a table (names only, no files)."""
    out = set()
    for source in list_names(spark, path):
        if source.startswith("source_id="):
            for batch in list_names(spark, f"{path}/{source}"):
                if batch.startswith("batch_id="):
                    out.add((unquote(source.removeprefix("source_id=")), int(batch.removeprefix("batch_id="))))
    return out


def load_manifest(spark: SparkSession, path: str) -> Manifest:
    """The current manifest, an empty one if the table was never merged."""
    folder = f"{segments_path(path)}/manifest"
    versions = [int(n.removesuffix(".json")) for n in list_names(spark, folder) if n.endswith(".json")]
    if not versions:
        return Manifest()
    state = json.loads(read_text(spark, f"{folder}/{max(versions)}.json"))
    return Manifest([Segment(**s) for s in state["segments"]],
                    {(s, n) for s, spans in state["covered"].items() for lo, hi in spans for n in range(lo, hi + 1)},
                    [tuple(r) for r in state["retired"]], state["time"], state["horizon"], max(versions))


def save_manifest(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Commit the state as the next version (runs of batch numbers as spans)."""
    spans: dict[str, list[list[int]]] = {}
    for source, number in sorted(manifest.covered):
        of = spans.setdefault(source, [])
        if of and of[-1][1] == number - 1:
            of[-1][1] = number
        else:
            of.append([number, number])
    manifest.version += 1
    write_text(spark, f"{segments_path(path)}/manifest/{manifest.version}.json", json.dumps({
        "segments": [asdict(s) for s in manifest.segments], "covered": spans, "retired": manifest.retired,
        "time": manifest.time, "horizon": manifest.horizon}))


def read_partitions(spark: SparkSession, path: str, schema: T.StructType, batches) -> DataFrame:
    paths = [partition_path(spark, path, b) for b in sorted(batches)]
    return spark.read.option("basePath", path).schema(schema).parquet(*paths)


def kept(rows: DataFrame, manifest: Manifest) -> DataFrame:
    """``rows`` without expired ones; rows without time never expire."""
    if manifest.horizon is None:
        return rows
    at = F.col(manifest.time)
    return rows.filter(at.isNull() | (at >= F.lit(manifest.horizon).cast("timestamp_ntz")))


def read_batch_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All current rows of the table, by its declared schema.

    Filters on time, source and batch reach both scans. The files are those of
    the moment of the call: folders that are merged later stay readable until
    ``maintenance.vacuum`` deletes them after its grace period.
    """
    manifest = load_manifest(spark, path)
    if not manifest.version:
        return spark.read.schema(schema).parquet(path)
    others = batch_partitions(spark, path) - manifest.covered
    parts = [read_partitions(spark, path, schema, others)] if others else []
    if manifest.segments:
        parts.append(spark.read.schema(schema).parquet(*[segment_path(path, s) for s in manifest.segments]))
    if not parts:
        return spark.createDataFrame([], schema)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return kept(rows, manifest)
