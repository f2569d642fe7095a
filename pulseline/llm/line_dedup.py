"""Line deduplication over levelled sorted runs of line hashes (operator 12), in DataFrame functions only.

The distinct lines seen so far lie in runs: tables of 128-bit line hashes,
bucketed and sorted by hash. Documents come in batches, the largest ids
first. Each batch is merge-anti-joined with the runs: hashes that no run
holds are new, their line belongs to the largest document that holds it, and
they become a run of their own. As soon as a level has ``fanout`` runs they
are merged into one run of the next level, so that a batch meets a number of
runs that is logarithmic in the number of batches. As many buckets are made
as the session has shuffle partitions, so neither side of those joins is
shuffled again.

All other occurrences of a line are repeats, counted by document. Lines with
enough of them are dropped everywhere but in the document that was first.
Every count combines map-side before its shuffle; lines so common that their
rows would crowd a task are few by a stated bound and joined by broadcast.

Ids are integers (a text id fails the cast). Defined results: a null or empty
text is one empty line. Rows that repeat an id are one document; a row
without id holds no line and keeps all its own. A text whose lines all go is
empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseline.llm.common import join_counted, staged
from pulseline.session import scratch_path

MIN_DOCS, MIN_CHARS = 3, 20
BATCHES, FANOUT = 4, 2
HASH = ["h1", "h2"]
SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


class LineRuns:
    """Levelled sorted runs of the distinct line hashes seen so far (``h1, h2, last``)."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.tables: list[str] = []

    def sorted_table(self, rows: DataFrame, name: str) -> str:
        """``rows`` written once below the shared folder, bucketed and sorted by hash."""
        table = f"pulseline_{name}_{uuid.uuid4().hex}"
        (rows.write.format("parquet").bucketBy(self.buckets, *HASH).sortBy(*HASH)
             .option("path", scratch_path(self.spark, name)).saveAsTable(table))
        self.tables.append(table)
        return table

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """Rows of ``keys`` whose hash is in no run: one merge anti-join a run."""
        for run in self.runs():
            keys = keys.join(self.spark.table(run).select(*HASH).hint("merge"), HASH, "left_anti")
        return keys

    def add(self, fresh: DataFrame) -> DataFrame:
        """Add hashes that no run holds as a run of the lowest level; returns that run."""
        run = self.sorted_table(fresh, "run")
        self._place(run, 0)
        return self.spark.table(run)

    def _place(self, run: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._all(self.levels[level])
            self.levels[level] = []
            self._place(self.sorted_table(merged.repartition(*HASH), "run"), level + 1)

    def _all(self, runs: list[str]) -> DataFrame:
        out = self.spark.table(runs[0])
        for run in runs[1:]:
            out = out.unionByName(self.spark.table(run))
        return out

    def merged(self) -> DataFrame | None:
        """All hashes (no run shares one with another), None before the first run."""
        return self._all(self.runs()) if self.runs() else None

    def forget(self) -> None:
        """Take the tables out of the catalog; their files stay in the scratch folder."""
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def _lines(docs: DataFrame, key: str, text: str, min_chars: int, batches: int) -> DataFrame:
    """``doc_id, version, pos, h1, h2, batch`` of all lines long enough, batch 0 having the largest ids.

    ``version`` tells the texts of a repeated id apart.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("t").isNotNull())
    shares = [k / batches for k in range(1, batches)]
    cuts = rows.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 1000)).first()[0] if shares else None
    batch = F.lit(0)
    for cut in cuts or []:
        batch = batch + (F.col("doc_id") <= F.lit(cut)).cast("int")
    lines = rows.select("doc_id", F.xxhash64("t").alias("version"), batch.alias("batch"),
                        F.posexplode(F.split("t", "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc_id", "version", "batch", "pos", line_key(F.col("line")).alias("k"))
    return keyed.filter(F.length("k") >= min_chars).select(
        "doc_id", "version", "pos", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(1), "k").alias("h2"), "batch")


def _by_hash(lines: DataFrame) -> DataFrame:
    """Per hash: its documents, its rows and the largest document."""
    docs = lines.groupBy("doc_id", *HASH).agg(F.count(F.lit(1)).alias("rows"))
    return docs.groupBy(*HASH).agg(F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("docs"),
                                   F.sum("rows").alias("rows"))


def repeated_lines(lines: DataFrame, min_docs: int, batches: int, fanout: int) -> DataFrame:
    """``h1, h2, last, rows`` of the lines found in ``min_docs`` documents or more."""
    spark = lines.sparkSession
    store, repeats = LineRuns(spark, fanout), None
    for number in range(batches):
        own = spark.table(store.sorted_table(_by_hash(lines.filter(F.col("batch") == number)), "batch"))
        fresh = store.add(store.unseen(own).select(*HASH, "last"))
        new = fresh.select(*HASH, F.lit(1).alias("first")).hint("merge")
        again = (own.join(new, HASH, "left")
                    .select(*HASH, (F.col("docs") - F.coalesce("first", F.lit(0))).alias("again"), "rows"))
        again = staged(again.filter("again > 0 or rows > 1"), "repeats")
        repeats = again if repeats is None else repeats.unionByName(again)
    # a hash with a single line in its batch is new or counted above; one row more covers it
    often = (repeats.groupBy(*HASH).agg(F.sum("again").alias("again"), (F.sum("rows") + 1).alias("rows"))
                    .filter(F.col("again") >= min_docs - 1))
    out = staged(store.merged().join(often, HASH).select(*HASH, "last", "rows"), "repeated")
    store.forget()
    return out


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                        min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_dropped`` and ``kept``, the text without its repeated lines."""
    spark = docs.sparkSession
    path = scratch_path(spark, "lines")
    found = _lines(docs, key, text, min_chars, batches)
    found.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(found.schema).parquet(path)
    often = repeated_lines(lines, min_docs, batches, fanout)
    gone = join_counted(lines.select("doc_id", "version", "pos", *HASH), often, HASH, "rows", lines.count())
    gone = staged(gone.filter(F.col("doc_id") < F.col("last")).groupBy("doc_id", "version")
                      .agg(F.sort_array(F.collect_set("pos")).alias("gone")), "dropped")

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    rows = rows.withColumn("version", F.xxhash64("t")).join(gone, ["doc_id", "version"], "left")
    rows = rows.select("doc_id", "t", "gone", F.split("t", "\n", -1).alias("lines"))
    left = F.transform(F.sequence(F.lit(0), F.size("gone")), lambda i: F.slice(
        "lines", F.when(i == 0, 1).otherwise(F.get("gone", i - 1) + 2),
        F.coalesce(F.get("gone", i), F.size("lines")) - F.when(i == 0, 0).otherwise(F.get("gone", i - 1) + 1)))
    return rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                       F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
                       F.when(F.col("gone").isNull(), F.col("t")).otherwise(F.array_join(F.flatten(left), "\n")).alias("kept"))
