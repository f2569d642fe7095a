"""Publish job (STR-10, SNK-1, SRC-1): JSON requests → validated → encoded → topic.

Ingest and processing are separate jobs over one code base: this job only
validates and publishes; ``processor.run_stream`` consumes the topic.
Rejected requests go to dead letters with their reason and every violation.
Delivery is at-least-once: a retried batch may publish a record twice, which
the consumer's keep-first dedup by ``event_id`` absorbs. Requests without a
number of their own are numbered in the order they arrived, so the consumer
keeps the first arrival.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseline.functions.codec import encode_binary
from pulseline.operators.quarantine import split_valid
from pulseline.schemas import HEARTBEAT_COLUMNS
from pulseline.session import list_names, read_text, write_text
from pulseline.sources.json_source import decode_json
from pulseline.streaming.sinks import write_dead_letters, write_topic


def with_arrival(requests: DataFrame, first: int = 0,
                 order=("file_time", "file_path")) -> tuple[DataFrame, DataFrame]:
    """``request_id`` from ``first`` on, in the order of file time, file and line; and the rows to unpersist.

    The rows of a batch are range-sorted (no single task) and written once to
    memory and disk; each sorted partition numbers its own rows from the sum
    of the counts before it, so the numbers have no gaps and never run out.
    The driver sees one count a partition.
    """
    lines = requests.withColumn("__line", F.monotonically_increasing_id())
    rows = (lines.orderBy(*order, "__line").withColumn("__place", F.monotonically_increasing_id())
                 .drop("__line", *order).persist(StorageLevel.MEMORY_AND_DISK))
    part, row = F.shiftright("__place", 33), F.col("__place").bitwiseAND((1 << 33) - 1)
    counts = sorted(tuple(r) for r in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1))).collect())
    starts, at = [], first
    for number, count in counts:
        starts.append((number, at))
        at += count
    before = F.broadcast(rows.sparkSession.createDataFrame(starts, "__part bigint, __first bigint"))  # a row a partition
    return (rows.join(before, part == F.col("__part"))
                .withColumn("request_id", F.col("__first") + row).drop("__place", "__part", "__first")), rows


def _numbered(spark, path: str, batch_id: int) -> int:
    """The number that the first request of a batch gets: one past those of all earlier batches."""
    ends = [int(n.removesuffix(".txt")) for n in list_names(spark, path) if n.endswith(".txt")]
    earlier = [n for n in ends if n < batch_id]
    return int(read_text(spark, f"{path}/{max(earlier)}.txt")) if earlier else 0


def publish_batch(requests: DataFrame, batch_id: int, topic_path: str | None,
                  dead_letter_path: str, topic: str | None = None,
                  kafka_options: dict | None = None, arrivals: str | None = None) -> None:
    """Validate one batch of requests (``request_id, received_at, body``) and publish it.

    Without ``request_id`` the columns ``file_time`` and ``file_path`` give the
    order, and ``arrivals`` names the folder that keeps how far earlier batches
    were numbered (a retried batch gets the same numbers again).
    """
    spark, sorted_rows = requests.sparkSession, None
    if "request_id" not in requests.columns:
        first = _numbered(spark, arrivals, batch_id) if arrivals else 0
        requests, sorted_rows = with_arrival(requests, first)
    decoded = decode_json(requests).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = decoded.count()
        if total == 0:
            return
        if sorted_rows is not None and arrivals and f"{batch_id}.txt" not in list_names(spark, arrivals):
            write_text(spark, f"{arrivals}/{batch_id}.txt", str(first + total))
        accepted, rejected = split_valid(decoded)
        # only the wire fields and the record metadata cross into Python; the
        # message keeps the request's event time, the record its ingest time
        wire = accepted.select(F.col("request_id").alias("arrival_seq"), "received_at",
                               *HEARTBEAT_COLUMNS)
        dead = rejected.select(
            F.encode(F.col("body"), "UTF-8").alias("payload"), "reason",
            F.col("violations").alias("detail"), F.col("received_at").alias("ingest_ts"))
        # the two sinks are independent: submit them as concurrent jobs
        with ThreadPoolExecutor(max_workers=2) as pool:
            futures = [
                pool.submit(write_topic, encode_binary(wire), topic_path, topic=topic,
                            kafka_options=kafka_options, record_time="received_at"),
                pool.submit(write_dead_letters, dead, dead_letter_path, batch_id)]
            for f in futures:
                f.result()
    finally:
        decoded.unpersist()
        if sorted_rows is not None:
            sorted_rows.unpersist()


def publish_job(requests_stream: DataFrame, topic_path: str | None, dead_letter_path: str,
                checkpoint: str, available_now: bool = True,
                processing_time: str = "5 seconds", topic: str | None = None,
                kafka_options: dict | None = None):
    """Streaming publish: each micro-batch of requests through ``publish_batch``.

    ``processing_time`` defaults to the reference's 5-second flush interval.
    Arrival numbers are kept next to the checkpoint.
    """
    writer = (requests_stream.writeStream
              .foreachBatch(lambda df, bid: publish_batch(df, bid, topic_path, dead_letter_path,
                                                          topic, kafka_options, f"{checkpoint}_arrivals"))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time)
    return writer.start()
