"""Deployable jobs (STR-10): ``spark-submit -m pulseline.cli <job> …`` or ``python -m pulseline.cli``.

* ``publish`` — JSON request files (one document per line) → validated →
  encoded → topic (parquet folder or Kafka); rejects to dead letters.
* ``process`` — topic → dead letters, new raw events, per-batch session KPIs.
* ``replay``  — a backlog folder through the same processing, into the same tables.
* ``recover`` — retained dead letters that decode now, into the same tables.

Ingest and processing run as separate applications from the same code base,
each with its own checkpoint. ``--once`` drains what is available and stops
(``availableNow``); otherwise the job runs on a processing-time trigger.
``publish`` numbers the requests by batch, file time, file and line; in a
parquet topic that number is the record's offset, so the consumer keeps the
first arrival of an id.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from pulseline.session import get_spark


def _kafka(args) -> dict | None:
    if not getattr(args, "kafka_bootstrap", None):
        return None
    opts = {"kafka.bootstrap.servers": args.kafka_bootstrap}
    if getattr(args, "kafka_subscribe", None):
        opts["subscribe"] = args.kafka_subscribe
    return opts


def _publish(spark, args):
    from pulseline.sources.json_source import read_json_heartbeats
    from pulseline.streaming.publish import publish_job
    stream = (read_json_heartbeats(spark, args.requests, streaming=True,
                                   max_files_per_trigger=args.max_files)
              .withColumn("received_at", F.current_timestamp().cast("timestamp_ntz")))
    return publish_job(stream, args.topic, args.dead_letters, args.checkpoint,
                       available_now=args.once, processing_time=args.trigger,
                       topic=args.kafka_topic, kafka_options=_kafka(args))


def _process(spark, args):
    from pulseline.sources.topic import heartbeat_stream
    from pulseline.streaming.processor import Layout, run_stream
    stream = heartbeat_stream(spark, args.topic, max_files_per_trigger=args.max_files,
                              kafka_options=_kafka(args),
                              max_offsets_per_trigger=args.max_offsets)
    return run_stream(stream, Layout(args.out), available_now=args.once,
                      processing_time=args.trigger, kpi_on=args.kpi_on,
                      lookup_horizon=args.lookup_horizon, validate_binary=args.validate_binary)


def _replay(spark, args):
    from pulseline.streaming.processor import Layout
    from pulseline.streaming.replay import replay
    return replay(spark, args.backlog, Layout(args.out), args.backlog_id,
                  slices_per_trigger=args.max_files, checkpoint=args.checkpoint)


def _recover(spark, args):
    from pulseline.streaming.processor import Layout
    from pulseline.sources.events import read_dead_letters
    from pulseline.streaming.replay import recover_dead_letters
    layout = Layout(args.out)
    dead = read_dead_letters(spark, args.dead_letters or layout.dead_letters)
    recover_dead_letters(dead, layout, args.run_id, args.retention_days).show(truncate=False)


def _maintain(spark, args):
    from pulseline.streaming.maintenance import maintain_layout
    from pulseline.streaming.processor import Layout
    maintain_layout(spark, Layout(args.out), args.retention_days, args.grace_seconds, args.merge_at,
                    stopped=args.stopped)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pulseline")
    sub = p.add_subparsers(dest="job", required=True)

    def common(sp):
        sp.add_argument("--once", action="store_true", help="drain available input and stop")
        sp.add_argument("--trigger", default="5 seconds", help="processing-time trigger")
        sp.add_argument("--max-files", type=int, default=None, help="files per micro-batch")
        sp.add_argument("--kafka-bootstrap", default=None)

    pub = sub.add_parser("publish", help="JSON requests -> topic")
    pub.add_argument("--requests", required=True)
    pub.add_argument("--topic", default=None, help="parquet topic folder (offline topic)")
    pub.add_argument("--kafka-topic", default=None)
    pub.add_argument("--dead-letters", required=True)
    pub.add_argument("--checkpoint", required=True)
    common(pub)

    pro = sub.add_parser("process", help="topic -> events, KPIs, dead letters")
    pro.add_argument("--topic", default=None, help="parquet topic folder")
    pro.add_argument("--kafka-subscribe", default=None)
    pro.add_argument("--max-offsets", type=int, default=None)
    pro.add_argument("--out", required=True)
    pro.add_argument("--kpi-on", choices=["decoded", "accepted"], default="decoded")
    pro.add_argument("--lookup-horizon", default=None, help='e.g. "2 days"')
    pro.add_argument("--validate-binary", action="store_true",
                     help="request constraints for decoded messages too")
    common(pro)

    rep = sub.add_parser("replay", help="backlog folder -> same tables as process")
    rep.add_argument("--backlog", required=True)
    rep.add_argument("--out", required=True)
    rep.add_argument("--backlog-id", required=True, help="name of this backlog, one per outage")
    rep.add_argument("--checkpoint", default=None)
    rep.add_argument("--max-files", type=int, default=4)

    rec = sub.add_parser("recover", help="retained dead letters -> same tables as process")
    rec.add_argument("--out", required=True)
    rec.add_argument("--dead-letters", default=None, help="default: the folder under --out")
    rec.add_argument("--run-id", required=True)
    rec.add_argument("--retention-days", type=int, default=7)

    mnt = sub.add_parser("maintain", help="merge batch folders, expire dead letters")
    mnt.add_argument("--out", required=True)
    mnt.add_argument("--retention-days", type=int, default=7)
    mnt.add_argument("--grace-seconds", type=float, default=24 * 3600)
    mnt.add_argument("--merge-at", type=int, default=16, help="settled folders that are merged")
    mnt.add_argument("--stopped", action="store_true", help="no stream is running on these tables")
    return p


def main(argv=None):
    args = parser().parse_args(argv)
    spark = get_spark(app=f"pulseline-{args.job}")
    q = {"publish": _publish, "process": _process, "replay": _replay, "recover": _recover,
         "maintain": _maintain}[args.job](spark, args)
    if q is not None and getattr(q, "isActive", False):
        q.awaitTermination()
    return q


if __name__ == "__main__":
    main()
