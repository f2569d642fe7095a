"""Duplicate handling: keep-first by event id, store-once, existence (AGG-1, JN-1, JN-2, SET-1, FLT-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_events(df: DataFrame, key: str = "event_id",
                 arrival: str = "arrival_seq") -> DataFrame:
    """Keep the first arrival of every ``key`` (AGG-1).

    ``min(struct(arrival, …))`` is an aggregate with a partial step: each
    input partition keeps one row per id before the shuffle, so an id that
    repeats massively (e.g. every blank id of the binary path) never gathers
    in one task, unlike ``row_number`` over a window. Ties on ``arrival`` are
    broken by the remaining columns, so the result is deterministic.
    """
    others = [c for c in df.columns if c not in (key, arrival)]
    first = F.min(F.struct(F.col(arrival), *[F.col(c) for c in others])).alias("__first")
    return (df.groupBy(key).agg(first)
              .select(key, *[F.col(f"__first.{c}").alias(c) for c in [arrival, *others]])
              .select(*df.columns))


def merge_replay(live: DataFrame, backlog: DataFrame, key: str = "event_id",
                 arrival: str = "arrival_seq") -> DataFrame:
    """Replayed backlog appended to the live batch (bag union), then keep-first (SET-1)."""
    return dedup_events(live.unionByName(backlog), key, arrival)


def _stored_hits(stored_ids: DataFrame, probe_ids: DataFrame, key: str) -> DataFrame:
    """Stored ids that occur among the probe ids, scanning only the key column.

    A semi-join: Spark broadcasts the probe ids where their measured size is
    under its broadcast threshold (at run time, with adaptive execution), and
    shuffles both sides on the key otherwise.
    """
    return stored_ids.select(key).join(probe_ids.select(key), key, "left_semi")


def append_new_events(batch: DataFrame, stored: DataFrame | None, key: str = "event_id",
                      arrival: str = "arrival_seq") -> DataFrame:
    """Rows of ``batch`` the raw table does not hold yet (SNK-2, JN-1).

    In-batch duplicates keep their first arrival, then ids already stored are
    skipped (``ON CONFLICT DO NOTHING``): the first stored row wins.
    """
    fresh = dedup_events(batch, key, arrival)
    if stored is None:
        return fresh
    # the probe needs no first arrivals, only ids: distinct on the narrow column
    hits = _stored_hits(stored, batch.select(key).distinct(), key)
    return fresh.join(hits, key, "left_anti")


def save_event(event: DataFrame, stored: DataFrame, key: str = "event_id",
               arrival: str = "arrival_seq") -> DataFrame:
    """``stored`` with one more event unless its id is there: a batch of one row (SNK-5)."""
    return stored.unionByName(append_new_events(event, stored, key, arrival).select(*stored.columns))


def exists_by_event_id(probe: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    """Probe rows with a boolean ``exists`` column (JN-2)."""
    hits = _stored_hits(stored, probe, key).distinct().withColumn("exists", F.lit(True))
    return (probe.join(hits, key, "left")
                 .withColumn("exists", F.coalesce(F.col("exists"), F.lit(False))))


def events_by_id(stored: DataFrame, ids, key: str = "event_id") -> DataFrame:
    """Stored rows with the given ids (FLT-7).

    A Python list becomes an ``IN`` filter that reaches the parquet scan; a
    DataFrame of ids becomes a semi-join.
    """
    if isinstance(ids, DataFrame):
        return stored.join(ids.select(key), key, "left_semi")
    return stored.filter(F.col(key).isin(list(ids)))
