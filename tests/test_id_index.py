"""The stored-id index: exactness, bounded reads, retries and merges."""

import re

from pyspark.sql import functions as F

from pulseline.session import list_names, read_text, scratch_path, write_text
from pulseline.streaming.id_index import IdIndex, seen_before
from pulseline.streaming.sinks import write_batch_partition


def ids(spark, lo, hi, step=1):
    return spark.range(lo, hi, step).select(F.concat(F.lit("event-"), F.col("id")).alias("event_id"))


def numbers(df):
    return sorted(int(r.event_id.removeprefix("event-")) for r in df.collect())


def new_index(spark, root, **kw):
    return IdIndex(spark, f"{root}/events", f"{root}/index", **{"shard_ids": 64, "recent": 2, "fanout": 3, **kw})


def process(spark, root, batch, number, source="live", **kw):
    """One batch of a store-once job: new ids are written, stored ones are not."""
    index = new_index(spark, root, **kw)
    seen = seen_before(index, batch, (source, number))
    write_batch_partition(batch.distinct().join(seen, "event_id", "left_anti"), f"{root}/events", number, source)
    index.release()
    return index


def stored(spark, root):
    return spark.read.parquet(f"{root}/events")


def scans(df, kind):
    """Scans of one part of the index in the plan."""
    column = {"ids": "event_id", "filters": "bitmap"}[kind]
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line and f"{column}#" in line and "shard#" in line]


def test_ids_are_stored_once_over_many_batches(spark):
    root = scratch_path(spark, "index-test")
    for n in range(12):
        process(spark, root, ids(spark, n * 40, n * 40 + 60), n, source="live" if n % 3 else "replay x=1")
    assert numbers(stored(spark, root)) == list(range(11 * 40 + 60))
    index = new_index(spark, root)
    assert index.segments and max(s.level for s in index.segments) >= 1 and sum(s.shards for s in index.segments) > 4
    assert len(index.partitions() - index.covered) <= 3
    probe = ids(spark, 0, 1000, 7).unionByName(spark.createDataFrame([(None,), ("",), ("event--1",)], "event_id string"))
    assert numbers(index.lookup(probe)) == list(range(0, 500, 7))
    index.release()
    # nothing is lost when the index is gone: it follows the table
    assert numbers(IdIndex(spark, f"{root}/events", f"{root}/other").lookup(ids(spark, 490, 600))) == list(range(490, 500))


def test_retries_and_repeated_batches_do_not_meet_their_own_rows(spark):
    root = scratch_path(spark, "index-retry")
    for n in range(6):
        process(spark, root, ids(spark, n * 50, n * 50 + 50), n)
    index = new_index(spark, root)
    assert ("live", 1) in index.covered
    process(spark, root, ids(spark, 50, 100), 1)                 # the same batch again
    assert numbers(stored(spark, root)) == list(range(300))
    process(spark, root, ids(spark, 45, 60), 1)                  # with other records
    assert numbers(stored(spark, root).filter("batch_id = 1")) == list(range(50, 60))
    process(spark, root, ids(spark, 60, 100), 7)                 # so its former ids are free
    assert numbers(stored(spark, root)) == list(range(300))
    for n in range(8, 14):                                       # covered and merged again
        process(spark, root, ids(spark, 0, 310), n)
    assert numbers(stored(spark, root)) == list(range(310))
    assert not new_index(spark, root).dropped


def test_new_ids_read_filters_of_their_shards_only(spark):
    root = scratch_path(spark, "index-reads")
    write_batch_partition(ids(spark, 0, 6_000), f"{root}/events", 0)
    index = new_index(spark, root, shard_ids=500)
    index.cover({("live", 0)})
    assert index.segments[0].shards == 12
    fresh = index.lookup(ids(spark, 50_000, 50_010))
    assert numbers(fresh) == [] and len(scans(fresh, "ids")) == 0
    some = index.lookup(ids(spark, 100, 103))
    assert numbers(some) == [100, 101, 102]
    for scan in (*scans(some, "ids"), *scans(index._held[-1], "filters")):
        assert re.search(r"PartitionFilters: \[.*shard#\d+L? (IN \(|= )", scan)
    assert scans(some, "ids")
    index.release()


def test_reads_stay_flat_while_the_table_grows(spark):
    """Shards that a batch of eight new ids selects, over ever more stored ids."""
    root, picked = scratch_path(spark, "index-flat"), []
    for n, (lo, hi) in enumerate([(0, 300), (300, 1_500), (1_500, 9_000)]):
        write_batch_partition(ids(spark, lo, hi), f"{root}/events", n)
        index = new_index(spark, root, fanout=2, shard_ids=300)
        index.cover({("live", n)})
        touched = []
        index_pairs = index._pairs
        index._pairs = lambda rows: touched.append(index_pairs(rows)) or touched[-1]
        assert numbers(index.lookup(ids(spark, 200_000, 200_008))) == []
        index.release()
        shards = sum(len(v) for t in touched[:1] for v in t.values())
        picked.append((shards, len(index.segments), sum(s.shards for s in index.segments)))
        assert shards <= 8 * len(index.segments)
        assert sum(len(v) for t in touched[1:] for v in t.values()) <= 2
    assert picked[-1][2] >= 20 * picked[0][2] and picked[-1][1] <= 3


def test_manifest_is_replaced_as_a_whole(spark):
    root = scratch_path(spark, "manifest")
    assert list_names(spark, root) == []
    write_text(spark, f"{root}/a.json", "é one")
    assert read_text(spark, f"{root}/a.json") == "é one" and list_names(spark, root) == ["a.json"]
    # a draft left by a crash is not read
    write_text(spark, f"{root}/index/manifest/7.json.tmp", "{")
    assert new_index(spark, root).segments == []


def test_empty_table_and_null_ids(spark):
    root = scratch_path(spark, "index-empty")
    index = new_index(spark, root)
    assert index.lookup(ids(spark, 0, 3)).count() == 0
    nulls = spark.createDataFrame([(None,), (None,), ("a",)], "event_id string")
    write_batch_partition(nulls, f"{root}/events", 0)
    index.cover({("live", 0)})
    assert [r.event_id for r in index.lookup(nulls).collect()] == ["a"]
    index.release()
