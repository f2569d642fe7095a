from pyspark.sql import functions as F

from pulseline.functions.murmur import murmur2, session_partition_id
from pulseline.operators.partitioning import order_by_session, partition_load

# Fixed values — Murmur2 vectors (key, hash, abs % 12, abs % 24).
VECTORS = [
    ("21", -973932308, 8, 20),
    ("foobar", -790332482, 2, 2),
    ("abc", 479470107, 3, 3),
    ("session-abc", 570094716, 0, 12),
    ("session-1", -783537844, 4, 4),
    ("session-123", 1378674777, 9, 9),
]


def _py_murmur2(data: bytes) -> int:
    m, h = 0x5BD1E995, (0x9747B28C ^ len(data)) & 0xFFFFFFFF
    for i in range(len(data) // 4):
        k = int.from_bytes(data[4 * i:4 * i + 4], "little")
        k = (k * m) & 0xFFFFFFFF
        k ^= k >> 24
        k = (k * m) & 0xFFFFFFFF
        h = ((h * m) & 0xFFFFFFFF) ^ k
    rem, off = len(data) & 3, (len(data) // 4) * 4
    if rem == 3:
        h ^= data[off + 2] << 16
    if rem >= 2:
        h ^= data[off + 1] << 8
    if rem >= 1:
        h ^= data[off]
        h = (h * m) & 0xFFFFFFFF
    h ^= h >> 13
    h = (h * m) & 0xFFFFFFFF
    h ^= h >> 15
    return h - (1 << 32) if h >= (1 << 31) else h


def test_vectors(spark):
    df = spark.createDataFrame([(k,) for k, *_ in VECTORS], "k string")
    got = {r["k"]: (r["h"], r["p12"], r["p24"]) for r in df.select(
        "k", murmur2("k").alias("h"), session_partition_id("k", 12).alias("p12"),
        session_partition_id("k", 24).alias("p24")).collect()}
    for k, h, p12, p24 in VECTORS:
        assert got[k] == (h, p12, p24)


def test_matches_plain_python_on_varied_keys(spark):
    keys = ["", "a", "ab", "abc", "abcd", "é", "日本語のキー", "session-" + "x" * 70] + \
           [f"session-{i}" for i in range(200)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r["k"]: r["h"] for r in df.select("k", murmur2("k").alias("h")).collect()}
    for k in keys:
        assert got[k] == _py_murmur2(k.encode("utf-8")), k


def test_stable_null_and_range(spark):
    keys = [("session-abc",), ("session-abc",), (None,)] + [(f"session-{i}",) for i in range(1000)]
    df = spark.createDataFrame(keys, "k string").select(
        "k", session_partition_id("k", 12).alias("p"))
    rows = df.collect()
    assert rows[0]["p"] == rows[1]["p"]
    assert rows[2]["p"] == 0
    assert all(0 <= r["p"] <= 11 for r in rows)


def test_order_by_session_keeps_publish_order(spark, sf_small):
    from pulseline.plans.fixtures import heartbeats
    laid = order_by_session(heartbeats(spark, sf_small), spark_partitions=6).withColumn(
        "pos", F.monotonically_increasing_id())            # physical order: partition, then row
    rows = [(r["partition_id"], r["session_id"], r["ts"], r["arrival_seq"])
            for r in laid.orderBy("pos").collect()]
    assert rows == sorted(rows)
    assert all(0 <= r[0] < 24 for r in rows)


def test_order_by_session_splits_a_hot_session(spark):
    n = 24000
    df = (spark.range(n).withColumn("session_id", F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                    .otherwise(F.concat(F.lit("s"), (F.col("id") % 500).cast("string"))))
          .withColumn("ts", F.timestamp_seconds(F.col("id"))).withColumn("arrival_seq", F.col("id")))
    laid = order_by_session(df, spark_partitions=8).withColumn("sp", F.spark_partition_id())
    hot_parts = laid.filter("session_id = 'hot'").select("sp").distinct().count()
    assert hot_parts > 1


def test_partition_load_totals(spark, sf_small):
    from pulseline.plans.fixtures import heartbeats
    hb = heartbeats(spark, sf_small)
    load = partition_load(hb).agg(F.sum("events").alias("e"), F.sum("sessions").alias("s")).collect()[0]
    assert load["e"] == hb.count()
    assert load["s"] == hb.select("session_id").distinct().count()
