"""Shared helpers of the training-data operators."""

import numpy as np
import pyarrow as pa

from pulseline.llm import common


def test_text_bytes_of_slices_nulls_and_large_strings():
    texts = ["ab", None, "é", "", "xyz"]
    for kind in (pa.string(), pa.large_string(), pa.binary()):
        values = [t.encode() if t is not None and kind == pa.binary() else t for t in texts]
        for lo in range(4):
            part = pa.array(values, kind).slice(lo, 2)
            if kind == pa.binary() and part.null_count:
                continue  # nulls are filled as text
            raw, offsets = common.text_bytes(part)
            want = [(t or "").encode() for t in texts[lo:lo + 2]]
            assert [raw[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])] == want
    raw, offsets = common.text_bytes(pa.array([], pa.string()))
    assert len(raw) == 0 and offsets.tolist() == [0]


def test_row_slices_cover_all_rows_in_order():
    sizes = np.array([5, 0, 100, 1, 1, 1, 50, 0])
    cut = common.row_slices(sizes, 10)
    assert [i for lo, hi in cut for i in range(lo, hi)] == list(range(8))
    assert all(sizes[lo:hi].sum() <= 10 or hi - lo == 1 or sizes[lo] > 0 for lo, hi in cut)
    assert common.row_slices(np.zeros(0, int), 10) == []


def test_mix64_is_a_bijection_on_a_sample():
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(common.mix64(x))) == len(x) and x[1] == 1  # the input stays


def test_staged_tables_keep_columns_and_the_package_is_shipped_once(spark):
    df = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, extra string")
    again = common.staged(df, "test")
    assert again.schema == df.schema and again.collect() == df.collect()
    assert common.staged(df.limit(0), "test").count() == 0
    common.ship_package(spark)
    shipped = len(spark.sparkContext.listFiles)
    common.ship_package(spark)
    assert len(spark.sparkContext.listFiles) == shipped >= 1


def test_small_batches_keep_lower_settings(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "37")
        common.small_batches(spark)
        assert spark.conf.get(key) == "37"
        spark.conf.set(key, "10000")
        common.small_batches(spark)
        assert spark.conf.get(key) == common.BATCH_ROWS
    finally:
        spark.conf.set(key, before)
