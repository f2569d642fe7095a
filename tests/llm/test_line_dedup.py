"""Line deduplication against a plain version, and its sorted runs."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pulseline.llm import line_dedup
from pulseline.llm.common import join_counted, staged

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(SPACE).translate(LOWER)


def plain(rows, min_docs=3, min_chars=20):
    """(lines, dropped, kept text) of every (doc_id, text)."""
    holds = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= min_chars:
                holds[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = [doc is not None and len(holds[key(x)]) >= min_docs and doc < max(holds[key(x)]) for x in lines]
        out.append((doc, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=str)


def found(docs, **kw):
    return sorted((tuple(r) for r in line_dedup.drop_repeated_lines(docs, **kw).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 0, 1, "y") for d, t in rows],
                                 "doc_id long, text string, lines string, pos int, h1 long, kept string")


LINE = "a line of twenty chars or more"
SHORT = "nineteen characters"
ROWS = [
    (1, LINE), (2, f"  {LINE.upper()}\t\nother"), (3, f"x\n{LINE}\r\n{LINE}"), (4, f"{LINE} once"), (5, f"{LINE} once"),
    (6, SHORT), (7, SHORT), (8, SHORT), (9, None), (10, ""), (11, "\n\n"), (None, LINE), (None, LINE),
    (12, "É" * 20), (13, "É" * 20), (14, "é" * 20), (15, "É" * 20),            # only A-Z are lower-cased
    (16, "repeated id, first text here"), (16, "repeated id, first text here"), (17, "repeated id, first text here"),
    (18, "x" * 20 + " "), (19, "x" * 20), (20, "x" * 20), (21, "x" * 20), (-5, "x" * 20),
    (22, "same line again and again\nsame line again and again"),
]


def test_odd_rows(spark):
    assert len(SHORT) == 19
    assert found(frame(spark, ROWS)) == plain(ROWS)
    assert found(frame(spark, ROWS).limit(0)) == []
    assert found(frame(spark, [(None, LINE), (None, None)])) == plain([(None, LINE), (None, None)])


def test_every_batch_and_fanout_gives_the_same(spark):
    rng = random.Random(5)
    pool = [f"line number {k} of the shared pool" for k in range(60)]
    rows = [(rng.randrange(150), "\n".join(rng.choice(pool) if rng.random() < 0.6 else f"own line {rng.random()} of it"
                                          for _ in range(rng.randrange(6)))) for _ in range(200)]
    rows += [(1000, "\n".join(pool * 40))]                                       # a long text
    rows += [(d, "the very same line for everyone") for d in range(2000, 2200)]  # a hot line
    docs = frame(spark, rows).repartition(5)
    want = plain(rows)
    assert found(docs) == want
    assert found(docs, batches=7, fanout=3) == want
    assert found(docs, batches=1) == want
    assert found(docs, min_docs=2, min_chars=25) == plain(rows, 2, 25)


def test_line_keys_keep_all_other_white_space(spark):
    lines = ["\x0b\x0cA b\r", " em space ", "İstanbul ÄÖ Z", "", " \t "]
    got = spark.createDataFrame([(x,) for x in lines], "x string").select(line_dedup.line_key(F.col("x"))).collect()
    assert [r[0] for r in got] == [key(x) for x in lines]


def test_runs_are_levelled_disjoint_and_merged_without_a_shuffle(spark):
    store = line_dedup.LineRuns(spark, fanout=2)
    rows = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("h1"), (-F.col("id")).alias("h2"), F.col("id").alias("last"))
    sizes = []
    for lo in range(0, 250, 50):
        store.add(store.unseen(rows(max(0, lo - 30), lo + 50)))
        sizes.append([len(level) for level in store.levels])
    assert sizes == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
    assert sorted(r.h1 for r in store.merged().collect()) == list(range(250))
    batch = spark.table(store.sorted_table(rows(0, 300), "batch"))
    plan = store.unseen(batch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan and "Broadcast" not in plan
    store.forget()
    assert not spark.catalog.tableExists(store.tables[0])


def test_plan_is_native_and_counts_before_the_shuffle(spark):
    out = line_dedup.drop_repeated_lines(frame(spark, ROWS))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    counted = line_dedup._by_hash(line_dedup._lines(frame(spark, ROWS), "doc_id", "text", 20, 2))
    assert "partial_sum" in counted._jdf.queryExecution().executedPlan().toString()


def test_counted_join_broadcasts_only_the_heavy_keys(spark):
    left = staged(spark.range(5000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("k"), "id"), "left")
    right = staged(left.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "right")
    joined = join_counted(left, right, ["k"], "n", 5000)
    assert joined.count() == 5000 and joined.filter("k = 0 and n = 4000").count() == 4000


@pytest.mark.parametrize("name", ["op12_line_dedup", "op13_fill_middle", "op11_hard_negatives"])
def test_registered(spark, name):
    from pulseline.llm import catalog
    from tests import oracle_compare
    sf = "/root/testdata/sf0.001"
    assert oracle_compare.compare(spark, sf, name, catalog.QUERIES[name], catalog.ORACLE[name])["status"] == "match"
