"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseline.llm.common import join_counted, staged

MAX_ROUNDS = 60


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` of every node in ``links`` (two id columns, any order).

    The component is the smallest node reachable. A large star hangs all
    larger neighbours of a node on its smallest one, a small star hangs all
    smaller neighbours there (Kiveris et al., 2014); after a number of rounds
    that is logarithmic in the longest path the links are stars around the
    smallest nodes. Every round is written to the shared folder. The neighbours
    of a node with very many of them stay where they are (``join_counted``).
    """
    a, b = links.columns
    # the larger end first
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .filter("u > v").distinct())
    edges, before = staged(edges, name), None
    for _ in range(MAX_ROUNDS):
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before or not now[0]:
            break
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("degree")), name)
        large = (join_counted(both, least, ["u"], "degree", 2 * now[0]).filter("v > u")
                     .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(hung.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), name)
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
