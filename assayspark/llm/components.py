"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    j = both.join(least, F.col("u") == F.col("k"))
    return j.where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    j = down.join(least, F.col("u") == F.col("k"))
    pairs = j.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p"))
    return pairs.select("p.u", "p.v").where("u <> v").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v): root is the smallest node of its component.

    Each round is written to the shared folder; the loop ends when a round
    changes nothing.  Groups are split by Spark's skew join, and the minima are
    pre-aggregated, so a star of many leaves does not meet in one task.
    """
    e = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = lambda d: tuple(d.agg(F.count(F.lit(1)), F.sum(F.shiftright(F.xxhash64("u", "v"), 20))).first())
    state = mark(e)
    while state[0]:
        e = materialize(_small_star(_large_star(e)), "links")
        now = mark(e)
        if now == state:
            break
        state = now
    top = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(top.select("node", F.col("node").alias("root")))
