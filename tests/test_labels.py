"""Label frames of many genes stacked in long form (U04) equal the frames stacked one by one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from assayspark.operators import sets as U


def test_stack_labels_equals_the_frames_one_by_one(spark):
    rows = [("s1", "a"), ("s1", "a"), ("s1", "b"), ("s2", "c"), (None, "b"), ("s3", None)]
    m = spark.createDataFrame(rows, "sample string, gene string")
    genes = ["a", "b", "c"]
    frames = [m.where(F.col("gene") == g).select("sample").distinct().withColumn(g, F.lit(True)) for g in genes]
    wide = reduce(lambda a, b: U.union_fill(a, b, False), frames)
    want = sorted((str(r["sample"]), g, r[g]) for r in wide.collect() for g in genes)
    got = sorted((str(r["sample"]), r["gene"], r["flag"]) for r in U.stack_labels(m, "sample", "gene", genes).collect())
    assert got == want and len(got) == 12
    assert U.stack_labels(m.limit(0), "sample", "gene", genes).count() == 0
