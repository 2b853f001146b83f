"""Equi, semi, anti and range joins.

Physical strategy is left to Catalyst/AQE (broadcast when the measured side is
under ``spark.sql.autoBroadcastJoinThreshold``, sort-merge or shuffled hash
otherwise, skew splitting on).  Explicit broadcast hints only where the small
side has a fixed bound (a label map, a motif set, k centroids).  Range
predicates are turned into equi-joins on a bucket id.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayspark.session import scratch_path


def annotate(df: DataFrame, ref: DataFrame, key: str, ref_key: str, ref_value: str, out: str, keep_original: str | None = None) -> DataFrame:
    """J01/J02 + P15: left-join a reference id -> symbol map; unmapped rows keep their original name."""
    r = ref.select(F.col(ref_key).alias("_rk"), F.col(ref_value).alias("_rv"))
    j = df.join(r, df[key] == r["_rk"], "left")
    val = F.coalesce(F.col("_rv"), F.col(keep_original)) if keep_original else F.col("_rv")
    return j.withColumn(out, val).drop("_rk", "_rv")


def semi(df: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows with a match (EXISTS)."""
    return df.join(other.select(*cols).distinct(), list(cols), "left_semi")


def anti(df: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows without a match (NOT EXISTS)."""
    return df.join(other.select(*cols), list(cols), "left_anti")


def flag_pairs(universe: DataFrame, flagged: DataFrame, cols: Sequence[str], flag: str) -> DataFrame:
    """All pairs left-joined to flagged pairs, missing -> False."""
    f = flagged.select(*cols, F.lit(True).alias("_f")).dropDuplicates(list(cols))
    return universe.join(f, list(cols), "left").select(*universe.columns, F.coalesce("_f", F.lit(False)).alias(flag))


def membership_label(df: DataFrame, members: DataFrame, col: str, out: str = "label") -> DataFrame:
    """1 if ``col`` is in the member set else 0."""
    m = members.select(F.col(col).alias("_m")).distinct()
    j = df.join(m, df[col] == m["_m"], "left")
    return j.withColumn(out, F.col("_m").isNotNull().cast("int")).drop("_m")


def extract_sequences(intervals: DataFrame, chunks: DataFrame, chunk: int) -> DataFrame:
    """BED interval -> upper-case sequence slice from a chunked genome (unknown chromosome -> '',
    an end past the sequence truncates).  ``intervals`` needs a unique ``row_idx``.

    An interval is exploded into the chunk ids it touches and joined to the
    chunk cores on (chrom, chunk_id); its pieces are put together in order.
    """
    ids = F.when(F.col("end") > F.col("start"), F.sequence((F.col("start") / chunk).cast("int"), ((F.col("end") - 1) / chunk).cast("int")))
    iv = intervals.select("row_idx", "chrom", "start", "end", F.explode(ids).alias("chunk_id"))
    c = chunks.select("chrom", "chunk_id", "chunk_start", F.substring(F.col("seq"), 1, chunk).alias("_cseq"))
    pieces = iv.join(c, ["chrom", "chunk_id"]).select(
        "row_idx", "chunk_id",
        F.expr("substring(_cseq, cast(greatest(start - chunk_start, 0) + 1 as int), "
               "cast(least(`end`, chunk_start + length(_cseq)) - greatest(start, chunk_start) as int))").alias("piece"),
    )
    assembled = pieces.groupBy("row_idx").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_id", "piece"))), lambda x: x["piece"]), "").alias("seq")
    )
    return intervals.join(assembled, "row_idx", "left").select(*intervals.columns, F.upper(F.coalesce("seq", F.lit(""))).alias("seq"))


def overlap_expand(intervals: DataFrame, region_chrom: str, region_start: int, region_end: int) -> DataFrame:
    """Intervals overlapping [start, end) on one chromosome, clamped and expanded to one row per base."""
    ov = intervals.where(
        (F.col("chrom") == region_chrom) & (F.col("start") < region_end) & (F.col("end") > region_start)
    )
    return ov.select(
        *[c for c in intervals.columns if c not in ("start", "end")],
        F.explode(F.sequence(F.greatest(F.col("start"), F.lit(region_start)), F.least(F.col("end"), F.lit(region_end)) - 1)).alias("pos"),
    )


def band_join(draws: DataFrame, bands: DataFrame, u: str, lo: str, hi: str) -> DataFrame:
    """Join each draw ``u`` to the band with lo <= u < hi; the bands are disjoint.

    Draws and band starts are range-partitioned together, and a draw takes the
    last band that starts at or before it in its task; for the draws ahead of a
    task's first band, a table of one row per task holds the last band of the
    tasks before.  So many draws in one wide band, or one band with nearly all
    the weight, still spread over the tasks and nothing is exploded.
    """
    spark = draws.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    b, d = bands.select(F.struct("*").alias("b")), draws.select(F.struct("*").alias("d"))
    none = lambda df: F.lit(None).cast(df.schema[0].dataType)
    both = b.select("b", none(d).alias("d"), F.col("b")[lo].alias("x"), F.lit(0).alias("o")).unionByName(
        d.select(none(b).alias("b"), "d", F.col("d")[u].alias("x"), F.lit(1).alias("o"))
    )
    ranged = both.repartitionByRange(n, "x").withColumn("t", F.spark_partition_id())
    w = Window.partitionBy("t").orderBy("x", "o").rowsBetween(Window.unboundedPreceding, 0)
    # Written once, so that the rows and the table of last bands come from the same partitioning.
    path = scratch_path(spark, f"band-join-{uuid.uuid4().hex}")
    ranged.select("d", "t", "x", F.col("b").isNotNull().alias("is_band"), F.last("b", ignorenulls=True).over(w).alias("b")).write.parquet(path)
    done = spark.read.parquet(path)
    ends = done.groupBy("t").agg(F.max_by("b", F.when(F.col("is_band"), F.col("x"))).alias("last"))
    before = F.last("last", ignorenulls=True).over(Window.orderBy("t").rowsBetween(Window.unboundedPreceding, -1))
    carry = ends.select(F.col("t").alias("_t"), before.alias("carry"))
    m = done.where(~F.col("is_band")).join(carry, F.col("t") == F.col("_t")).withColumn("b", F.coalesce("b", "carry"))
    m = m.where((F.col("d")[u] >= F.col("b")[lo]) & (F.col("d")[u] < F.col("b")[hi]))
    return m.select(*[F.col("d")[c].alias(c) for c in draws.columns], *[F.col("b")[c].alias(c) for c in bands.columns])
