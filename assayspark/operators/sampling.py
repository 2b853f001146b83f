"""Seeded splits, folds, class weights and weighted sampling.

Randomness is a hash of (row key, seed), never ``rand()``: the draw of a row
does not depend on how the data happen to be partitioned.  Row ranks inside a
class come from the skew-safe two-level row number, so a class holding most of
the rows is still spread over many tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayspark.functions.tokens import HASH_MOD, arith_hash
from assayspark.operators.windows import row_number_within
from assayspark.session import scratch_path


def _with_hash(df: DataFrame, id_col: str, seed: int, hash_col: Column | None = None) -> DataFrame:
    return df.withColumn("_h", hash_col if hash_col is not None else arith_hash(F.col(id_col), F.lit(seed)))


def exact_split(df: DataFrame, id_col: str, frac: float, seed: int = 42, hash_col: Column | None = None) -> DataFrame:
    """Exactly max(1, floor(n * frac)) rows go to 'val' (smallest hash), the rest to 'train'."""
    h = _with_hash(df, id_col, seed, hash_col)
    n_val = F.greatest(F.lit(1), F.floor(h.agg(F.count(F.lit(1))).scalar() * frac)).cast("long")
    ranked = row_number_within(h, [], ["_h", id_col], "_rn")
    return ranked.withColumn("split", F.when(F.col("_rn") <= n_val, "val").otherwise("train")).drop("_h", "_rn")


def class_quota(df: DataFrame, label: str, frac: float) -> DataFrame:
    """Per-class validation sizes summing to ceil(frac * N), by largest remainder (ties: smaller label).

    Works on the class-count table (one row per class).
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    total = counts.agg(F.sum("n_c")).scalar()
    n_val = F.ceil(total * frac)
    q = counts.withColumn("_quota", n_val * F.col("n_c") / total)
    q = q.withColumn("_base", F.floor("_quota").cast("long")).withColumn("_frac", F.col("_quota") - F.col("_base"))
    left = n_val - q.agg(F.sum("_base")).scalar()
    w = Window.orderBy(F.desc("_frac"), F.asc(label))  # one row per class
    q = q.withColumn("_r", F.row_number().over(w))
    return q.select(label, "n_c", (F.col("_base") + F.when(F.col("_r") <= left, 1).otherwise(0)).cast("long").alias("n_val"))


def stratified_split(df: DataFrame, id_col: str, label: str, frac: float = 0.2, seed: int = 42, hash_col: Column | None = None) -> DataFrame:
    """Stratified train/val split with exact per-class sizes (total ceil(frac * N))."""
    quota = class_quota(df, label, frac)
    h = _with_hash(df, id_col, seed, hash_col)
    ranked = row_number_within(h, [label], ["_h", id_col], "_rn")
    j = ranked.join(quota.select(label, "n_val"), label)
    return j.withColumn("split", F.when(F.col("_rn") <= F.col("n_val"), "val").otherwise("train")).drop("_h", "_rn", "n_val")


def stratified_folds(df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 42, hash_col: Column | None = None) -> DataFrame:
    """Round-robin folds within each class (rank by hash), continued across classes.

    fold = (rank within class - 1 + rows of the preceding classes) mod k, so
    fold sizes differ by at most 1 within every class and overall.  The class
    offsets come from the class-count table (one row per class).
    """
    h = _with_hash(df, id_col, seed, hash_col)
    ranked = row_number_within(h, [label], ["_h", id_col], "_rn")
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n_c"))
    w = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)  # over classes only
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n_c").over(w), F.lit(0))).select(label, "_off")
    j = ranked.join(offs, label)
    return j.withColumn("fold", ((F.col("_rn") - 1 + F.col("_off")) % k).cast("int")).drop("_h", "_rn", "_off")


def kfold(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, hash_col: Column | None = None) -> DataFrame:
    """Plain shuffled k-fold, fold = (global hash rank - 1) mod k."""
    h = _with_hash(df, id_col, seed, hash_col)
    ranked = row_number_within(h, [], ["_h", id_col], "_rn")
    return ranked.withColumn("fold", ((F.col("_rn") - 1) % k).cast("int")).drop("_h", "_rn")


def balanced_weights(df: DataFrame, label: str, domain: DataFrame | None = None) -> DataFrame:
    """N / (n_classes * n_c) per class (classes present in ``df``)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    n = counts.agg(F.sum("n_c")).scalar()
    k = counts.agg(F.count(F.lit(1))).scalar()
    return counts.select(label, "n_c", (n / (k * F.col("n_c"))).alias("weight"))


def inverse_count_weights(df: DataFrame, label: str, domain: DataFrame) -> DataFrame:
    """X06 (A25 + F03): weight 1 / max(n_c, 1) over a fixed label domain, joined to every row."""
    from assayspark.operators.profile import class_counts

    cc = class_counts(df, label, domain).withColumn("weight", F.lit(1.0) / F.greatest(F.col("count"), F.lit(1)))
    return df.join(cc.select(label, "weight"), label, "left")


def pos_weight(df: DataFrame, y: str) -> DataFrame:
    """Negatives / positives."""
    return df.agg((F.sum((F.col(y) == 0).cast("double")) / F.sum((F.col(y) == 1).cast("double"))).alias("pos_weight"))


def cumulative_weights(df: DataFrame, id_col: str, weight: str) -> DataFrame:
    """[lo, hi) bands of the running weight sum in id order, as a two-level prefix sum.

    Rows are range-partitioned by id; each task sums its slice; the per-task
    totals (one row per task) get a prefix sum; each row adds its task offset to
    a within-task running sum.  No window ever spans all rows.  A band begins at
    the very number at which the one before it ends (the first of a task at the
    task's offset, the last of a task at the next offset), so the bands leave no
    gap and do not overlap, whatever the rounding.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = df.where(F.col(weight) > 0).select(id_col, F.col(weight).cast("double").alias("_w"), F.struct("*").alias("_row"))
    r = r.repartitionByRange(n, id_col).withColumn("_pid", F.spark_partition_id())
    w = Window.partitionBy("_pid").orderBy(id_col)
    run = F.sum("_w").over(w.rowsBetween(Window.unboundedPreceding, 0))
    # Written once: the running sums and the per-task totals must come from one and the same partitioning (see row_number_within).
    path = scratch_path(spark, f"bands-{uuid.uuid4().hex}")
    r.select("_row", "_pid", run.alias("_run"), F.lead(id_col).over(w).isNull().alias("_last"), F.col(id_col).alias("_id")).write.parquet(path)
    r = spark.read.parquet(path)
    tot = r.groupBy("_pid").agg(F.max("_run").alias("_t"))
    line = Window.orderBy("_pid")
    upto = F.sum("_t").over(line.rowsBetween(Window.unboundedPreceding, 0))
    off = tot.select(F.col("_pid").alias("_opid"), upto.alias("_end")).withColumn("_off", F.coalesce(F.lag("_end").over(Window.orderBy("_opid")), F.lit(0.0)))
    j = r.join(off, F.col("_pid") == F.col("_opid"))
    j = j.withColumn("hi", F.when(F.col("_last"), F.col("_end")).otherwise(F.col("_off") + F.col("_run")))
    lo = F.coalesce(F.lag("hi").over(Window.partitionBy("_pid").orderBy("_id")), F.col("_off"))
    return j.withColumn("lo", lo).select(*[F.col(f"_row.`{c}`").alias(c) for c in df.columns], "lo", "hi")


def weighted_sample(df: DataFrame, id_col: str, weight: str, n_draws: int, seed: int = 42) -> DataFrame:
    """Exactly ``n_draws`` draws with replacement, P(row) proportional to its weight.

    Draw d takes u = hash(d, seed) / 2^31 * total and the row whose band holds
    u (J17).
    """
    from assayspark.operators.joins import band_join

    spark = df.sparkSession
    bands = cumulative_weights(df, id_col, weight)
    total = bands.agg(F.max("hi")).first()[0]  # the end of the last band, so every draw below it has one
    draws = spark.range(n_draws).select(F.col("id").alias("draw"))
    draws = draws.withColumn("u", arith_hash(F.col("draw"), F.lit(seed)) / float(HASH_MOD) * total)
    return band_join(draws, bands, "u", "lo", "hi")
