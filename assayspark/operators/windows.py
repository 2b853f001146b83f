"""Order-dependent operators that stay parallel when one key holds a large share of rows.

``row_number_within`` numbers rows inside each key by an order column without
a window over the whole key: rows are range-partitioned on (key, order), so a
hot key is spread over many tasks; each task numbers its slice, and a small
per-(task, key) count table supplies the offsets (two-level prefix sum).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from assayspark.session import scratch_path


def _local_running(keys: list[str], value: str | None):
    """Per-task running count (or running sum of ``value``) over rows sorted by (keys, order)."""

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last_key, carried = None, 0.0
        for pdf in batches:
            if pdf.empty:
                yield pdf.assign(_local=pd.Series([], dtype="float64" if value else "int64"))
                continue
            key = list(pdf[keys].itertuples(index=False, name=None)) if keys else [()] * len(pdf)
            same = np.ones(len(pdf), dtype=bool)
            same[0] = last_key is not None and _same(key[0], last_key)
            for k in keys:
                # Equal neighbours, NULL equal to NULL: compared by value, so no two keys can be taken for one.
                col = pdf[k]
                here, before = col.iloc[1:].reset_index(drop=True), col.iloc[:-1].reset_index(drop=True)
                same[1:] &= ((here == before) | (here.isna() & before.isna())).to_numpy(dtype=bool)
            run = np.cumsum(~same)
            v = pdf[value].fillna(0).to_numpy(dtype=np.float64) if value else np.ones(len(pdf))
            local = pd.Series(v).groupby(run).cumsum().to_numpy()
            if same[0]:
                local[run == run[0]] += carried
            last_key = key[-1]
            carried = float(local[-1])
            out = local if value else np.rint(local).astype(np.int64)
            yield pdf.assign(_local=pd.Series(out, index=pdf.index))

    return fn


def _same(a: tuple, b: tuple) -> bool:
    return all(x == y or (pd.isna(x) and pd.isna(y)) for x, y in zip(a, b, strict=True))


def running_sum_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | None, name: str, partitions: int | None = None
) -> DataFrame:
    """Running count (``value`` None) or running sum of ``value`` inside each key, in ``order``, inclusive.

    Rows are range-partitioned on (keys, order) so a hot key spans many tasks;
    each task accumulates its slice, and a per-(task, key) total table gives
    the offsets (two-level prefix sum).  ``order`` must be total within a key.
    """
    keys, order = list(keys), list(order)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *[F.col(c) for c in keys + order]).sortWithinPartitions(*(keys + order))
    ranged = ranged.withColumn("_pid", F.spark_partition_id())
    ltype = T.DoubleType() if value else T.LongType()
    schema = T.StructType(ranged.schema.fields + [T.StructField("_local", ltype)])
    # Written once to the shared folder: the per-task slices and the offset table must come from
    # one and the same range partitioning (a recomputation could sample different range bounds when the
    # input order is not stable, e.g. after a shuffle), and a lost executor then re-reads, not re-ranges.
    path = scratch_path(spark, f"running-{uuid.uuid4().hex}")
    ranged.mapInPandas(_local_running(keys, value), schema).write.parquet(path)
    numbered = spark.read.schema(schema).parquet(path)
    counts = numbered.groupBy("_pid", *keys).agg(F.max_by("_local", F.struct(*order)).alias("_cnt"))
    w = Window.partitionBy(*keys).orderBy("_pid") if keys else Window.orderBy("_pid")
    zero = F.lit(0.0) if value else F.lit(0)
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), zero)
    ).select(F.col("_pid").alias("_opid"), *[F.col(k).alias(f"_ok{i}") for i, k in enumerate(keys)], "_off")
    # NULL keys must join to their own offsets: use null-safe equality.
    cond = [F.col("_pid") == F.col("_opid")] + [F.col(k).eqNullSafe(F.col(f"_ok{i}")) for i, k in enumerate(keys)]
    return numbered.join(offsets, cond).select(*df.columns, (F.col("_local") + F.col("_off")).alias(name))


def row_number_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn", partitions: int | None = None
) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` without a single-task hot key.

    ``order`` must make the order total within a key (add a unique id).
    With no keys it is a global row number.
    """
    return running_sum_within(df, keys, order, None, name, partitions)


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Top n rows per group by ascending ``order`` columns (W02 grouped form), hot groups split."""
    return row_number_within(df, group, order, "_rn").where(F.col("_rn") <= n).drop("_rn")


def bin_means(df: DataFrame, keys: Sequence[str], pos: str, value: str, bin_size: int) -> DataFrame:
    """Mean per bin of ``bin_size`` positions counted from the first position of the region (the keys).

    Only the last bin of a region can be short; it is padded with its last
    value up to ``bin_size``.  Positions missing inside a region are left out of
    their bin's mean.  ``bin`` is 0 at the region start, whose place comes from
    a grouped minimum joined back, so no window spans a region.
    """
    keys = list(keys)
    ends = df.groupBy(*keys).agg(F.min(pos).alias("_lo"), F.max(pos).alias("_hi"))
    b = df.join(ends, keys).withColumn("bin", F.floor((F.col(pos) - F.col("_lo")) / bin_size).cast("long"))
    agg = b.groupBy(*keys, "bin").agg(
        F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_n"), F.max_by(value, pos).alias("_last"),
        F.max(F.col("_lo") + (F.col("bin") + 1) * bin_size - 1 - F.col("_hi")).alias("_over"),
    )
    pad = F.greatest(F.col("_over"), F.lit(0))
    return agg.select(*keys, "bin", ((F.col("_s") + pad * F.col("_last")) / (F.col("_n") + pad)).alias("bin_mean"))


def running_best(df: DataFrame, group: list[str], order: str, metric: str) -> DataFrame:
    """Best metric so far (strict improvement) and a new-best flag per row."""
    w = Window.partitionBy(*group).orderBy(order)
    prev_best = F.max(metric).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("prev_best", prev_best).withColumn(
        "is_new_best", F.col("prev_best").isNull() | (F.col(metric) > F.col("prev_best"))
    ).withColumn("best_so_far", F.greatest(F.col(metric), F.coalesce(F.col("prev_best"), F.col(metric))))


def patience(df: DataFrame, group: list[str], order: str, err: str, tol: float = 1e-6, patience_n: int = 10) -> DataFrame:
    """Relative improvement vs the previous row, run length of bad steps, stop flag.

    A step is bad when its relative improvement is <= tol (worse steps too);
    the run length restarts at each good step (gaps and islands by a running
    count of good steps).
    """
    w = Window.partitionBy(*group).orderBy(order)
    prev = F.lag(err).over(w)
    x = df.withColumn("rel_improve", (prev - F.col(err)) / prev)
    x = x.withColumn("bad", F.col("rel_improve").isNotNull() & (F.col("rel_improve") <= tol))
    x = x.withColumn("_island", F.sum((~F.col("bad")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    wi = Window.partitionBy(*group, "_island").orderBy(order)
    x = x.withColumn("bad_run", F.sum(F.col("bad").cast("int")).over(wi.rowsBetween(Window.unboundedPreceding, 0)))
    return x.withColumn("stop", F.col("bad_run") >= patience_n).drop("_island")


def total_variation(df: DataFrame, group: list[str], pos: str, value: str) -> DataFrame:
    """Sum of |x_p - x_(p-1)| per group over consecutive integer positions.

    Neighbours are paired by an equi-join on (group, pos + 1) rather than a
    window, so a long group is not sorted inside one task.
    """
    a = df.select(*group, pos, F.col(value).alias("_x"))
    b = df.select(*group, (F.col(pos) + 1).alias(pos), F.col(value).alias("_prev"))
    d = a.join(b, [*group, pos]).select(*group, F.abs(F.col("_x") - F.col("_prev")).alias("_d"))
    return d.groupBy(*group).agg(F.sum("_d").alias("tv"))
