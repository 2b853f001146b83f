"""Feature selection and scaling on long matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def feature_stats(m: DataFrame, feature: str = "feature", value: str = "value") -> DataFrame:
    """Per-feature n, mean, sample and population variance (one partial+final aggregate)."""
    return m.groupBy(feature).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.var_samp(value).alias("var_samp"),
        F.var_pop(value).alias("var_pop"),
    )


def top_n_by(stats: DataFrame, key: str, n: int, name: str = "feature") -> DataFrame:
    """The n rows with the largest ``key`` (ties by name), re-sorted by name.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top n and one task merges n x tasks rows, never the whole input.
    """
    return stats.orderBy(F.desc(key), F.asc(name)).limit(n).orderBy(name)


def variance_select(
    m: DataFrame, var_threshold: float = 0.1, top_n: int = 1500, feature: str = "feature", value: str = "value"
) -> DataFrame:
    """M03 + W02: population variance > threshold, then the top_n by sample variance.

    Returns every feature's stats with a ``selected`` flag; Spark picks the join
    with the selected set (at most ``top_n`` rows) by its size.
    """
    stats = feature_stats(m, feature, value)
    top = top_n_by(stats.where(F.col("var_pop") > var_threshold), "var_samp", top_n, feature)
    flag = top.select(feature, F.lit(True).alias("selected"))
    return stats.join(flag, feature, "left").withColumn(
        "selected", F.coalesce(F.col("selected"), F.lit(False))
    )


def standardize(train: DataFrame, apply_to: DataFrame | None = None, feature: str = "feature", value: str = "value") -> DataFrame:
    """(x - mean) / population sd using the statistics of ``train``; sd 0 -> scale 1."""
    st = train.groupBy(feature).agg(F.avg(value).alias("_mu"), F.stddev_pop(value).alias("_sd"))
    target = apply_to if apply_to is not None else train
    sd = F.when((F.col("_sd") == 0) | F.col("_sd").isNull(), F.lit(1.0)).otherwise(F.col("_sd"))
    return target.join(st, feature, "left").withColumn(value, (F.col(value) - F.col("_mu")) / sd).drop("_mu", "_sd")


def drop_all_missing(m: DataFrame, feature: str = "feature", value: str = "value") -> DataFrame:
    """Drop features with no observed value."""
    keep = m.groupBy(feature).agg(F.count(value).alias("_n")).where(F.col("_n") > 0).select(feature)
    # The features are hashed, so the cells need not be sorted.
    return m.join(keep.hint("shuffle_hash"), feature, "left_semi")


def drop_missing_rate(m: DataFrame, max_rate: float = 0.5, feature: str = "feature", value: str = "value") -> DataFrame:
    """P10: drop features whose missing share is strictly greater than ``max_rate``."""
    keep = (
        m.groupBy(feature)
        .agg(F.avg(F.col(value).isNull().cast("double")).alias("_rate"))
        .where(F.col("_rate") <= max_rate)
        .select(feature)
    )
    return m.join(keep.hint("shuffle_hash"), feature, "left_semi")
