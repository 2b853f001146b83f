"""Cell x gene matrices: variable-gene selection and cohort stacking.

All per-gene statistics are grouped aggregates over the long matrix; the
dispersion ranking works on the per-gene table (one row per gene), joined back
as a semi join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dispersion_hvg(m: DataFrame, n_top: int, n_bins: int = 20, feature: str = "feature", value: str = "value") -> DataFrame:
    """Variable genes by binned, z-scored log dispersion.

    Per gene: mean, sample variance, dispersion = var / mean (mean > 0),
    log dispersion; genes are put in ``n_bins`` equal-width bins of their mean;
    within a bin the log dispersion is z-scored (sample sd; a one-gene bin
    gives 0); the top ``n_top`` genes by z (ties by gene) are flagged.
    """
    st = m.groupBy(feature).agg(F.avg(value).alias("mean"), F.var_samp(value).alias("var"))
    st = st.withColumn("dispersion", F.when(F.col("mean") > 0, F.col("var") / F.col("mean")))
    st = st.withColumn("log_disp", F.log(F.col("dispersion")))
    lo = st.agg(F.min("mean")).scalar()
    hi = st.agg(F.max("mean")).scalar()
    raw = F.floor((F.col("mean") - lo) / (hi - lo) * n_bins) + 1
    st = st.withColumn("bin", F.least(raw, F.lit(n_bins)).cast("int"))
    per_bin = st.groupBy("bin").agg(F.avg("log_disp").alias("_bm"), F.stddev_samp("log_disp").alias("_bs"))
    z = F.when(F.col("_bs").isNull() | (F.col("_bs") == 0), F.lit(0.0)).otherwise((F.col("log_disp") - F.col("_bm")) / F.col("_bs"))
    st = st.join(per_bin, "bin").withColumn("z", z).drop("_bm", "_bs")
    # Ranked on z rounded to 1e-9 so genes tied in exact arithmetic stay tied (then by gene).
    top = st.where(F.col("z").isNotNull()).orderBy(F.desc(F.round("z", 9)), F.asc(feature)).limit(n_top).select(feature, F.lit(True).alias("highly_variable"))
    return st.join(top, feature, "left").withColumn("highly_variable", F.coalesce("highly_variable", F.lit(False)))


def normalised_variance_hvg(m: DataFrame, n_top: int, n_bins: int = 20, feature: str = "feature", value: str = "raw_value") -> DataFrame:
    """W08, raw-count flavour: variable genes by the variance of counts relative to that of genes with a similar mean.

    Per gene: mean and sample variance of the raw values; genes are put in
    ``n_bins`` equal-width bins of ln(1 + mean); the expected variance of a gene
    is the mean variance of its bin; the top ``n_top`` genes by
    variance / expected (ties by gene) are flagged.
    """
    st = m.groupBy(feature).agg(F.avg(value).alias("mean"), F.var_samp(value).alias("var")).withColumn("_lm", F.log1p("mean"))
    lo, hi = st.agg(F.min("_lm")).scalar(), st.agg(F.max("_lm")).scalar()
    raw = F.floor((F.col("_lm") - lo) / (hi - lo) * n_bins) + 1
    st = st.withColumn("bin", F.least(raw, F.lit(n_bins)).cast("int"))
    per_bin = st.groupBy("bin").agg(F.avg("var").alias("_e"))
    st = st.join(per_bin, "bin").withColumn("ratio", F.when(F.col("_e") > 0, F.col("var") / F.col("_e")).otherwise(F.lit(0.0))).drop("_e", "_lm")
    top = st.orderBy(F.desc(F.round("ratio", 9)), F.asc(feature)).limit(n_top).select(feature, F.lit(True).alias("highly_variable"))
    return st.join(top, feature, "left").withColumn("highly_variable", F.coalesce("highly_variable", F.lit(False)))


def select_genes(m: DataFrame, var: DataFrame, n_top: int, feature: str = "feature") -> DataFrame:
    """Reuse an existing ``highly_variable`` column of the gene table if present, else compute W08."""
    if "highly_variable" in var.columns:
        keep = var.where(F.col("highly_variable")).select(feature)
    else:
        keep = dispersion_hvg(m, n_top, feature=feature).where(F.col("highly_variable")).select(feature)
    return m.join(keep, feature, "left_semi")


def stack_shared(a: DataFrame, b: DataFrame, feature: str = "feature", split: str = "split") -> DataFrame:
    """Row-stack two cell sets keeping only shared genes, with a split flag (no positional offsets)."""
    shared = a.select(feature).distinct().intersect(b.select(feature).distinct())
    return a.withColumn(split, F.lit("a")).unionByName(b.withColumn(split, F.lit("b"))).join(shared, feature, "left_semi")
