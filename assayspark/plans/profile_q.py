"""Registered queries: profiles, selection and normalisation over the matrix views."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayspark.operators import profile as P
from assayspark.operators import select as S
from assayspark.plans.registry import query, view


def r6(c, d: int = 6):
    return F.round(c, d)


# Flagship selection parameters on the dense stand-in matrix.
VAR_THRESHOLD = 0.012
TOP_N = 20


@query(
    "m03_variance_select",
    f"""
    WITH stats AS (SELECT feature, count(value) AS n, avg(value) AS mean, var_samp(value) AS var_samp,
                          var_pop(value) AS var_pop FROM matrix GROUP BY feature),
         top AS (SELECT feature FROM stats WHERE var_pop > {VAR_THRESHOLD} ORDER BY var_samp DESC, feature LIMIT {TOP_N})
    SELECT s.feature, s.n, round(s.mean, 6) AS mean, round(s.var_samp, 6) AS var_samp, round(s.var_pop, 6) AS var_pop,
           t.feature IS NOT NULL AS selected
    FROM stats s LEFT JOIN top t ON s.feature = t.feature""",
    ("matrix",),
)
def m03_variance_select(spark, d):
    out = S.variance_select(view(spark, d, "matrix"), VAR_THRESHOLD, TOP_N)
    return out.select("feature", "n", r6(F.col("mean")).alias("mean"), r6(F.col("var_samp")).alias("var_samp"),
                      r6(F.col("var_pop")).alias("var_pop"), "selected")


@query(
    "a01_shape",
    """SELECT count(*) AS n_cells, count(DISTINCT feature) AS n_features, count(DISTINCT sample) AS n_samples
       FROM matrix_sparse""",
    ("matrix_sparse",),
)
def a01_shape(spark, d):
    return P.shape(view(spark, d, "matrix_sparse"))


@query(
    "a02_missing_total",
    "SELECT count(*) AS n_cells, CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing FROM matrix_sparse",
    ("matrix_sparse",),
)
def a02_missing_total(spark, d):
    return P.missing_total(view(spark, d, "matrix_sparse"))


@query(
    "a03_missing_per_feature",
    "SELECT feature, count(*) AS n_missing FROM matrix_sparse WHERE value IS NULL GROUP BY feature",
    ("matrix_sparse",),
)
def a03_missing_per_feature(spark, d):
    return P.missing_per_feature(view(spark, d, "matrix_sparse"))


@query(
    "a03_missing_cells",
    "SELECT feature, sample FROM matrix_sparse WHERE value IS NULL",
    ("matrix_sparse",),
)
def a03_missing_cells(spark, d):
    return P.missing_cells(view(spark, d, "matrix_sparse"))


@query(
    "a04_global_moments",
    """SELECT round(avg(m), 6) AS mean_of_means, round(avg(v), 6) AS mean_of_vars, round(min(lo), 6) AS min, round(max(hi), 6) AS max
       FROM (SELECT sample, avg(value) m, var_samp(value) v, min(value) lo, max(value) hi FROM matrix GROUP BY sample) t""",
    ("matrix",),
)
def a04_global_moments(spark, d):
    g = P.global_moments(view(spark, d, "matrix"))
    return g.select(*[r6(F.col(c)).alias(c) for c in g.columns])


@query(
    "a05_top_genes",
    """SELECT gene, count(*) AS count FROM mutations WHERE gene IS NOT NULL GROUP BY gene
       ORDER BY count DESC, gene LIMIT 10""",
    ("mutations",),
)
def a05_top_genes(spark, d):
    return P.top_k(view(spark, d, "mutations"), "gene", 10)


@query(
    "a05_top_genes_with_null",
    """SELECT gene, count(*) AS count FROM mutations GROUP BY gene
       ORDER BY count DESC, gene NULLS LAST LIMIT 10""",
    ("mutations",),
)
def a05_top_genes_with_null(spark, d):
    return P.top_k(view(spark, d, "mutations"), "gene", 10, include_null=True)


@query(
    "a06_top_share",
    """WITH top AS (SELECT gene, count(*) AS c FROM mutations WHERE gene IS NOT NULL GROUP BY gene ORDER BY c DESC, gene LIMIT 5)
       SELECT CAST(sum(c) AS BIGINT) AS n_top, round(sum(c) / (SELECT count(*) FROM mutations), 6) AS share FROM top""",
    ("mutations",),
)
def a06_top_share(spark, d):
    t = P.top_k_share(view(spark, d, "mutations"), "gene", 5)
    return t.select(F.col("n_top").cast("long").alias("n_top"), r6(F.col("share")).alias("share"))


@query(
    "a07_consequence_frequency",
    "SELECT consequence, count(*) AS count FROM mutations GROUP BY consequence",
    ("mutations",),
)
def a07_consequence_frequency(spark, d):
    return P.frequency_ascending(view(spark, d, "mutations"), "consequence")


@query(
    "a08_histogram",
    """WITH b AS (SELECT min(value) lo, max(value) hi FROM matrix),
         c AS (SELECT CAST(least(floor((value - lo) / (hi - lo) * 50) + 1, 50) AS INTEGER) AS bin, count(*) AS n
               FROM matrix, b GROUP BY 1)
       SELECT CAST(i AS INTEGER) AS bin, round(lo + (i - 1) * (hi - lo) / 50, 6) AS lo, round(lo + i * (hi - lo) / 50, 6) AS hi,
              coalesce(n, 0) AS count
       FROM range(1, 51) r(i) CROSS JOIN b LEFT JOIN c ON c.bin = r.i""",
    ("matrix",),
)
def a08_histogram(spark, d):
    h = P.histogram(view(spark, d, "matrix"), "value", 50)
    return h.select("bin", r6(F.col("lo")).alias("lo"), r6(F.col("hi")).alias("hi"), "count")


@query(
    "a09_clipped_histogram",
    """WITH pc AS (SELECT sample, avg(value) mu, stddev_samp(value) sd FROM matrix GROUP BY sample),
         b AS (SELECT avg(mu) - 2 * avg(sd) AS lo, avg(mu) + 2 * avg(sd) AS hi FROM pc),
         x AS (SELECT greatest(lo, least(hi, value)) AS v FROM matrix, b),
         c AS (SELECT CAST(least(floor((v - lo) / (hi - lo) * 20) + 1, 20) AS INTEGER) AS bin, count(*) AS n FROM x, b GROUP BY 1)
       SELECT CAST(i AS INTEGER) AS bin, coalesce(n, 0) AS count FROM range(1, 21) r(i) LEFT JOIN c ON c.bin = r.i""",
    ("matrix",),
)
def a09_clipped_histogram(spark, d):
    return P.clipped_histogram(view(spark, d, "matrix"), 20).select("bin", "count")


@query(
    "a10_sd_features",
    "SELECT feature, round(stddev_pop(value), 6) AS sd_pop, count(value) AS n FROM matrix GROUP BY feature",
    ("matrix",),
)
def a10_sd_features(spark, d):
    return P.population_sd(view(spark, d, "matrix"), "feature").select("feature", r6(F.col("sd_pop")).alias("sd_pop"), "n")


@query(
    "a10_sd_samples",
    "SELECT sample, round(stddev_pop(value), 6) AS sd_pop, count(value) AS n FROM matrix GROUP BY sample",
    ("matrix",),
)
def a10_sd_samples(spark, d):
    return P.population_sd(view(spark, d, "matrix"), "sample").select("sample", r6(F.col("sd_pop")).alias("sd_pop"), "n")


@query(
    "a11_feature_corr",
    """SELECT a.feature AS feature_i, b.feature AS feature_j, round(corr(a.value, b.value), 6) + 0 AS r
       FROM matrix a JOIN matrix b ON a.sample = b.sample GROUP BY 1, 2""",
    ("matrix",),
)
def a11_feature_corr(spark, d):
    c = P.pairwise_corr(view(spark, d, "matrix"))
    return c.select("feature_i", "feature_j", (r6(F.col("r")) + 0.0).alias("r"))


@query(
    "a11_sample_corr",
    """SELECT a.sample AS sample_i, b.sample AS sample_j, round(corr(a.value, b.value), 6) + 0 AS r
       FROM matrix a JOIN matrix b ON a.feature = b.feature GROUP BY 1, 2""",
    ("matrix",),
)
def a11_sample_corr(spark, d):
    c = P.pairwise_corr(view(spark, d, "matrix"), var="sample", obs="feature")
    return c.select("sample_i", "sample_j", (r6(F.col("r")) + 0.0).alias("r"))


@query(
    "a12_mean_corr_features",
    """SELECT round(avg(r), 6) AS mean_r, CAST(count(DISTINCT fi) AS BIGINT) AS n_vars FROM (
         SELECT a.feature fi, b.feature fj, corr(a.value, b.value) r FROM matrix a JOIN matrix b
         ON a.sample = b.sample AND a.feature <> b.feature GROUP BY 1, 2) t""",
    ("matrix",),
)
def a12_mean_corr_features(spark, d):
    x = P.mean_offdiag_corr(view(spark, d, "matrix"), var="feature", obs="sample")
    return x.select(r6(F.col("mean_r")).alias("mean_r"), "n_vars")


@query(
    "a12_mean_corr_samples",
    """WITH z AS (SELECT sample, feature, (value - avg(value) OVER (PARTITION BY sample))
                   / (stddev_pop(value) OVER (PARTITION BY sample) * sqrt(count(value) OVER (PARTITION BY sample))) AS z FROM matrix),
         s AS (SELECT feature, sum(z) AS s FROM z GROUP BY feature),
         n AS (SELECT CAST(count(DISTINCT sample) AS DOUBLE) AS n FROM matrix)
       SELECT round((sum(s * s) - n) / (n * (n - 1)), 6) AS mean_r, CAST(n AS BIGINT) AS n_vars FROM s, n GROUP BY n""",
    ("matrix",),
)
def a12_mean_corr_samples(spark, d):
    x = P.mean_offdiag_corr(view(spark, d, "matrix"), var="sample", obs="feature")
    return x.select(r6(F.col("mean_r")).alias("mean_r"), "n_vars")


@query(
    "a13_top_var_corr",
    """WITH top AS (SELECT feature FROM matrix GROUP BY feature ORDER BY var_samp(value) DESC, feature LIMIT 100),
         m AS (SELECT * FROM matrix WHERE feature IN (SELECT feature FROM top))
       SELECT a.feature AS feature_i, b.feature AS feature_j, round(corr(a.value, b.value), 6) + 0 AS r
       FROM m a JOIN m b ON a.sample = b.sample GROUP BY 1, 2""",
    ("matrix",),
)
def a13_top_var_corr(spark, d):
    m = view(spark, d, "matrix")
    top = S.top_n_by(S.feature_stats(m, "feature"), "var_samp", 100, "feature").select("feature")
    c = P.pairwise_corr(m.join(top, "feature", "left_semi"), var="feature", obs="sample")
    return c.select("feature_i", "feature_j", (r6(F.col("r")) + 0.0).alias("r"))


@query(
    "a13_top_var_corr_samples",
    """WITH top AS (SELECT sample FROM matrix GROUP BY sample ORDER BY var_samp(value) DESC, sample LIMIT 100),
         m AS (SELECT * FROM matrix WHERE sample IN (SELECT sample FROM top))
       SELECT a.sample AS sample_i, b.sample AS sample_j, round(corr(a.value, b.value), 6) + 0 AS r
       FROM m a JOIN m b ON a.feature = b.feature GROUP BY 1, 2""",
    ("matrix",),
)
def a13_top_var_corr_samples(spark, d):
    m = view(spark, d, "matrix")
    top = S.top_n_by(S.feature_stats(m, "sample"), "var_samp", 100, "sample").select("sample")
    c = P.pairwise_corr(m.join(top, "sample", "left_semi"), var="sample", obs="feature")
    return c.select("sample_i", "sample_j", (r6(F.col("r")) + 0.0).alias("r"))


@query(
    "a14_fewest_missing_dataset",
    """WITH j AS (SELECT dataset, symbol FROM matrix_sparse LEFT JOIN ref_map ON feature = id),
         per AS (SELECT dataset, CAST(sum(CASE WHEN symbol IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing FROM j GROUP BY dataset)
       SELECT dataset, n_missing FROM per ORDER BY n_missing, dataset LIMIT 1""",
    ("matrix_sparse", "ref_map"),
)
def a14_fewest_missing_dataset(spark, d):
    m = view(spark, d, "matrix_sparse")
    rm = view(spark, d, "ref_map")
    j = m.join(rm, m.feature == rm.id, "left").select("dataset", "symbol")
    return P.fewest_missing(j, "dataset", "symbol")


@query(
    "a15_median_impute",
    """SELECT feature, sample, row_idx, round(coalesce(value, median(value) OVER (PARTITION BY feature)), 6) AS value
       FROM matrix_sparse""",
    ("matrix_sparse",),
)
def a15_median_impute(spark, d):
    m = P.median_impute(view(spark, d, "matrix_sparse"))
    return m.select("feature", "sample", "row_idx", r6(F.col("value")).alias("value"))


@query(
    "a16_log2p1_if_counts",
    """WITH r AS (SELECT dataset, min(value) lo, max(value) hi FROM matrix_sparse GROUP BY dataset)
       SELECT m.dataset, feature, sample, row_idx, NOT (lo < 0 OR hi < 50) AS was_raw,
              round(CASE WHEN NOT (lo < 0 OR hi < 50) THEN log2(value + 1) ELSE value END, 6) AS value
       FROM matrix_sparse m JOIN r ON m.dataset = r.dataset""",
    ("matrix_sparse",),
)
def a16_log2p1_if_counts(spark, d):
    m = P.log2p1_if_counts(view(spark, d, "matrix_sparse"))
    return m.select("dataset", "feature", "sample", "row_idx", "was_raw", r6(F.col("value")).alias("value"))


@query(
    "a17_log2_cpm",
    """SELECT dataset, feature, sample, row_idx,
              round(log2(value / nullif(sum(value) OVER (PARTITION BY dataset, sample), 0) * 1e6 + 1), 6) AS value
       FROM matrix_sparse""",
    ("matrix_sparse",),
)
def a17_log2_cpm(spark, d):
    m = P.log2_cpm(view(spark, d, "matrix_sparse"))
    return m.select("dataset", "feature", "sample", "row_idx", r6(F.col("value")).alias("value"))


@query(
    "a18_normalize_total_log1p",
    """SELECT feature, sample, round(value - (SELECT min(value) FROM matrix), 6) AS raw_value,
              round(ln(1 + (value - (SELECT min(value) FROM matrix))
                     / nullif(sum(value - (SELECT min(value) FROM matrix)) OVER (PARTITION BY sample), 0) * 10000), 6) AS value
       FROM matrix""",
    ("matrix",),
)
def a18_normalize_total_log1p(spark, d):
    m = view(spark, d, "matrix")
    lo = m.agg(F.min("value")).scalar()
    shifted = m.withColumn("value", F.col("value") - lo)
    out = P.normalize_total_log1p(shifted)
    return out.select("feature", "sample", r6(F.col("raw_value")).alias("raw_value"), r6(F.col("value")).alias("value"))


@query(
    "a19_detected_genes",
    """SELECT feature, count(*) AS n_cells FROM matrix_sparse WHERE feature IN
         (SELECT feature FROM matrix_sparse GROUP BY feature HAVING sum(CASE WHEN value > 30 THEN 1 ELSE 0 END) >= 3)
       GROUP BY feature""",
    ("matrix_sparse",),
)
def a19_detected_genes(spark, d):
    m = view(spark, d, "matrix_sparse")
    # "Detected" here means quantity above 30, so the 3-cell rule keeps only part of the features.
    det = P.detected_in(m.withColumn("value", F.col("value") - 30), 3)
    return det.groupBy("feature").agg(F.count(F.lit(1)).alias("n_cells"))


@query(
    "a31_describe_quantity",
    """SELECT count(l_quantity) AS count, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std,
              min(l_quantity) AS min, quantile_cont(l_quantity, 0.25) AS p25, quantile_cont(l_quantity, 0.5) AS p50,
              quantile_cont(l_quantity, 0.75) AS p75, max(l_quantity) AS max, round(var_pop(l_quantity), 6) AS var_pop
       FROM lineitem""",
)
def a31_describe_quantity(spark, d):
    from assayspark.session import table

    x = P.describe(table(spark, d, "lineitem"), "l_quantity")
    return x.select("count", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"), "min", "p25", "p50", "p75", "max",
                    r6(F.col("var_pop")).alias("var_pop"))


@query(
    "p09_p10_missing_filters",
    """WITH s AS (SELECT feature, count(value) n, avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) rate
                  FROM matrix_sparse GROUP BY feature)
       SELECT feature, count(*) AS n_rows FROM matrix_sparse
       WHERE feature IN (SELECT feature FROM s WHERE n > 0 AND rate <= 0.5) GROUP BY feature""",
    ("matrix_sparse",),
)
def p09_p10_missing_filters(spark, d):
    m = S.drop_missing_rate(S.drop_all_missing(view(spark, d, "matrix_sparse")), 0.5)
    return m.groupBy("feature").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "p12_drop_constant",
    """SELECT feature, count(*) AS n_rows FROM matrix_sparse WHERE feature IN
         (SELECT feature FROM matrix_sparse GROUP BY feature HAVING stddev_pop(value) <> 0) GROUP BY feature""",
    ("matrix_sparse",),
)
def p12_drop_constant(spark, d):
    return P.drop_constant(view(spark, d, "matrix_sparse")).groupBy("feature").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "m02_standardize",
    """SELECT feature, sample, round((value - avg(value) OVER (PARTITION BY feature))
                                     / CASE WHEN stddev_pop(value) OVER (PARTITION BY feature) = 0 THEN 1
                                            ELSE stddev_pop(value) OVER (PARTITION BY feature) END, 6) AS value
       FROM matrix""",
    ("matrix",),
)
def m02_standardize(spark, d):
    z = S.standardize(view(spark, d, "matrix"))
    return z.select("feature", "sample", r6(F.col("value")).alias("value"))
