"""Registered queries: splits, folds, class weights and weighted sampling over the embeddings labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayspark.functions.tokens import HASH_MOD, arith_hash_sql
from assayspark.operators import profile as P
from assayspark.operators import sampling as X
from assayspark.plans.registry import query
from assayspark.session import table

# Label domain for the class-count operators: embeddings labels 0..9 plus an always-empty class 10.
N_LABELS = 11


def labelled(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "label")


def label_domain(spark):
    return spark.range(N_LABELS).select(F.col("id").cast("int").alias("label"))


H = arith_hash_sql("vec_id", "42")


@query(
    "x02_stratified_split",
    f"""WITH c AS (SELECT label, count(*) AS n_c FROM embeddings GROUP BY label),
             t AS (SELECT CAST(ceil((SELECT count(*) FROM embeddings) * 0.2) AS BIGINT) AS n_val, (SELECT count(*) FROM embeddings) AS n),
             q AS (SELECT label, n_c, n_val * n_c / n AS quota FROM c, t),
             b AS (SELECT label, n_c, CAST(floor(quota) AS BIGINT) AS base, quota - floor(quota) AS fr FROM q),
             r AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY fr DESC, label)
                           <= (SELECT n_val FROM t) - (SELECT sum(base) FROM b) THEN 1 ELSE 0 END AS n_val FROM b),
             e AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY {H}, vec_id) AS rn FROM embeddings)
        SELECT e.vec_id AS id, e.label, CASE WHEN rn <= r.n_val THEN 'val' ELSE 'train' END AS split
        FROM e JOIN r ON e.label = r.label""",
)
def x02_stratified_split(spark, d):
    return X.stratified_split(labelled(spark, d), "id", "label", 0.2, 42).select("id", "label", "split")


@query(
    "x03_stratified_folds",
    f"""WITH c AS (SELECT label, count(*) AS n_c FROM embeddings GROUP BY label),
             o AS (SELECT label, coalesce(sum(n_c) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM c)
        SELECT vec_id AS id, e.label, CAST((row_number() OVER (PARTITION BY e.label ORDER BY {H}, vec_id) - 1 + off) % 5 AS INTEGER) AS fold
        FROM embeddings e JOIN o ON e.label = o.label""",
)
def x03_stratified_folds(spark, d):
    return X.stratified_folds(labelled(spark, d), "id", "label", 5, 42).select("id", "label", "fold")


@query(
    "x04_kfold",
    f"""SELECT vec_id AS id, CAST((row_number() OVER (ORDER BY {H}, vec_id) - 1) % 5 AS INTEGER) AS fold FROM embeddings""",
)
def x04_kfold(spark, d):
    return X.kfold(labelled(spark, d).select("id"), "id", 5, 42).select("id", "fold")


@query(
    "x05_balanced_weights",
    """SELECT label, count(*) AS n_c, round((SELECT count(*) FROM embeddings) / ((SELECT count(DISTINCT label) FROM embeddings) * count(*)), 6) AS weight
       FROM embeddings GROUP BY label""",
)
def x05_balanced_weights(spark, d):
    w = X.balanced_weights(labelled(spark, d), "label")
    return w.select("label", "n_c", F.round("weight", 6).alias("weight"))


@query(
    "a25_x06_class_counts_weights",
    f"""SELECT CAST(r.i AS INTEGER) AS label, coalesce(c.n, 0) AS count, round(1.0 / greatest(coalesce(c.n, 0), 1), 6) AS weight
        FROM range({N_LABELS}) r(i) LEFT JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY label) c ON c.label = r.i""",
)
def a25_x06_class_counts_weights(spark, d):
    cc = P.class_counts(labelled(spark, d), "label", label_domain(spark))
    return cc.select("label", "count", F.round(F.lit(1.0) / F.greatest(F.col("count"), F.lit(1)), 6).alias("weight"))


@query(
    "x07_weighted_sample",
    f"""WITH w AS (SELECT vec_id, e.label, 1.0 / c.n AS wt FROM embeddings e JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY label) c
                   ON e.label = c.label),
             b AS (SELECT vec_id, label, sum(wt) OVER (ORDER BY vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - wt AS lo,
                          sum(wt) OVER (ORDER BY vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi FROM w),
             t AS (SELECT sum(wt) AS total FROM w),
             dr AS (SELECT i AS draw, ({arith_hash_sql('i', '42')}) / {float(HASH_MOD)} * total AS u FROM range((SELECT count(*) FROM embeddings)) r(i), t)
        SELECT label, count(*) AS n_draws FROM dr JOIN b ON dr.u >= b.lo AND dr.u < b.hi GROUP BY label""",
)
def x07_weighted_sample(spark, d):
    e = labelled(spark, d)
    w = X.inverse_count_weights(e, "label", label_domain(spark))
    s = X.weighted_sample(w, "id", "weight", w.count(), seed=42)
    return s.groupBy("label").agg(F.count(F.lit(1)).alias("n_draws"))


@query(
    "x08_pos_weight",
    "SELECT round(sum(CASE WHEN label < 3 THEN 0.0 ELSE 1.0 END) / sum(CASE WHEN label < 3 THEN 1.0 ELSE 0.0 END), 6) AS pos_weight FROM embeddings",
)
def x08_pos_weight(spark, d):
    y = labelled(spark, d).select((F.col("label") < 3).cast("int").alias("y"))
    return X.pos_weight(y, "y").select(F.round("pos_weight", 6).alias("pos_weight"))


@query(
    "a26_label_counter",
    "SELECT label, count(*) AS count FROM embeddings GROUP BY label",
)
def a26_label_counter(spark, d):
    return P.label_counter(labelled(spark, d), "label")
