"""Registered queries: the trainable-model flows (mutation classifier, cells, chromatin regression, search).

Fits have no SQL equivalent; what goes into them and comes out of them in closed
form (imputed and scaled cells, fallback rows, dense arrays) is checked by SQL
in queries of its own.  Each reads the driver tables through the stand-in views.
"""

from __future__ import annotations


import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.functions import sequence as Q
from assayspark.functions.tokens import arith_hash, arith_hash_sql
from assayspark.operators import cells as C
from assayspark.operators import histogram_trees as HT
from assayspark.operators import ml as ML
from assayspark.operators import profile as P
from assayspark.operators import sampling as X
from assayspark.operators import select as S
from assayspark.operators import stacked_linear as LIN
from assayspark.operators.knn import knn_classify, knn_join
from assayspark.operators.scoring import adjusted_mutual_info, adjusted_mutual_info_per, roc_auc
from assayspark.plans.registry import query, view
from assayspark.session import scratch_path, table
from assayspark.sources import motifs as M
from assayspark.sources import sinks as SK

# Stand-in classifier targets ("genes") are embedding classes; L42 never occurs (fallback path).
TARGETS = {**{f"L{c}": c for c in range(10)}, "L42": 42}
# Boosting rounds of the chromatin regression.
M20_ROUNDS = 200


def _split_samples(spark, d):
    """Samples with a seeded exact 30% test split."""
    e = view(spark, d, "matrix").select("sample", F.col("dataset").alias("cls")).distinct()
    return X.exact_split(e, "sample", 0.3, seed=42)


def scaled_cells(train, test):
    """M01 + M02 in long form: both sides imputed with the train medians, then scaled by the imputed train matrix."""
    full_train, full_test = ML.impute_median(train, train), ML.impute_median(train, test)
    return S.standardize(full_train, full_train), S.standardize(full_train, full_test)


SPLIT3 = f"({arith_hash_sql('sample', '11')}) % 3 = 0"


@query(
    "m01_m02_scaled_cells",
    f"""WITH t AS (SELECT *, {SPLIT3} AS test FROM matrix_sparse),
             med AS (SELECT feature, median(value) AS med FROM t WHERE NOT test GROUP BY feature),
             i AS (SELECT t.feature, t.sample, t.row_idx, t.dataset, t.test, coalesce(t.value, med.med) AS value FROM t LEFT JOIN med USING (feature)),
             st AS (SELECT feature, avg(value) AS mu, stddev_pop(value) AS sd FROM i WHERE NOT test GROUP BY feature)
        SELECT i.feature, i.sample, i.row_idx, i.dataset, i.test,
               round((value - mu) / CASE WHEN sd IS NULL OR sd = 0 THEN 1 ELSE sd END, 5) AS z FROM i LEFT JOIN st USING (feature)""",
    ("matrix_sparse",),
)
def m01_m02_scaled_cells(spark, d):
    """Train and test cells of a matrix with missing values, as they go into the vectors."""
    m = view(spark, d, "matrix_sparse").withColumn("test", arith_hash(F.col("sample"), F.lit(11)) % 3 == 0)
    tr, te = scaled_cells(m.where(~F.col("test")), m.where("test"))
    return tr.unionByName(te).select("feature", "sample", "row_idx", "dataset", "test", F.round("value", 5).alias("z"))


def prepared_features(spark, d, var_threshold: float = 0.005, top_n: int = 32):
    """3.1 feature preparation in long form: split, select (M03/W02) on train, impute (M01), scale (M02), assemble.

    The two vector tables are written once: every estimator makes many passes over them.
    """
    m = view(spark, d, "matrix")
    split = materialized(_split_samples(spark, d), "split")
    m = m.join(split.select("sample", "split"), "sample")
    train, test = m.where(F.col("split") == "train"), m.where(F.col("split") == "val")
    sel = S.variance_select(train, var_threshold, top_n).where("selected").select("feature")
    z_train, z_test = scaled_cells(train.join(sel, "feature", "left_semi"), test.join(sel, "feature", "left_semi"))
    labels = split.select("sample", "cls")
    out = [ML.feature_vectors(z)[0].join(labels, "sample") for z in (z_train, z_test)]
    return materialized(out[0], "train"), materialized(out[1], "test")


def materialized(df, name: str):
    """A table in the shared folder: read many times, nothing to release afterwards."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query("m04_m10_k01_k02_predictions")
def m04_m10_k01_k02_predictions(spark, d):
    """Per target gene: balanced elastic-net LR (C = 0.01, l1_ratio 0.5) -> P(mutated) per test sample,
    formatted 'sample %.5f'; a target with no positive training sample gets the constant 0.0 (K02)."""
    train, test = prepared_features(spark, d)
    present = {r["cls"] for r in train.select("cls").distinct().collect()}  # one row per target

    def fit(item):
        gene, c = item
        tr = ML.with_balanced_weights(train.withColumn("label", (F.col("cls") == c).cast("double")), "label")
        model = ML.elastic_net(C=0.01, weight_sum=tr.agg(F.sum("weight")).first()[0]).fit(tr)
        return ML.p_class1(model.transform(test)).select(F.lit(gene).alias("gene"), "sample", "prob")

    with ThreadPoolExecutor(max_workers=4) as pool:  # independent fits
        outs = list(pool.map(fit, [(g, c) for g, c in TARGETS.items() if c in present]))
    missing = [g for g, c in TARGETS.items() if c not in present]
    if missing:
        outs.append(SK.constant_fallback(test, missing))
    res = reduce(lambda a, b: a.unionByName(b), outs)
    return res.select("gene", "sample", F.format_string("%s %.5f", F.col("sample").cast("string"), "prob").alias("line"))


@query(
    "k02_constant_rows",
    """SELECT 'L' || CAST(l.label AS VARCHAR) AS gene, vec_id AS sample, printf('%s %.5f', CAST(vec_id AS VARCHAR), 0.0) AS line
       FROM embeddings, (SELECT unnest(range(40, 43)) AS label) l WHERE l.label NOT IN (SELECT label FROM embeddings)""",
)
def k02_constant_rows(spark, d):
    """Targets that no sample has: the constant probability, written as prediction files and read back."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("sample"), "label")
    absent = [g for g in (40, 41, 42) if e.where(F.col("label") == g).isEmpty()]
    path = scratch_path(spark, f"fallback-{uuid.uuid4().hex}")
    SK.write_predictions(SK.constant_fallback(e, [f"L{g}" for g in absent]), path)
    lines = spark.read.text(path)
    return lines.select("gene", F.split("value", " ")[0].cast("long").alias("sample"), F.col("value").alias("line"))


@query(
    "k03_dense_arrays",
    """SELECT row_idx, vec_id, round(list_sum(embedding), 4) AS total FROM
       (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row_idx, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS embedding FROM embeddings) t""",
)
def k03_dense_arrays(spark, d):
    """Factor rows written as a dense array in row order; the row index is the place in the written files."""
    from assayspark.sources.files import with_row_index

    path = scratch_path(spark, f"arrays-{uuid.uuid4().hex}")
    SK.write_arrays(table(spark, d, "embeddings").select("vec_id", "embedding"), path, order="vec_id")
    back = with_row_index(spark.read.parquet(path).select("*", "_metadata"))
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return back.select(F.col("row_idx"), "vec_id", F.round(total, 4).alias("total"))


def _with_folds(spark, d, cls: int):
    """Training rows with a target, balanced weights and 5 stratified folds; test rows with weight 0 and fold -2."""
    train, test = prepared_features(spark, d)
    tr = ML.with_balanced_weights(train.withColumn("label", (F.col("cls") == cls).cast("int")), "label")
    tr = X.stratified_folds(tr, "sample", "label", 5, seed=42)
    te = test.withColumn("label", (F.col("cls") == cls).cast("int"))
    cols = ["sample", "features", "label"]
    rows = tr.select(*cols, F.col("fold").cast("int").alias("fold"), "weight").unionByName(te.select(*cols, F.lit(-2).alias("fold"), F.lit(0.0).alias("weight")))
    return materialized(rows, "folds")


def _fold_auc(scored, fits):
    """Mean and population sd of the AUC over the folds of each group of five fits: [(mean, sd)]."""
    held = F.element_at(F.array(*[F.lit(f.without_fold) for f in fits]), F.col("fit") + 1)
    auc = roc_auc(scored.where(F.col("fold") == held), "score", "label", group=["fit"])
    per = auc.groupBy(F.floor(F.col("fit") / 5).cast("int").alias("g")).agg(F.avg("auc").alias("m"), F.stddev_pop("auc").alias("s"))
    return {r.g: (r.m, r.s) for r in per.collect()}  # one row per model or grid point


@query("m05_m08_model_bakeoff")
def m05_m08_model_bakeoff(spark, d):
    """Four models by 5-fold stratified AUC for one target; the winner (strict >, first listed wins) is refit on all
    training rows and applied to the test rows.  All folds and the refits of a kind are grown in the same passes."""
    rows = _with_folds(spark, d, 3)
    folds = range(5)
    counts = {r.label: r.n for r in rows.where("weight > 0").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    linear = [LIN.LinearFit("logistic", 0.1, r, without_fold=f) for r in (1.0, 0.5) for f in folds] + [LIN.LinearFit("logistic", 0.1, r) for r in (1.0, 0.5)]
    forest = HT.Fit("gini", 200, 10, features="sqrt", min_child=5)
    boost = HT.Fit("logistic", 100, 3, pos_weight=counts.get(0, 1) / max(1, counts.get(1, 0)))
    each = lambda f: [replace(f, without_fold=k) for k in (*folds, -1)]
    plain = rows.withColumn("weight", F.when(F.col("weight") > 0, 1.0).otherwise(0.0))
    jobs = (
        lambda: LIN.fit_all(LIN.pack(rows, "sample", "label", weight="weight", fold="fold"), linear),
        lambda: HT.grow(HT.binned(rows, "sample", "label", weight="weight", fold="fold", max_bins=64), each(forest)),
        lambda: HT.grow(HT.binned(plain, "sample", "label", weight="weight", fold="fold"), each(boost)),
    )
    with ThreadPoolExecutor(max_workers=3) as pool:  # independent sequences of jobs
        m, gf, gb = pool.map(lambda f: f(), jobs)
    sigmoid = lambda c: 1 / (1 + F.exp(-c))
    of = {
        "linear": (LIN.held_out(m).withColumn("score", sigmoid(F.col("scores")[0])), linear),
        "forest": (HT.forest_votes(gf, [(10, 200)]).withColumn("score", F.col("shares")[1]), gf.fits),
        "boosted": (HT.held_out(gb).withColumn("score", sigmoid(F.col("margins")[0])), gb.fits),
    }
    of = {k: (materialized(df.select("fit", "id", "fold", "label", "score"), f"scores-{k}"), fits) for k, (df, fits) in of.items()}
    auc = {k: _fold_auc(df, fits) for k, (df, fits) in of.items()}
    listed = [("l1_logistic", "linear", 0, 10), ("elastic_net", "linear", 1, 11), ("forest", "forest", 0, 5), ("boosted", "boosted", 0, 5)]
    best = max(listed, key=lambda x: auc[x[1]][x[2]][0])
    scored = spark.createDataFrame([(name, *auc[kind][g], name == best[0]) for name, kind, g, _ in listed], "model string, auc_mean double, auc_sd double, is_best boolean")
    won = of[best[1]][0].where((F.col("fit") == best[3]) & (F.col("fold") == -2))
    won = won.select(F.lit(best[0]).alias("model"), F.col("id").alias("sample"), "label", F.round("score", 6).alias("prob"))
    return scored.join(won, "model", "left")


GRID_C, GRID_L1 = (0.001, 0.01, 0.1, 1.0), (0.1, 0.3, 0.5, 0.7, 0.9)


@query("m09_elastic_net_grid")
def m09_elastic_net_grid(spark, d):
    """Elastic-net grid (4 C x 5 l1_ratio) by 5-fold AUC, 100 fits in one solver; refit on all rows; reports non-zero coefficients."""
    p = LIN.pack(_with_folds(spark, d, 7), "sample", "label", weight="weight", fold="fold")
    grid = [LIN.LinearFit("logistic", c, r) for c in GRID_C for r in GRID_L1]
    m = LIN.fit_all(p, [replace(g, without_fold=f) for g in grid for f in range(5)])
    auc = _fold_auc(materialized(LIN.held_out(m).select("fit", "id", "fold", "label", F.col("scores")[0].alias("score")), "grid-scores"), m.fits)
    best = max(range(len(grid)), key=lambda i: auc[i][0])
    nz = int((LIN.fit_all(p, [grid[best]]).coef[0][:, :-1] != 0).sum())
    rows = [(g.C, g.l1_ratio, auc[i][0], nz if i == best else None) for i, g in enumerate(grid)]
    return spark.createDataFrame(rows, "C double, l1_ratio double, auc double, nonzero_coef int")


@query(
    "m09_grid_optimality",
    f"""SELECT c.C AS "C", r.l1_ratio, count(*) AS n_rows, round(sum(e.w), 6) AS weight, true AS optimal
        FROM (SELECT unnest({list(GRID_C)}) AS C) c, (SELECT unnest({list(GRID_L1)}) AS l1_ratio) r,
             (SELECT count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY label = 7)) AS w FROM embeddings) e
        GROUP BY c.C, r.l1_ratio""",
)
def m09_grid_optimality(spark, d):
    """The optimality conditions of all 20 grid points, computed from the coefficients and the rows apart from the solver:
    at a coefficient of 0 the slope of the loss is within the l1 penalty, elsewhere it cancels the penalty's."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"), (F.col("label") == 7).cast("int").alias("y"))
    e = materialized(ML.with_balanced_weights(e, "y"), "optimality-rows")
    grid = [LIN.LinearFit("logistic", c, r) for c in GRID_C for r in GRID_L1]
    m = LIN.fit_all(LIN.pack(e, "id", "y", features="x", weight="weight"), grid)
    coef = [(g.C, g.l1_ratio, c[0, :-1].tolist(), float(c[0, -1])) for g, c in ((g, m.raw_coef(i)) for i, g in enumerate(grid))]
    coef_of = np.array([[*b, b0] for _, _, b, b0 in coef])

    def slopes(batches):
        """Per fit and feature the sums over a task's rows: one matrix product gives the scores, another one the slopes."""
        g, g0, w, n = np.zeros((len(grid), coef_of.shape[1] - 1)), np.zeros(len(grid)), 0.0, 0
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y, wt = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in (1, 2))
            r = wt[:, None] * (1 / (1 + np.exp(-np.clip(x @ coef_of[:, :-1].T + coef_of[:, -1], -700, 700))) - y[:, None])
            g, g0, w, n = g + r.T @ x, g0 + r.sum(axis=0), w + wt.sum(), n + len(x)
        d = g.shape[1]
        fit = np.repeat(np.arange(len(grid), dtype=np.int32), d)
        cols = [fit, np.tile(np.arange(d, dtype=np.int32), len(grid)), g.ravel(), g0[fit], np.full(g.size, w), np.full(g.size, n)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["fit", "j", "g", "g0", "w", "n"])

    sums = e.select("x", "y", "weight").mapInArrow(slopes, "fit int, j int, g double, g0 double, w double, n long").groupBy("fit", "j").agg(*[F.sum(c).alias(c) for c in ("g", "g0", "w", "n")])
    points = F.array(*[F.struct(F.lit(c).alias("C"), F.lit(r).alias("l1"), F.array(*map(F.lit, b)).alias("b")) for c, r, b, _ in coef])
    sums = sums.where("n > 0").withColumn("f", F.get(points, "fit")).select(F.col("f.C").alias("C"), F.col("f.l1").alias("l1"), F.get("f.b", "j").alias("b"), "g", "g0", "w", "n")
    slope = (F.col("g") + (1 - F.col("l1")) * F.col("b") / F.col("C")) / F.col("w")
    limit = F.col("l1") / F.col("C") / F.col("w")
    off = F.when(F.col("b") == 0, F.greatest(F.abs(slope) - limit, F.lit(0.0))).otherwise(F.abs(slope + limit * F.signum("b")))
    worst = F.max(F.greatest(off, F.abs(F.col("g0") / F.col("w"))))
    out = sums.groupBy("C", F.col("l1").alias("l1_ratio")).agg(F.max("n").alias("n_rows"), F.round(F.max("w"), 6).alias("weight"), (worst < 1e-5).alias("optimal"))
    return out


def cell_matrix(spark, d):
    """Cells stand-in: vec_id = cell, embedding slot = gene, values shifted to >= 0, normalised (A18), genes detected."""
    m = view(spark, d, "matrix")
    lo = m.agg(F.min("value")).scalar()
    m = m.withColumn("value", F.col("value") - lo)
    m = P.normalize_total_log1p(m)
    return P.detected_in(m, 3)


@query(
    "w08_variable_genes",
    """WITH m0 AS (SELECT feature, sample, value - (SELECT min(value) FROM matrix) AS v FROM matrix),
            t AS (SELECT sample, sum(v) AS tot FROM m0 GROUP BY sample),
            m AS (SELECT feature, ln(1 + m0.v / t.tot * 10000) AS value FROM m0 JOIN t USING (sample)),
            st AS (SELECT feature, avg(value) AS mean, var_samp(value) AS var FROM m GROUP BY feature),
            st2 AS (SELECT *, ln(CASE WHEN mean > 0 THEN var / mean END) AS ld,
                           CAST(least(floor((mean - (SELECT min(mean) FROM st)) / ((SELECT max(mean) FROM st) - (SELECT min(mean) FROM st)) * 20) + 1, 20) AS INTEGER) AS bin FROM st),
            pb AS (SELECT bin, avg(ld) AS bm, stddev_samp(ld) AS bs FROM st2 GROUP BY bin),
            z AS (SELECT feature, st2.bin, CASE WHEN bs IS NULL OR bs = 0 THEN 0.0 ELSE (ld - bm) / bs END AS z FROM st2 JOIN pb USING (bin)),
            top AS (SELECT feature FROM z ORDER BY round(z, 9) DESC, feature LIMIT 16)
       SELECT z.feature, z.bin, round(z.z, 6) AS z, z.feature IN (SELECT feature FROM top) AS highly_variable FROM z""",
    ("matrix",),
)
def w08_variable_genes(spark, d):
    m = view(spark, d, "matrix")
    lo = m.agg(F.min("value")).scalar()
    m = P.normalize_total_log1p(m.withColumn("value", F.col("value") - lo))
    h = C.dispersion_hvg(m, 16)
    return h.select("feature", "bin", F.round("z", 6).alias("z"), "highly_variable")


@query(
    "w08_variable_genes_raw",
    """WITH m AS (SELECT feature, value - (SELECT min(value) FROM matrix) AS v FROM matrix),
            st AS (SELECT feature, var_samp(v) AS var, ln(1 + avg(v)) AS lm FROM m GROUP BY feature),
            b AS (SELECT *, CAST(least(floor((lm - (SELECT min(lm) FROM st)) / ((SELECT max(lm) FROM st) - (SELECT min(lm) FROM st)) * 20) + 1, 20) AS INTEGER) AS bin FROM st),
            e AS (SELECT bin, avg(var) AS e FROM b GROUP BY bin),
            r AS (SELECT feature, b.bin, CASE WHEN e > 0 THEN var / e ELSE 0 END AS ratio FROM b JOIN e USING (bin)),
            top AS (SELECT feature FROM r ORDER BY round(ratio, 9) DESC, feature LIMIT 16)
       SELECT feature, bin, round(ratio, 6) AS ratio, feature IN (SELECT feature FROM top) AS highly_variable FROM r""",
    ("matrix",),
)
def w08_variable_genes_raw(spark, d):
    m = view(spark, d, "matrix")
    lo = m.agg(F.min("value")).scalar()
    h = C.normalised_variance_hvg(m.withColumn("raw_value", F.col("value") - lo), 16)
    return h.select("feature", "bin", F.round("ratio", 6).alias("ratio"), "highly_variable")


@query("m11_m12_a35_cluster_cells")
def m11_m12_a35_cluster_cells(spark, d):
    """Cells: variable genes (W08/W09) -> centred PCA (10) -> k-means (k = classes, 50 iterations, seed 42); AMI vs truth."""
    m = cell_matrix(spark, d)
    m = C.select_genes(m, m.select("feature").distinct(), 32)
    vec, _ = ML.feature_vectors(m)
    scores, _ = ML.centred_pca(materialized(vec, "cells"), 10)
    scores = materialized(scores, "scores")
    truth = view(spark, d, "matrix").select("sample", F.col("dataset").alias("label")).distinct()
    k = truth.select("label").distinct().count()
    clustered, _ = ML.kmeans(scores, k)
    out = materialized(clustered.join(truth, "sample").select("sample", "label", "cluster"), "clusters")
    ami = adjusted_mutual_info(out, "label", "cluster").first()["ami"]
    return out.withColumn("ami", F.lit(float(ami)))


def _cell_vectors_with_split(spark, d):
    m = cell_matrix(spark, d)
    truth = view(spark, d, "matrix").select("sample", F.col("dataset").alias("cls")).distinct()
    vec, _ = ML.feature_vectors(m)
    v = vec.join(truth, "sample").withColumn("split", F.when(arith_hash(F.col("sample"), F.lit(5)) % 2 == 0, "a").otherwise("b"))
    idx = ML.label_encoder("cls_s").fit(v.withColumn("cls_s", F.col("cls").cast("string")))
    v = materialized(idx.transform(v.withColumn("cls_s", F.col("cls").cast("string"))), "cell-vectors")
    return v, idx


@query("m13_m14_forest_labels")
def m13_m14_forest_labels(spark, d):
    """Cross-data-set labelling: balanced forest (0.3 of features per split) trained on set a, labels set b; AMI."""
    v, idx = _cell_vectors_with_split(spark, d)
    train = ML.with_balanced_weights(v.where("split = 'a'"), "label")
    model = ML.forest(n_trees=500, depth=10, min_leaf=1, subset="0.3").fit(train)
    pred = model.transform(v.where("split = 'b'"))
    pred = ML.label_decoder(idx).transform(pred)
    out = materialized(pred.select("sample", F.col("cls_s").alias("label"), "predicted_label"), "labels")
    ami = adjusted_mutual_info(out, "label", "predicted_label").first()["ami"]
    return out.withColumn("ami", F.lit(float(ami)))


def _out_of_fold_labels(rows, n_class: int, names: tuple[str, ...]):
    """(model, id, label, prediction) of the classifiers of M14-M17 for the rows that each fit was not trained on.

    ``rows`` has sample, features, label, fold, weight (0: never trained on) and balanced weights ``balanced``.  The
    fits of all folds are made together: one solver, one sequence of tree passes, one set of landmarks.
    """
    folds = [r.fold for r in rows.where("weight > 0").groupBy("fold").count().orderBy("fold").collect()]
    held = folds if len(folds) > 1 else [-1]
    # First of the largest scores, as an argmax.
    argmax = lambda c: (F.array_position(c, F.array_max(c)) - 1).cast("double")

    def keep(name, df):
        cols = [F.lit(name).alias("model"), F.col("id").cast("long").alias("id"), F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction")]
        return materialized(df.select(*cols), "out-of-fold")

    def elastic_net():
        fits = [LIN.LinearFit("softmax", 0.1, 0.5, without_fold=f, n_class=n_class) for f in held]
        m = LIN.fit_all(LIN.pack(rows, "sample", "label", weight="balanced", fold="fold"), fits, max_iter=1000, tol=1e-5)
        return [keep("elastic_net", LIN.held_out(m).withColumn("prediction", argmax(F.col("scores"))))]

    def svm_rbf():
        train = rows.where("weight > 0")
        marks = LIN.landmark_rows(train, "sample", "features", LANDMARKS)
        mapped = LIN.kernel_features(rows, marks, LIN.scale_gamma(train, "features"))
        fits = [p for f in held for p in LIN.one_vs_one(LIN.LinearFit("hinge2", 1.0, without_fold=f), range(n_class))]
        m = LIN.fit_all(LIN.pack(mapped, "sample", "label", weight="weight", fold="fold"), fits, max_iter=1000, tol=1e-3)
        return [keep("svm_rbf", LIN.vote(LIN.held_out(m), m.fits))]

    def boosted():
        g = HT.grow(HT.binned(rows, "sample", "label", weight="weight", fold="fold"), [HT.Fit("softmax", 100, 3, n_class=n_class, without_fold=f) for f in held])
        return [keep("boosted", HT.held_out(g).withColumn("prediction", argmax(F.col("margins"))))]

    def forest_200():
        weighted = HT.binned(rows, "sample", "label", weight="balanced", fold="fold", max_bins=64)
        g = HT.grow(weighted, [HT.Fit("gini", 200, 10, features="sqrt", n_class=n_class, without_fold=f) for f in held])
        votes = materialized(HT.forest_votes(g, [(10, 100), (10, 200)]), "forest-votes")
        return [keep(f"forest_{n}", votes.where(F.col("n_trees") == n)) for n in (100, 200)]

    def knn_20():
        v = materialized(rows.select("sample", F.col("label").cast("long").alias("label"), "fold", "weight", vector_to_array("features").alias("v")), "knn-rows")
        near = reduce(DataFrame.unionByName, [knn_join(v.where(F.col("fold") == f), v.where((F.col("fold") != f) & (F.col("weight") > 0)), 20, q_id="sample", r_id="sample") for f in held])
        near = materialized(near, "neighbours")
        truth = v.select(F.col("sample").alias("id"), F.col("label"))
        votes = {k: knn_classify(near.where(F.col("rank") <= k)).select(F.col("q_id").alias("id"), F.col("pred").alias("prediction")) for k in (5, 10, 15, 20)}
        return [keep(f"knn_{k}", got.join(truth, "id")) for k, got in votes.items()]

    # Independent sequences of jobs: run them from driver threads.
    families = [f for f in (svm_rbf, boosted, forest_200, elastic_net, knn_20) if f.__name__ in names]
    with ThreadPoolExecutor(max_workers=len(families)) as pool:
        return reduce(DataFrame.unionByName, [df for made in pool.map(lambda f: f(), families) for df in made])


#: Landmarks of the kernel classifier; with at least as many as training rows it is exact.
LANDMARKS = 256
ALL_MODELS = ("knn_5", "knn_10", "knn_15", "knn_20", "elastic_net", "svm_rbf", "boosted", "forest_100", "forest_200")


def _cell_rows(v):
    return ML.with_balanced_weights(v.withColumn("label", F.col("label").cast("int")), "label", "balanced")


@query("m16_m17_multiclass")
def m16_m17_multiclass(spark, d):
    """Kernel margin classifier, softmax boosted trees (100 rounds) and multinomial elastic net on the cell vectors; held-out accuracy and AMI."""
    v, _ = _cell_vectors_with_split(spark, d)
    rows = _cell_rows(v.where("split = 'a'")).select("sample", "features", "label", F.lit(0).alias("fold"), F.lit(1.0).alias("weight"), "balanced")
    held = v.where("split = 'b'").select("sample", "features", F.col("label").cast("int").alias("label"), F.lit(-1).alias("fold"), F.lit(0.0).alias("weight"), F.lit(0.0).alias("balanced"))
    rows = materialized(rows.unionByName(held), "multiclass")
    n_class = v.agg(F.max("label")).first()[0]
    p = _out_of_fold_labels(rows, int(n_class) + 1, ("elastic_net", "svm_rbf", "boosted"))
    acc = p.groupBy("model").agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))
    return acc.join(adjusted_mutual_info_per(p, ["model"], "label", "prediction").select("model", "ami"), "model")


@query("m18_out_of_fold_ami")
def m18_out_of_fold_ami(spark, d):
    """Nine classifiers' out-of-fold predictions over 5 folds, scored by one AMI each."""
    v, _ = _cell_vectors_with_split(spark, d)
    v = X.stratified_folds(_cell_rows(v), "sample", "label", 5, seed=42)
    rows = materialized(v.select("sample", "features", "label", F.col("fold").cast("int").alias("fold"), F.lit(1.0).alias("weight"), "balanced"), "folds")
    n_class = int(rows.agg(F.max("label")).first()[0]) + 1
    p = _out_of_fold_labels(rows, n_class, ALL_MODELS)
    return adjusted_mutual_info_per(p, ["model"], "label", "prediction")


@query("m18_m19_forest_grid_ami")
def m18_m19_forest_grid_ami(spark, d):
    """Balanced forest grid (3 sizes x 4 depths x 3 feature shares) scored by mean AMI over 5 folds; the best marked.

    Depth 0 stands for no limit (30 levels).  Trees are drawn by number and grown level by level, so one forest of 500
    deep trees per feature share and fold holds all sizes and depths of the grid.
    """
    v, _ = _cell_vectors_with_split(spark, d)
    v = X.stratified_folds(_cell_rows(v), "sample", "label", 5, seed=42)
    rows = materialized(v.select("sample", "features", "label", F.col("fold").cast("int").alias("fold"), "balanced"), "folds")
    n_class = int(rows.agg(F.max("label")).first()[0]) + 1
    b = HT.binned(rows, "sample", "label", weight="balanced", fold="fold", max_bins=32)
    shares, depths, sizes = ("sqrt", "log2", 0.3), (5, 10, 15, 30), (100, 200, 500)
    g = HT.grow(b, [HT.Fit("gini", max(sizes), max(depths), features=s, n_class=n_class, without_fold=f) for s in shares for f in range(5)])
    votes = materialized(HT.forest_votes(g, [(x, n) for x in depths for n in sizes]).select("fit", "depth", "n_trees", "id", "label", "prediction"), "grid-votes")
    ami = adjusted_mutual_info_per(votes, ["fit", "depth", "n_trees"], "label", "prediction")
    name = F.element_at(F.array(*[F.lit(str(s)) for s in shares]), (F.floor(F.col("fit") / 5) + 1).cast("int"))
    depth = F.when(F.col("depth") == max(depths), 0).otherwise(F.col("depth"))
    per = ami.groupBy(depth.cast("int").alias("max_depth"), F.col("n_trees").alias("num_trees"), name.alias("max_features")).agg(F.avg("ami").alias("ami"))
    best = per.agg(F.max("ami")).scalar()
    return per.withColumn("is_best", F.col("ami") == best)


def chromatin_frame(spark, d):
    """3.3: BED windows -> sequences (J09) -> motif features (F07) -> vectors, label = GC share of the window."""
    from pyspark.ml.functions import array_to_vector

    from assayspark.plans.sequence_q import bed_sequences

    s = bed_sequences(spark, d).select("row_idx", "seq", Q.gc_fraction(F.col("seq")).alias("label"))
    f = Q.motif_features(s, M.motif_list())
    fr = f.join(s.select("row_idx", "label"), "row_idx").select("row_idx", array_to_vector("features").alias("features"), "label")
    return materialized(fr, "chromatin")


@query("m20_gbt_chromatin")
def m20_gbt_chromatin(spark, d):
    """Boosted-tree regression of the window target from motif features; predictions for the held-out windows."""
    fr = X.exact_split(chromatin_frame(spark, d), "row_idx", 0.2, seed=42)
    fr = materialized(fr.withColumn("weight", F.when(F.col("split") == "train", 1.0).otherwise(0.0)), "chromatin-split")
    g = HT.grow(HT.binned(fr, "row_idx", "label", weight="weight"), [HT.Fit("squared", M20_ROUNDS, 7, rate=0.1, rows=0.8)])
    pred = materialized(HT.held_out(g).select(F.col("id").alias("row_idx"), "label", F.col("margins")[0].alias("prediction")), "chromatin-pred")
    r = pred.agg(F.corr("prediction", "label")).first()[0]
    return pred.withColumn("pearson_r", F.lit(float(r or 0.0)))


def _first_tree_sql(depth: int) -> str:
    """The first tree of a boosting fit in SQL: a pair of common table expressions per level, every value a threshold."""
    names = ("l_quantity", "l_discount", "l_tax")
    feats = ", ".join(f"({i}, CAST({c} AS DOUBLE))" for i, c in enumerate(names))
    score = lambda g, n: f"({g}) * ({g}) / (({n}) + 1.0)"
    parts = [f"""r0 AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS id, *, 1 AS node, 4.0 - l_linenumber AS g FROM lineitem)"""]
    for k in range(depth):
        parts.append(f"""
        v{k} AS (SELECT node, f.f, f.v, sum(g) AS g, count(*) AS n FROM r{k}, LATERAL (SELECT * FROM (VALUES {feats}) t(f, v)) f GROUP BY ALL),
        c{k} AS (SELECT node, f, v, sum(g) OVER w AS gl, sum(n) OVER w AS nl, sum(g) OVER (PARTITION BY node, f) AS gt, sum(n) OVER (PARTITION BY node, f) AS nt
                 FROM v{k} WINDOW w AS (PARTITION BY node, f ORDER BY v)),
        s{k} AS (SELECT * FROM (SELECT node, f, v, gt, nt, {score('gl', 'nl')} + {score('gt - gl', 'nt - nl')} - {score('gt', 'nt')} AS gain FROM c{k} WHERE nl < nt) WHERE gain > 1e-9
                 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1),
        r{k + 1} AS (SELECT r.* EXCLUDE (node), 2 * r.node + CASE WHEN CASE s.f WHEN 0 THEN CAST(l_quantity AS DOUBLE) WHEN 1 THEN CAST(l_discount AS DOUBLE) ELSE CAST(l_tax AS DOUBLE) END <= s.v THEN 0 ELSE 1 END AS node
                 FROM r{k} r JOIN s{k} s USING (node))""")
    splits = " UNION ALL ".join(f"SELECT node, f, v, gain, nt FROM s{k}" for k in range(depth))
    leaves = " UNION ALL ".join(f"SELECT node FROM r{k} ANTI JOIN s{k} USING (node)" for k in range(depth))
    return f"""WITH {", ".join(parts)}
        SELECT CAST(node AS BIGINT) AS node, CAST(f AS INTEGER) AS feature, v AS threshold, round(gain, 3) AS gain, nt AS n_rows FROM ({splits})
        UNION ALL SELECT node, NULL, NULL, NULL, count(*) FROM ({leaves} UNION ALL SELECT node FROM r{depth}) GROUP BY node"""


@query("m20_first_tree", _first_tree_sql(3))
def m20_first_tree(spark, d):
    """The first boosted tree over all line items: splits, gains and row counts of every node."""
    li = table(spark, d, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber").alias("id"), F.array(*[F.col(c).cast("double") for c in ("l_quantity", "l_discount", "l_tax")]).alias("features"), (F.col("l_linenumber") - 4).alias("label")
    )
    g = HT.grow(HT.binned(li, "id", "label"), [HT.Fit("squared", 1, 3, base=0.0)], local_cells=50_000)
    rows = [(n, f, v, round(x, 3) if x is not None else None, m) for n, f, v, x, m in HT.tree_table(g, 0)]
    return spark.createDataFrame(rows, "node long, feature int, threshold double, gain double, n_rows long")


@query("m21_regression_grid")
def m21_regression_grid(spark, d):
    """Regression grid (3 depths x 3 sizes x 2 rates x 3 row shares) by mean Pearson r over 5 folds; the best marked.

    The margins after 50, 100 and 200 rounds come from the same fit, so 18 x 5 fits grow together; 32 bins a feature.
    """
    fr = materialized(X.kfold(chromatin_frame(spark, d), "row_idx", 5, seed=42).withColumn("fold", F.col("fold").cast("int")), "chromatin-folds")
    points = [(depth, rate, rows) for depth in (3, 5, 7) for rate in (0.1, 0.01) for rows in (0.5, 0.8, 1.0)]
    sizes = (50, 100, 200)
    fits = [HT.Fit("squared", max(sizes), depth, rate=rate, rows=rows, without_fold=f) for depth, rate, rows in points for f in range(5)]
    g = HT.grow(HT.binned(fr, "row_idx", "label", fold="fold", max_bins=32), fits, stages=sizes)
    staged = [HT.held_out(g, n).select(F.lit(n).alias("n"), "fit", F.col("margins")[0].alias("p"), "label") for n in sizes]
    r = reduce(DataFrame.unionByName, staged).groupBy("n", "fit").agg(F.coalesce(F.corr("p", "label"), F.lit(0.0)).alias("r"))
    at = (F.floor(F.col("fit") / 5) + 1).cast("int")
    of = lambda i, kind: F.element_at(F.array(*[F.lit(x[i]) for x in points]), at).cast(kind)
    per = r.groupBy(of(0, "int").alias("max_depth"), F.col("n").alias("max_iter"), of(1, "double").alias("rate"), of(2, "double").alias("row_share")).agg(F.avg("r").alias("pearson_r"))
    per = materialized(per, "grid-scores")
    return per.withColumn("is_best", F.col("pearson_r") == per.agg(F.max("pearson_r")).scalar())


@query("m26_a39_random_search")
def m26_a39_random_search(spark, d):
    """Seeded random search (log-uniform regParam, uniform elasticNet) scored on a held-out split; best by A39 rule."""
    train, test = prepared_features(spark, d)
    tr = train.withColumn("label", (F.col("cls") == 3).cast("double"))
    te = test.withColumn("label", (F.col("cls") == 3).cast("double"))
    maps = ML.random_param_maps({"regParam": ("loguniform", 1e-4, 1.0), "elasticNetParam": ("uniform", 0.0, 1.0)}, 40, seed=42)

    def run(item):
        i, pm = item
        lr = ML.multinomial_elastic_net(pm["regParam"], pm["elasticNetParam"], 100).setFamily("binomial")
        pred = ML.p_class1(lr.fit(tr).transform(te))
        auc = roc_auc(pred, "prob", "label").first()["auc"]
        return i, pm["regParam"], pm["elasticNetParam"], float(auc) if auc is not None else None

    with ThreadPoolExecutor(max_workers=8) as pool:
        rows = list(pool.map(run, enumerate(maps)))
    df = spark.createDataFrame(rows, "run int, reg double, l1_ratio double, auc double")
    best = P.best_run(df.where(F.col("auc").isNotNull()), "run", F.struct(F.col("auc"), (-F.col("run")).alias("neg_run"))).first()["run"]
    return df.withColumn("is_best", F.col("run") == best)


@query("m27_k05_pipeline_export")
def m27_k05_pipeline_export(spark, d):
    """Scaler + classifier as one PipelineModel, written to the shared checkpoint folder, read back, applied to test rows."""
    train, test = prepared_features(spark, d)
    tr = train.withColumn("label", (F.col("cls") == 7).cast("double"))
    pipe = Pipeline(stages=[StandardScaler(inputCol="features", outputCol="scaled", withMean=True),
                            ML.multinomial_elastic_net(0.01, 0.0, 100).setFamily("binomial").setFeaturesCol("scaled")])
    model = pipe.fit(tr)
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    ML.export_model(model, path)
    loaded = PipelineModel.load(path)
    return ML.p_class1(loaded.transform(test)).select("sample", "cls", F.round("prob", 6).alias("prob"))
