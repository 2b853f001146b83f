"""Registered queries: image arrays, model-output scoring and run logs (projects 3, 5 and 6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayspark.functions import images as I
from assayspark.functions import tokens as K
from assayspark.operators import profile as P
from assayspark.operators import scoring as S
from assayspark.operators import windows as W
from assayspark.plans.registry import query, view
from assayspark.session import table

FOLD_SQL = f"CAST(({K.arith_hash_sql('id', '7')}) % 5 AS INTEGER)"


def _channel_sums(df, col):
    return df.select("id", F.posexplode(col).alias("ch", "x")).select(
        "id", F.col("ch").cast("int").alias("ch"), F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v), 6).alias("s")
    )


@query(
    "f12_minmax_channels",
    """SELECT id, CAST(ch - 1 AS INTEGER) AS ch,
              round(CASE WHEN list_max(c) = list_min(c) THEN list_sum(c) ELSE (list_sum(c) - 64 * list_min(c)) / (list_max(c) - list_min(c)) END, 6) AS s,
              round(CASE WHEN list_max(c) = list_min(c) THEN 0 ELSE (list_sum(c) - 64 * list_min(c)) / (list_max(c) - list_min(c)) END, 6) AS s_zero
       FROM (SELECT id, unnest(channels) AS c, unnest(range(1, 4)) AS ch FROM image) t""",
    ("image",),
)
def f12_minmax_channels(spark, d):
    im = view(spark, d, "image")
    a = _channel_sums(im.select("id", I.minmax_channels(F.col("channels")).alias("c")), "c")
    b = _channel_sums(im.select("id", I.minmax_channels(F.col("channels"), constant_to_zero=True).alias("c")), "c")
    return a.join(b.withColumnRenamed("s", "s_zero"), ["id", "ch"])


@query(
    "f13_resize",
    """SELECT id, CAST(ch - 1 AS INTEGER) AS ch, round((c[1] + c[2] + c[9] + c[10]) / 4, 4) AS p00, round(list_sum(c) / 4, 4) AS s
       FROM (SELECT id, unnest(channels) AS c, unnest(range(1, 4)) AS ch FROM image) t""",
    ("image",),
)
def f13_resize(spark, d):
    im = view(spark, d, "image")
    r = im.select("id", I.resize_udf(8, 8, 4, 4)(F.col("channels")).alias("r"))
    x = r.select("id", F.posexplode("r").alias("ch", "c"))
    return x.select(
        "id", F.col("ch").cast("int").alias("ch"), F.round(F.element_at("c", 1).cast("double"), 4).alias("p00"),
        F.round(F.aggregate("c", F.lit(0.0), lambda a, v: a + v.cast("double")), 4).alias("s"),
    )


@query(
    "f14_flips",
    """SELECT id, channels[1][8] AS h0, channels[1][57] AS v0, channels[2][64] AS hv_last FROM image""",
    ("image",),
)
def f14_flips(spark, d):
    im = view(spark, d, "image")
    h = I.flip_h(F.col("channels"), 8)
    v = I.flip_v(F.col("channels"), 8)
    hv = I.flip_v(I.flip_h(F.col("channels"), 8), 8)
    return im.select(
        "id", F.element_at(F.element_at(h, 1), 1).alias("h0"), F.element_at(F.element_at(v, 1), 1).alias("v0"),
        F.element_at(F.element_at(hv, 2), 1).alias("hv_last"),
    )


def _draw(seed: int) -> str:
    return f"({K.arith_hash_sql('id', '1', str(seed))}) / {float(K.HASH_MOD)}"


@query(
    "f14_augment",
    f"""WITH d AS (SELECT id, channels[1] AS c, {_draw(42)} < 0.5 AS fh, {_draw(43)} < 0.5 AS fv, ({_draw(44)} * 2 - 1) * 90.0 AS angle FROM image),
             o AS (SELECT d.*, CAST(p % 8 AS DOUBLE) - 3.5 AS dx, CAST(p // 8 AS DOUBLE) - 3.5 AS dy FROM d, (SELECT unnest(range(64)) AS p)),
             r AS (SELECT *, CAST(round(cos(radians(angle)) * dx + sin(radians(angle)) * dy + 3.5) AS INTEGER) AS ix,
                          CAST(round(cos(radians(angle)) * dy - sin(radians(angle)) * dx + 3.5) AS INTEGER) AS iy FROM o),
             v AS (SELECT *, CASE WHEN ix BETWEEN 0 AND 7 AND iy BETWEEN 0 AND 7
                          THEN CAST(CAST(c[8 * (CASE WHEN fv THEN 7 - iy ELSE iy END) + (CASE WHEN fh THEN 7 - ix ELSE ix END) + 1] AS FLOAT) AS DOUBLE) ELSE 0 END AS x FROM r)
        SELECT id, any_value(fh) AS _flip_h, any_value(fv) AS _flip_v, round(any_value(angle), 4) AS angle, round(sum(x), 4) AS sum0 FROM v GROUP BY id""",
    ("image",),
)
def f14_augment(spark, d):
    """Seeded flips + rotation per (id, epoch); the per-image draw is shared by all channels."""
    im = view(spark, d, "image")
    a = I.augment(im, "channels", "id", epoch=1, h=8, w=8)
    return a.select("id", "_flip_h", "_flip_v", F.round("_angle", 4).alias("angle"),
                    F.round(F.aggregate(F.element_at("channels", 1), F.lit(0.0), lambda s, v: s + v.cast("double")), 4).alias("sum0"))


@query(
    "f15_softmax_argmax",
    """SELECT id, CAST(list_position(logits, list_max(logits)) - 1 AS INTEGER) AS pred,
              round(1.0 / list_sum(list_transform(logits, lambda v: exp(v - list_max(logits)))), 6) AS p_max
       FROM logits""",
    ("logits",),
)
def f15_softmax_argmax(spark, d):
    lg = view(spark, d, "logits")
    return lg.select("id", K.argmax(F.col("logits")).cast("int").alias("pred"), F.round(F.array_max(K.softmax(F.col("logits"))), 6).alias("p_max"))


CE_SQL = "(list_max(logits) + ln(list_sum(list_transform(logits, lambda v: exp(v - list_max(logits))))) - logits[label + 1])"


@query(
    "f16_a34_ce_accuracy",
    f"""SELECT label, round(avg(CASE WHEN list_position(logits, list_max(logits)) - 1 = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
               count(*) AS n, round(avg({CE_SQL}), 6) AS mean_loss FROM logits GROUP BY label""",
    ("logits",),
)
def f16_a34_ce_accuracy(spark, d):
    lg = view(spark, d, "logits").select("label", K.argmax(F.col("logits")).alias("pred"), K.cross_entropy(F.col("logits"), F.col("label")).alias("ce"))
    out = lg.groupBy("label").agg(
        F.round(F.avg((F.col("pred") == F.col("label")).cast("double")), 6).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("ce"), 6).alias("mean_loss"),
    )
    return out


@query(
    "a34_weighted_loss",
    f"""SELECT round(avg(CASE WHEN list_position(logits, list_max(logits)) - 1 = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
               count(*) AS n, round(sum({CE_SQL} * (1 + id % 3)) / sum(1 + id % 3), 6) AS mean_loss FROM logits""",
    ("logits",),
)
def a34_weighted_loss(spark, d):
    lg = view(spark, d, "logits").select(
        "label", K.argmax(F.col("logits")).alias("pred"), K.cross_entropy(F.col("logits"), F.col("label")).alias("ce"),
        (1 + F.col("id") % 3).cast("double").alias("w"),
    )
    a = P.accuracy_and_loss(lg, "pred", "label", "ce", "w")
    return a.select(F.round("accuracy", 6).alias("accuracy"), "n", F.round("mean_loss", 6).alias("mean_loss"))


@query(
    "f19_kl_standard_normal",
    """SELECT round(avg(-0.5 * list_sum(list_transform(range(32), lambda i: 1 + CAST(embedding[33 + i] AS DOUBLE)
                 - CAST(embedding[1 + i] AS DOUBLE) * CAST(embedding[1 + i] AS DOUBLE) - exp(CAST(embedding[33 + i] AS DOUBLE))))), 6) AS kl
       FROM embeddings""",
)
def f19_kl_standard_normal(spark, d):
    e = table(spark, d, "embeddings").select(F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    kl = K.kl_standard_normal(F.slice("e", 1, 32), F.slice("e", 33, 32))
    return e.agg(F.round(F.avg(kl), 6).alias("kl"))


@query(
    "a36_auc_per_fold",
    f"""WITH s AS (SELECT id, {FOLD_SQL} AS fold, logits[4] AS score, CASE WHEN label = 3 THEN 1 ELSE 0 END AS y FROM logits),
             r AS (SELECT *, rank() OVER (PARTITION BY fold ORDER BY score) + (count(*) OVER (PARTITION BY fold, score) - 1) / 2.0 AS rk FROM s)
        SELECT fold, round((sum(CASE WHEN y = 1 THEN rk ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))), 6) AS auc
        FROM r GROUP BY fold""",
    ("logits",),
)
def a36_auc_per_fold(spark, d):
    lg = view(spark, d, "logits").select(
        (K.arith_hash(F.col("id"), F.lit(7)) % 5).cast("int").alias("fold"),
        F.element_at("logits", 4).alias("score"),
        (F.col("label") == 3).cast("int").alias("y"),
    )
    a = S.roc_auc(lg, "score", "y", ["fold"])
    return a.select("fold", F.round("auc", 6).alias("auc"))


@query(
    "a36_auc_summary",
    f"""WITH s AS (SELECT id, {FOLD_SQL} AS fold, logits[4] AS score, CASE WHEN label = 3 THEN 1 ELSE 0 END AS y FROM logits),
             r AS (SELECT *, rank() OVER (PARTITION BY fold ORDER BY score) + (count(*) OVER (PARTITION BY fold, score) - 1) / 2.0 AS rk FROM s),
             f AS (SELECT fold, (sum(CASE WHEN y = 1 THEN rk ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) AS auc
                   FROM r GROUP BY fold)
        SELECT round(avg(auc), 6) AS mean, round(stddev_pop(auc), 6) AS sd, count(*) AS n_folds FROM f""",
    ("logits",),
)
def a36_auc_summary(spark, d):
    lg = view(spark, d, "logits").select(
        (K.arith_hash(F.col("id"), F.lit(7)) % 5).cast("int").alias("fold"),
        F.element_at("logits", 4).alias("score"),
        (F.col("label") == 3).cast("int").alias("y"),
    )
    s = S.fold_summary(S.roc_auc(lg, "score", "y", ["fold"]), "auc")
    return s.select(F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"), "n_folds")


@query(
    "a38_batch_means",
    f"""SELECT round(avg(m), 6) AS mean_ce, count(*) AS n_batches FROM
          (SELECT id // 16 AS b, avg({CE_SQL}) AS m FROM logits GROUP BY 1) t""",
    ("logits",),
)
def a38_batch_means(spark, d):
    lg = view(spark, d, "logits").select("id", K.cross_entropy(F.col("logits"), F.col("label")).alias("ce"))
    b = S.batch_means(lg, "id", "ce", 16)
    return b.select(F.round("mean_ce", 6).alias("mean_ce"), "n_batches")


@query(
    "a35_ami",
    """WITH x AS (SELECT label AS a, CAST(vec_id % 4 AS INTEGER) + CASE WHEN label < 5 THEN 0 ELSE 4 END AS b FROM embeddings),
            n AS (SELECT count(*) AS n FROM x),
            ct AS (SELECT a, b, count(*) AS nab FROM x GROUP BY a, b),
            ra AS (SELECT a, count(*) AS na FROM x GROUP BY a),
            cb AS (SELECT b, count(*) AS nb FROM x GROUP BY b),
            mi AS (SELECT sum(nab / n * ln(n * nab / (na * nb))) AS mi FROM ct JOIN ra USING (a) JOIN cb USING (b), n),
            ent AS (SELECT (SELECT -sum(na / n * ln(na / n)) FROM ra, n) AS ha, (SELECT -sum(nb / n * ln(nb / n)) FROM cb, n) AS hb),
            sup AS (SELECT na, nb, n, unnest(range(greatest(1, na + nb - n), least(na, nb) + 1)) AS k FROM ra, cb, n),
            emi AS (SELECT coalesce(sum(k / n * ln(n * k / (na * nb)) * exp(lgamma(na + 1) + lgamma(nb + 1) + lgamma(n - na + 1) + lgamma(n - nb + 1)
                       - lgamma(n + 1) - lgamma(k + 1) - lgamma(na - k + 1) - lgamma(nb - k + 1) - lgamma(n - na - nb + k + 1))), 0) AS emi FROM sup)
       SELECT round(mi, 6) AS mi, round(emi, 6) AS emi, round((mi - emi) / (0.5 * (ha + hb) - emi), 6) AS ami FROM mi, ent, emi""",
)
def a35_ami(spark, d):
    e = table(spark, d, "embeddings").select(
        F.col("label").alias("a"), ((F.col("vec_id") % 4).cast("int") + F.when(F.col("label") < 5, 0).otherwise(4)).alias("b")
    )
    r = S.adjusted_mutual_info(e, "a", "b")
    return r.select(F.round("mi", 6).alias("mi"), F.round("emi", 6).alias("emi"), F.round("ami", 6).alias("ami"))


@query(
    "a39_best_run",
    """SELECT run, step, metric FROM runs ORDER BY metric DESC, step ASC, run ASC LIMIT 1""",
    ("runs",),
)
def a39_best_run(spark, d):
    r = view(spark, d, "runs")
    best = P.best_run(r, "run", F.struct(F.col("metric"), (-F.col("step")).alias("neg_step")))
    return best.select("run", (-F.col("best.neg_step")).alias("step"), F.col("best.metric").alias("metric"))


@query(
    "w06_running_best",
    """SELECT run, step, metric, coalesce(prev IS NULL OR metric > prev, true) AS is_new_best FROM
         (SELECT *, max(metric) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM runs) t""",
    ("runs",),
)
def w06_running_best(spark, d):
    r = W.running_best(view(spark, d, "runs"), ["run"], "step", "metric")
    return r.select("run", "step", "metric", "is_new_best")


@query(
    "w07_patience",
    """WITH x AS (SELECT run, step, loss, (lag(loss) OVER w - loss) / lag(loss) OVER w AS rel FROM runs WINDOW w AS (PARTITION BY run ORDER BY step)),
            y AS (SELECT *, rel IS NOT NULL AND rel <= 1e-6 AS bad FROM x),
            z AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY run ORDER BY step ROWS UNBOUNDED PRECEDING) AS isl FROM y)
       SELECT run, step, round(rel, 6) AS rel_improve, bad,
              CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER (PARTITION BY run, isl ORDER BY step ROWS UNBOUNDED PRECEDING) AS INTEGER) AS bad_run
       FROM z""",
    ("runs",),
)
def w07_patience(spark, d):
    p = W.patience(view(spark, d, "runs"), ["run"], "step", "loss", 1e-6, 3)
    return p.select("run", "step", F.round("rel_improve", 6).alias("rel_improve"), "bad", F.col("bad_run").cast("int").alias("bad_run"))
