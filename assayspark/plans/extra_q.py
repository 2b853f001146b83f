"""Registered queries for inventory rows not isolated elsewhere: remaining scans, joins, windows and sorts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayspark.functions import tokens as K
from assayspark.functions.images import LABELS
from assayspark.operators import cells as C
from assayspark.operators import joins as J
from assayspark.operators import profile as P
from assayspark.operators import sampling as X
from assayspark.operators import windows as W
from assayspark.operators.ml import impute_median
from assayspark.plans.registry import query, view
from assayspark.plans.sequence_q import COUNTS_SQL, genome_counts
from assayspark.session import scratch_path, table
from assayspark.sources import files as R
from assayspark.sources import motifs as M

SPLIT_SQL = f"CASE WHEN ({K.arith_hash_sql('sample', '11')}) % 3 = 0 THEN 'test' ELSE 'train' END"


def _fresh(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@query(
    "s09_motif_file_scan",
    f"""WITH {COUNTS_SQL}
        SELECT 'MOTIF' || CAST(motif_id AS VARCHAR) AS name, CAST(motif_id * 0.25 AS FLOAT) AS threshold, CAST(count(DISTINCT j) AS INTEGER) AS len,
               round(sum(log2(((cnt + 0.01) / (row_sum + 0.04)) / 0.25)), 6) AS lod_sum FROM pf GROUP BY motif_id""",
    ("genome",),
)
def s09_motif_file_scan(spark, d):
    """Motifs counted from the genome, written as a four-column frequency file, scanned back, log-odds made again."""
    path = _fresh(spark, "motifs")
    m = genome_counts(spark, d).select(
        F.concat(F.lit("MOTIF"), F.col("motif_id").cast("string")).alias("name"), "motif_id", (F.col("motif_id") * 0.25).alias("threshold"), "counts"
    )
    M.write_motif_file(m, path)
    mf = M.scan_motif_file(spark, path)
    flat = F.flatten("log_odds")
    return mf.select("name", "threshold", "len", F.round(F.aggregate(flat, F.lit(0.0), lambda a, x: a + x), 6).alias("lod_sum"))


@query(
    "s10_cell_tables",
    """SELECT (SELECT count(*) FROM matrix) AS n_x, (SELECT count(DISTINCT sample) FROM matrix) AS n_obs,
              (SELECT count(DISTINCT feature) FROM matrix) AS n_var""",
    ("matrix",),
)
def s10_cell_tables(spark, d):
    base = _fresh(spark, "cells")
    m = view(spark, d, "matrix")
    m.select(F.col("sample").alias("cell_id"), F.col("feature").alias("gene"), "value").write.parquet(f"{base}/x")
    m.select(F.col("sample").alias("cell_id"), F.col("dataset").alias("cell_type")).distinct().write.parquet(f"{base}/obs")
    m.select(F.col("feature").alias("gene")).distinct().write.parquet(f"{base}/var")
    x, obs, var = R.read_cells(spark, base)
    return x.agg(
        F.count(F.lit(1)).alias("n_x"),
        obs.agg(F.count(F.lit(1))).scalar().alias("n_obs"),
        var.agg(F.count(F.lit(1))).scalar().alias("n_var"),
    )


LABELS_SQL = "[" + ", ".join(f"'{x}'" for x in LABELS) + "]"


@query(
    "s11_s12_j11_manifest_images",
    """SELECT row_number() OVER (ORDER BY id) - 1 AS row_idx, label, round(list_sum(channels[1]), 4) AS s0, round(list_sum(channels[2]), 4) AS s1,
              round(list_sum(channels[3]), 4) AS s2, round(channels[1][1], 4) AS first0, round(channels[3][64], 4) AS last2
       FROM image""",
    ("image",),
)
def s11_s12_j11_manifest_images(spark, d):
    """Manifest 'label f0 f1 f2' lines and one pixel record per channel file, joined back per manifest row."""
    base = _fresh(spark, "images")
    im = view(spark, d, "image")
    names = F.array(*[F.lit(x) for x in LABELS])
    files = [F.concat(F.lit("img_"), F.col("id").cast("string"), F.lit(f"_c{c}")) for c in range(3)]
    man = im.select("id", F.concat_ws(" ", F.element_at(names, F.col("label") + 1), *files).alias("value"))
    man.repartitionByRange(2, "id").sortWithinPartitions("id").select("value").write.text(f"{base}/manifest")
    ch = im.select("id", F.posexplode("channels").alias("c", "pixels"))
    name = F.concat(F.lit("img_"), F.col("id").cast("string"), F.lit("_c"), F.col("c").cast("string"))
    R.write_channels(ch.select(name.alias("name"), "pixels"), f"{base}/content")
    manifest = R.read_manifest(spark, f"{base}/manifest", {x: i for i, x in enumerate(LABELS)})
    j = R.read_images(spark, manifest, f"{base}/content")
    total = lambda c: F.round(F.aggregate(F.get("channels", c), F.lit(0.0), lambda a, v: a + v), 4).alias(f"s{c}")
    return j.select("row_idx", "label", *[total(c) for c in range(3)], F.round(F.get(F.get("channels", 0), 0), 4).alias("first0"), F.round(F.get(F.get("channels", 2), 63), 4).alias("last2"))


@query(
    "s13_token_parquet",
    """SELECT count(*) AS n, CAST(sum(length(s)) AS BIGINT) AS n_tokens FROM strings
       WHERE length(s) > 0 AND length(s) < 150 AND length(translate(s, 'C(=O)[-]N+1P234S#567HIBF89', '')) = 0""",
    ("strings",),
)
def s13_token_parquet(spark, d):
    path = _fresh(spark, "tokens")
    s = view(spark, d, "strings").where(K.valid_for_encoding(F.col("s"), 150))
    s.select("row_idx", F.transform(K.encode(F.col("s"), 150), lambda t: t.cast("tinyint")).alias("tokens")).write.parquet(path)
    t = R.read_tokens(spark, path)
    n_tok = F.aggregate("tokens", F.lit(0), lambda a, x: a + F.when(x != 0, 1).otherwise(0))
    return t.agg(F.count(F.lit(1)).alias("n"), F.sum(n_tok).cast("long").alias("n_tokens"))


@query(
    "p19_p20_p22_p23_lines",
    """SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS line_no, upper(p_name) AS name_upper,
              starts_with(p_name, 's') AS starts_s, ends_with(p_name, 'e') AS ends_e FROM part""",
)
def p19_p20_p22_p23_lines(spark, d):
    """Text lines written in key order over several files, read back with a file-order row index (P20)."""
    path = _fresh(spark, "names")
    p = table(spark, d, "part")
    p.repartitionByRange(3, "p_partkey").sortWithinPartitions("p_partkey").select(F.col("p_name").alias("value")).write.text(path)
    lines = R.read_lines(spark, path)
    out = lines.select(
        F.col("row_idx").alias("line_no"), F.upper("value").alias("name_upper"),
        F.col("value").startswith("s").alias("starts_s"), F.col("value").endswith("e").alias("ends_e"), "path",
    )
    return out.drop("path").select("name_upper", "starts_s", "ends_e", "line_no")  # P19: drop + reorder


@query(
    "j01_j02_annotate_features",
    """SELECT dataset, count(*) AS n_rows, count(symbol) AS n_mapped FROM matrix_sparse LEFT JOIN ref_map ON feature = id GROUP BY dataset""",
    ("matrix_sparse", "ref_map"),
)
def j01_j02_annotate_features(spark, d):
    a = J.annotate(view(spark, d, "matrix_sparse"), view(spark, d, "ref_map"), "feature", "id", "symbol", "symbol")
    return a.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_rows"), F.count("symbol").alias("n_mapped"))


@query(
    "j07_train_test_alignment",
    f"""WITH t AS (SELECT *, {SPLIT_SQL} AS split FROM matrix_sparse WHERE value IS NOT NULL),
             f AS (SELECT feature FROM t WHERE split = 'train' INTERSECT SELECT feature FROM t WHERE split = 'test')
        SELECT split, count(*) AS n_cells, count(DISTINCT feature) AS n_features FROM t WHERE feature IN (SELECT feature FROM f) GROUP BY split""",
    ("matrix_sparse",),
)
def j07_train_test_alignment(spark, d):
    m = view(spark, d, "matrix_sparse").where(F.col("value").isNotNull())
    m = m.withColumn("split", F.when(K.arith_hash(F.col("sample"), F.lit(11)) % 3 == 0, "test").otherwise("train"))
    tr, te = m.where("split = 'train'"), m.where("split = 'test'")
    tr2, te2 = J.semi(tr, te, ["feature"]), J.semi(te, tr, ["feature"])
    return tr2.unionByName(te2).groupBy("split").agg(F.count(F.lit(1)).alias("n_cells"), F.countDistinct("feature").alias("n_features"))


@query(
    "j13_motif_sequence_pairs",
    f"""WITH {__import__('assayspark.plans.sequence_q', fromlist=['SEQ_SQL']).SEQ_SQL},
         mt AS (SELECT DISTINCT motif_id, len FROM ({M.motif_cells_sql()}) m)
        SELECT mt.motif_id, count(*) AS n_scored FROM seqs JOIN mt ON length(seqs.seq) >= mt.len GROUP BY mt.motif_id""",
    ("genome", "bed"),
)
def j13_motif_sequence_pairs(spark, d):
    """Which (sequence, motif) pairs get scored: the motif set is a bounded literal array, not a joined table."""
    from assayspark.plans.sequence_q import bed_sequences

    lens = F.array(*[F.lit(int(m["counts"].shape[0])) for m in M.builtin_motifs()])
    s = bed_sequences(spark, d).select(F.length("seq").alias("n"))
    x = s.select("n", F.posexplode(lens).alias("motif_id", "len")).where(F.col("n") >= F.col("len"))
    return x.groupBy(F.col("motif_id").cast("int").alias("motif_id")).agg(F.count(F.lit(1)).alias("n_scored"))


@query(
    "j14_stack_shared_genes",
    """WITH t AS (SELECT * FROM matrix_sparse WHERE value IS NOT NULL),
             p AS (SELECT x.dataset AS da, y.dataset AS db FROM (SELECT DISTINCT dataset FROM t) x JOIN (SELECT DISTINCT dataset FROM t) y ON x.dataset < y.dataset),
             s AS (SELECT DISTINCT da, db, a.feature FROM p JOIN t a ON a.dataset = da JOIN t b ON b.dataset = db AND a.feature = b.feature)
        SELECT da || '+' || db AS stack, CASE WHEN t.dataset = da THEN 'a' ELSE 'b' END AS split, count(*) AS n
        FROM s JOIN t ON t.feature = s.feature AND t.dataset IN (da, db) GROUP BY 1, 2""",
    ("matrix_sparse",),
)
def j14_stack_shared_genes(spark, d):
    """Every pair of data sets stacked on its shared genes."""
    m = view(spark, d, "matrix_sparse").where(F.col("value").isNotNull())
    names = sorted(r["dataset"] for r in m.select("dataset").distinct().collect())  # one per cohort
    out = None
    for i, x in enumerate(names):
        for y in names[i + 1 :]:
            st = C.stack_shared(m.where(F.col("dataset") == x), m.where(F.col("dataset") == y))
            st = st.groupBy("split").agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"{x}+{y}").alias("stack"), "split", "n")
            out = st if out is None else out.unionByName(st)
    return out


@query(
    "j15_nearest_centroid",
    """WITH c AS (SELECT label AS c, feature, avg(value) AS mu FROM (SELECT label, vec_id, unnest(range(64)) AS feature,
                    CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings) t GROUP BY 1, 2),
            m AS (SELECT vec_id, unnest(range(64)) AS feature, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings),
            dist AS (SELECT vec_id, c, sum((value - mu) * (value - mu)) AS d2 FROM m JOIN c USING (feature) GROUP BY 1, 2)
       SELECT vec_id, CAST(arg_min(c, d2) AS INTEGER) AS centroid FROM dist GROUP BY vec_id""",
)
def j15_nearest_centroid(spark, d):
    """Nearest of k class centroids; the k x d centroid table is a bounded aggregate, passed as a literal array."""
    from assayspark.views import matrix

    cen = matrix(spark, d).groupBy("dataset", "feature").agg(F.avg("value").alias("mu"))
    rows = cen.orderBy("dataset", "feature").collect()
    by = {}
    for r in rows:
        by.setdefault(r["dataset"], []).append(float(r["mu"]))
    ids = sorted(by)
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    dists = F.array(*[
        F.aggregate(F.zip_with(F.col("v"), F.array(*[F.lit(x) for x in by[c]]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
        for c in ids
    ])
    best = F.array_position(dists, F.array_min(dists)) - 1
    lab = F.element_at(F.array(*[F.lit(int(c)) for c in ids]), (best + 1).cast("int"))
    return e.select("vec_id", lab.cast("int").alias("centroid"))


@query(
    "w02_top_n_per_group",
    """SELECT dataset, feature, round(v, 6) AS var_samp FROM (
         SELECT dataset, feature, var_samp(value) AS v, row_number() OVER (PARTITION BY dataset ORDER BY var_samp(value) DESC, feature) AS rn
         FROM matrix GROUP BY dataset, feature) t WHERE rn <= 3""",
    ("matrix",),
)
def w02_top_n_per_group(spark, d):
    st = view(spark, d, "matrix").groupBy("dataset", "feature").agg(F.var_samp("value").alias("v"))
    top = W.top_n_per_group(st.withColumn("_neg", -F.col("v")), ["dataset"], ["_neg", "feature"], 3)
    return top.select("dataset", "feature", F.round("v", 6).alias("var_samp"))


@query(
    "w09_reuse_selection",
    """SELECT count(*) AS n_cells, count(DISTINCT feature) AS n_genes FROM matrix WHERE feature % 4 = 1""",
    ("matrix",),
)
def w09_reuse_selection(spark, d):
    """A gene table that already carries ``highly_variable`` is used as is (no recomputation)."""
    m = view(spark, d, "matrix")
    var = m.select("feature").distinct().withColumn("highly_variable", F.col("feature") % 4 == 1)
    sel = C.select_genes(m, var, 16)
    return sel.agg(F.count(F.lit(1)).alias("n_cells"), F.countDistinct("feature").alias("n_genes"))


@query(
    "w10_cumulative_weights",
    """SELECT vec_id AS id, round(coalesce(sum(w) OVER (ORDER BY vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS lo,
              round(sum(w) OVER (ORDER BY vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS hi
       FROM (SELECT vec_id, CAST(label + 1 AS DOUBLE) AS w FROM embeddings) t""",
)
def w10_cumulative_weights(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), (F.col("label") + 1).cast("double").alias("w"))
    cw = X.cumulative_weights(e, "id", "w")
    return cw.select("id", F.round(F.coalesce("lo", F.lit(0.0)), 6).alias("lo"), F.round("hi", 6).alias("hi"))


@query(
    "j17_band_join",
    """WITH b AS (SELECT vec_id, sum(label + 1) OVER (ORDER BY vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi, label + 1 AS w FROM embeddings),
            u AS (SELECT i AS draw, (i * 7919) % (SELECT sum(label + 1) FROM embeddings) + 0.5 AS u FROM range(0, (SELECT count(*) FROM embeddings)) r(i))
       SELECT draw, vec_id FROM u JOIN b ON u.u >= b.hi - b.w AND u.u < b.hi""",
)
def j17_band_join(spark, d):
    """Each draw lands in exactly one [lo, hi) band: an equi-join on a bucket of the draw value."""
    e = table(spark, d, "embeddings").select("vec_id", (F.col("label") + 1).cast("double").alias("w"))
    bands = X.cumulative_weights(e, "vec_id", "w")
    total = e.agg(F.sum("w")).first()[0]
    n = e.count()
    draws = spark.range(n).select(F.col("id").alias("draw"), ((F.col("id") * 7919) % F.lit(int(total)) + 0.5).alias("u"))
    return J.band_join(draws, bands, "u", "lo", "hi").select("draw", "vec_id")


@query(
    "o01_o03_sorted_reports",
    """SELECT gene, count(*) AS count, CAST(row_number() OVER (ORDER BY count(*) DESC, gene) AS INTEGER) AS rank_desc,
              CAST(row_number() OVER (ORDER BY count(*), gene) AS INTEGER) AS rank_asc
       FROM mutations WHERE gene IS NOT NULL GROUP BY gene""",
    ("mutations",),
)
def o01_o03_sorted_reports(spark, d):
    """Frequency table sorted both ways; ranks come from windows over the (small) frequency table."""
    vc = P.value_counts(view(spark, d, "mutations"), "gene")
    return vc.select(
        "gene", "count",
        F.row_number().over(Window.orderBy(F.desc("count"), "gene")).cast("int").alias("rank_desc"),
        F.row_number().over(Window.orderBy("count", "gene")).cast("int").alias("rank_asc"),
    )


@query(
    "o05_first_n_valid",
    """SELECT row_idx, s FROM strings WHERE length(s) > 0 AND length(s) < 150
         AND length(translate(s, 'C(=O)[-]N+1P234S#567HIBF89', '')) = 0 ORDER BY row_idx LIMIT 500""",
    ("strings",),
)
def o05_first_n_valid(spark, d):
    """Keep the first N valid strings in input order (the cap is the operator: max_mols)."""
    v = view(spark, d, "strings").where(K.valid_for_encoding(F.col("s"), 150))
    return v.orderBy("row_idx").limit(500).select("row_idx", "s")


@query(
    "f02_clip_values",
    """SELECT feature, sample, greatest(-0.1, least(0.1, value)) AS clipped FROM matrix""",
    ("matrix",),
)
def f02_clip_values(spark, d):
    from assayspark.functions.scalar import clip

    return view(spark, d, "matrix").select("feature", "sample", clip(F.col("value"), -0.1, 0.1).alias("clipped"))


@query(
    "m01_median_imputer",
    f"""WITH t AS (SELECT *, {SPLIT_SQL} AS split FROM matrix_sparse),
             med AS (SELECT feature, median(value) AS med FROM t WHERE split = 'train' GROUP BY feature)
        SELECT t.feature, t.sample, t.row_idx, t.dataset, coalesce(t.value, med.med) AS value
        FROM t LEFT JOIN med ON t.feature = med.feature WHERE t.split = 'test'""",
    ("matrix_sparse",),
)
def m01_median_imputer(spark, d):
    """Median imputer fitted on the train split, applied to the test split."""
    m = view(spark, d, "matrix_sparse").withColumn("split", F.when(K.arith_hash(F.col("sample"), F.lit(11)) % 3 == 0, "test").otherwise("train"))
    out = impute_median(m.where("split = 'train'"), m.where("split = 'test'"))
    return out.select("feature", "sample", "row_idx", "dataset", "value")



KNN_SQL = f"""WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
                         ({K.arith_hash_sql('vec_id', '3')}) % 2 AS side FROM embeddings),
     pairs AS (SELECT q.vec_id AS q_id, r.vec_id AS r_id, r.label,
                      sqrt(list_sum(list_transform(range(64), lambda i: (q.v[i + 1] - r.v[i + 1]) * (q.v[i + 1] - r.v[i + 1])))) AS dist
               FROM e q JOIN e r ON q.side = 1 AND r.side = 0),
     nn AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY dist, r_id) AS rank FROM pairs)"""


def _knn(spark, d, k: int = 5):
    from assayspark.operators.knn import knn_join

    e = table(spark, d, "embeddings").select(
        "vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"),
        (K.arith_hash(F.col("vec_id"), F.lit(3)) % 2).alias("side"),
    )
    return knn_join(e.where("side = 1"), e.where("side = 0"), k, q_id="vec_id", r_id="vec_id", vec="v", r_label="label")


@query(
    "j16_knn_join",
    f"""{KNN_SQL} SELECT q_id, r_id, CAST(rank AS INTEGER) AS rank, round(dist, 4) AS dist FROM nn WHERE rank <= 5""",
)
def j16_knn_join(spark, d):
    """Exact 5-nearest reference cells for every query cell (pivot cells, blocks skipped by the triangle inequality)."""
    return _knn(spark, d).select("q_id", "r_id", "rank", F.round("dist", 4).alias("dist"))


@query(
    "m15_knn_classifier",
    f"""{KNN_SQL}, votes AS (SELECT q_id, label, count(*) AS n FROM nn WHERE rank <= 5 GROUP BY 1, 2)
        SELECT q_id, CAST(arg_min(label, (-n, label)) AS BIGINT) AS pred FROM votes GROUP BY q_id""",
)
def m15_knn_classifier(spark, d):
    from assayspark.operators.knn import knn_classify

    return knn_classify(_knn(spark, d))
