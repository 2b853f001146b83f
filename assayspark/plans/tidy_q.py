"""Registered queries: tidy layer, sets, joins, ordering and scalar functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from assayspark.operators import joins as J
from assayspark.operators import sets as U
from assayspark.operators import tidy as T
from assayspark.plans.registry import query, view
from assayspark.session import table


def r6(c, d: int = 6):
    return F.round(c, d)


@query(
    "p01_p02_melt",
    """SELECT l_orderkey, l_linenumber, sample, value FROM
       (UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
        ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME sample VALUE value)""",
)
def p01_p02_melt(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    wide = T.drop_leading(li, 2)
    return T.melt(wide, ["l_orderkey", "l_linenumber"])


WIDE = range(64)


@query(
    "p03_pivot_small",
    "SELECT dataset, " + ", ".join(f"max(CASE WHEN feature = {i} THEN value END) AS f{i}" for i in WIDE)
    + " FROM (SELECT dataset, feature, round(avg(value), 6) AS value FROM matrix GROUP BY 1, 2) t GROUP BY dataset",
    ("matrix",),
)
def p03_pivot_small(spark, d):
    """All features of the stand-in as columns, one row per data set."""
    per = view(spark, d, "matrix").groupBy("dataset", "feature").agg(r6(F.avg("value")).alias("value"))
    w = T.to_wide(per, "dataset", "feature", "value", list(WIDE))
    return w.select("dataset", *[F.col(f"`{i}`").alias(f"f{i}") for i in WIDE])


@query(
    "p04_coerce_numeric",
    """SELECT feature, sample, row_idx, CASE WHEN isnan(TRY_CAST(raw AS DOUBLE)) THEN NULL ELSE TRY_CAST(raw AS DOUBLE) END AS value
       FROM expr_raw""",
    ("expr_raw",),
)
def p04_coerce_numeric(spark, d):
    x = view(spark, d, "expr_raw")
    return x.select("feature", "sample", "row_idx", T.coerce_numeric(F.col("raw")).alias("value"))


@query(
    "p05_narrow_types",
    """SELECT feature, sample, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value32, CAST(feature AS INTEGER) AS feature32
       FROM matrix_sparse WHERE value IS NOT NULL""",
    ("matrix_sparse",),
)
def p05_narrow_types(spark, d):
    m = view(spark, d, "matrix_sparse").where(F.col("value").isNotNull())
    n = T.narrow(m.withColumn("value32", F.col("value")).withColumn("feature32", F.col("feature")), floats=["value32"], ints=["feature32"])
    return n.select("feature", "sample", F.col("value32").cast("double").alias("value32"), "feature32")


@query(
    "p06_member_filter",
    """SELECT gene, count(*) AS n FROM mutations WHERE gene IN ('Brand#1', 'Brand#7', 'Brand#13') GROUP BY gene""",
    ("mutations",),
)
def p06_member_filter(spark, d):
    m = T.member_of(view(spark, d, "mutations"), "gene", ["Brand#1", "Brand#7", "Brand#13"])
    return m.groupBy("gene").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p07_p08_nonsynonymous",
    """SELECT gene, count(DISTINCT sample) AS n_samples FROM mutations
       WHERE gene IS NOT NULL AND NOT coalesce(contains(consequence, 'synonymous_variant'), false) GROUP BY gene""",
    ("mutations",),
)
def p07_p08_nonsynonymous(spark, d):
    m = T.drop_missing_keys(view(spark, d, "mutations"), ["gene"])
    m = m.where(T.not_containing(F.col("consequence"), "synonymous_variant"))
    return m.groupBy("gene").agg(F.countDistinct("sample").alias("n_samples"))


@query(
    "p11_clean_signal",
    """SELECT track, chrom, start, round(CASE WHEN isnan(value) OR isinf(value) OR value IS NULL THEN 0
                                             ELSE greatest(value, 0) END, 6) AS value FROM track""",
    ("track",),
)
def p11_clean_signal(spark, d):
    t = view(spark, d, "track")
    return t.select("track", "chrom", "start", r6(T.clean_signal(F.col("value"))).alias("value"))


@query(
    "p14_label_map",
    """SELECT vec_id, label AS label_id FROM embeddings""",
)
def p14_label_map(spark, d):
    from assayspark.functions.images import LABELS

    e = table(spark, d, "embeddings")
    names = F.array(*[F.lit(n) for n in LABELS])
    named = e.select("vec_id", F.element_at(names, F.col("label") + 1).alias("label_name"))
    return named.select("vec_id", T.map_labels(F.col("label_name"), {n: i for i, n in enumerate(LABELS)}).alias("label_id"))


@query(
    "p15_map_or_keep",
    """SELECT feature, coalesce(symbol, CAST(feature AS VARCHAR)) AS name, count(*) AS n
       FROM matrix_sparse LEFT JOIN ref_map ON feature = id GROUP BY 1, 2""",
    ("matrix_sparse", "ref_map"),
)
def p15_map_or_keep(spark, d):
    m = view(spark, d, "matrix_sparse").withColumn("feature_s", F.col("feature").cast("string"))
    a = J.annotate(m, view(spark, d, "ref_map"), "feature", "id", "symbol", "name", keep_original="feature_s")
    return a.groupBy("feature", "name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p16_variant_fallback",
    """SELECT p_partkey, CASE WHEN length(v) < 12 AND NOT contains(v, '%') THEN v WHEN length(p_name) < 12 THEN p_name END AS s
       FROM (SELECT p_partkey, p_name, CASE WHEN p_size % 3 = 0 THEN p_name || '%' ELSE upper(p_name) END AS v FROM part) t
       WHERE CASE WHEN length(v) < 12 AND NOT contains(v, '%') THEN v WHEN length(p_name) < 12 THEN p_name END IS NOT NULL""",
)
def p16_variant_fallback(spark, d):
    p = table(spark, d, "part")
    v = F.when(F.col("p_size") % 3 == 0, F.concat("p_name", F.lit("%"))).otherwise(F.upper("p_name"))
    out = p.select("p_partkey", T.variant_or_original(v, F.col("p_name"), 12).alias("s"))
    return out.where(F.col("s").isNotNull())


@query(
    "p17_p18_unique_names",
    """SELECT p_partkey, p_name AS short_name,
              CASE WHEN rn = 1 THEN p_name ELSE p_name || '-' || CAST(rn - 1 AS VARCHAR) END AS unique_name
       FROM (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part) t""",
)
def p17_p18_unique_names(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat(F.lit("ENS"), F.col("p_partkey").cast("string"), F.lit("_"), F.col("p_name")).alias("gene_id"))
    s = p.select("p_partkey", T.last_field(F.col("gene_id")).alias("short_name"))
    return T.unique_names(s, "short_name", "p_partkey")


@query(
    "p24_raw_or_logged",
    """SELECT dataset, min(value) AS min, max(value) AS max, NOT (min(value) < 0 OR max(value) < 50) AS is_raw
       FROM matrix_sparse GROUP BY dataset""",
    ("matrix_sparse",),
)
def p24_raw_or_logged(spark, d):
    return T.raw_or_logged(view(spark, d, "matrix_sparse"), "dataset", "value")


@query(
    "u01_common_features",
    """SELECT feature FROM matrix_sparse WHERE value IS NOT NULL GROUP BY feature
       HAVING count(DISTINCT dataset) = (SELECT count(DISTINCT dataset) FROM matrix_sparse WHERE value IS NOT NULL)""",
    ("matrix_sparse",),
)
def u01_common_features(spark, d):
    m = view(spark, d, "matrix_sparse").where(F.col("value").isNotNull())
    return U.intersect_all_groups(m, "feature", "dataset")


@query(
    "u02_shared_samples",
    """WITH s AS (SELECT DISTINCT dataset, sample FROM matrix_sparse)
       SELECT a.dataset || '+' || b.dataset AS pair, a.sample FROM s a JOIN s b ON a.dataset < b.dataset AND a.sample = b.sample""",
    ("matrix_sparse",),
)
def u02_shared_samples(spark, d):
    """The samples that each two data sets share."""
    m = view(spark, d, "matrix_sparse")
    names = sorted(r["dataset"] for r in m.select("dataset").distinct().collect())  # one per cohort
    pairs = [(x, y) for i, x in enumerate(names) for y in names[i + 1 :]]
    out = [U.intersect2(m.where(F.col("dataset") == x), m.where(F.col("dataset") == y), "sample").select(F.lit(f"{x}+{y}").alias("pair"), "sample") for x, y in pairs]
    return reduce(lambda a, b: a.unionByName(b), out)


def _brands(spark, d):
    m = view(spark, d, "mutations").where(F.col("gene").isNotNull())
    return m, sorted(r["gene"] for r in m.select("gene").distinct().collect())  # one frame per file: a brand


@query(
    "u03_union_samples",
    """SELECT DISTINCT sample FROM mutations WHERE gene IS NOT NULL""",
    ("mutations",),
)
def u03_union_samples(spark, d):
    """The samples of all brands' frames, read as one long frame."""
    m = view(spark, d, "mutations").where(F.col("gene").isNotNull())
    return U.union_distinct(m.select("sample"))


@query(
    "u04_union_fill",
    """WITH g AS (SELECT DISTINCT gene, sample FROM mutations WHERE gene IS NOT NULL), n AS (SELECT DISTINCT gene FROM g)
       SELECT g.sample, n.gene, g.gene = n.gene AS flag FROM g CROSS JOIN n""",
    ("mutations",),
)
def u04_union_fill(spark, d):
    """Label frames of all brands stacked; a brand's column is False in the frames that lack it."""
    m, names = _brands(spark, d)
    return U.stack_labels(m, "sample", "gene", names)


@query(
    "u05_distinct_pairs",
    "SELECT DISTINCT gene, sample FROM mutations",
    ("mutations",),
)
def u05_distinct_pairs(spark, d):
    return U.distinct_pairs(view(spark, d, "mutations"), ["gene", "sample"])


@query(
    "u06_keep_first",
    """SELECT feature, sample, value, row_idx, dataset FROM (
         SELECT *, row_number() OVER (PARTITION BY feature ORDER BY row_idx, dataset, sample) AS rn FROM matrix_sparse) t WHERE rn = 1""",
    ("matrix_sparse",),
)
def u06_keep_first(spark, d):
    # row_idx can repeat in the stand-in, so ties are broken by the remaining columns
    return U.keep_first(view(spark, d, "matrix_sparse"), ["feature"], ["row_idx", "dataset", "sample"])


@query(
    "u07_keep_first_by_values",
    """SELECT sample, value, feature, row_idx, dataset FROM (
         SELECT *, row_number() OVER (PARTITION BY sample, value ORDER BY row_idx, dataset, feature) AS rn FROM matrix_sparse) t WHERE rn = 1""",
    ("matrix_sparse",),
)
def u07_keep_first_by_values(spark, d):
    return U.keep_first_by_values(view(spark, d, "matrix_sparse"), ["sample", "value"], ["row_idx", "dataset", "feature"])


@query(
    "u08_duplicate_names",
    "SELECT p_name, count(*) AS count FROM part GROUP BY p_name HAVING count(*) > 1",
)
def u08_duplicate_names(spark, d):
    return U.duplicated_names(table(spark, d, "part"), "p_name")


@query(
    "j03_concat_common",
    """WITH c AS (SELECT feature FROM matrix_sparse WHERE value IS NOT NULL GROUP BY feature
                  HAVING count(DISTINCT dataset) = (SELECT count(DISTINCT dataset) FROM matrix_sparse WHERE value IS NOT NULL))
       SELECT dataset, count(*) AS n_cells, count(DISTINCT feature) AS n_features FROM matrix_sparse
       WHERE feature IN (SELECT feature FROM c) GROUP BY dataset""",
    ("matrix_sparse",),
)
def j03_concat_common(spark, d):
    m = view(spark, d, "matrix_sparse")
    common = U.intersect_all_groups(m.where(F.col("value").isNotNull()), "feature", "dataset")
    parts = [m.where(F.col("dataset") == x) for x in ("A", "N", "R")]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return J.semi(stacked, common, ["feature"]).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_cells"), F.countDistinct("feature").alias("n_features")
    )


@query(
    "j04_j05_align_samples",
    """SELECT count(*) AS n_cells, count(DISTINCT sample) AS n_samples FROM matrix_sparse
       WHERE sample IN (SELECT sample FROM mutations) AND feature IN (SELECT id FROM ref_map WHERE symbol IS NOT NULL)""",
    ("matrix_sparse", "mutations", "ref_map"),
)
def j04_j05_align_samples(spark, d):
    m = view(spark, d, "matrix_sparse")
    mut = view(spark, d, "mutations")
    rm = view(spark, d, "ref_map").where(F.col("symbol").isNotNull()).select(F.col("id").alias("feature"))
    x = J.semi(J.semi(m, mut, ["sample"]), rm, ["feature"])
    return x.agg(F.count(F.lit(1)).alias("n_cells"), F.countDistinct("sample").alias("n_samples"))


@query(
    "j06_flag_pairs",
    """SELECT gene, sample, bool_or(NOT coalesce(contains(consequence, 'synonymous_variant'), false)) AS mutated
       FROM mutations WHERE gene IS NOT NULL GROUP BY gene, sample""",
    ("mutations",),
)
def j06_flag_pairs(spark, d):
    m = view(spark, d, "mutations").where(F.col("gene").isNotNull())
    pairs = U.distinct_pairs(m, ["gene", "sample"])
    flagged = m.where(T.not_containing(F.col("consequence"), "synonymous_variant"))
    return J.flag_pairs(pairs, flagged, ["gene", "sample"], "mutated")


@query(
    "j08_membership_label",
    """SELECT s.sample, CASE WHEN f.sample IS NULL THEN 0 ELSE 1 END AS label
       FROM (SELECT DISTINCT sample FROM mutations) s LEFT JOIN
            (SELECT DISTINCT sample FROM mutations WHERE gene = 'Brand#7'
             AND NOT coalesce(contains(consequence, 'synonymous_variant'), false)) f ON s.sample = f.sample""",
    ("mutations",),
)
def j08_membership_label(spark, d):
    m = view(spark, d, "mutations")
    universe = m.select("sample").distinct()
    members = m.where((F.col("gene") == "Brand#7") & T.not_containing(F.col("consequence"), "synonymous_variant"))
    return J.membership_label(universe, members, "sample")


@query(
    "o04_head_tail",
    """(SELECT row_idx, feature, sample FROM matrix_sparse ORDER BY row_idx, dataset, feature LIMIT 10)
       UNION ALL (SELECT row_idx, feature, sample FROM matrix_sparse ORDER BY row_idx DESC, dataset DESC, feature DESC LIMIT 10)""",
    ("matrix_sparse",),
)
def o04_head_tail(spark, d):
    m = view(spark, d, "matrix_sparse")
    head = m.orderBy("row_idx", "dataset", "feature").limit(10)
    tail = m.orderBy(F.desc("row_idx"), F.desc("dataset"), F.desc("feature")).limit(10)
    return head.select("row_idx", "feature", "sample").unionByName(tail.select("row_idx", "feature", "sample"))


@query(
    "o02_sorted_valid_ids",
    """SELECT CAST(floor(TRY_CAST(raw AS DOUBLE)) AS BIGINT) AS id, row_idx FROM expr_raw
       WHERE TRY_CAST(raw AS DOUBLE) IS NOT NULL AND NOT isnan(TRY_CAST(raw AS DOUBLE)) ORDER BY id, row_idx""",
    ("expr_raw",),
)
def o02_sorted_valid_ids(spark, d):
    x = view(spark, d, "expr_raw").select(T.coerce_numeric(F.col("raw")).alias("v"), "row_idx")
    return x.dropna(subset=["v"]).select(F.floor("v").cast("long").alias("id"), "row_idx").orderBy("id", "row_idx")


@query(
    "o06_track_rank",
    "SELECT DISTINCT track, CAST(dense_rank() OVER (ORDER BY track) AS INTEGER) AS col_idx FROM track",
    ("track",),
)
def o06_track_rank(spark, d):
    from pyspark.sql.window import Window

    names = view(spark, d, "track").select("track").distinct()
    # The window runs over the distinct track names only (one row per track).
    return names.withColumn("col_idx", F.dense_rank().over(Window.orderBy("track")).cast("int"))


@query(
    "f01_f03_scalar",
    """SELECT row_idx, round(log2(value + 1), 6) AS log2p1, round(ln(1 + value), 6) AS log1p, round(exp(value / 50), 6) AS ex,
              round(sqrt(value), 6) AS sq, abs(value - 25) AS ab, greatest(10.0, least(40.0, value)) AS clipped,
              round(1.0 / greatest(value, 1), 6) AS recip
       FROM matrix_sparse WHERE value IS NOT NULL""",
    ("matrix_sparse",),
)
def f01_f03_scalar(spark, d):
    from assayspark.functions import scalar as Fs

    m = view(spark, d, "matrix_sparse").where(F.col("value").isNotNull())
    v = F.col("value")
    return m.select(
        "row_idx",
        r6(Fs.log2p1(v)).alias("log2p1"),
        r6(F.log1p(v)).alias("log1p"),
        r6(F.exp(v / 50)).alias("ex"),
        r6(F.sqrt(v)).alias("sq"),
        F.abs(v - 25).alias("ab"),
        Fs.clip(v, 10.0, 40.0).alias("clipped"),
        r6(Fs.safe_reciprocal(v)).alias("recip"),
    )


@query(
    "f22_format_split_basename",
    """SELECT p_partkey, printf('%s %.5f', p_name, p_retailprice / 1000) AS line,
              string_split(p_type || '\t' || p_brand, '\t')[2] AS brand, string_split('/data/img/' || p_name || '.npy', '/')[-1] AS base
       FROM part""",
)
def f22_format_split_basename(spark, d):
    p = table(spark, d, "part")
    return p.select(
        "p_partkey",
        F.format_string("%s %.5f", F.col("p_name"), F.col("p_retailprice") / 1000).alias("line"),
        F.element_at(F.split(F.concat_ws("\t", "p_type", "p_brand"), "\t"), 2).alias("brand"),
        T.basename(F.concat(F.lit("/data/img/"), F.col("p_name"), F.lit(".npy"))).alias("base"),
    )
