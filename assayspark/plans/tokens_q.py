"""Registered queries: molecule-string filtering, encoding and generation statistics (project-6 data steps)."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayspark.functions import tokens as K
from assayspark.operators import joins as J
from assayspark.operators import profile as P
from assayspark.operators.sampling import exact_split
from assayspark.plans.registry import query, view

A = K.ALPHABET
SC = K.STRING_CHARS
MAXLEN = 150

VALID_SQL = f"length(s) > 0 AND length(s) < {MAXLEN} AND length(translate(s, '{SC}', '')) = 0"
OUTSIDE_SQL = r"regexp_replace(s, '\[[^\[\]]*\]', '', 'g')"
WELL_FORMED_SQL = f"""(length(s) > 0 AND left(s, 1) NOT IN ('(', ')', '=', '#', '-')
      AND length(translate(o, '[]', '')) = length(o)
      AND length(replace(o, ')', '')) = length(replace(o, '(', ''))
      AND coalesce(list_min(list_transform(range(1, length(o) + 1),
            lambda k: length(replace(left(o, k), ')', '')) - length(replace(left(o, k), '(', '')))), 0) >= 0
      AND {' AND '.join(f"(length(o) - length(replace(o, '{d}', ''))) % 2 = 0" for d in K.RING_DIGITS)})"""
RINGS_SQL = "CAST((length(o) - length(translate(o, '123456789', ''))) // 2 AS INTEGER)"


def valid_strings(spark, d):
    s = view(spark, d, "strings")
    return s.where(K.valid_for_encoding(F.col("s"), MAXLEN))


@query(
    "p13_a29_valid_counts",
    f"""SELECT CAST(row_idx % 2 AS INTEGER) AS src, count(*) AS n_lines,
               CAST(sum(CASE WHEN {VALID_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS n_valid
        FROM strings GROUP BY 1""",
    ("strings",),
)
def p13_a29_valid_counts(spark, d):
    s = view(spark, d, "strings")
    return s.groupBy((F.col("row_idx") % 2).cast("int").alias("src")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(K.valid_for_encoding(F.col("s"), MAXLEN)).alias("n_valid"),
    )


@query(
    "f09_f10_encode_decode",
    f"""SELECT row_idx,
               md5(array_to_string(list_resize(list_concat(list_transform(string_split(s, ''), lambda c: instr('{A}', c) - 1), [0]), {MAXLEN}, 0), ',')) AS enc_md5,
               true AS roundtrip
        FROM strings WHERE {VALID_SQL}""",
    ("strings",),
)
def f09_f10_encode_decode(spark, d):
    # Encode once into a column; later expressions reference it instead of re-encoding.
    v = valid_strings(spark, d).select("row_idx", "s", K.encode(F.col("s"), MAXLEN).alias("enc"))
    enc = F.col("enc")
    return v.select(
        "row_idx",
        F.md5(F.array_join(F.transform(enc, lambda x: x.cast("string")), ",")).alias("enc_md5"),
        (K.decode(enc) == F.col("s")).alias("roundtrip"),
    )


@query(
    "f11_w05_guard_and_mask",
    f"""SELECT row_idx, CASE WHEN row_idx % 5 = 0 THEN 'x' ELSE s END AS decoded, length(s) + 1 AS mask_sum
        FROM strings WHERE {VALID_SQL}""",
    ("strings",),
)
def f11_w05_guard_and_mask(spark, d):
    v = valid_strings(spark, d).select("row_idx", K.encode(F.col("s"), MAXLEN).alias("enc"))
    # SOS injected after the EOS on every 5th row: the guard must still see it.
    v = v.withColumn("tok", F.transform("enc", lambda t, i: F.when((i == MAXLEN - 1) & (F.col("row_idx") % 5 == 0), F.lit(K.SOS)).otherwise(t)))
    return v.select(
        "row_idx",
        K.decode_guarded(F.col("tok")).alias("decoded"),
        F.aggregate(K.mask_to_first_eos(F.col("enc")), F.lit(0), lambda a, x: a + x).cast("long").alias("mask_sum"),
    )


@query(
    "f17_f18_well_formed",
    f"""SELECT row_idx, {WELL_FORMED_SQL} AS well_formed, {RINGS_SQL} AS rings
        FROM (SELECT row_idx, s, {OUTSIDE_SQL} AS o FROM strings WHERE {VALID_SQL}) t""",
    ("strings",),
)
def f17_f18_well_formed(spark, d):
    v = valid_strings(spark, d)
    return v.select("row_idx", K.well_formed(F.col("s")).alias("well_formed"), K.ring_count(F.col("s")).alias("rings"))


@query(
    "a27_length_profile",
    """SELECT count(*) AS n, min(length(s)) AS min_len, max(length(s)) AS max_len, round(avg(length(s)), 6) AS mean_len,
              median(length(s)) AS median_len, round(avg(CASE WHEN length(s) < 50 THEN 1.0 ELSE 0.0 END), 6) AS share_lt_50,
              round(avg(CASE WHEN length(s) < 100 THEN 1.0 ELSE 0.0 END), 6) AS share_lt_100 FROM strings""",
    ("strings",),
)
def a27_length_profile(spark, d):
    p = P.length_profile(view(spark, d, "strings"))
    return p.select("n", F.col("min_len").cast("long").alias("min_len"), F.col("max_len").cast("long").alias("max_len"), F.round("mean_len", 6).alias("mean_len"), F.col("median_len").cast("double").alias("median_len"),
                    F.round("share_lt_50", 6).alias("share_lt_50"), F.round("share_lt_100", 6).alias("share_lt_100"))


@query(
    "a28_alphabet",
    f"""SELECT ch, count(*) AS count FROM (SELECT unnest(string_split(s, '')) AS ch FROM strings WHERE {VALID_SQL}) t
        WHERE ch <> '' GROUP BY ch""",
    ("strings",),
)
def a28_alphabet(spark, d):
    return P.alphabet(valid_strings(spark, d))


GEN_SQL = f"""gen AS (SELECT row_idx, s, {OUTSIDE_SQL} AS o FROM strings WHERE row_idx % 2 = 1 AND {VALID_SQL}),
     train AS (SELECT DISTINCT s FROM strings WHERE row_idx % 2 = 0 AND {VALID_SQL}),
     ok AS (SELECT s, {RINGS_SQL} AS rings FROM gen WHERE {WELL_FORMED_SQL}),
     uniq AS (SELECT DISTINCT s, rings FROM ok)"""


def generated_and_training(spark, d):
    v = valid_strings(spark, d)
    gen = v.where(F.col("row_idx") % 2 == 1)
    train = v.where(F.col("row_idx") % 2 == 0).select("s").distinct()
    return gen, train


@query(
    "a32_generation_stats",
    f"""WITH {GEN_SQL}
        SELECT (SELECT count(*) FROM ok) AS n_valid, (SELECT count(*) FROM uniq) AS n_unique,
               (SELECT count(*) FROM uniq WHERE s NOT IN (SELECT s FROM train)) AS n_novel,
               round(coalesce((SELECT avg(rings) FROM uniq), 0), 6) AS mean_rings""",
    ("strings",),
)
def a32_generation_stats(spark, d):
    """One pass over the strings: grouped by string with its generated copies and whether it is a training string;
    validity and rings are then made once per distinct string."""
    per = valid_strings(spark, d).groupBy("s").agg(
        F.count_if(F.col("row_idx") % 2 == 1).alias("copies"), F.max(F.col("row_idx") % 2 == 0).alias("in_train")
    )
    ok = per.where(F.col("copies") > 0).where(K.well_formed(F.col("s"))).select("copies", "in_train", K.ring_count(F.col("s")).alias("rings"))
    return ok.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("n_valid"),
        F.count(F.lit(1)).alias("n_unique"),
        F.count_if(~F.col("in_train")).alias("n_novel"),
        F.round(F.coalesce(F.avg("rings"), F.lit(0.0)), 6).alias("mean_rings"),
    )


@query(
    "a33_distinct_generated",
    f"""WITH {GEN_SQL} SELECT count(DISTINCT s) AS n_distinct, count(*) AS n FROM gen""",
    ("strings",),
)
def a33_distinct_generated(spark, d):
    gen, _ = generated_and_training(spark, d)
    return gen.agg(F.countDistinct("s").alias("n_distinct"), F.count(F.lit(1)).alias("n"))


@query(
    "j10_novel_strings",
    f"""WITH {GEN_SQL} SELECT s FROM uniq WHERE s NOT IN (SELECT s FROM train)""",
    ("strings",),
)
def j10_novel_strings(spark, d):
    gen, train = generated_and_training(spark, d)
    uniq = gen.where(K.well_formed(F.col("s"))).select("s").distinct()
    return J.anti(uniq, train, ["s"])


@query(
    "x01_exact_split",
    f"""WITH v AS (SELECT row_idx, {K.arith_hash_sql('row_idx', '42')} AS h FROM strings WHERE {VALID_SQL}),
             n AS (SELECT greatest(1, CAST(floor(count(*) * 0.1) AS BIGINT)) AS n_val FROM v)
        SELECT row_idx, CASE WHEN row_number() OVER (ORDER BY h, row_idx) <= n_val THEN 'val' ELSE 'train' END AS split
        FROM v, n""",
    ("strings",),
)
def x01_exact_split(spark, d):
    v = valid_strings(spark, d).select("row_idx")
    out = exact_split(v, "row_idx", 0.1, seed=42)
    return out.select("row_idx", "split")


@query(
    "f20_random_mask",
    f"""WITH v AS (SELECT row_idx, length(s) AS n FROM strings WHERE {VALID_SQL}),
             p AS (SELECT row_idx, n, unnest(range(0, {MAXLEN})) AS i FROM v)
        SELECT row_idx, CAST(sum(CASE WHEN i >= n OR ({K.arith_hash_sql('row_idx', 'i', '3', '42')}) / {float(K.HASH_MOD)} < 0.15
                                     THEN 1 ELSE 0 END) AS INTEGER) AS n_zero
        FROM p GROUP BY row_idx""",
    ("strings",),
)
def f20_random_mask(spark, d):
    v = valid_strings(spark, d)
    m = K.random_mask(K.encode(F.col("s"), MAXLEN), F.col("row_idx"), 3, 0.15, seed=42)
    # Token ids are never 0 before EOS, so zeros = masked tokens + EOS/padding.
    return v.select("row_idx", F.size(F.filter(m, lambda t: t == 0)).alias("n_zero"))
