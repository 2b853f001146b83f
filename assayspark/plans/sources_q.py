"""Registered queries: file scans and sinks as round trips.

No domain files ship with the driver data, so each query writes a driver
table (or a view of it) in the file format under the shared checkpoint
folder, scans it back with the library reader and reports what the oracle can
check on the plain table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from assayspark.sources import files as R
from assayspark.sources import sinks as K
from assayspark.plans.registry import query, view
from assayspark.session import scratch_path, table
from assayspark.views import CHUNK_BP


#: Rows of a written file.
FILE_ROWS = 100_000


def _fresh(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@query(
    "s01_s04_tsv_expression",
    """WITH t AS (SELECT CAST(s AS VARCHAR) AS sample, p_partkey, v FROM
         (UNPIVOT (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part) ON p_size, p_retailprice INTO NAME s VALUE v) x
       UNION ALL SELECT CAST(s AS VARCHAR), p_partkey, v FROM
         (UNPIVOT (SELECT p_partkey, p_retailprice AS total, CAST(p_size AS DOUBLE) * 2 AS p_size, CAST(p_partkey AS DOUBLE) AS price FROM part)
          ON total, p_size, price INTO NAME s VALUE v) y)
       SELECT sample, count(*) AS n, round(sum(v), 4) AS total FROM t GROUP BY sample""",
)
def s01_s04_tsv_expression(spark, d):
    """Two cohorts whose files have other samples in another order, read in one scan."""
    one, two = _fresh(spark, "expr-a"), _fresh(spark, "expr-b")
    p = table(spark, d, "part")
    p.select("p_partkey", "p_type", "p_size", "p_retailprice").repartition(3).write.csv(one, sep="\t", header=True)
    p.select("p_partkey", "p_type", F.col("p_retailprice").alias("total"), (F.col("p_size") * 2).alias("p_size"), F.col("p_partkey").alias("price")).repartition(2).write.csv(
        two, sep="\t", header=True)
    long = R.read_expression(spark, [one, two], n_meta=2)
    return long.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(
    "s02_s03_comment_first_line",
    """SELECT gene, count(*) AS n, count(DISTINCT sample) AS n_samples FROM mutations GROUP BY gene""",
    ("mutations",),
)
def s02_s03_comment_first_line(spark, d):
    """A leading '#' line is skipped in the files that have one; the header is the next line; empty cells are NULL.

    The mutations are written as many files, more for more rows: those of odd part numbers begin with a comment line,
    the others do not.
    """
    path = _fresh(spark, "mut-tsv")
    m = view(spark, d, "mutations")
    n = max(8, -(-m.count() // FILE_ROWS))
    body = m.select(
        F.concat_ws("\t", F.coalesce("gene", F.lit("")), F.col("sample").cast("string"), F.coalesce("consequence", F.lit(""))).alias("value"),
        F.pmod(F.xxhash64("row_idx"), F.lit(n)).cast("int").alias("part"), F.lit(2).alias("line"),
    )
    parts = spark.range(n).select(F.col("id").cast("int").alias("part"))
    head = parts.select(F.lit("Hugo_Symbol\tTumor_Sample_Barcode\tConsequence").alias("value"), "part", F.lit(1).alias("line"))
    note = parts.where("part % 2 = 1").select(F.lit("#version 2.4").alias("value"), "part", F.lit(0).alias("line"))
    files = body.unionByName(head).unionByName(note).repartition(n, "part").sortWithinPartitions("part", "line")
    files.select("value", "part").write.partitionBy("part").text(path)
    mut = R.read_mutations(spark, path)
    return mut.groupBy("gene").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("sample").alias("n_samples"))


@query(
    "s05_gzip_lines",
    """SELECT count(*) AS n, CAST(sum(length(s)) AS BIGINT) AS total_len FROM strings""",
    ("strings",),
)
def s05_gzip_lines(spark, d):
    path = _fresh(spark, "lines-gz")
    view(spark, d, "strings").select(F.col("s").alias("value")).write.option("compression", "gzip").text(path)
    lines = R.read_lines(spark, path, min_partitions=8)
    return lines.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("total_len"))


@query(
    "s07_fasta_roundtrip",
    f"""SELECT chrom, CAST(c AS INTEGER) AS chunk_id, length(substring(seq, CAST(c * {CHUNK_BP} + 1 AS BIGINT), {CHUNK_BP})) AS len,
               md5(substring(seq, CAST(c * {CHUNK_BP} + 1 AS BIGINT), {CHUNK_BP})) AS seq_md5
        FROM (SELECT chrom, seq, unnest(range(greatest(1, (length(seq) + {CHUNK_BP} - 1) // {CHUNK_BP}))) AS c FROM genome) t""",
    ("genome",),
)
def s07_fasta_roundtrip(spark, d):
    path = _fresh(spark, "genome-fa")
    g = view(spark, d, "genome")
    wrapped = F.regexp_replace(F.col("seq"), "(.{60})", "$1\n")
    g.select(F.concat(F.lit(">"), F.col("chrom"), F.lit(" stand-in\n"), wrapped).alias("value")).write.text(path)
    fa = R.read_fasta(spark, path, CHUNK_BP)
    return fa.select("chrom", "chunk_id", F.length("seq").cast("long").alias("len"), F.md5("seq").alias("seq_md5"))


@query(
    "s08_bed_roundtrip",
    """SELECT row_number() OVER (ORDER BY row_idx) - 1 AS row_idx, chrom, start, "end" FROM bed""",
    ("bed",),
)
def s08_bed_roundtrip(spark, d):
    path = _fresh(spark, "windows-bed")
    b = view(spark, d, "bed")
    b.repartitionByRange(4, "row_idx").sortWithinPartitions("row_idx").select("chrom", "start", "end").write.csv(path, sep="\t")
    return R.read_bed(spark, path, with_label=False).select("row_idx", "chrom", "start", "end")


@query(
    "s06_s14_track_folder",
    """SELECT track, count(*) AS n, round(sum(CASE WHEN isnan(value) OR isinf(value) OR value IS NULL THEN 0 ELSE greatest(value, 0) END), 6) AS total
       FROM track WHERE chrom = 'u1' AND start < 20000 AND "end" > 100 GROUP BY track""",
    ("track",),
)
def s06_s14_track_folder(spark, d):
    from assayspark.operators.tidy import clean_signal

    path = _fresh(spark, "tracks")
    view(spark, d, "track").write.partitionBy("track").csv(path, sep="\t")
    t = R.read_tracks(spark, path, chrom="u1", start=100, end=20000)
    return t.groupBy("track").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(clean_signal(F.col("value"))), 6).alias("total"))


@query(
    "k01_prediction_files",
    """SELECT 'G' || CAST(label % 3 AS VARCHAR) AS gene, printf('%s %.5f', CAST(id AS VARCHAR), 1.0 / (1.0 + exp(-logits[4]))) AS line
       FROM logits""",
    ("logits",),
)
def k01_prediction_files(spark, d):
    path = _fresh(spark, "predictions")
    lg = view(spark, d, "logits").select(
        F.concat(F.lit("G"), (F.col("label") % 3).cast("string")).alias("gene"), F.col("id").alias("sample"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.element_at("logits", 4)))).alias("prob"),
    )
    K.write_predictions(lg, path)
    back = spark.read.text(path)
    return back.select("gene", F.col("value").alias("line"))


@query(
    "k03_k04_distinct_sink",
    """SELECT count(DISTINCT s) AS n_distinct FROM strings""",
    ("strings",),
)
def k03_k04_distinct_sink(spark, d):
    path = _fresh(spark, "reference-set")
    K.write_distinct(view(spark, d, "strings"), "s", path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_distinct"))
