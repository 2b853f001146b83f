"""Stand-in views over the driver tables.

The domain files (expression TSVs, mutation tables, signal tracks, FASTA, ...)
are not shipped, so each operator runs on a view derived from the driver's
tables.  Every view exists twice: as a Spark DataFrame builder and as a
DuckDB CTE body with the same rows, so oracle SQL can be written against the
same named relation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayspark.session import table

# Geometry of the sequence stand-in.
WINDOW_BP = 500          # BED window width and step (windows tile each sequence)
CHUNK_BP = 4096          # genome chunk size for the chunked layout
UNKNOWN_CHROM_EVERY = 25  # one window on an unknown chromosome per this many docs


# --------------------------------------------------------------------------
# Spark builders
# --------------------------------------------------------------------------

def matrix(spark: SparkSession, d: str) -> DataFrame:
    """Dense long matrix (dataset, feature, sample, value) from ``embeddings``."""
    e = table(spark, d, "embeddings")
    return e.select(
        F.col("label").alias("dataset"),
        F.posexplode("embedding").alias("feature", "v"),
        F.col("vec_id").alias("sample"),
    ).select("dataset", "feature", "sample", F.col("v").cast("double").alias("value"))


def sparse_value(c_part: Column, c_order: Column, c_qty: Column) -> Column:
    return (
        F.when(c_part % 97 == 0, F.lit(None))
        .when((c_part % 13 == 0) & (c_order % 3 != 0), F.lit(None))
        .when(c_order % 11 == 0, F.lit(None))
        .otherwise(c_qty)
        .cast("double")
    )


def matrix_sparse(spark: SparkSession, d: str) -> DataFrame:
    """Long matrix with NULLs, all-NULL features, duplicate (feature, sample) keys."""
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("dataset"),
        F.col("l_partkey").alias("feature"),
        F.col("l_suppkey").alias("sample"),
        sparse_value(F.col("l_partkey"), F.col("l_orderkey"), F.col("l_quantity")).alias("value"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_idx"),
    )


def expr_raw(spark: SparkSession, d: str) -> DataFrame:
    """Expression cells as text, some non-numeric (input of numeric coercion)."""
    li = table(spark, d, "lineitem")
    raw = (
        F.when(F.col("l_orderkey") % 17 == 0, F.lit("n/a"))
        .when(F.col("l_orderkey") % 19 == 0, F.lit("NaN"))
        .otherwise(F.format_string("%.2f", F.col("l_extendedprice")))
    )
    return li.select(
        F.col("l_partkey").alias("feature"),
        F.col("l_suppkey").alias("sample"),
        raw.alias("raw"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_idx"),
    )


def mutations(spark: SparkSession, d: str) -> DataFrame:
    """Mutation rows (gene, sample, consequence) from lineitem joined to part."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    j = li.join(p, li.l_partkey == p.p_partkey)
    gene = F.when(F.col("p_size") == 1, F.lit(None).cast("string")).otherwise(F.col("p_brand"))
    cons = (
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
        .when(F.col("p_type") == "ECONOMY", F.lit("synonymous_variant"))
        .when(F.col("p_type") == "PROMO", F.lit("splice_region_variant,synonymous_variant"))
        .otherwise(F.concat(F.lower("p_type"), F.lit("_variant")))
    )
    return j.select(
        gene.alias("gene"),
        F.col("l_orderkey").alias("sample"),
        cons.alias("consequence"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_idx"),
    )


def ref_map(spark: SparkSession, d: str) -> DataFrame:
    """Reference id -> symbol mapping (with NULL symbols and repeated symbols)."""
    p = table(spark, d, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_partkey") % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("symbol"),
    )


def track(spark: SparkSession, d: str) -> DataFrame:
    """Signal intervals (track, chrom, start, end, value) from ``events``.

    start = whole minutes since the first event; end = next start in the same
    (track, chrom); zero-length intervals dropped; the last one has length 1.
    Values carry the quirks of real tracks: NaN, +inf and negatives.
    """
    ev = table(spark, d, "events")
    t0 = ev.agg(F.min("ts")).scalar()
    val = (
        F.when(F.col("event_id") % 53 == 0, F.lit(float("nan")))
        .when(F.col("event_id") % 61 == 0, F.lit(float("inf")))
        .when(F.col("event_id") % 59 == 0, -F.col("value"))
        .otherwise(F.col("value"))
    )
    base = ev.select(
        F.col("event_type").alias("track"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("chrom"),
        F.floor(F.timestamp_diff("MICROSECOND", t0, F.col("ts")) / F.lit(60_000_000)).cast("long").alias("start"),
        F.col("event_id"),
        val.alias("value"),
    )
    w = Window.partitionBy("track", "chrom").orderBy("start", "event_id")
    out = base.withColumn("end", F.coalesce(F.lead("start").over(w), F.col("start") + 1))
    return out.where(F.col("end") > F.col("start")).select("track", "chrom", "start", "end", "value")


def fold_acgt(text: Column) -> Column:
    """Letters only, lower case, then folded onto A/C/G/T (z -> N)."""
    letters = F.lower(F.regexp_replace(text, "[^A-Za-z]", ""))
    return F.translate(letters, "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAN")


def genome(spark: SparkSession, d: str) -> DataFrame:
    """Genome (chrom, seq): each document folded to DNA letters."""
    doc = table(spark, d, "documents")
    return doc.select(
        F.concat(F.lit("chr"), F.col("doc_id").cast("string")).alias("chrom"),
        fold_acgt(F.col("text")).alias("seq"),
    )


def genome_chunks(spark: SparkSession, d: str, chunk: int = CHUNK_BP) -> DataFrame:
    """Chunked genome layout (chrom, chunk_id, chunk_start, seq): no row holds a whole chromosome;"""
    from assayspark.sources.files import chunk_genome

    return chunk_genome(genome(spark, d), chunk)


def bed(spark: SparkSession, d: str, width: int = WINDOW_BP) -> DataFrame:
    """BED windows tiling every sequence, plus windows on unknown chromosomes.

    Columns (row_idx, chrom, start, end).  The last window of a sequence runs
    past its end; windows on ``chrUn*`` have no sequence.
    """
    doc = table(spark, d, "documents").select("doc_id", "text")
    # Length first (one fold per text), then the window ids; no filter, which would be inlined and fold twice.
    lens = doc.select("doc_id", F.length(fold_acgt(F.col("text"))).alias("n"))
    n = F.col("n")
    ids = F.when(n > 0, F.sequence(F.lit(0), ((n - 1) / F.lit(width)).cast("int"))).otherwise(F.array().cast("array<int>"))
    tiles = lens.select("doc_id", F.explode(ids).alias("i")).select(
        (F.col("doc_id") * 1_000_000 + F.col("i")).alias("row_idx"),
        F.concat(F.lit("chr"), F.col("doc_id").cast("string")).alias("chrom"),
        (F.col("i").cast("long") * width).alias("start"),
        (F.col("i").cast("long") * width + width).alias("end"),
    )
    unknown = doc.where(F.col("doc_id") % UNKNOWN_CHROM_EVERY == 0).select(
        (F.col("doc_id") * 1_000_000 + 999_999).alias("row_idx"),
        F.concat(F.lit("chrUn"), F.col("doc_id").cast("string")).alias("chrom"),
        F.lit(0).cast("long").alias("start"),
        F.lit(width).cast("long").alias("end"),
    )
    return tiles.unionByName(unknown)


def strings(spark: SparkSession, d: str) -> DataFrame:
    """Candidate molecule strings (row_idx, s): every part name and every text line.

    Lines are folded onto the token alphabet: letters map to the element
    symbols used by the alphabet, punctuation to bonds and branches.
    """
    p = table(spark, d, "part").select(
        (F.col("p_partkey") * 2).alias("row_idx"), fold_smiles(F.col("p_name")).alias("s")
    )
    doc = table(spark, d, "documents").select("doc_id", "text")
    lines = doc.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "line"))
    t = lines.select(
        (F.col("doc_id") * 100_000 + F.col("ln")).cast("long").alias("row_idx_d"),
        fold_smiles(F.col("line")).alias("s"),
    ).select((F.col("row_idx_d") * 2 + 1).alias("row_idx"), "s")
    return p.unionByName(t)


# Character folding onto the token alphabet for the string stand-in.
# Letters a..z (either case) map by position onto SMILES_LETTERS; punctuation onto
# bonds/branches/brackets; spaces are deleted (translate drops unmatched tail chars).
SMILES_LETTERS = "CCOCCNC(CSCCNC1)P=CC2FOBI#"
SMILES_FROM = "abcdefghijklmnopqrstuvwxyz" + "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + ".,;:!?'- "
SMILES_TO = SMILES_LETTERS + SMILES_LETTERS + "=()[]+H-"


def fold_smiles(text: Column) -> Column:
    return F.translate(text, SMILES_FROM, SMILES_TO)


def logits(spark: SparkSession, d: str) -> DataFrame:
    """Model output rows (id, label, logits[10]) from embeddings (scaled first 10 coordinates)."""
    e = table(spark, d, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        F.col("label"),
        F.transform(F.slice("embedding", 1, 10), lambda x: x.cast("double") * 10).alias("logits"),
    )


def image(spark: SparkSession, d: str) -> DataFrame:
    """Images (id, label, channels ARRAY<ARRAY<DOUBLE>>): three flattened 8 x 8 channels from each embedding.

    Channel 0 is the embedding, channel 1 the embedding rotated by one slot,
    channel 2 its square - or a constant 0.5 on every 10th image.
    """
    e = table(spark, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    ch1 = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.element_at(F.col("e"), (i + 1) % 64 + 1))
    ch2 = F.when(F.col("vec_id") % 10 == 0, F.array_repeat(F.lit(0.5), 64)).otherwise(F.transform("e", lambda x: x * x))
    return e.select(F.col("vec_id").alias("id"), "label", F.array(F.col("e"), ch1, ch2).alias("channels"))


def runs(spark: SparkSession, d: str) -> DataFrame:
    """Run log (run, step, metric, loss): one run per event type, one step per day.

    Metrics come from integer cent sums so every engine gets bit-identical values (ties stay ties).
    """
    ev = table(spark, d, "events")
    cents = F.round(F.col("value") * 100).cast("long")
    return ev.groupBy(
        F.col("event_type").alias("run"),
        F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("step"),
    ).agg(
        (F.sum(cents).cast("double") / F.count(F.lit(1)) / 50000).alias("metric"),
        ((F.max(cents) - F.min(cents)).cast("double") / 10000).alias("loss"),
    )


# --------------------------------------------------------------------------
# DuckDB CTE bodies (same rows)
# --------------------------------------------------------------------------

SQL = {
    "matrix": """SELECT label AS dataset, CAST(unnest(range(len(embedding))) AS INTEGER) AS feature,
        vec_id AS sample, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings""",
    "matrix_sparse": """SELECT l_returnflag AS dataset, l_partkey AS feature, l_suppkey AS sample,
        CAST(CASE WHEN l_partkey % 97 = 0 THEN NULL
                  WHEN l_partkey % 13 = 0 AND l_orderkey % 3 <> 0 THEN NULL
                  WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_quantity END AS DOUBLE) AS value,
        l_orderkey * 8 + l_linenumber AS row_idx FROM lineitem""",
    "expr_raw": """SELECT l_partkey AS feature, l_suppkey AS sample,
        CASE WHEN l_orderkey % 17 = 0 THEN 'n/a' WHEN l_orderkey % 19 = 0 THEN 'NaN'
             ELSE printf('%.2f', l_extendedprice) END AS raw,
        l_orderkey * 8 + l_linenumber AS row_idx FROM lineitem""",
    "mutations": """SELECT CASE WHEN p_size = 1 THEN NULL ELSE p_brand END AS gene, l_orderkey AS sample,
        CASE WHEN l_linenumber = 7 THEN NULL WHEN p_type = 'ECONOMY' THEN 'synonymous_variant'
             WHEN p_type = 'PROMO' THEN 'splice_region_variant,synonymous_variant'
             ELSE lower(p_type) || '_variant' END AS consequence,
        l_orderkey * 8 + l_linenumber AS row_idx
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "ref_map": """SELECT p_partkey AS id, CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_name END AS symbol FROM part""",
    "track": """SELECT track, chrom, start, "end", value FROM (
        SELECT *, coalesce(lead(start) OVER (PARTITION BY track, chrom ORDER BY start, event_id), start + 1) AS "end"
        FROM (SELECT event_type AS track, 'u' || CAST(user_id AS VARCHAR) AS chrom,
                     (epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) // 60000000 AS start, event_id,
                     CASE WHEN event_id % 53 = 0 THEN CAST('NaN' AS DOUBLE)
                          WHEN event_id % 61 = 0 THEN CAST('Infinity' AS DOUBLE)
                          WHEN event_id % 59 = 0 THEN -value ELSE value END AS value
              FROM events) b) t WHERE "end" > start""",
    "genome": """SELECT 'chr' || CAST(doc_id AS VARCHAR) AS chrom,
        translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'abcdefghijklmnopqrstuvwxyz',
                  'ACGTACGTACGTACGTACGTACGTAN') AS seq FROM documents""",
    "bed": f"""SELECT doc_id * 1000000 + i AS row_idx, 'chr' || CAST(doc_id AS VARCHAR) AS chrom,
            CAST(i AS BIGINT) * {WINDOW_BP} AS start, CAST(i AS BIGINT) * {WINDOW_BP} + {WINDOW_BP} AS "end"
        FROM (SELECT doc_id, unnest(range(0, (length(regexp_replace(text, '[^A-Za-z]', '', 'g')) + {WINDOW_BP - 1}) // {WINDOW_BP})) AS i
              FROM documents) w
        UNION ALL
        SELECT doc_id * 1000000 + 999999, 'chrUn' || CAST(doc_id AS VARCHAR), CAST(0 AS BIGINT), CAST({WINDOW_BP} AS BIGINT)
        FROM documents WHERE doc_id % {UNKNOWN_CHROM_EVERY} = 0""",
    "strings": f"""SELECT p_partkey * 2 AS row_idx,
            translate(p_name, '{SMILES_FROM.replace("'", "''")}', '{SMILES_TO}') AS s FROM part
        UNION ALL
        SELECT (doc_id * 100000 + ln) * 2 + 1,
            translate(line, '{SMILES_FROM.replace("'", "''")}', '{SMILES_TO}')
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                     unnest(range(len(string_split(text, chr(10))))) AS ln FROM documents) l""",
    "logits": """SELECT vec_id AS id, label,
        list_transform(embedding[1:10], lambda x: CAST(x AS DOUBLE) * 10) AS logits FROM embeddings""",
    "image": """SELECT vec_id AS id, label, [e, list_transform(range(64), lambda i: e[(i + 1) % 64 + 1]),
            CASE WHEN vec_id % 10 = 0 THEN list_transform(range(64), lambda i: 0.5) ELSE list_transform(e, lambda x: x * x) END] AS channels
        FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings) t""",
    "runs": """SELECT event_type AS run, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS step,
        CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) / 50000 AS metric,
        CAST(max(CAST(round(value * 100) AS BIGINT)) - min(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 10000 AS loss
        FROM events GROUP BY 1, 2""",
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named stand-in views."""
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({SQL[n]})" for n in names)
    body = sql.lstrip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


BUILDERS = {
    "matrix": matrix,
    "matrix_sparse": matrix_sparse,
    "expr_raw": expr_raw,
    "mutations": mutations,
    "ref_map": ref_map,
    "track": track,
    "genome": genome,
    "bed": bed,
    "strings": strings,
    "logits": logits,
    "image": image,
    "runs": runs,
}
