"""File scans (S01-S08, S10-S14) and row positions (P20).

Every scan is a plain ``spark.read`` with an explicit schema where the format
has one, so Catalyst prunes columns and pushes filters into the reader.
Row order, where the reference depends on it, is made explicit with
:func:`with_row_index` instead of trusting partition order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from assayspark.operators.tidy import coerce_numeric
from assayspark.operators.windows import running_sum_within

BED_SCHEMA = T.StructType(
    [
        T.StructField("chrom", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("label", T.DoubleType()),
    ]
)
TRACK_SCHEMA = T.StructType(
    [
        T.StructField("chrom", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def with_row_index(df: DataFrame, name: str = "row_idx") -> DataFrame:
    """P20: dense 0-based position of each row in file order (file path, then offset inside the file).

    Rows are tagged with (file, split start, per-task id); a small per-split
    table (one row per file split) gets counts and a prefix sum, and each row
    adds its position inside the split.  Only the split table is ordered in
    one place, never the rows.
    """
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_fp"),
        F.col("_metadata.file_block_start").alias("_fb"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    blocks = tagged.groupBy("_fp", "_fb").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_mid0"))
    w = Window.orderBy("_fp", "_fb").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).select(
        F.col("_fp").alias("_bfp"), F.col("_fb").alias("_bfb"), "_mid0", "_off"
    )
    j = tagged.join(F.broadcast(blocks), (F.col("_fp") == F.col("_bfp")) & (F.col("_fb") == F.col("_bfb")))
    keep = [c for c in df.columns if c != "_metadata"]
    return j.select(*keep, (F.col("_off") + F.col("_mid") - F.col("_mid0")).alias(name))


def read_lines(spark: SparkSession, paths: str | Sequence[str], min_partitions: int | None = None) -> DataFrame:
    """Text lines with file path and file-order index; gzip input is not splittable, so it is
    repartitioned after the scan when ``min_partitions`` is given."""
    df = spark.read.text(paths if isinstance(paths, str) else list(paths))
    df = with_row_index(df.select("value", F.col("_metadata.file_path").alias("path"), "_metadata"))
    return df.repartition(min_partitions) if min_partitions else df


def _headed(spark: SparkSession, paths: str | Sequence[str], mark: str) -> tuple[DataFrame, DataFrame]:
    """Data lines (dataset, cells ARRAY) and headers (dataset, header ARRAY; one row per file)."""
    plist = [paths] if isinstance(paths, str) else list(paths)
    lines = with_row_index(spark.read.text(plist).select("value", F.col("_metadata.file_path").alias("dataset"), "_metadata"))
    first = lines.groupBy("dataset").agg(F.min(F.struct("row_idx", "value")).alias("_f"))
    at = F.col("_f.row_idx") + F.col("_f.value").startswith(mark).cast("long")
    first = first.select("dataset", at.alias("_at"))
    # Joins by file are broadcast: by key, all lines of a file would go to one task.
    placed = lines.join(F.broadcast(first), "dataset")
    heads = placed.where(F.col("row_idx") == F.col("_at")).select("dataset", F.split("value", "\t", -1).alias("header"))
    data = placed.where(F.col("row_idx") > F.col("_at")).select("dataset", F.split("value", "\t", -1).alias("cells"))
    return data, heads


def headed_lines(spark: SparkSession, paths: str | Sequence[str], mark: str = "#") -> DataFrame:
    """Data lines of tab-separated files as (dataset, header ARRAY, cells ARRAY), each file with its own header.

    A file's first line is dropped if it starts with ``mark`` (other such lines
    stay data) and the next line is its header.  The headers are one row per
    file, joined back by path.
    """
    data, heads = _headed(spark, paths, mark)
    return data.join(F.broadcast(heads), "dataset")


def read_tsv_table(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Header TSV files, every column as STRING, plus ``dataset`` = source file path.

    Files may differ in columns, column order and a leading comment line: a name
    is looked up once in every file's header, its cells are then taken by their
    place, and a column that a file lacks is NULL.  ``columns`` names the wanted
    columns; by default all names of all headers (one small row per file), in
    order of first appearance.
    """
    data, heads = _headed(spark, paths, "#")
    if columns is None:
        seen: dict[str, None] = {}
        for r in heads.orderBy("dataset").toLocalIterator():
            seen |= dict.fromkeys(r["header"])
        columns = list(seen)
    places = heads.select("dataset", F.array(*[(F.array_position("header", F.lit(c)) - 1).cast("int") for c in columns]).alias("_places"))
    cells = data.join(F.broadcast(places), "dataset")
    return cells.select(*[F.nullif(F.get("cells", F.get("_places", F.lit(i))), F.lit("")).alias(c) for i, c in enumerate(columns)], "dataset")


def read_expression(spark: SparkSession, paths: str | Sequence[str], n_meta: int = 2, feature_col: str | None = None) -> DataFrame:
    """S01 + P01 + P02 + P04: wide expression TSV(s) -> long (dataset, feature, sample, value DOUBLE).

    Each file is unpivoted under its own header, so cohorts with different
    samples, or the same ones in another order, can be read together.  Values
    that do not parse become NULL.
    """
    rows = headed_lines(spark, paths)
    at = F.array_position("header", F.lit(feature_col)).cast("int") - 1 if feature_col else F.lit(0)
    cell = F.explode(F.arrays_zip(F.slice("header", n_meta + 1, F.size("header")).alias("sample"), F.slice("cells", n_meta + 1, F.size("header")).alias("value")))
    long = rows.select("dataset", F.get("cells", at).alias("feature"), cell.alias("c"))
    return long.select("dataset", "feature", F.col("c.sample").alias("sample"), coerce_numeric(F.col("c.value")).alias("value"))


def read_mutations(spark: SparkSession, path: str | Sequence[str], sample_col: str = "Tumor_Sample_Barcode", type_col: str = "Consequence",
                   gene_col: str = "Hugo_Symbol") -> DataFrame:
    """Column-pruned mutation scan (gene, sample, consequence) as strings."""
    t = read_tsv_table(spark, path, [gene_col, sample_col, type_col])
    return t.select(F.col(gene_col).alias("gene"), F.col(sample_col).alias("sample"), F.col(type_col).alias("consequence"))


def read_bed(spark: SparkSession, path: str, with_label: bool = True) -> DataFrame:
    """Headerless BED (chrom, start, end[, label]) with file-order ``row_idx``."""
    schema = BED_SCHEMA if with_label else T.StructType(BED_SCHEMA.fields[:3])
    df = spark.read.csv(path, sep="\t", header=False, schema=schema)
    return with_row_index(df.select("*", "_metadata"))


def read_fasta(spark: SparkSession, path: str, chunk: int) -> DataFrame:
    """FASTA files -> chunks (chrom, chunk_id, chunk_start, seq) of ``chunk`` bases.

    Files are read line by line.  A header line ('>name ...', first word = name)
    holds for the lines after it, and a line's place in its sequence is the sum
    of the lengths before it; both are running values over the file order, as
    two-level prefix sums, so a chromosome spreads over many tasks.  A line is
    then cut at the chunk borders and the pieces of a chunk put together.
    Headers without a base give one empty chunk.
    """
    lines = with_row_index(spark.read.text(path).select("value", "_metadata"))
    text = F.regexp_replace("value", "\\s", "")
    head = F.col("value").startswith(">")
    rows = lines.select(
        "row_idx", F.when(head, F.element_at(F.split(F.substring("value", 2, 1 << 20), "\\s+"), 1)).alias("name"),
        F.when(head, F.lit("")).otherwise(text).alias("seq"), head.cast("long").alias("is_head"),
    ).withColumn("len", F.length("seq").cast("long"))
    rows = running_sum_within(rows, [], ["row_idx"], "is_head", "record")
    rows = running_sum_within(rows, [], ["row_idx"], "len", "upto")
    heads = rows.where("is_head = 1").select("record", F.col("name").alias("chrom"), F.col("upto").alias("base"))
    placed = rows.where("is_head = 0 and len > 0").select("record", "seq", "len", "upto").join(heads, "record")
    placed = placed.select("chrom", "seq", "len", (F.col("upto") - F.col("len") - F.col("base")).cast("long").alias("start"))
    first, last = F.floor(F.col("start") / chunk), F.floor((F.col("start") + F.col("len") - 1) / chunk)
    cut = placed.select("chrom", "seq", "start", F.explode(F.sequence(first, last)).alias("chunk_id"))
    at = F.greatest(F.col("chunk_id") * chunk - F.col("start"), F.lit(0))
    end = F.least((F.col("chunk_id") + 1) * chunk - F.col("start"), F.length("seq"))
    cut = cut.select("chrom", "chunk_id", (F.col("start") + at).alias("pos"), F.substring("seq", (at + 1).cast("int"), (end - at).cast("int")).alias("piece"))
    got = cut.groupBy("chrom", "chunk_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"]), "").alias("seq"))
    empty = heads.select("chrom").join(got.select("chrom").distinct(), "chrom", "left_anti").select("chrom", F.lit(0).cast("long").alias("chunk_id"), F.lit("").alias("seq"))
    return got.unionByName(empty).select("chrom", F.col("chunk_id").cast("int").alias("chunk_id"), (F.col("chunk_id") * chunk).alias("chunk_start"), "seq")


def chunk_genome(genome: DataFrame, chunk: int) -> DataFrame:
    """Fixed-size chunks (chrom, chunk_id, chunk_start, seq) so no later row holds a whole chromosome."""
    n = F.length("seq")
    # Empty sequences explode to nothing (no filter, which would be inlined and recompute ``seq``).
    ids = F.when(n > 0, F.sequence(F.lit(0), ((n - 1) / F.lit(chunk)).cast("int"))).otherwise(F.array().cast("array<int>"))
    x = genome.select("chrom", "seq", F.explode(ids).alias("chunk_id"))
    return x.select(
        "chrom", "chunk_id", (F.col("chunk_id").cast("long") * chunk).alias("chunk_start"),
        F.substring(F.col("seq"), F.col("chunk_id") * chunk + 1, F.lit(chunk)).alias("seq"),
    )


def read_tracks(spark: SparkSession, directory: str, chrom: str | None = None, start: int | None = None, end: int | None = None) -> DataFrame:
    """One interval file per track (chrom, start, end, value TSV); track = file name stem.

    The region predicate is a plain filter, so it reaches the reader (and
    Parquet row-group / partition pruning when the tracks are stored that way).
    """
    df = spark.read.csv(directory, sep="\t", header=False, schema=TRACK_SCHEMA)
    if "track" not in df.columns:  # flat folder: the track is the file name; partitioned folder: discovered
        stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
        df = df.withColumn("track", stem)
    if chrom is not None:
        df = df.where(F.col("chrom") == chrom)
    if start is not None:
        df = df.where(F.col("end") > start)
    if end is not None:
        df = df.where(F.col("start") < end)
    return df.select("track", "chrom", "start", "end", "value")


def read_cells(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Annotated cell matrix as three Parquet tables x(cell_id, gene, value), obs(cell_id, ...), var(gene, ...)."""
    return (spark.read.parquet(f"{directory}/x"), spark.read.parquet(f"{directory}/obs"), spark.read.parquet(f"{directory}/var"))


def read_manifest(spark: SparkSession, path: str, labels: dict[str, int]) -> DataFrame:
    """S11 + P14: 'label file1 file2 file3' lines -> (row_idx, label_id, files ARRAY<STRING>); unknown label fails."""
    from assayspark.operators.tidy import map_labels

    lines = with_row_index(spark.read.text(path).select("value", "_metadata")).where(F.length(F.trim("value")) > 0)
    parts = F.split(F.trim("value"), " +")
    return lines.select("row_idx", map_labels(F.element_at(parts, 1), labels).alias("label"), F.slice(parts, 2, 3).alias("files"))


def write_channels(channels: DataFrame, path: str) -> None:
    """Channel images (name, pixels) as many records per file, so a folder does not hold one file per channel."""
    channels.select("name", F.transform("pixels", lambda x: x.cast("double")).alias("pixels")).write.parquet(path)


def read_images(spark: SparkSession, manifest: DataFrame, root: str) -> DataFrame:
    """S12 + J11: join each manifest row's three channel names to their pixels: (row_idx, label, channels) in manifest order."""
    content = spark.read.parquet(root).select("name", "pixels")
    m = manifest.select("row_idx", "label", F.posexplode("files").alias("pos", "name"))
    got = m.join(content, "name").groupBy("row_idx", "label").agg(F.array_sort(F.collect_list(F.struct("pos", "pixels"))).alias("c"))
    return got.select("row_idx", "label", F.transform("c", lambda s: s["pixels"]).alias("channels"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Encoded token arrays stored as Parquet ARRAY<TINYINT>."""
    return spark.read.parquet(path)
