"""Incremental (Structured Streaming) form of the string-corpus preparation.

The reference has no streaming operators; its one stream-like step is reading
a gzip corpus line by line, filtering and encoding it.  ``corpus_stream``
runs that same step over files that keep arriving in a folder: the text
source picks up new files, each micro-batch is filtered (P13) and encoded
(F09) with the same column functions as the batch path, and ``foreachBatch``
writes it to the Parquet partition of its batch id (K03), which a retried batch
overwrites.  With ``availableNow`` it processes what is
there and stops, which is how the tests drive it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assayspark.functions.tokens import encode, valid_for_encoding


def encoded_corpus(lines: DataFrame, max_len: int = 150) -> DataFrame:
    """Valid lines -> (path, s, tokens ARRAY<TINYINT>); works on batch and streaming frames alike."""
    s = lines.select(F.col("_metadata.file_path").alias("path"), F.rtrim(F.col("value")).alias("s"))
    ok = s.where(valid_for_encoding(F.col("s"), max_len))
    return ok.select("path", "s", F.transform(encode(F.col("s"), max_len), lambda t: t.cast("tinyint")).alias("tokens"))


def corpus_stream(
    spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, max_len: int = 150, available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the incremental corpus encoder; the checkpoint folder must be on shared storage."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(in_dir).select("value", "_metadata")
    enc = encoded_corpus(lines, max_len)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")

    w = enc.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
