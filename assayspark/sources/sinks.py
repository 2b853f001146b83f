"""Sinks (K01-K04); model export (K05) is in :mod:`assayspark.operators.ml`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_predictions(pred: DataFrame, path: str, gene: str = "gene", name: str = "sample", prob: str = "prob") -> None:
    """Text output per gene with lines 'name %.5f', sorted by name (binary collation).

    Rows are range-partitioned on (gene, name), so a gene with most of the rows
    spans many tasks and its files follow one another in name order;
    ``partitionBy`` makes one directory per gene.
    """
    n = int(pred.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = pred.select(gene, name, F.format_string("%s %.5f", F.col(name).cast("string"), F.col(prob)).alias("value"))
    (
        lines.repartitionByRange(n, gene, name)
        .sortWithinPartitions(gene, name)
        .select(gene, "value")
        .write.mode("overwrite")
        .partitionBy(gene)
        .text(path)
    )


def constant_fallback(samples: DataFrame, genes: list[str], value: float = 0.0, name: str = "sample") -> DataFrame:
    """A constant probability for genes with no model, one row per (gene, test sample).

    The gene list is a parameter (bounded); rows are generated by exploding it on the sample frame.
    """
    return samples.select(name, F.explode(F.array(*[F.lit(g) for g in genes])).alias("gene")).select(
        "gene", name, F.lit(float(value)).alias("prob")
    )


def write_arrays(df: DataFrame, path: str, order: str = "row_idx") -> None:
    """Dense arrays (factor rows, predictions, tokens) as Parquet files in ascending ``order``.

    Range-partitioned and sorted, so part files hold consecutive rows and their
    row-group statistics prune a slice of the array.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, order).sortWithinPartitions(order).write.mode("overwrite").parquet(path)


def write_distinct(df: DataFrame, col: str, path: str) -> None:
    """The distinct reference set (e.g. training strings) as Parquet, read back by the novelty anti join."""
    df.select(col).distinct().write.mode("overwrite").parquet(path)
