"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayspark.session import scratch_path

# Fixed value: one word of the contracts, a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the plan a single time.
    Void columns do not occur here, and the folder name is unique per call.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast ``df`` only after counting that it has at most ``max_rows`` rows; otherwise leave the join to Spark."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def others(df: DataFrame, new: Sequence[str]) -> list[Column]:
    """The columns of ``df`` except those that a result named ``new`` replaces (names compare without case)."""
    gone = {c.lower() for c in new}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in gone]


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
