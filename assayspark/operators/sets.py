"""Set operations and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def intersect_all_groups(df: DataFrame, item: str, group: str) -> DataFrame:
    """Items present in every group (n-way intersection by distinct group count)."""
    n = df.agg(F.countDistinct(group)).scalar()
    return df.groupBy(item).agg(F.countDistinct(group).alias("_g")).where(F.col("_g") == n).select(item)


def intersect2(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Two-way intersection of distinct values, sorted."""
    return a.select(col).intersect(b.select(col)).orderBy(col)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Union of distinct values over several frames."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def union_fill(a: DataFrame, b: DataFrame, fill=False) -> DataFrame:
    """Union by name, columns missing on one side filled (absent gene -> False)."""
    u = a.unionByName(b, allowMissingColumns=True)
    extra = [c for c in u.columns if c not in a.columns or c not in b.columns]
    return u.fillna(fill, subset=extra) if extra else u


def distinct_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct key pairs."""
    return df.dropDuplicates(list(cols)).select(*cols)


def keep_first(df: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """One row per key, the one with the smallest ``order`` (several columns: lexicographic).

    ``min_by`` over a struct of the other columns aggregates map-side first,
    so a hot key never sorts in one task (unlike row_number over the key).
    """
    others = [c for c in df.columns if c not in keys]
    ordcol = F.col(order) if isinstance(order, str) else F.struct(*order)
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*others), ordcol).alias("_r"))
    return agg.select(*keys, *[F.col("_r")[c].alias(c) for c in others])


def keep_first_by_values(df: DataFrame, value_cols: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """De-duplicate whole rows by their values (keep the earliest)."""
    return keep_first(df, value_cols, order)


def duplicated_names(df: DataFrame, name: str) -> DataFrame:
    """Names that occur more than once, with their counts."""
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def stack_labels(m: DataFrame, row: str, label: str, labels: Sequence[str]) -> DataFrame:
    """U04 in long form: the label frames of all ``labels`` stacked, as rows (row, label, flag).

    A frame holds the distinct ``row`` values of one label, True for it and False
    for every other one.  The plan has one step whatever the number of labels;
    rows with a NULL label are in no frame.
    """
    own = m.where(F.col(label).isNotNull()).select(row, F.col(label).alias("_own")).distinct()
    each = own.select(row, "_own", F.explode(F.lit(list(labels)).cast("array<string>")).alias(label))
    return each.select(row, label, (F.col("_own") == F.col(label)).alias("flag"))
