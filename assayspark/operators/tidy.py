"""Projections, filters and per-row cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_leading(df: DataFrame, n: int) -> DataFrame:
    """Drop the first n columns (metadata columns of a wide matrix)."""
    return df.select(*df.columns[n:])


def melt(df: DataFrame, ids: Sequence[str], var_name: str = "sample", value_name: str = "value") -> DataFrame:
    """Wide -> long; every non-id column becomes a (var_name, value) row."""
    values = [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), values, var_name, value_name)


def to_wide(m: DataFrame, row: str, col: str, value: str = "value", columns: list | None = None) -> DataFrame:
    """Long -> wide for small outputs (pivot values given or discovered)."""
    return m.groupBy(row).pivot(col, columns).agg(F.first(value))


def coerce_numeric(c: Column) -> Column:
    """Text -> DOUBLE; unparsable text and NaN become NULL."""
    v = c.try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def narrow(df: DataFrame, floats: Sequence[str] = (), ints: Sequence[str] = (), longs: Sequence[str] = ()) -> DataFrame:
    """Type narrowing to float32 / int / bigint."""
    for c in floats:
        df = df.withColumn(c, F.col(c).cast("float"))
    for c in ints:
        df = df.withColumn(c, F.col(c).cast("int"))
    for c in longs:
        df = df.withColumn(c, F.col(c).cast("long"))
    return df


def member_of(df: DataFrame, col: str, values: Sequence | DataFrame) -> DataFrame:
    """Keep rows whose ``col`` is in a literal list or in another frame's column (semi join)."""
    if isinstance(values, DataFrame):
        other = values.select(F.col(values.columns[0]).alias(col)).distinct()
        return df.join(other, col, "left_semi")
    return df.where(F.col(col).isin(list(values)))


def not_containing(c: Column, needle: str) -> Column:
    """NOT contains(needle), where a missing value counts as not containing it (kept)."""
    return ~F.coalesce(F.contains(c, F.lit(needle)), F.lit(False))


def drop_missing_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any key column."""
    return df.dropna(subset=list(keys))


def clean_signal(c: Column) -> Column:
    """NaN and +-inf -> 0, negatives -> 0."""
    bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf"))) | c.isNull()
    return F.when(bad, F.lit(0.0)).otherwise(F.greatest(c, F.lit(0.0)))


def map_labels(c: Column, mapping: dict[str, int]) -> Column:
    """Label text -> id; an unknown label fails the job (like a dict KeyError)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    looked = m[c]
    return F.when(looked.isNull(), F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(c, F.lit("NULL"))))).otherwise(looked)


def map_or_keep(looked_up: Column, original: Column) -> Column:
    """Mapped value when present, else the original."""
    return F.coalesce(looked_up, original)


def variant_or_original(variant: Column, original: Column, max_len: int = 150, banned: str = "%") -> Column:
    """The variant if short and free of ``banned``, else the original if short, else NULL (dropped)."""
    return (
        F.when((F.length(variant) < max_len) & ~F.contains(variant, F.lit(banned)), variant)
        .when(F.length(original) < max_len, original)
    )


def last_field(c: Column, sep: str = "_") -> Column:
    """Text after the last separator (whole text when absent)."""
    return F.element_at(F.split(c, sep, -1), -1)


def unique_names(df: DataFrame, name: str, order: str, out: str = "unique_name") -> DataFrame:
    """Make names unique: 2nd, 3rd ... copy (by ``order``) get suffixes -1, -2, ...

    Numbering inside a name uses the skew-safe two-level row number.
    """
    from assayspark.operators.windows import row_number_within

    n = row_number_within(df, [name], [order], "_copy")
    return n.withColumn(
        out, F.when(F.col("_copy") == 1, F.col(name)).otherwise(F.concat(F.col(name), F.lit("-"), (F.col("_copy") - 1).cast("string")))
    ).drop("_copy")


def raw_or_logged(df: DataFrame, group: str, value: str, cutoff: float = 50.0, strict: bool = False) -> DataFrame:
    """Per-group flag 'already normalised' (min < 0 or max < cutoff); ``strict``: raw only if max > cutoff."""
    rng = df.groupBy(group).agg(F.min(value).alias("min"), F.max(value).alias("max"))
    raw = (F.col("max") > cutoff) if strict else ~((F.col("min") < 0) | (F.col("max") < cutoff))
    return rng.withColumn("is_raw", raw)


def basename(c: Column) -> Column:
    """last path component."""
    return F.element_at(F.split(c, "/", -1), -1)
