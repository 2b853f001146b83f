"""Profiles and aggregates over long (tidy) matrices and category columns.

All reductions are exact and run as partial + final hash aggregation, so a hot
key is combined map-side before it is shuffled.  Scalars that feed a later
step (global min/max, means) stay inside the plan as scalar subqueries instead
of being collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayspark.operators.windows import running_sum_within


def _scalar(df: DataFrame, expr: Column) -> Column:
    """One-row aggregate as a scalar subquery column."""
    return df.agg(expr).scalar()


def shape(m: DataFrame, feature: str = "feature", sample: str = "sample") -> DataFrame:
    """Number of cells, features (rows) and samples (columns) of a long matrix."""
    return m.agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.countDistinct(feature).alias("n_features"),
        F.countDistinct(sample).alias("n_samples"),
    )


def missing_total(m: DataFrame, value: str = "value") -> DataFrame:
    """Total missing cells."""
    return m.agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.sum(F.col(value).isNull().cast("long")).alias("n_missing"),
    )


def missing_per_feature(m: DataFrame, feature: str = "feature", value: str = "value") -> DataFrame:
    """A03 (counts): features with at least one missing cell and how many."""
    return (
        m.where(F.col(value).isNull())
        .groupBy(feature)
        .agg(F.count(F.lit(1)).alias("n_missing"))
    )


def missing_cells(m: DataFrame, feature: str = "feature", sample: str = "sample", value: str = "value") -> DataFrame:
    """A03 (listing): the (feature, sample) cells that are missing, long form (no per-feature list)."""
    return m.where(F.col(value).isNull()).select(feature, sample)


def global_moments(m: DataFrame, sample: str = "sample", value: str = "value") -> DataFrame:
    """Mean of column means, mean of column sample variances, global min and max."""
    per_col = m.groupBy(sample).agg(
        F.avg(value).alias("col_mean"),
        F.var_samp(value).alias("col_var"),
        F.min(value).alias("col_min"),
        F.max(value).alias("col_max"),
    )
    return per_col.agg(
        F.avg("col_mean").alias("mean_of_means"),
        F.avg("col_var").alias("mean_of_vars"),
        F.min("col_min").alias("min"),
        F.max("col_max").alias("max"),
    )


def value_counts(df: DataFrame, key: str, include_null: bool = False) -> DataFrame:
    """Category frequencies (key, count); NULL key kept only when asked."""
    src = df if include_null else df.where(F.col(key).isNotNull())
    return src.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def top_k(df: DataFrame, key: str, k: int = 10, include_null: bool = False) -> DataFrame:
    """The k most frequent values; ties broken by key (NULL last)."""
    vc = value_counts(df, key, include_null)
    return vc.orderBy(F.desc("count"), F.asc_nulls_last(key)).limit(k)


def top_k_share(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """Share of all rows (NULL keys included in the denominator) held by the top-k values."""
    top = top_k(df, key, k).select(F.col(key).alias("_k"), "count")
    total = _scalar(df, F.count(F.lit(1)))
    return top.agg(
        F.sum("count").alias("n_top"),
        (F.sum("count") / total).alias("share"),
    )


def frequency_ascending(df: DataFrame, key: str, include_null: bool = True) -> DataFrame:
    """Category frequency sorted ascending (ties by key)."""
    return value_counts(df, key, include_null).orderBy("count", F.asc_nulls_first(key))


def histogram(df: DataFrame, value: str, bins: int, lo: Column | None = None, hi: Column | None = None) -> DataFrame:
    """Equal-width histogram over [lo, hi] with ``bins`` bins; the last bin is closed.

    Bin edges come from a min/max pass (scalar subquery) unless given; empty
    bins are filled from ``range`` so every bin appears exactly once.
    """
    x = df.where(F.col(value).isNotNull())
    lo = lo if lo is not None else _scalar(x, F.min(value))
    hi = hi if hi is not None else _scalar(x, F.max(value))
    width = hi - lo
    raw_bin = F.floor((F.col(value) - lo) / width * bins) + 1
    b = F.when(width == 0, F.lit(1)).otherwise(F.least(raw_bin, F.lit(bins))).cast("int")
    counts = x.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    all_bins = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (
        all_bins.join(counts, "bin", "left")
        .select(
            "bin",
            (lo + (F.col("bin") - 1) * width / bins).alias("lo"),
            (lo + F.col("bin") * width / bins).alias("hi"),
            F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"),
        )
    )


def clipped_histogram(m: DataFrame, bins: int, sample: str = "sample", value: str = "value", n_sd: float = 2.0) -> DataFrame:
    """Clip to mean +- n_sd * (mean of column sample sd), then histogram."""
    per_col = m.groupBy(sample).agg(F.avg(value).alias("mu"), F.stddev_samp(value).alias("sd"))
    mu = _scalar(per_col, F.avg("mu"))
    sd = _scalar(per_col, F.avg("sd"))
    lo, hi = mu - F.lit(n_sd) * sd, mu + F.lit(n_sd) * sd
    clipped = m.where(F.col(value).isNotNull()).select(F.greatest(lo, F.least(hi, F.col(value))).alias(value))
    return histogram(clipped, value, bins, lo, hi)


def population_sd(m: DataFrame, by: str, value: str = "value") -> DataFrame:
    """A10: population standard deviation per row (feature) or per column (sample)."""
    return m.groupBy(by).agg(F.stddev_pop(value).alias("sd_pop"), F.count(value).alias("n"))


def drop_constant(m: DataFrame, feature: str = "feature", value: str = "value") -> DataFrame:
    """Keep only features whose population sd is non-zero (semi join on a per-feature aggregate)."""
    keep = m.groupBy(feature).agg(F.stddev_pop(value).alias("sd")).where(F.col("sd") != 0).select(feature)
    return m.join(keep, feature, "left_semi")


def mean_offdiag_corr(m: DataFrame, var: str = "feature", obs: str = "sample", value: str = "value") -> DataFrame:
    """Mean off-diagonal Pearson r between the ``var`` variables, without the n x n matrix.

    With unit-norm centred vectors z_i the sum of all r_ij equals ||sum_i z_i||^2,
    so the mean over i != j is (||sum z||^2 - n) / (n (n - 1)).  One per-variable
    aggregate, one per-observation sum: two shuffles, linear in the data.
    Constant variables are excluded (their r is undefined).
    """
    stats = m.groupBy(var).agg(F.avg(value).alias("_mu"), F.stddev_pop(value).alias("_sd"), F.count(value).alias("_n"))
    stats = stats.where(F.col("_sd") > 0)
    z = m.join(stats, var).select(
        obs, ((F.col(value) - F.col("_mu")) / (F.col("_sd") * F.sqrt(F.col("_n").cast("double")))).alias("z")
    )
    s = z.groupBy(obs).agg(F.sum("z").alias("s"))
    n = _scalar(stats, F.count(F.lit(1)).cast("double"))
    return s.agg(((F.sum(F.col("s") * F.col("s")) - n) / (n * (n - 1))).alias("mean_r"), n.cast("long").alias("n_vars"))


#: Variables per side of a block product, and observations per chunk.
CORR_VARS, CORR_OBS = 256, 4096
#: Blocks of variables asked for where the observations fit one chunk, and rows of the result in a batch.
CORR_BLOCKS, CORR_ROWS = 16, 131_072


def pairwise_corr(m: DataFrame, var: str = "feature", obs: str = "sample", value: str = "value") -> DataFrame:
    """Pearson matrix between variables as long rows (var_i, var_j, r), as a block matrix product.

    Cells are standardised per variable, observations are cut into chunks and
    variables into blocks, and each (chunk, block) becomes one packed matrix
    with the names of its variables.  With one chunk the blocks travel to their
    pairs and the products leave their task as rows of the result, so nothing
    of the size of the result is shuffled.  With more, blocks of a chunk meet
    by an equi-join and the partial products are summed per block pair; a task
    never holds more than a block.  A variable without variance has no r.
    Missing cells count as the variable's mean.
    """
    # One row per variable and per observation: their dense numbers.
    number = lambda c, n: m.select(c).distinct().select(F.col(c).alias(f"_{n}v"), (F.row_number().over(Window.orderBy(c)) - 1).alias(f"_{n}"))
    st = m.groupBy(var).agg(F.avg(value).alias("_mu"), F.stddev_pop(value).alias("_sd"), F.count(value).alias("_n")).where("_sd > 0")
    vs, os_ = number(var, "i"), number(obs, "o")
    n_vars, n_obs = vs.count(), os_.count()
    single = n_obs <= CORR_OBS
    size = max(CORR_VARS, min(CORR_VARS * CORR_OBS // max(n_obs, 1), -(-n_vars // CORR_BLOCKS))) if single else CORR_VARS
    z = (F.col(value) - F.col("_mu")) / (F.col("_sd") * F.sqrt(F.col("_n").cast("double")))
    cells = m.join(st, var).join(vs, F.col(var) == F.col("_iv")).join(os_, F.col(obs) == F.col("_ov"))
    cells = cells.where(F.col(value).isNotNull()).select(
        F.floor(F.col("_o") / CORR_OBS).alias("c"), F.floor(F.col("_i") / size).alias("b"), (F.col("_o") % CORR_OBS).alias("o"), (F.col("_i") % size).alias("i"), z.alias("z")
    )

    def pack(t: pa.Table) -> pa.Table:
        o, i = t.column("o").to_numpy(), t.column("i").to_numpy()
        x = np.zeros((int(o.max()) + 1, size))
        x[o, i] = t.column("z").to_numpy()
        used = np.flatnonzero(x.any(axis=1))
        top = int(used[-1]) + 1 if len(used) else 0
        return pa.table({"c": t.column("c").slice(0, 1), "b": t.column("b").slice(0, 1), "x": pa.array([x[:top].tobytes()], pa.binary())})

    packed = cells.groupBy("c", "b").applyInArrow(pack, "c long, b long, x binary")
    live = vs.join(st.select(F.col(var).alias("_sv")), F.col("_iv") == F.col("_sv"))
    names = live.groupBy(F.floor(F.col("_i") / size).alias("b")).agg(F.collect_list(F.struct((F.col("_i") % size).alias("i"), F.col("_iv").alias("v"))).alias("names"))
    kind = m.schema[var].dataType.simpleString()
    schema = f"`{var}_i` {kind}, `{var}_j` {kind}, r double"

    most = CORR_ROWS  # tasks get the driver's value

    def rows(product: Callable[[np.ndarray, np.ndarray], np.ndarray], left: pa.Array, right: pa.Array, twice: bool) -> Iterator[pa.RecordBatch]:
        """The rows of a block of the result, some variables of the left side at a time (twice: also with the sides exchanged)."""
        (i, vi), (j, vj) = ((n.field("i").to_numpy(), n.field("v")) for n in (left, right))
        step = max(1, most // max(1, len(j)))
        for lo in range(0, len(i), step):
            k = i[lo : lo + step]
            a = vi.take(pa.array(np.repeat(np.arange(lo, lo + len(k)), len(j))))
            b = vj.take(pa.array(np.tile(np.arange(len(j)), len(k))))
            r = pa.array(product(k, j).ravel())
            yield pa.RecordBatch.from_arrays([a, b, r], names=[f"{var}_i", f"{var}_j", "r"])
            if twice:
                yield pa.RecordBatch.from_arrays([b, a, r], names=[f"{var}_i", f"{var}_j", "r"])

    if single:
        n_blocks = -(-n_vars // size)
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, n_blocks - 1)).cast("long"))).alias("k")
        sides = packed.join(names, "b").select("b", "x", "names", other)
        sides = sides.select(F.least("b", "k").alias("b1"), F.greatest("b", "k").alias("b2"), "b", "x", "names")
        tasks = max(1, min(n_blocks * (n_blocks + 1) // 2, 8 * m.sparkSession.sparkContext.defaultParallelism))

        def multiply_pairs(batches):
            held = None
            for batch in batches:
                for k in range(batch.num_rows):
                    b1, b2, b = (batch.column(c)[k].as_py() for c in range(3))
                    x, n = np.frombuffer(batch.column(3)[k].as_buffer()).reshape(-1, size), batch.column(4)[k].values
                    if b == b1 and b1 != b2:
                        held = (b1, b2, x.copy(), n)  # the other side is the next row
                        continue
                    if b1 == b2:
                        yield from rows(lambda i, j: x[:, i].T @ x[:, j], n, n, False)  # noqa: B023
                    elif held is not None and held[:2] == (b1, b2):
                        both = min(len(x), len(held[2]))
                        y, x = held[2][:both], x[:both]
                        yield from rows(lambda i, j: y[:, i].T @ x[:, j], held[3], n, True)  # noqa: B023
                    held = None

        return sides.repartition(tasks, "b1", "b2").sortWithinPartitions("b1", "b2", "b").mapInArrow(multiply_pairs, schema)

    left = packed.select(F.col("c").alias("c1"), F.col("b").alias("b1"), F.col("x").alias("x1"))
    met = left.join(packed, (F.col("c1") == F.col("c")) & (F.col("b1") <= F.col("b"))).select("b1", "b", "x1", "x")

    def multiply(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(j)[k].as_py()).reshape(-1, CORR_VARS) for j in (2, 3))
                n = min(len(x), len(y))
                p = x[:n].T @ y[:n]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([p.tobytes()], pa.binary())], names=["b1", "b", "p"])

    parts = met.mapInArrow(multiply, "b1 long, b long, p binary")

    def total(t: pa.Table, n: pa.Table) -> pa.Table:
        if not t.num_rows or not n.num_rows:
            return pa.Table.from_batches([], pa.schema([(f"{var}_i", n.schema.field("names1").type.value_type.field("v").type), (f"{var}_j", n.schema.field("names2").type.value_type.field("v").type), ("r", pa.float64())]))
        p = sum(np.frombuffer(x.as_py()) for x in t.column("p")).reshape(CORR_VARS, CORR_VARS)
        return pa.Table.from_batches(list(rows(lambda i, j: p[np.ix_(i, j)], n.column("names1")[0].values, n.column("names2")[0].values, n.column("b1")[0].as_py() != n.column("b")[0].as_py())))

    pairs = names.select(F.col("b").alias("b1"), F.col("names").alias("names1"), F.explode(F.sequence("b", F.lit(max(0, -(-n_vars // size) - 1)).cast("long"))).alias("b"))
    pairs = pairs.join(names.select("b", F.col("names").alias("names2")), "b").select("b1", "b", "names1", "names2")
    return parts.groupBy("b1", "b").cogroup(pairs.groupBy("b1", "b")).applyInArrow(total, schema)


def fewest_missing(df: DataFrame, group: str, value: str, order: str | None = None) -> DataFrame:
    """The group with the fewest missing values (tie: smallest ``order``, else group)."""
    per = df.groupBy(group).agg(
        F.sum(F.col(value).isNull().cast("long")).alias("n_missing"),
        F.min(order or group).alias("_ord"),
    )
    return per.agg(F.min_by(group, F.struct("n_missing", "_ord")).alias(group), F.min("n_missing").alias("n_missing"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles (linear between ranks) of ``value`` per key, NULLs left out: (keys, one column per ``probs`` entry).

    Equal values are counted first, the counts are summed along each key by the
    two-level running sum, and the values at the wanted ranks are picked by a
    grouped minimum, so no task holds all values of a key.
    """
    per = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    run = running_sum_within(per, keys, ["_v"], "_c", "_upto")
    total = run.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    if keys:
        run = run.join(total.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_n"), [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    else:
        run = run.withColumn("_n", total.select("_n").scalar())
    ranks = {name: (F.col("_n") - 1) * F.lit(p) for name, p in probs.items()}
    aggs = [F.max("_n").alias("_n")]
    for name, r in ranks.items():
        aggs += [F.min(F.when(F.col("_upto") > F.floor(r), F.col("_v"))).alias(f"_{name}_lo"), F.min(F.when(F.col("_upto") > F.ceil(r), F.col("_v"))).alias(f"_{name}_hi")]
    got = run.groupBy(*keys).agg(*aggs)
    lo, hi = (lambda n: F.col(f"_{n}_lo")), (lambda n: F.col(f"_{n}_hi"))
    return got.select(*keys, *[(lo(n) + (hi(n) - lo(n)) * (r - F.floor(r))).alias(n) for n, r in ranks.items()])


def median_impute(m: DataFrame, feature: str = "feature", value: str = "value") -> DataFrame:
    """Fill missing cells with the exact median of their feature."""
    med = exact_quantiles(m, [feature], value, {"_median": 0.5})
    return m.join(med, feature, "left").withColumn(value, F.coalesce(F.col(value), F.col("_median"))).drop("_median")


def log2p1_if_counts(m: DataFrame, group: str = "dataset", value: str = "value", cutoff: float = 50.0) -> DataFrame:
    """A16 with P24: log2(x + 1) per group unless the group already looks normalised.

    A group is treated as normalised when min < 0 or max < cutoff; ``max == cutoff`` counts as raw.
    """
    rng = m.groupBy(group).agg(F.min(value).alias("_min"), F.max(value).alias("_max"))
    is_raw = ~((F.col("_min") < 0) | (F.col("_max") < cutoff))
    return (
        # Few groups of many rows: joined by key, a group's rows would go to one task.
        m.join(F.broadcast(rng), group, "left")
        .withColumn(value, F.when(is_raw, F.log2(F.col(value) + 1)).otherwise(F.col(value)))
        .withColumn("was_raw", is_raw)
        .drop("_min", "_max")
    )


def log2_cpm(m: DataFrame, keys: tuple[str, ...] = ("dataset", "sample"), value: str = "value", scale: float = 1e6) -> DataFrame:
    """Library-size normalisation log2(v / total * 1e6 + 1); a zero total gives NULL.

    Totals come from a grouped aggregate joined back, not a window, so a hot
    sample is pre-aggregated map-side and the join can split it.
    """
    tot = m.groupBy(*keys).agg(F.sum(value).alias("_total"))
    return (
        m.join(tot, list(keys), "left")
        .withColumn(value, F.log2(F.col(value) / F.nullif(F.col("_total"), F.lit(0.0)) * scale + 1))
        .drop("_total")
    )


def normalize_total_log1p(m: DataFrame, cell: str = "sample", value: str = "value", target: float = 1e4) -> DataFrame:
    """Per-cell scaling to ``target`` total then log1p, keeping the raw value."""
    tot = m.groupBy(cell).agg(F.sum(value).alias("_total"))
    return (
        m.join(tot, cell, "left")
        .withColumn("raw_value", F.col(value))
        .withColumn(value, F.log1p(F.col(value) / F.nullif(F.col("_total"), F.lit(0.0)) * target))
        .drop("_total")
    )


def detected_in(m: DataFrame, min_cells: int = 3, feature: str = "feature", value: str = "value") -> DataFrame:
    """Keep genes with a positive value in at least ``min_cells`` cells."""
    keep = m.groupBy(feature).agg(F.sum((F.col(value) > 0).cast("long")).alias("_n")).where(F.col("_n") >= min_cells)
    return m.join(keep.select(feature), feature, "left_semi")


def describe(df: DataFrame, value: str) -> DataFrame:
    """Count, mean, sample sd, quartiles, min, max and population variance of one column."""
    v = F.col(value)
    one = df.agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"), F.var_pop(v).alias("var_pop")
    )
    q = exact_quantiles(df, [], value, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return one.select("count", "mean", "std", "min", *[q.select(p).scalar().alias(p) for p in ("p25", "p50", "p75")], "max", "var_pop")


def class_counts(df: DataFrame, label: str, domain: DataFrame) -> DataFrame:
    """Counts per class over a fixed label domain (absent classes count 0)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    return domain.join(c, label, "left").select(label, F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def label_counter(df: DataFrame, *cols: str) -> DataFrame:
    """Plain counter per label (or label pair)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))


def length_profile(df: DataFrame, s: str = "s") -> DataFrame:
    """N, min, max, mean, median length and share under 50 / 100 characters."""
    n = F.length(s)
    median = exact_quantiles(df.select(n.alias("_len")), [], "_len", {"m": 0.5}).select("m").scalar()
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(n).alias("min_len"),
        F.max(n).alias("max_len"),
        F.avg(n).alias("mean_len"),
        median.alias("median_len"),
        F.avg((n < 50).cast("double")).alias("share_lt_50"),
        F.avg((n < 100).cast("double")).alias("share_lt_100"),
    )


def alphabet(df: DataFrame, s: str = "s") -> DataFrame:
    """Distinct characters with their counts, sorted."""
    ch = df.select(F.explode(F.split(s, "")).alias("ch")).where(F.col("ch") != "")
    return ch.groupBy("ch").agg(F.count(F.lit(1)).alias("count")).orderBy("ch")


def accuracy_and_loss(df: DataFrame, pred: str, label: str, loss: str | None = None, weight: str | None = None) -> DataFrame:
    """Accuracy and the sample-weighted mean loss."""
    w = F.col(weight) if weight else F.lit(1.0)
    aggs = [F.avg((F.col(pred) == F.col(label)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n")]
    if loss:
        aggs.append((F.sum(F.col(loss) * w) / F.sum(w)).alias("mean_loss"))
    return df.agg(*aggs)


def best_run(df: DataFrame, run: str, key: Column) -> DataFrame:
    """The run maximising ``key`` (a struct for lexicographic order); earliest wins ties."""
    return df.agg(F.max_by(run, key).alias(run), F.max(key).alias("best"))
