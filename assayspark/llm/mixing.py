"""Mixing sources to target weights by weighted fair queueing.

Each source lists its documents in a shuffled order, again and again.  A
document's virtual finish time is the number of its source's words up to its
end divided by the source's target, so all sources reach their targets at time
1.  The mix is the range-sorted list of finish times up to the total budget.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayspark.functions.tokens import HASH_MOD, arith_hash, arith_hash_sql
from assayspark.llm.common import WORD, materialize, small_side

# Fixed values of the contract: weights in turn, budget and repeats.
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = 42
#: Pieces of the shuffled order of a source, and of the time axis up to ``LAST``.
SLICES = 4096
TICKS = 8192
LAST = 2.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, seed: int = SEED) -> Column:
    """Pseudo-random place of a document, the same in every run (NULL ids count as 0)."""
    return arith_hash(F.abs(F.coalesce(doc_id, F.lit(0))) % HASH_MOD, F.lit(seed))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, epochs: int = MAX_EPOCHS) -> DataFrame:
    """Target words of every source from (source, source_size), with its ``rank`` in code-point order, NULL last.

    ``budget`` times all words is shared by weight; a target stops at ``epochs``
    times its source, and the excess is shared again by weight.  With the
    sources ordered by cap / weight, the level after the first i of them are
    capped is (budget - their caps) / (remaining weights), and the first source
    that stays below its cap fixes the level for all that follow.
    The windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = sources.withColumn("rank", F.row_number().over(order) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    s = s.withColumn("w", w).withColumn("cap", F.col("source_size") * float(epochs))
    by_need = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    s = s.select(
        "*",
        F.coalesce(F.sum("cap").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("capped"),
        F.sum("w").over(by_need.rowsBetween(0, Window.unboundedFollowing)).alias("open_w"),
        (F.sum("source_size").over(Window.partitionBy()) * float(budget)).alias("total"),
    )
    level = (F.col("total") - F.col("capped")) / F.col("open_w")
    s = s.withColumn("level", F.when(F.col("cap") > level * F.col("w"), level))
    whole = by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("level", F.first("level", ignorenulls=True).over(whole))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("w")))
    return s.select("source", "source_size", "rank", target.alias("target"))


def running_words(sized: DataFrame) -> DataFrame:
    """Add ``upto``: words of the source up to and including the row, in shuffled order.

    A source is cut into ``SLICES`` slices of the shuffle key, so that no task
    holds a whole source; slice totals (at most sources x SLICES rows) give the
    start of each slice.
    """
    d = sized.withColumn("slice", F.floor(F.col("h") * SLICES / HASH_MOD).cast("int"))
    sums = d.groupBy("rank", "slice").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("rank").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select(F.col("rank").alias("_r"), F.col("slice").alias("_s"), F.coalesce(before, F.lit(0)).alias("start"))
    w = Window.partitionBy("rank", "slice").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    inner = d.withColumn("_in", F.sum("size").over(w))
    j = inner.join(starts, (F.col("rank") == F.col("_r")) & (F.col("slice") == F.col("_s")))
    return j.withColumn("upto", F.col("start") + F.col("_in")).drop("_in", "_r", "_s", "start", "slice")


def mix(sized: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(doc_id, source, size) rows plus source_size, target and ``epochs_taken``.

    NULL source is a source of its own (last); a source without words has target
    0 and is not taken.  Rows equal in doc_id, source and size are
    interchangeable.  The total of the words taken is the budget less at most
    the document at the cut.
    """
    sized = materialize(sized.select("doc_id", "source", "size", shuffle_key(F.col("doc_id")).alias("h")), "mix-sizes")
    goal = materialize(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, epochs), "mix-targets")
    goal_side = small_side(goal.withColumnRenamed("source", "_source"))
    d = sized.join(goal_side, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    queued = materialize(running_words(d), "mix-queue")

    finish = [(F.col("upto") + F.col("source_size") * e) / F.nullif(F.col("target"), F.lit(0.0)) for e in range(epochs)]
    entry = lambda e: F.struct(finish[e].alias("v"), F.col("rank").alias("rank"), F.lit(e).alias("epoch"), F.col("h").alias("h"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"))
    entries = queued.select("size", F.explode(F.array(*[entry(e) for e in range(epochs)])).alias("x")).where((F.col("x.v") < LAST) & (F.col("size") > 0))
    tick = F.floor(F.col("x.v") * TICKS / LAST)
    # Range sort: words per tick (at most TICKS rows), then the exact order inside the tick in which the budget ends.
    per_tick = entries.groupBy(tick.alias("tick")).agg(F.sum("size").alias("n"))
    line = per_tick.withColumn("upto", F.sum("n").over(Window.orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)))
    total = goal.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    # The budget may exceed the sum of whole words by rounding only.
    room = total * (1 + 1e-12)
    cut_tick = line.where(F.col("upto") > room).orderBy("tick").first()
    taken = F.lit(0)
    if cut_tick is None:
        for v in finish:
            taken = taken + F.coalesce((v < LAST).cast("int"), F.lit(0))
        return queued.select("doc_id", "source", "size", "source_size", "target", taken.alias("epochs_taken"))
    start = cut_tick.upto - cut_tick.n
    inside = entries.where(tick == cut_tick.tick)
    order = Window.orderBy("x", "size").rowsBetween(Window.unboundedPreceding, 0)
    fits = inside.withColumn("upto", F.sum("size").over(order) + start).where(F.col("upto") <= room)
    last = fits.agg(F.max("x").alias("x")).first().x
    for e, v in enumerate(finish):
        here = F.floor(v * TICKS / LAST)
        keep = here < cut_tick.tick
        if last is not None:
            bound = F.struct(F.lit(last.v).alias("v"), F.lit(last.rank).alias("rank"), F.lit(last.epoch).alias("epoch"), F.lit(last.h).cast("long").alias("h"), F.lit(last.id).cast("long").alias("id"))
            keep = keep | ((here == cut_tick.tick) & (entry(e) <= bound))
        taken = taken + F.coalesce(keep.cast("int"), F.lit(0))
    return queued.select("doc_id", "source", "size", "source_size", "target", taken.alias("epochs_taken"))


def mix_table(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and words taken of every document (doc_id, source and text are read)."""
    m = mix(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs_taken")).cast("long").alias("taken"))


def mixed_docs(docs: DataFrame, epochs: int = MAX_EPOCHS) -> DataFrame:
    """The documents of the mix with their own columns, one row for each time a document is taken.

    Documents whose size the mix leaves out are dropped; those taken twice stand
    twice.  Rows equal in doc_id, source and size (NULLs are equal) may differ
    in how often they are taken, where the budget or a target ends among them:
    they are then numbered, and a row with number i is taken as often as there
    are passes that take more than i of them, so the words emitted are those of
    ``mix``.  Fully equal rows share a range of numbers.  An empty table and one
    without words give no rows.
    """
    m = mix(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), epochs=epochs)
    passes = [f"_n{e}" for e in range(1, epochs + 1)]
    took = [F.sum((F.col("epochs_taken") >= e).cast("long")).alias(f"_n{e}") for e in range(1, epochs + 1)]
    key = ["_i", "_s", "_z"]
    times = m.groupBy(F.col("doc_id").alias("_i"), F.col("source").alias("_s"), F.col("size").alias("_z")).agg(F.count(F.lit(1)).alias("_rows"), *took)
    times = materialize(times.where(F.col(passes[0]) > 0), "mix-times")
    base = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_d"), F.col("source").alias("_src"), word_count(F.col("text")).alias("_size"))
    met = F.col("_d").eqNullSafe(F.col("_i")) & F.col("_src").eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_z"))
    split = F.lit(False)
    for n in passes:
        split = split | ((F.col(n) > 0) & (F.col(n) < F.col("_rows")))
    all_alike = sum(((F.col(n) > 0).cast("long") for n in passes), F.lit(0))
    # The decisions grow with the documents, and their file is many times smaller than their rows in memory: not broadcast.
    out = base.join(times.where(~split).hint("merge"), met).select("row", all_alike.alias("_copies"))

    # At most one such key per source and pass, and one at the cut: a short list, though its rows may be many.
    uneven = times.where(split)
    if not uneven.isEmpty():
        rows = base.join(small_side(uneven), met).withColumn("_digest", F.sha2(F.to_json("row"), 256))
        rows = rows.groupBy(*key, *passes, "_digest").agg(F.count(F.lit(1)).alias("_same"), F.first("row").alias("row"))
        rows = materialize(rows.withColumn("_slice", F.pmod(F.xxhash64("_digest"), F.lit(SLICES))), "mix-uneven")
        per_slice = rows.groupBy(*key, "_slice").agg(F.sum("_same").alias("_n"))
        before = per_slice.withColumn("_start", F.sum("_n").over(Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
        before = before.select(*[F.col(c).alias(f"{c}b") for c in (*key, "_slice")], "_start")
        inside = rows.withColumn("_upto", F.sum("_same").over(Window.partitionBy(*key, "_slice").orderBy("_digest").rowsBetween(Window.unboundedPreceding, 0)))
        same = F.lit(True)
        for c in (*key, "_slice"):
            same = same & F.col(c).eqNullSafe(F.col(f"{c}b"))
        first = F.col("_start") + F.col("_upto") - F.col("_same")
        copies = sum((F.greatest(F.least(first + F.col("_same"), F.col(n)) - first, F.lit(0)) for n in passes), F.lit(0))
        out = out.unionByName(inside.join(before, same).select("row", copies.alias("_copies")))
    out = out.where("_copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies").cast("long"))))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         {arith_hash_sql(f"abs(coalesce(doc_id, 0)) % {HASH_MOD}", str(SEED))} AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source),
w AS (SELECT *, CAST([{', '.join(f'{x}.0' for x in WEIGHTS)}][rank % {len(WEIGHTS)} + 1] AS DOUBLE) AS w, CAST(source_size AS DOUBLE) * {MAX_EPOCHS} AS cap FROM s),
l AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
         sum(source_size) OVER () * CAST({BUDGET} AS DOUBLE) AS total FROM w),
f AS (SELECT (SELECT (total - capped) / open_w FROM l WHERE cap > (total - capped) / open_w * w ORDER BY cap / w, rank LIMIT 1) AS level),
t AS (SELECT l.*, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * w) END AS target FROM l, f),
q AS (
  SELECT d.*, t.source_size, t.target, t.rank,
         sum(d.size) OVER (PARTITION BY t.rank ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT q.*, epoch, CAST(upto + epoch * source_size AS DOUBLE) / nullif(target, 0) AS v
  FROM q, (SELECT unnest(range({MAX_EPOCHS})) AS epoch) WHERE size > 0),
c AS (
  SELECT *, sum(size) OVER (ORDER BY v, rank, epoch, h, doc_id, size ROWS UNBOUNDED PRECEDING) AS line
  FROM e WHERE v < {LAST}),
k AS (SELECT doc_id, rank, h, CAST(sum(size) AS BIGINT) AS taken FROM c
      WHERE line <= (SELECT sum(target) FROM t) * (1 + 1e-12) GROUP BY doc_id, rank, h)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(k.taken, 0) AS taken
FROM q LEFT JOIN k ON q.doc_id = k.doc_id AND q.rank = k.rank
"""
