"""Filter interaction audit: what each filter removes in every order of a filter chain.

The documents are reduced to mask cells, (part, set of failed filters) -> counts,
in one pass.  A recursive query then extends filter prefixes by the unused
letters; it carries the applied bits and the cells, and each level emits the
metrics of its step.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import materialize

# Fixed values of the contract: white space between words, and the limits of the five filters.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER, SIGNS = 200, 50, 3, "[#$%&*|]"
#: Letters of the filters on the text alone, and of the filter on earlier equal texts.
COPY = "E"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a text without NULL."""
    inner = F.btrim(text, F.lit(SPACE))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))
    n = F.size(words)
    upper = F.char_length(text) - F.char_length(F.translate(text, UPPER, ""))
    return {
        "A": n < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * n,
        "C": 100 * upper > MAX_UPPER * F.char_length(text),
        "D": text.rlike(SIGNS),
    }


def failures(docs: DataFrame, labels: DataFrame, part: str = "lang", filters: Mapping[str, Column] | None = None) -> DataFrame:
    """(part, mask, good, toxic, n): documents by part, failed filters (bit i: i-th letter) and labels.

    ``filters`` are failure conditions over the columns of ``docs`` with
    ``text`` free of NULL (default: A to D); the copy filter follows them.  A
    document fails it when a smaller doc_id has an equal text.  A row without
    doc_id is neither smaller nor larger than any.  The lookup of the smallest
    id joins on (text hash, id), so copies of one text spread over all tasks.
    """
    filters = text_filters(F.col("text")) if filters is None else filters
    whole = docs.withColumn("text", F.coalesce("text", F.lit("")))
    bits = sum((F.coalesce(c, F.lit(False)).cast("int") * (1 << i) for i, c in enumerate(filters.values())), F.lit(0))
    d = whole.select(
        F.col("doc_id").alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        bits.alias("mask"),
        F.xxhash64("text").alias("h1"),
        F.xxhash64(F.lit(7), "text").alias("h2"),
    )
    d = materialize(d, "filter-bits")
    first = d.groupBy("h1", "h2").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    joined = d.join(first, ["h1", "h2", "id"], "left").join(marks, "id", "left")
    copy = (F.col("id").isNotNull() & F.col("first").isNull()).cast("int") * (1 << len(filters))
    cells = joined.select("part", (F.col("mask") + copy).alias("mask"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    return cells.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic")
    )


def walk_sql(cells: str, letters: str) -> str:
    """Recursive query over the view ``cells`` (part, cells: one array per part): one row per part and filter prefix.

    LIMIT ALL lifts Spark's limit on the rows of a recursion: their number is 325 a part for five letters.
    """
    names = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << i})" for i, x in enumerate(letters))

    def total(condition: str, value: str = "n") -> str:
        return f"aggregate(c.cells, 0L, (s, x) -> s + IF({condition}, x.{value}, 0L))"

    removed = "(x.mask & w.applied) = 0 AND (x.mask & w.bit) <> 0"
    return f"""
    WITH RECURSIVE walk(part, prefix, applied, step, letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
      SELECT part, '', 0, 0, '', 0L, 0L, 0L, 0L, 0L, 0L FROM {cells}
      UNION ALL
      SELECT w.part, concat(w.prefix, w.letter), w.applied | w.bit, w.step + 1, w.letter,
             {total("(x.mask & (w.applied | w.bit)) = 0")},
             {total(removed)},
             {total("(x.mask & w.applied) <> 0 AND (x.mask & w.bit) <> 0")},
             {total("x.mask = w.bit")},
             {total(removed, "good")},
             {total(removed, "toxic")}
      FROM (
        SELECT p.part, p.prefix, p.applied, p.step, u.letter, u.bit
        FROM (SELECT part, prefix, applied, step, explode(filter(array({names}), l -> (applied & l.bit) = 0)) AS u FROM walk) p
      ) w JOIN {cells} c ON w.part = c.part
    )
    SELECT * FROM (SELECT * FROM walk LIMIT ALL) WHERE step > 0
    """


def interactions(cells: DataFrame, letters: str) -> DataFrame:
    """Metrics of every part, filter order and step from mask cells (part, mask, n, good, toxic).

    Cells of one part are at most 2^letters, so a part is one small row and the
    recursion makes sum(letters!/(letters-k)!) rows a part (325 for five).  A
    prefix is computed once and joined to the orders that begin with it.  No
    cells give no rows.
    """
    spark = cells.sparkSession
    n = len(letters)
    packed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    packed = materialize(packed, "mask-cells")
    view = f"mask_cells_{uuid.uuid4().hex}"
    packed.createOrReplaceTempView(view)
    walk = materialize(spark.sql(walk_sql(view, letters)), "filter-walk")
    spark.catalog.dropTempView(view)
    # Every order's removed counts of a filter: a prefix of k letters begins (n - k)! orders.
    orders_of = F.element_at(F.array(*[F.lit(math.factorial(n - k)) for k in range(1, n + 1)]), F.col("step")).cast("long")
    shapley = walk.groupBy("part", "letter").agg(F.sum(F.col("removed") * orders_of).alias("shapley"))
    full = walk.where(F.col("step") == n).select("part", F.col("prefix").alias("filter_order"))
    steps = full.select("part", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    steps = steps.withColumn("prefix", F.expr("substring(filter_order, 1, step)"))
    out = steps.join(walk.drop("step", "applied"), ["part", "prefix"]).join(shapley, ["part", "letter"])
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_table(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Metrics of the five filters per part, order and step.

    NULL text is empty, NULL part the empty string.  Repeated rows of one
    doc_id count each and are no copies of each other.  A document is good
    (toxic) when any of its label rows says so; labels without a document and
    columns that are not named here change nothing.  An empty table gives no
    rows.
    """
    d = docs.select("doc_id", "text", part)
    return interactions(failures(d, labels.select("doc_id", "quality", "toxic"), part), "ABCD" + COPY)


AUDIT_SQL = r"""
WITH RECURSIVE lab AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), d AS (
  SELECT doc_id, coalesce(lang, '') AS part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)
), first AS (
  SELECT t, min(doc_id) AS first_id FROM d GROUP BY t
), marked AS (
  SELECT d.part, coalesce(lab.good, 0) AS good, coalesce(lab.toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 3 * length(d.t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN d.doc_id > first.first_id THEN 16 ELSE 0 END AS mask
  FROM d JOIN first ON d.t = first.t LEFT JOIN lab ON d.doc_id = lab.doc_id
), cells AS (
  SELECT part, mask, count(*) AS n, sum(good)::BIGINT AS good, sum(toxic)::BIGINT AS toxic FROM marked GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), orders(filter_order, applied) AS (
  SELECT '', 0
  UNION ALL
  SELECT filter_order || letter, applied | bit FROM orders, letters WHERE applied & bit = 0
), steps AS (
  SELECT filter_order, step, l.letter, l.bit,
    (SELECT coalesce(sum(b.bit), 0)::INTEGER FROM letters b WHERE contains(filter_order[1:step - 1], b.letter)) AS before
  FROM (SELECT filter_order FROM orders WHERE length(filter_order) = 5), range(1, 6) r(step), letters l
  WHERE l.letter = filter_order[step]
), got AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (WHERE mask & (before | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE mask & before <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM got
"""
