"""Quality rules whose thresholds come from mergeable quantile sketches per language and source.

The sketch of a metric is a table of counts over logarithmic buckets (the
DDSketch layout): merging two sketches adds their counts, every quantile is
within ``ACCURACY`` of the exact one, and nothing in it is random.  A limit
uses only the half of a group that lies on the other side of its median, so it
rejects outliers, not a fixed share, and junk in up to half of a group does not
move it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from assayspark.llm.common import materialize, others, small_side

# Fixed values of the contract: symbols that count, window length and the two base limits.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_same_words"]
ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
TINY = 1e-4
_CONTINUATION = bytes(range(0x80, 0xC0))
_MIX = 0x9E3779B97F4A7C15


def _repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside ``window``-word windows that occur at least twice in the text (first occurrence included)."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    roll = np.zeros(n, dtype=np.uint64)
    for i in range(window):
        roll = roll * np.uint64(_MIX) + h[i : i + n]
    order = np.argsort(roll, kind="stable")
    same = roll[order[1:]] == roll[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def text_counts(text: bytes) -> tuple[int, ...]:
    """The counts of ``COUNTS`` over one whole UTF-8 text; n_same_words are words equal to the word before."""
    words = text.split()  # splits at exactly the white space of the contract
    chars = len(b"".join(words).translate(None, _CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    same = sum(map(bytes.__eq__, words, words[1:]))
    return len(words), chars, symbols, len(lines) - len(set(lines)), _repeat_words(words), len(lines), same


def with_counts(docs: DataFrame, keep: Sequence[str], text: str = "text", name: str = "counts") -> DataFrame:
    """``keep`` columns plus a struct ``name`` of the text counts (NULL text counts as empty)."""
    rest = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("binary").alias("_bytes"))
    schema = T.StructType(
        [f for f in rest.schema.fields if f.name != "_bytes"]
        + [T.StructField(name, T.StructType([T.StructField(c, T.LongType(), False) for c in COUNTS]), False)]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = b.schema.get_field_index("_bytes")
            rows = np.array([text_counts(x.as_py() or b"") for x in b.column(k)], dtype=np.int64).reshape(-1, len(COUNTS))
            made = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(COUNTS))], names=COUNTS)
            cols = [b.column(i) for i in range(b.num_columns) if i != k]
            names = [b.schema.names[i] for i in range(b.num_columns) if i != k]
            yield pa.RecordBatch.from_arrays([*cols, made], names=[*names, name])

    return rest.mapInArrow(count, schema)


def base_failed(counts: str = "counts") -> Column:
    c = lambda x: F.col(f"{counts}.{x}")
    return (c("n_words") < MIN_WORDS) | (c("n_repeat_words") * 100 > c("n_words") * MAX_REPEAT_PERCENT)


def metrics(counts: str = "counts") -> dict[str, Column]:
    """The rates that get adaptive limits; each is NULL where its base is 0."""
    c = lambda x: F.col(f"{counts}.{x}").cast("double")
    words, lines = F.nullif(c("n_words"), F.lit(0.0)), F.nullif(c("n_lines"), F.lit(0.0))
    return {
        "mean_word": c("word_chars") / words,
        "symbols": c("n_symbols") / words,
        "dup_lines": c("n_dup_lines") / lines,
        "repeats": c("n_repeat_words") / words,
        "same_words": c("n_same_words") / words,
    }


def sketch(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches as rows (keys, metric, bucket, n): one per occupied bucket, pre-aggregated in each task."""
    items = [F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in metrics().items()]
    long = counted.select(*keys, F.explode(F.array(*items)).alias("m")).where("m.value is not null")
    v = F.col("m.value")
    bucket = F.when(v <= TINY, F.lit(0)).otherwise(F.ceil(F.log(v / TINY) / math.log(GAMMA)).cast("int"))
    return long.groupBy(*keys, F.col("m.metric").alias("metric"), bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketches: DataFrame, keys: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """Quantiles ``probs`` (name -> probability) and the count ``total`` of every (keys, metric) sketch."""
    w = Window.partitionBy(*keys, "metric")
    run = sketches.withColumn("upto", F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
    run = run.withColumn("total", F.sum("n").over(w))
    value = F.when(F.col("bucket") == 0, F.lit(0.0)).otherwise(F.lit(TINY) * F.pow(F.lit(GAMMA), F.col("bucket")))
    at = [F.min(F.when(F.col("upto") >= F.col("total") * p, value)).alias(q) for q, p in probs.items()]
    return run.groupBy(*keys, "metric").agg(F.max("total").alias("total"), *at)


#: Beyond the spread of the group, a rate may exceed its median by so much; keeps short clean texts.
SLACK = {"mean_word": 2.0, "symbols": 0.25, "dup_lines": 0.4, "repeats": 0.1, "same_words": 0.2}
#: Rates of repetition, junk in any source: the strictest of the limits of source, language and corpus, and never above this.
CAPS = {"dup_lines": 0.8, "repeats": 0.25, "same_words": 0.6}
#: A text may repeat so many words besides its share: one window that occurs twice, which is much of a short text.
SPARE_REPEATS = 2 * WINDOW
#: A group counts as much as the level above it from so many documents on; a corpus of SMALL documents has twice the slack.
PRIOR, SMALL = 50.0, 20.0


def fences(sketches: DataFrame, lang: str, source: str, prior: float, spread: float, slack: dict[str, float]) -> DataFrame:
    """One row per (lang, source): a limit ``hi_<metric>`` for each metric and ``lo_mean_word``.

    Quantiles of a group of n documents have the weight n / (n + ``prior``); the
    rest comes from its language, and there in the same way from the corpus.
    limit = q50 + 2 * ``spread`` * (q50 - q25) + slack, for a metric of ``CAPS``
    the least over the three levels and the cap.
    """
    probs = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    merged_lang = sketches.groupBy(lang, "metric", "bucket").agg(F.sum("n").alias("n"))
    merged_all = sketches.groupBy("metric", "bucket").agg(F.sum("n").alias("n"))
    ren = lambda q, p: q.select(*[c for c in q.columns if c not in ("total", *probs)], *[F.col(c).alias(p + c) for c in ("total", *probs)])
    own, by_lang, by_all = quantiles(sketches, [lang, source], probs), ren(quantiles(merged_lang, [lang], probs), "l_"), ren(quantiles(merged_all, [], probs), "a_")
    by_lang = by_lang.withColumnRenamed(lang, "_l").withColumnRenamed("metric", "_m")
    q = own.join(by_lang, F.col(lang).eqNullSafe(F.col("_l")) & (F.col("metric") == F.col("_m"))).join(by_all, "metric")

    def blend(p: str, above: dict[str, Column]) -> dict[str, Column]:
        w = F.col(p + "total") / (F.col(p + "total") + prior)
        return {c: w * F.col(p + c) + (1 - w) * v for c, v in above.items()}

    at_all = {c: F.col("a_" + c) for c in probs}
    at_lang = blend("l_", at_all)
    at_own = blend("", at_lang)
    by_metric = lambda d: F.element_at(F.create_map(*[x for m, v in d.items() for x in (F.lit(m), F.lit(v))]), F.col("metric"))
    extra = by_metric(slack) * (1 + SMALL / F.col("a_total"))
    hi = lambda v: v["q50"] + (v["q50"] - v["q25"]) * (2 * spread) + extra
    strict = F.least(hi(at_own), hi(at_lang), hi(at_all), by_metric({m: CAPS.get(m, math.inf) for m in slack}))
    lo = at_own["q50"] - (at_own["q75"] - at_own["q50"]) * (2 * spread) - extra
    q = q.select(lang, source, "metric", F.when(F.col("metric").isin(*CAPS), strict).otherwise(hi(at_own)).alias("hi"), lo.alias("lo"))
    pick = lambda m, c: F.max(F.when(F.col("metric") == m, F.col(c)))
    return q.groupBy(lang, source).agg(*[pick(m, "hi").alias(f"hi_{m}") for m in slack], pick("mean_word", "lo").alias("lo_mean_word"))


def judge(
    counted: DataFrame, lang: str = "lang", source: str = "source", prior: float = PRIOR, spread: float = 6.0, sketches: DataFrame | None = None
) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to rows that carry a ``counts`` struct.

    The limits come from the sketches of all rows (``sketches``, if given, is
    such a table made earlier).  The limit table is broadcast only after its
    rows have been counted.  NULL language or source is a group of its own.
    """
    sk = sketch(counted, [lang, source]) if sketches is None else sketches
    limits = small_side(materialize(fences(sk, lang, source, prior, spread, SLACK), "quality-limits").select(
        F.col(lang).alias("_lang"), F.col(source).alias("_source"), *[f"hi_{m}" for m in SLACK], "lo_mean_word"))
    j = counted.join(limits, F.col(lang).eqNullSafe(F.col("_lang")) & F.col(source).eqNullSafe(F.col("_source")), "left")
    rates = metrics()
    spare = {"repeats": F.lit(float(SPARE_REPEATS)) / F.nullif(F.col("counts.n_words").cast("double"), F.lit(0.0))}
    odd = [F.coalesce(v > F.col(f"hi_{m}") + spare.get(m, F.lit(0.0)), F.lit(False)) for m, v in rates.items()]
    odd.append(F.coalesce(rates["mean_word"] < F.col("lo_mean_word"), F.lit(False)))
    any_odd = odd[0]
    for o in odd[1:]:
        any_odd = any_odd | o
    return j.select(
        *[F.col(f"`{c}`") for c in counted.columns], base_failed().alias("base_failed"), (~base_failed() & ~any_odd).alias("kept")
    )


def quality_table(docs: DataFrame) -> DataFrame:
    """Counts, base rule and verdict of every document (one output row per input row).

    NULL text counts as empty (no words: fails the base rule).  Repeated rows
    are judged alike.  Only doc_id, text, lang and source are read, so other
    columns cannot clash.  The narrow counts are written once and reread for
    the sketches and the verdict.
    """
    counted = materialize(with_counts(docs, ["doc_id", "lang", "source"]), "quality-counts")
    j = judge(counted)
    c = [F.col(f"counts.{x}").alias(x) for x in COUNTS]
    return j.select("doc_id", *c, "base_failed", "kept")


def keep_quality(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns.

    The counts are computed twice (for the sketches and for the verdict) so that
    no text is shuffled or written in between.
    """
    sk = materialize(sketch(with_counts(docs, ["lang", "source"]), ["lang", "source"]), "quality-sketch")
    whole = docs.select(F.struct("*").alias("row"), F.col("text"), F.col("lang"), F.col("source"))
    j = judge(with_counts(whole, ["row", "lang", "source"]), sketches=sk)
    return j.where("kept").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
