"""URL verdicts: a rule list, then association rules mined from labelled URLs with FP-growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import ascii_lower, materialize, others, small_side

#: (verdict, rule) list of the contract, as it is written there.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Item that stands for the label in a transaction; no URL token has this form.
BLOCKED = "label=block"


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for NULL."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://`` or for NULL."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(host: Column, path: Column, rule: str) -> Column:
    cut = rule.index("/")
    name, prefix = rule[:cut], rule[cut:]
    return ((host == name) | host.endswith("." + name)) & path.startswith(prefix)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits (NULL if none does)."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        out = F.when(_fits(host, path, rule), F.lit(rule)).otherwise(out)
    return out


def tokens(host: Column, path: Column) -> Column:
    """Distinct URL tokens: each domain suffix of the host, each path segment (numbers as one token), the file extension."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("host:"), F.array_join(F.slice(labels, i, n), ".")))
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    plain = F.transform(segments, lambda s: F.concat(F.lit("path:"), F.when(s.rlike(r"^[0-9]+(\.\w+)?$"), F.lit("<number>")).otherwise(s)))
    ext = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    suffix = F.when(ext != "", F.array(F.concat(F.lit("ext:"), ext))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.when(host != "", suffixes).otherwise(F.array().cast("array<string>")), plain, suffix))


def mine_rules(labelled: DataFrame, min_support: float, min_confidence: float, min_lift: float = 1.0) -> DataFrame:
    """Association rules ``antecedent -> block`` from rows (items, blocked).

    Spark's FP-growth counts the frequent combinations of tokens and label.
    A rule survives if its support and confidence reach the limits, its lift is
    above ``min_lift`` and no rule over a subset of its tokens is as confident.
    No labelled rows, or none that is blocked, give an empty table.
    """
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], "antecedent array<string>, confidence double, support double")
    basket = F.when(F.col("blocked"), F.concat("items", F.array(F.lit(BLOCKED)))).otherwise(F.col("items"))
    baskets = materialize(labelled.where(F.size("items") > 0).select(basket.alias("items")), "url-baskets")
    if baskets.isEmpty():
        return empty
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where((F.element_at("consequent", 1) == BLOCKED) & (F.col("lift") > min_lift))
    rules = materialize(rules.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support"), "url-rules")
    # A strictly smaller antecedent shares its first token with the larger one's exploded tokens: an equi-join, not all pairs.
    big = rules.select("antecedent", "confidence", F.explode("antecedent").alias("t"))
    small = rules.select(F.col("antecedent").alias("s"), F.col("confidence").alias("sc"), F.element_at("antecedent", 1).alias("t"))
    redundant = (
        big.join(small, "t")
        .where((F.size("s") < F.size("antecedent")) & (F.size(F.array_except("s", "antecedent")) == 0) & (F.col("sc") >= F.col("confidence")))
        .select("antecedent")
        .distinct()
    )
    return rules.join(redundant, "antecedent", "left_anti")


def match_rules(urls: DataFrame, rules: DataFrame, items: str = "items") -> DataFrame:
    """Rows of ``urls`` (key ``url``, ``items``) that some rule covers, with the best ``confidence``.

    Inverted index: each rule is filed under its rarest token, URLs look it up
    by their tokens and the rest of the antecedent is then compared.
    """
    freq = urls.select(F.explode(items).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    tok = rules.select("antecedent", "confidence", F.explode("antecedent").alias("t"))
    filed = (
        tok.join(freq, "t", "left")
        .groupBy("antecedent", "confidence")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("t"))).alias("k"))
        .select("antecedent", "confidence", F.col("k.t").alias("t"))
    )
    filed = small_side(materialize(filed, "url-index"))
    hits = urls.select("url", items, F.explode(items).alias("t")).join(filed, "t")
    hits = hits.where(F.size(F.array_except("antecedent", items)) == 0)
    return hits.groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    min_support: float = 0.01,
    min_confidence: float = 0.9,
    url: str = "url",
) -> DataFrame:
    """Every input row with host, path, rule, verdict and confidence added.

    A fitting rule decides.  The rows that a rule decides are also the labels:
    token combinations that predict ``block`` among them are mined and decide
    the other rows, ``allow`` where none matches.  The verdict is a function of
    the URL, so equal URLs are judged once.  NULL or host-less URLs match no
    rule and are allowed.  Input columns with the names of the result are
    replaced; an empty table gives an empty table.
    """
    new = ["host", "path", "rule", "verdict", "confidence"]
    host, path = host_of(F.col(url)), path_of(F.col(url))
    parsed = pages.select(F.col(url).alias("url")).where("url is not null").select("url", host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdicts = F.create_map(*[x for v, r in rules for x in (F.lit(r), F.lit(v))])
    seen = parsed.select("rule", tokens(F.col("host"), F.col("path")).alias("items"), (verdicts[F.col("rule")] == "block").alias("blocked"))
    mined = mine_rules(seen.where("rule is not null"), min_support, min_confidence)
    open_urls = parsed.where("rule is null").select("url", tokens(F.col("host"), F.col("path")).alias("items")).distinct()
    found = match_rules(open_urls, mined).select(F.col("url").alias("_url"), "confidence")
    base = pages.select(F.struct("*").alias("row"), F.col(url).alias("_u"), host.alias("host"), path.alias("path"))
    base = base.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    j = base.join(found, F.col("_u") == F.col("_url"), "left")
    verdict = F.coalesce(verdicts[F.col("rule")], F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    keep = [F.col(f"row.`{c}`").alias(c) for c in pages.columns if c.lower() not in new]
    return j.select(*keep, "host", "path", "rule", verdict.alias("verdict"), F.when(F.col("rule").isNull(), F.col("confidence")).alias("confidence"))


def url_table(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and confidence of every page; only page_id and url are read."""
    return judge_urls(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "confidence")
