"""Line dedup: long lines that many documents share stay in one document only; column functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import ascii_lower, materialize, small_side

# Fixed values of the contract: the characters that a key loses at both ends, and the two thresholds.
STRIP = "\x20\x09\x0a\x0b\x0c\x0d"
MIN_CHARS = 40
MIN_DOCS = 5


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    return F.btrim(ascii_lower(line), F.lit(STRIP))


def _two_hashes(*cols: Column) -> list[Column]:
    """128 bits of hash: two chains from different seeds."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(7), *cols)]


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Every line whose key has at least ``min_chars`` code points: (id, r1, r2, pos, h1, h2).

    r1 and r2 identify a row by its id and text, so rows that are equal in
    both, which lose the same lines, count once.
    """
    r1, r2 = _two_hashes(F.col(doc_id), F.col(text))
    lines = docs.select(F.col(doc_id).alias("id"), r1.alias("r1"), r2.alias("r2"), F.posexplode(_lines(F.col(text))).alias("pos", "line"))
    keys = lines.select("id", "r1", "r2", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    h1, h2 = _two_hashes(F.col("key"))
    return keys.select("id", "r1", "r2", "pos", h1.alias("h1"), h2.alias("h2"))


def common_lines(occ: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Keys of at least ``min_docs`` different documents, with the document that keeps its lines: (h1, h2, n_docs, keeper).

    Spark combines (key, document) inside each task before the first shuffle
    and counts before the second, so a line of a third of all documents sends
    one row a task.  NULL ids are one document, smaller than all others.
    """
    null_id = F.max(F.col("id").isNull().cast("int"))
    found = occ.groupBy("h1", "h2").agg((F.count_distinct("id") + null_id).alias("n_docs"), F.max("id").alias("keeper"))
    return found.where(F.col("n_docs") >= min_docs)


def drop_common_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """Every input row with ``n_lines``, ``n_dropped`` and ``kept`` (the text that stays) added.

    A line is dropped when its key (see ``line_key``) has at least
    ``min_chars`` code points, stands in at least ``min_docs`` documents and
    this is not the largest id among them; that document keeps all its lines
    of the key.  NULL and empty text are one empty line.  A document is an id:
    rows of one id count once and are treated alike, NULL ids are one document
    that is smaller than all others.  Repeated rows all come back.  Input
    columns named n_lines, n_dropped or kept are replaced.  An empty table
    gives an empty table.

    Texts are read twice and travel once; what is shuffled of a line is its
    hash and place.  Dropped places are collected per row, so a row's list is
    bounded by its own text.
    """
    new = ("n_lines", "n_dropped", "kept")
    occ = occurrences(docs, doc_id, text, min_chars)
    common = materialize(common_lines(occ, min_docs), "common-lines")
    gone = occ.join(small_side(common), ["h1", "h2"]).where(F.col("id").isNull() | (F.col("id") < F.col("keeper")))
    places = gone.groupBy("r1", "r2").agg(F.collect_set("pos").alias("gone"))
    r1, r2 = _two_hashes(F.col(doc_id), F.col(text))
    rows = docs.select(F.struct("*").alias("row"), r1.alias("r1"), r2.alias("r2"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    met = rows.join(places, ["r1", "r2"], "left").select("row", "t", "gone", _lines(F.col("t")).alias("lines"))
    # array_except on numbers hashes its second side and keeps the order of the first: linear in the lines.
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("t")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    n_dropped = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone"))
    told = met.select("row", F.size("lines").cast("long").alias("a"), n_dropped.cast("long").alias("b"), kept.alias("c"))
    cols = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in new]
    return told.select(*cols, *[F.col(x).alias(name) for x, name in zip("abc", new, strict=True)])


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the text that stays, for every document."""
    d = drop_common_lines(docs.select("doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


LINE_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(list_zip(ls, range(len(ls)))) AS z
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT doc_id, z[2] AS pos, z[1] AS line,
         trim(translate(z[1], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id < c.keeper AS gone
  FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
