"""Secret scan with column functions only: three pattern kinds and high-entropy strings.

Positions come from marking: ``regexp_replace`` puts one control character
before and one after each match, and splitting at the first gives pieces whose
lengths add up to the code-point offsets.  Control characters that the text
itself contains are first replaced one for one by U+FFFD, which no pattern
accepts, so offsets stay those of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "\x01", "\x02"
# Fixed values of the contract.  A run of the class is maximal for access and hex, so the length limit
# can stand in the pattern; for assign a match that is too short still uses up its text.
ASSIGN = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]{16,})"
HEX = r"([0-9a-f]{24,})"
ASSIGN_MIN = 6
KINDS = ("assign", "access", "hex")

#: A candidate is a run of these characters; no alternative, so a run is maximal.
CANDIDATE = r"([A-Za-z0-9+/_=-]{20,})"
#: The characters of a candidate; the window's counts are kept in this order.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Bits per character that a window of ``WINDOW`` characters must reach, by the class of the candidate.
WINDOW = 20
ENTROPY = {"hex": 3.0, "alnum": 3.6, "base64": 3.7}
#: Letters without a digit are a key only if each case has this share of them; words in camel case have few capitals.
CASE_SHARE = 0.25
#: Allow-list: shapes of high entropy that are no secrets (UUIDs, dates with a time or words after them, paths, words
#: joined by signs, numbers).  Repeated groups are possessive: each begins with a sign that no group ends in, so
#: nothing is lost by not stepping back, and strings of any length are matched in a loop.
ALLOW = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:T?[0-9]{2,6}Z?)?(?:[-_/+=][A-Za-z]{0,15}[0-9]{0,6})*+$",
    r"^(?:/|[A-Za-z]+/)[A-Za-z_-]+(?:/[A-Za-z0-9_-]{1,15})*+/?$",
    r"^[A-Za-z]{1,15}(?:[-_/+=][A-Za-z]{1,15})*+(?:[-_/+=]?[0-9]{1,4})?$",
    r"^[-_=+/0-9]+$",
)

SPAN = "struct<start:int,rank:int,kind:string,end:int>"


def _clean(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), OPEN + CLOSE, "\uFFFD\uFFFD")


def _spans(text: Column, pattern: str, kind: str, rank: int) -> Column:
    """Spans of the matches: pieces begin after OPEN, and a piece's match ends at CLOSE."""
    pieces = F.split(F.regexp_replace(text, pattern, OPEN + "$0" + CLOSE), OPEN)
    first = F.struct(F.char_length(F.element_at(pieces, 1)).alias("pos"), _none().alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        length = F.instr(piece, CLOSE) - 1
        span = F.struct(
            acc["pos"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), (acc["pos"] + length).alias("end")
        )
        out = F.concat(acc["out"], F.array(span))
        if kind == "assign":
            value = F.regexp_extract(F.substring(piece, F.lit(1), length), ASSIGN, 2)
            out = F.when(F.char_length(value) >= ASSIGN_MIN, out).otherwise(acc["out"])
        return F.struct((acc["pos"] + F.char_length(piece) - 1).alias("pos"), out.alias("out"))

    rest = F.slice(pieces, 2, F.size(pieces))
    found = F.aggregate(rest, first, step, lambda acc: acc["out"])
    # Most texts have no match: they are searched once and not copied.
    return F.when(text.rlike(pattern), found).otherwise(_none())


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def _candidates(text: Column) -> Column:
    """Candidate strings with their start, their characters and the entropy that a window must reach."""
    pieces = F.split(F.regexp_replace(text, CANDIDATE, OPEN + "$0" + CLOSE), OPEN)
    first = F.struct(F.char_length(F.element_at(pieces, 1)).alias("pos"), F.array().cast("array<struct<start:int,s:string>>").alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        found = F.struct(acc["pos"].alias("start"), F.substring_index(piece, CLOSE, 1).alias("s"))
        return F.struct((acc["pos"] + F.char_length(piece) - 1).alias("pos"), F.concat(acc["out"], F.array(found)).alias("out"))

    all_found = F.aggregate(F.slice(pieces, 2, F.size(pieces)), first, step, lambda acc: acc["out"])

    def wanted(c: Column) -> Column:
        shape = F.lit(False)
        for pattern in ALLOW:
            shape = shape | c["s"].rlike(pattern)
        capitals = F.char_length(F.regexp_replace(c["s"], "[^A-Z]", ""))
        smalls = F.char_length(F.regexp_replace(c["s"], "[^a-z]", ""))
        mixed = F.least(capitals, smalls) >= CASE_SHARE * (capitals + smalls)
        return c["s"].rlike("[A-Za-z]") & (c["s"].rlike("[0-9]") | mixed) & ~shape

    def prepared(c: Column) -> Column:
        limit = (
            F.when(c["s"].rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit(ENTROPY["hex"]))
            .when(c["s"].rlike("[+/=]"), F.lit(ENTROPY["base64"]))
            .otherwise(F.lit(ENTROPY["alnum"]))
        )
        return F.struct(c["start"].alias("start"), F.split(c["s"], "").alias("chars"), limit.alias("limit"))

    none = F.array().cast("array<struct<start:int,chars:array<string>,limit:double>>")
    return F.when(text.rlike(CANDIDATE), F.transform(F.filter(all_found, wanted), prepared)).otherwise(none)


def _entropy_span(c: Column) -> Column:
    """The candidate cut to its windows of high entropy (NULL if it has none).

    The counts of the window's characters are held as one string, a character
    per member of ``ALPHABET``, and change in two places as the window moves.
    S = sum of c * log2(c) over the counts changes by f(c - 1) - f(c) for the
    character that leaves and f(c + 1) - f(c) for the one that enters; the
    entropy is log2(W) - S / W.
    """
    chars = c["chars"]
    f = lambda n: F.when(n <= 1, F.lit(0.0)).otherwise(n * F.log2(n.cast("double")))
    high = lambda x: (F.log2(F.lit(float(WINDOW))) - x / WINDOW) >= c["limit"]
    none = ord("A")
    zero = F.struct(
        F.lit(0.0).alias("s"), F.lit(chr(none) * len(ALPHABET)).alias("n"),
        F.lit(None).cast("int").alias("lo"), F.lit(None).cast("int").alias("hi"),
    )

    def let(value: Column, body) -> Column:
        """``body`` of a value that is computed once."""
        return F.element_at(F.transform(F.array(value), body), 1)

    def moved(state: Column, ch: Column, by: int) -> Column:
        """(s, n) after one more or one less of a character."""
        at = lambda w: F.struct(w.alias("at"), (F.ascii(F.substring(state["n"], w, F.lit(1))) - none).alias("c"))
        change = lambda x: F.struct(
            (state["s"] + f(x["c"] + by) - f(x["c"])).alias("s"),
            F.overlay(state["n"], F.char(x["c"] + (none + by)), x["at"], F.lit(1)).alias("n"),
        )
        return let(let(F.position(ch, F.lit(ALPHABET)), at), change)

    def slide(acc: Column, i: Column) -> Column:
        # Character i - W leaves and character i enters; the window holds i - W + 1 .. i afterwards.
        old = F.element_at(chars, F.greatest(i - WINDOW, F.lit(1)))
        kept = F.struct(acc["s"].alias("s"), acc["n"].alias("n"))
        left = F.when(i > WINDOW, moved(acc, old, -1)).otherwise(kept)
        first = i - WINDOW + 1

        def state(now: Column) -> Column:
            hit = (i >= WINDOW) & high(now["s"])
            return F.struct(
                now["s"].alias("s"),
                now["n"].alias("n"),
                F.coalesce(acc["lo"], F.when(hit, first)).alias("lo"),
                F.when(hit, first).otherwise(acc["hi"]).alias("hi"),
            )

        return let(let(left, lambda x: moved(x, F.element_at(chars, i), 1)), state)

    end = lambda acc: F.when(
        acc["lo"].isNotNull(),
        F.struct(
            (c["start"] + acc["lo"] - 1).alias("start"),
            F.lit(len(KINDS)).alias("rank"),
            F.lit("entropy").alias("kind"),
            (c["start"] + acc["hi"] + WINDOW - 1).alias("end"),
        ),
    )
    return F.aggregate(F.sequence(F.lit(1), F.size(chars)), zero, slide, end)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every input row with ``base`` and ``spans`` added: arrays of (start, rank, kind, end).

    Offsets count code points, ends are exclusive.  ``base`` has the three
    pattern kinds, ordered by start and then kind; ``spans`` has these and the
    entropy spans that no base span contains.  NULL text has no spans, equal
    texts have equal spans.  Input columns named base or spans are replaced.
    The work on one text is linear in its length and quadratic in its matches.
    """
    t = F.col("_t")
    d = docs.select(F.struct("*").alias("_row"), _clean(F.col(text)).alias("_t"))
    d = d.select(
        "_row",
        "_t",
        F.concat(_spans(t, ASSIGN, "assign", 0), _spans(t, ACCESS, "access", 1), _spans(t, HEX, "hex", 2)).alias("_b"),
        _candidates(t).alias("_c"),
    )
    d = d.select("_row", F.array_sort("_b").alias("_b"), F.transform("_c", _entropy_span).alias("_e"))
    inside = lambda e: F.exists("_b", lambda b: (b["start"] <= e["start"]) & (e["end"] <= b["end"]))
    extra = F.filter("_e", lambda e: e.isNotNull() & ~inside(e))
    keep = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c.lower() not in ("base", "spans")]
    return d.select(*keep, F.col("_b").alias("base"), F.array_sort(F.concat("_b", extra)).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_table(docs: DataFrame) -> DataFrame:
    """Counts per kind, digest of the base spans and the list of all spans of every document (doc_id and text are read)."""
    d = scan(docs.select("doc_id", "text"))
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return d.select("doc_id", *[n(k) for k in KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
