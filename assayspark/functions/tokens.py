"""Molecule-string tokens (P13, F09-F11, F16-F20, W05) as array expressions.

Everything here is a built-in column expression (``transform``,
``aggregate``, ``array_position``...), so it runs inside whole-stage codegen
with no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 28-symbol token alphabet in id order ('$' = 0 = EOS/pad, '^' = 1 = SOS).
ALPHABET = "$^C(=O)[-]N+1P234S#567HIBF89"
EOS, SOS = 0, 1
# Characters a string may contain (everything but the two control symbols).
STRING_CHARS = ALPHABET[2:]
# Characters that may not open a string (bonds and branches) and ring-closure digits.
NO_LEADING = "()=#-"
RING_DIGITS = "123456789"


def valid_for_encoding(s: Column, max_len: int = 150) -> Column:
    """0 < length < max_len (room for EOS) and every character in the token alphabet.

    Membership is tested by deleting alphabet characters: nothing may remain.
    """
    leftover = F.translate(s, STRING_CHARS, "")
    return (F.length(s) > 0) & (F.length(s) < max_len) & (F.length(leftover) == 0)


def encode(s: Column, max_len: int = 150) -> Column:
    """characters -> ids, then EOS, zero-padded to max_len (ARRAY<INT>)."""
    ids = F.transform(F.split(s, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    pad = F.array_repeat(F.lit(EOS), F.greatest(F.lit(max_len) - F.size(ids) - 1, F.lit(0)))
    return F.concat(ids, F.array(F.lit(EOS)), pad)


def decode(tokens: Column) -> Column:
    """ids up to (not including) the first EOS -> string."""
    pos = F.array_position(tokens, EOS)
    keep = F.when(pos == 0, F.size(tokens)).otherwise(pos - 1)
    head = F.slice(tokens, 1, keep)
    return F.array_join(F.transform(head, lambda t: F.substring(F.lit(ALPHABET), t + 1, 1)), "")


def decode_guarded(tokens: Column) -> Column:
    """any SOS id anywhere (also after EOS) -> 'x', else the decoded string."""
    return F.when(F.array_contains(tokens, SOS), F.lit("x")).otherwise(decode(tokens))


def mask_to_first_eos(tokens: Column) -> Column:
    """1 for positions up to and including the first EOS, 0 after (ARRAY<INT>)."""
    pos = F.array_position(tokens, EOS)
    last = F.when(pos == 0, F.size(tokens)).otherwise(pos)
    return F.transform(tokens, lambda t, i: F.when(i < last, F.lit(1)).otherwise(F.lit(0)))


def _outside_brackets(s: Column) -> Column:
    return F.regexp_replace(s, r"\[[^\[\]]*\]", "")


def well_formed(s: Column) -> Column:
    """F17 (structural): the checks a string must pass before it can be a molecule.

    Non-empty; does not start with a bond or branch; brackets pair without
    nesting; parentheses never close below depth 0 and end balanced; every
    ring-closure digit outside brackets occurs an even number of times.
    Chemistry (valence, aromaticity) is not checked.
    """
    outside = _outside_brackets(s)
    no_brackets_left = F.length(F.translate(outside, "[]", "")) == F.length(outside)
    depth_trace = F.aggregate(
        F.split(outside, ""),
        F.struct(F.lit(0).alias("d"), F.lit(0).alias("lo")),
        lambda acc, c: F.struct(
            (acc["d"] + F.when(c == "(", 1).when(c == ")", -1).otherwise(0)).alias("d"),
            F.least(acc["lo"], acc["d"] + F.when(c == "(", 1).when(c == ")", -1).otherwise(0)).alias("lo"),
        ),
    )
    parens_ok = (depth_trace["d"] == 0) & (depth_trace["lo"] >= 0)
    rings_even = F.lit(True)
    for dgt in RING_DIGITS:
        n = F.length(outside) - F.length(F.replace(outside, F.lit(dgt), F.lit("")))
        rings_even = rings_even & (n % 2 == 0)
    first_ok = ~F.substring(s, 1, 1).isin(list(NO_LEADING))
    return (F.length(s) > 0) & first_ok & no_brackets_left & parens_ok & rings_even


def ring_count(s: Column) -> Column:
    """ring-closure digit pairs outside brackets."""
    outside = _outside_brackets(s)
    digits = F.length(outside) - F.length(F.translate(outside, RING_DIGITS, ""))
    return (digits / 2).cast("int")


def logsumexp(x: Column) -> Column:
    m = F.array_max(x)
    return m + F.log(F.aggregate(x, F.lit(0.0), lambda a, v: a + F.exp(v - m)))


def cross_entropy(logits: Column, target: Column) -> Column:
    """F16: -log softmax(logits)[target] (target 0-based)."""
    return logsumexp(logits) - F.element_at(logits, target + 1)


def softmax(x: Column) -> Column:
    """softmax of an array."""
    m = F.array_max(x)
    z = F.aggregate(x, F.lit(0.0), lambda a, v: a + F.exp(v - m))
    return F.transform(x, lambda v: F.exp(v - m) / z)


def argmax(x: Column) -> Column:
    """0-based index of the first maximum."""
    return F.array_position(x, F.array_max(x)) - 1


def kl_standard_normal(mu: Column, logvar: Column) -> Column:
    """KL(N(mu, exp(logvar)) || N(0, 1)) summed over dimensions."""
    terms = F.zip_with(mu, logvar, lambda m, lv: 1 + lv - m * m - F.exp(lv))
    return F.lit(-0.5) * F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)


HASH_MOD = 2147483648  # 2^31: keeps every intermediate product below 2^63
HASH_MUL = 2654435761


def arith_hash(*parts: Column) -> Column:
    """Arithmetic hash in [0, 2^31) that SQL engines can reproduce exactly (non-negative parts)."""
    h = F.lit(0).cast("long")
    for p in parts:
        h = F.pmod(F.pmod(h * 31 + p.cast("long"), F.lit(HASH_MOD)) * HASH_MUL, F.lit(HASH_MOD))
    return h


def arith_hash_sql(*parts: str) -> str:
    """The same hash as SQL text (DuckDB / Spark SQL)."""
    h = "CAST(0 AS BIGINT)"
    for p in parts:
        h = f"((({h}) * 31 + CAST({p} AS BIGINT)) % {HASH_MOD}) * {HASH_MUL} % {HASH_MOD}"
    return h


def random_mask(tokens: Column, row_id: Column, epoch: int, p: float, seed: int = 42) -> Column:
    """each token kept with probability 1 - p, else replaced by 0; draw per (id, pos, epoch).

    The draw is ``arith_hash(id, pos, epoch, seed)``.  Every step of that hash is linear modulo 2^31, so it is
    a number of the row, computed once, plus the position times a constant.
    """
    m, mul = HASH_MOD, HASH_MUL % HASH_MOD
    step = 31 * mul % m
    at = step * step * mul % m  # what one position adds
    rest = (epoch * step + seed) * mul % m
    row = F.pmod(F.pmod(row_id.cast("long"), F.lit(m)) * (at * step % m) + rest, F.lit(m))
    draw = lambda h: F.transform(tokens, lambda t, i: F.when(F.pmod(h + i * F.lit(at).cast("long"), F.lit(m)) < p * m, F.lit(0)).otherwise(t))
    return F.element_at(F.transform(F.array(row), draw), 1)
