"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most three bits have a common variant: one
side flips one bit and the other at most two.  Three differing bits change the
parity of the bit count, so only fingerprints of odd parity have to flip two,
and of any three bit positions two are both even or both odd, so it is enough
to flip pairs of equal position parity.  An even fingerprint has 65 variants,
an odd one 1 + 64 + 992.

A variant is shuffled by its upper ``ROUTE_BITS`` bits: a fingerprint is sent
once for every upper half among its variants (17 or 73 rows), and the lower
bits are varied where the rows meet.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayspark.llm import components
from assayspark.llm.common import materialize

SHINGLE = 3
MAX_BITS = 3
SEED = 42
ROUTE_BITS = 16
LOW_BITS = 64 - ROUTE_BITS
#: Rows that a task varies at a time; whole routes only.
CHUNK = 20_000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the bits of XXH64 over the word shingles (A-Z lower-cased); 0 without words."""
    w = text.lower().split()
    if not w:
        return 0
    grams = zip(*(w[i:] for i in range(shingle)), strict=False) if len(w) >= shingle else [w]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    h = np.array([digest(join(g), SEED) for g in grams], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, keep: Sequence[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns plus ``fp`` (BIGINT with the bits of the fingerprint); NULL text has no words."""
    src = docs.select(*keep, F.col(text).cast("binary").alias("_bytes"))
    schema = T.StructType([*src.schema.fields[:-1], T.StructField("fp", T.LongType(), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1)
            fp = np.fromiter((fingerprint(x.as_py() or b"", shingle) for x in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp.view(np.int64))], names=[*b.schema.names[:-1], "fp"])

    return src.mapInArrow(work, schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _pairs(lo: int, hi: int) -> list[int]:
    return [1 << a | 1 << b for a, b in combinations(range(lo, hi), 2) if (a - b) % 2 == 0]


#: Lower-bit masks: single bits, and pairs of equal position parity.
_SINGLES = np.array([1 << i for i in range(LOW_BITS)], dtype=np.uint64)
_PAIRS = np.array(_pairs(0, LOW_BITS), dtype=np.uint64)


def routes(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(route, fp): each distinct fingerprint at the upper bits of every variant it has."""
    one = [0, *[1 << i for i in range(ROUTE_BITS)]]
    two = one + (_pairs(0, ROUTE_BITS) if max_bits >= 3 else [])
    lit = lambda masks: F.array(*[F.lit(m) for m in masks])
    odd = F.bit_count("fp") % 2 == 1
    top = F.shiftrightunsigned("fp", LOW_BITS).cast("int")
    return fps.select(F.explode(F.when(odd, lit(two)).otherwise(lit(one))).alias("m"), "fp", top.alias("top")).select(
        F.col("top").bitwiseXOR(F.col("m")).alias("route"), "fp"
    )


def _vary(route: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Variants of rows (route, fp): value, row number, and whether two bits are flipped."""
    flips = (fp >> np.uint64(LOW_BITS)) ^ route
    n = np.bitwise_count(flips)
    base = fp ^ (flips << np.uint64(LOW_BITS))
    odd = np.bitwise_count(fp) % 2 == 1
    idx = np.arange(len(fp))
    parts = [(base, idx, n == 2)]

    def add(rows: np.ndarray, masks: np.ndarray, far: bool) -> None:
        z = (base[rows][:, None] ^ masks[None, :]).ravel()
        parts.append((z, np.repeat(rows, len(masks)), np.full(len(z), far)))

    add(idx[n == 0], _SINGLES, False)
    if max_bits >= 3:
        add(idx[(n == 0) & odd], _PAIRS, True)
        bit = np.bitwise_count(flips - np.uint64(1)) % 2  # position parity of a single flipped bit
        for parity in (0, 1):
            add(idx[(n == 1) & odd & (bit == (parity + LOW_BITS) % 2)], _SINGLES[parity::2], True)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _meet(route: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows that share a variant: the first fingerprint at most one bit away, to all others there.

    Fingerprints at most one bit away from a variant differ in at most two bits
    and one at two bits differs from them in at most three, so these links
    connect exactly what the variant connects; two fingerprints both two bits
    away meet at another variant if they are close.
    """
    z, row, far = _vary(route, fp, max_bits)
    order = np.lexsort((far, z))
    z, row, far = z[order], row[order], far[order]
    first = np.ones(len(z), dtype=bool)
    first[1:] = z[1:] != z[:-1]
    head = np.flatnonzero(first)[np.cumsum(first) - 1]
    use = ~first & ~far[head]
    a, b = fp[row[head[use]]], fp[row[use]]
    near = (a != b) & (np.bitwise_count(a ^ b) <= max_bits)
    u, v = np.minimum(a[near], b[near]), np.maximum(a[near], b[near])
    pairs = np.unique(np.stack([u, v], axis=1), axis=0) if len(u) else np.zeros((0, 2), dtype=np.uint64)
    return pairs[:, 0], pairs[:, 1]


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` that keep every component at ``max_bits`` (2 or 3) connected."""
    if max_bits not in (2, 3):
        raise ValueError("max_bits must be 2 or 3")
    met = routes(fps, max_bits).repartition("route").sortWithinPartitions("route")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_r, held_f = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        for b in batches:
            held_r = np.concatenate([held_r, b.column(0).to_numpy().astype(np.uint64)])
            held_f = np.concatenate([held_f, b.column(1).to_numpy().view(np.uint64)])
            if len(held_r) < CHUNK:
                continue
            cut = int(np.searchsorted(held_r, held_r[-1]))  # the last route may go on
            if cut:
                u, v = _meet(held_r[:cut], held_f[:cut], max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])
                held_r, held_f = held_r[cut:], held_f[cut:]
        if len(held_r):
            u, v = _meet(held_r, held_f, max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return met.mapInArrow(work, "u long, v long").distinct()


def fingerprint_roots(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``prints``; equal roots mean one component."""
    fps = materialize(prints.select("fp").distinct(), "simhash-fps")
    r = components.roots(links(fps, max_bits))
    j = fps.join(r, F.col("fp") == F.col("node"), "left")
    return j.select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_table(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document, one row per input row.

    component_id is the smallest doc_id of the component (NULL if it has only
    NULL ids).  Empty and NULL texts share fingerprint zero.  Repeated rows stay
    repeated.  Only doc_id and text are read.
    """
    prints = materialize(with_fingerprint(docs, ["doc_id"], "text", shingle), "simhash-prints")
    tops = materialize(fingerprint_roots(prints, max_bits), "simhash-roots")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("d")).join(tops, "fp")
    ids = least.groupBy("root").agg(F.min("d").alias("component_id"))
    by_fp = tops.join(ids, "root").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(by_fp, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of every component, with its own columns: the smallest doc_id (NULL ids last; then by text digest).

    Rows are addressed by a digest of id and text, so NULL ids and repeated
    rows need no rule of their own: repeated rows are one document.
    """
    rid = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(" "), F.coalesce("text", F.lit(""))))
    whole = docs.select(F.struct("*").alias("row"), rid.alias("rid"))
    prints = materialize(with_fingerprint(docs.select("doc_id", "text", rid.alias("rid")), ["doc_id", "rid"], "text", shingle), "simhash-prints")
    tops = fingerprint_roots(prints, max_bits)
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("rid")))
    best = prints.groupBy("fp").agg(pick.alias("p")).join(tops, "fp").groupBy("root").agg(F.min("p").alias("p"))
    winners = materialize(best.select(F.col("p.rid").alias("_rid")), "simhash-kept")
    kept = whole.join(winners, F.col("rid") == F.col("_rid")).dropDuplicates(["rid"])
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
