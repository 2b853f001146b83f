"""Texts in blocks of bounded size, and packed arrays that travel between blocks and hash buckets.

A block holds whole documents that a hash of doc_id deals to it, so copies of a
text spread evenly.  What a block has to say about hashes goes to a bucket per
hash range as one row of packed arrays; repeated hashes are merged in the block
first, so a bucket gets at most one entry of a hash from each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20
LAST_ID = np.iinfo(np.int64).max


def blocked(docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(block, doc_id, text as bytes) rows and the number of blocks, about one per ``block_bytes`` of text."""
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    total = docs.agg(F.coalesce(F.sum(F.octet_length(raw)), F.lit(0))).first()[0]
    n = max(8, -(-total // block_bytes))
    d = docs.select(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(n)).cast("int").alias("block"), F.col("doc_id").cast("long").alias("doc_id"), raw.alias("text"))
    return d, n


class Block:
    """The documents of one block in a fixed order (doc_id, NULL last, then text), as one byte array."""

    def __init__(self, table: pa.Table):
        ids = [LAST_ID if i is None else i for i in table.column("doc_id").to_pylist()]
        nulls = [i is None for i in table.column("doc_id").to_pylist()]
        rows = sorted(zip(ids, nulls, table.column("text").to_pylist(), strict=True))
        self.number = table.column("block")[0].as_py() if table.num_rows else None
        self.ids = np.array([r[0] for r in rows], dtype=np.int64)
        self.nulls = [r[1] for r in rows]
        self.texts = [r[2] for r in rows]
        self.sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    def bytes(self) -> np.ndarray:
        return np.frombuffer(b"".join(self.texts), dtype=np.uint8)


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, row numbers) of each bucket that occurs, rows in their order."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), part


def unpack(column: pa.ChunkedArray, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), dtype=dtype) for x in column]


def roll(a: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of ``k`` values of ``a`` (uint64), by doubling a polynomial and mixing the bits."""
    base = 0x5851F42D4C957F2D
    cur, size = (a + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1
    cur ^= cur >> np.uint64(29)
    out, have, left = None, 0, k
    while left:
        if left & 1:
            if out is None:
                out, have = cur, size
            else:
                n = len(a) - (have + size) + 1
                out = out[:n] * np.uint64(pow(base, size, 1 << 64)) + cur[have : have + n]
                have += size
        left >>= 1
        if left:
            n = len(a) - 2 * size + 1
            cur = cur[:n] * np.uint64(pow(base, size, 1 << 64)) + cur[size : size + n]
            size *= 2
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(30))


_LOW = np.uint64((1 << 20) - 1)
SEGMENT = 1 << 19


def leftmost_minima(values: np.ndarray, valid: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing: the leftmost smallest ``k``-run hash inside every valid window of ``window`` values.

    Returns one entry per run of neighbouring windows with the same choice:
    first window start, number of windows, place of the choice, hash.  The choice depends on the
    content of the window alone, so equal windows choose equal places.
    """
    firsts, counts, places, hashes = [], [], [], []
    span = window - k + 1
    for g in range(0, len(values) - window + 1, SEGMENT):
        part = values[g : g + SEGMENT + window - 1].astype(np.uint64)
        h = roll(part, k)
        m = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= span:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        if size < span:
            m = np.minimum(m[: len(m) - (span - size)], m[span - size :])
        s = np.flatnonzero(valid[g : g + len(m)])
        if not len(s):
            continue
        at = (m[s] & _LOW).astype(np.int64)
        new = np.ones(len(s), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (s[1:] != s[:-1] + 1)
        head = np.flatnonzero(new)
        firsts.append(s[head] + g)
        counts.append(np.diff(np.append(head, len(s))))
        places.append(at[head] + g)
        hashes.append(h[at[head]])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(places), np.concatenate(hashes)


_SENT = np.uint64((1 << 48) - 1)
HASHES = "bucket int, block int, hashes binary, weight binary"
FLAGS = "bucket int, block int, shared binary"


def hash_rows(block: int, hashes: np.ndarray, n: int) -> pa.Table:
    """One row per bucket with the distinct hashes of the block, and whether each occurs once or more in it.

    48 bits of a hash travel: two hashes that agree in them are only taken for
    shared, and what follows compares whole strings.
    """
    u, c = np.unique(hashes & _SENT, return_counts=True)
    out = [(b, u[rows].view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), np.packbits(c[rows] > 1).tobytes()) for b, rows in by_bucket(bucket_of(u, n))]
    return pa.table(
        {
            "bucket": pa.array([o[0] for o in out], pa.int32()),
            "block": pa.array([block] * len(out), pa.int32()),
            "hashes": pa.array([o[1] for o in out], pa.binary()),
            "weight": pa.array([o[2] for o in out], pa.binary()),
        }
    )


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(24)) % np.uint64(n)).astype(np.int32)


def flag_shared(table: pa.Table) -> pa.Table:
    """For every row of ``hash_rows`` that met in a bucket: which of its hashes occur twice or more anywhere."""
    parts = []
    for x in unpack(table.column("hashes"), np.uint8):
        h = np.zeros((len(x) // 6, 8), dtype=np.uint8)
        h[:, :6] = x.reshape(-1, 6)
        parts.append(h.view(np.uint64).ravel())
    more = np.concatenate([np.unpackbits(w, count=len(p)) for w, p in zip(unpack(table.column("weight"), np.uint8), parts, strict=True)])
    u, inv = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(inv, weights=more + 1.0, minlength=len(u))
    shared, at, out = (total >= 2)[inv], 0, []
    for p in parts:
        out.append(np.packbits(shared[at : at + len(p)]).tobytes())
        at += len(p)
    return pa.table({"bucket": table.column("bucket"), "block": table.column("block"), "shared": pa.array(out, pa.binary())})


def read_flags(hashes: np.ndarray, flags: pa.Table, n: int) -> np.ndarray:
    """The answer of ``flag_shared`` for each of the block's ``hashes``."""
    u, inv = np.unique(hashes & _SENT, return_inverse=True)
    said = dict(zip(flags.column("bucket").to_pylist(), flags.column("shared").to_pylist(), strict=True))
    shared = np.zeros(len(u), dtype=bool)
    for b, rows in by_bucket(bucket_of(u, n)):
        shared[rows] = np.unpackbits(np.frombuffer(said[b], dtype=np.uint8), count=len(rows)).astype(bool)
    return shared[inv]
