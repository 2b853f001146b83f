"""Exact substring de-duplication: bytes of later copies go, the first copy stays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller doc_id.  That is the longest-previous-factor question
with a threshold: in suffix order, does the previous or next start with a
smaller doc_id share ``LENGTH`` bytes?

1. Every string of ``LENGTH`` bytes chooses the leftmost smallest hash among
   its 16-byte runs.  Equal strings choose equal runs, so a string can recur
   only if its run occurs twice in the corpus.  Blocks send their distinct run
   hashes to buckets and learn which occur twice (8 bytes for some 18 of text).
2. The strings of the runs that recur go to a bucket by run hash, as the bytes
   they span, with equal spans of a block merged.  The bucket sorts the string
   starts into suffix order, cut at ``LENGTH`` bytes, and finds the previous
   smaller start of each: where that shares the whole string, the longest
   previous factor reaches the threshold.
3. The answers return to the blocks, which cut the bytes out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.llm.blocks import (
    BLOCK_BYTES, FLAGS, HASHES, Block, blocked, bucket_of, by_bucket, flag_shared, hash_rows, leftmost_minima, read_flags, unpack,
)

# Fixed value of the contract.
LENGTH = 50
RUN = 16

UNITS = "bucket int, block int, khash binary, doc binary, at binary, count binary, span binary, done_at binary, done_count binary"
CUTS = "block int, at binary, windows binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>, kept binary"


def _choices(b: Block, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values = b.bytes()
    valid = np.zeros(len(values), dtype=bool)
    for s, n in zip(b.starts, b.sizes, strict=False):
        if n >= length:
            valid[s : s + n - length + 1] = True
    first, count, _, khash = leftmost_minima(values, valid, RUN, length)
    return first, count, khash


def _digests(spans: list[bytes]) -> np.ndarray:
    """128-bit digests, two numbers per span."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, spans)), dtype=">u8").reshape(-1, 2)


def _units(b: Block, flags: pa.Table, n: int, length: int) -> pa.Table:
    """Spans of the strings whose run recurs; of equal spans in the block only that of the smallest doc_id travels."""
    at, count, khash = _choices(b, length)
    if len(at):
        use = read_flags(khash, flags, n)
        at, count, khash = at[use], count[use], khash[use]
    doc = b.ids[np.searchsorted(b.starts, at, side="right") - 1]
    data = b"".join(b.texts)
    spans = [data[i : i + c + length - 1] for i, c in zip(at.tolist(), count.tolist(), strict=True)]
    digest = _digests(spans)
    # Documents come in doc_id order, so the first of equal spans has the smallest id; those of the same id are not later copies.
    order = np.lexsort((np.arange(len(at)), digest[:, 1], digest[:, 0]))
    new = np.ones(len(at), dtype=bool)
    new[1:] = (digest[order[1:]] != digest[order[:-1]]).any(axis=1)
    head = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(at) else order
    done = np.zeros(len(at), dtype=bool)
    done[order] = doc[order] > doc[head]
    go = ~done
    rows: dict[str, list] = {k: [] for k in ("bucket", "khash", "doc", "at", "count", "span")}
    pick = np.flatnonzero(go)
    for k, part in by_bucket(bucket_of(khash[pick], n)):
        r = pick[part]
        rows["bucket"].append(k)
        rows["khash"].append(khash[r].tobytes())
        rows["doc"].append(doc[r].tobytes())
        rows["at"].append(at[r].astype(np.int32).tobytes())
        rows["count"].append(count[r].astype(np.uint8).tobytes())
        rows["span"].append(b"".join(spans[i] for i in r.tolist()))
    m = len(rows["bucket"])
    none = [b""] * m
    table = {k: pa.array(rows[k], pa.int32() if k == "bucket" else pa.binary()) for k in rows}
    table |= {"block": pa.array([b.number] * m, pa.int32()), "done_at": pa.array(none, pa.binary()), "done_count": pa.array(none, pa.binary())}
    out = pa.table(table)
    if done.any():
        settled = {k: pa.array([b""], pa.binary()) for k in ("khash", "doc", "at", "count", "span")}
        settled |= {"bucket": pa.array([b.number % n], pa.int32()), "block": pa.array([b.number], pa.int32())}
        settled |= {"done_at": pa.array([at[done].astype(np.int32).tobytes()], pa.binary()), "done_count": pa.array([count[done].astype(np.uint8).tobytes()], pa.binary())}
        out = pa.concat_tables([out, pa.table({k: settled[k] for k in out.column_names})])
    return out.select([c.split()[0] for c in UNITS.split(", ")])


def suffix_order(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of ``starts``, cut at ``length`` bytes, and where a start differs from the one before it.

    Equal strings keep the order in which their starts are given.  Only the
    starts are sorted, each by its own bytes.
    """
    keys = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[starts]).view(f"S{length}").ravel()
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return order, new


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank, in suffix order cut at ``length`` bytes, of every position that has that many bytes after it."""
    order, new = suffix_order(data, np.arange(len(data) - length + 1), length)
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def has_previous(doc: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Whether the longest previous factor of each start, in suffix order, reaches the cut.

    Starts of equal strings stand in document order, so the previous smaller
    one of a start is right before the first start of its document there, and
    no next smaller one shares the whole string.
    """
    i = np.arange(len(doc))
    run = new.copy()
    run[1:] |= doc[1:] != doc[:-1]
    previous_smaller = np.maximum.accumulate(np.where(run, i, 0)) - 1
    return previous_smaller >= np.maximum.accumulate(np.where(new, i, 0))


def _resolve(table: pa.Table, length: int) -> pa.Table:
    """Which strings of the spans that met in a bucket also start in a document with a smaller doc_id."""
    sizes = [len(x) // 4 for x in table.column("at").to_pylist()]
    khash = np.concatenate(unpack(table.column("khash"), np.uint64))
    doc = np.concatenate(unpack(table.column("doc"), np.int64))
    count = np.concatenate(unpack(table.column("count"), np.uint8)).astype(np.int64)
    data = b"".join(table.column("span").to_pylist())
    begin = np.concatenate([[0], np.cumsum(count + length - 1)])[:-1]
    digest = _digests([data[i : i + c + length - 1] for i, c in zip(begin.tolist(), count.tolist(), strict=True)])
    full = (np.uint64(1) << count.astype(np.uint64)) - np.uint64(1)
    masks = np.zeros(len(khash), dtype=np.uint64)
    if len(khash):
        # Equal spans: all strings of a later document go; the first one stands for them.
        order = np.lexsort((doc, digest[:, 1], digest[:, 0], khash))
        new_k = np.ones(len(order), dtype=bool)
        new_k[1:] = khash[order[1:]] != khash[order[:-1]]
        new = new_k.copy()
        new[1:] |= (digest[order[1:]] != digest[order[:-1]]).any(axis=1)
        head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        masks[order] = np.where(doc[order] > doc[head], full[order], np.uint64(0))
        # A run hash with one span has nothing more to compare.
        group = np.cumsum(new_k) - 1
        kinds = np.bincount(group, weights=new)
        rest = order[new & (kinds[group] > 1)]
        for part in _parts(khash[rest], count[rest]):
            _windows(rest[part], data, begin, count, doc, masks, length)
        # Equal spans of the same document share the answer of their first.
        again = doc[order] == doc[head]
        masks[order[again]] = masks[head[again]]
    out, i = [], 0
    for block, m, at, done_at, done_count in zip(
        table.column("block").to_pylist(), sizes, unpack(table.column("at"), np.int32), unpack(table.column("done_at"), np.int32), unpack(table.column("done_count"), np.uint8), strict=True
    ):
        mine = masks[i : i + m]
        i += m
        hit = mine != 0
        settled = (np.uint64(1) << done_count.astype(np.uint64)) - np.uint64(1)
        where = np.concatenate([at[hit], done_at])
        if len(where):
            out.append((block, where.tobytes(), np.concatenate([mine[hit], settled]).tobytes()))
    return pa.table(
        {
            "block": pa.array([o[0] for o in out], pa.int32()),
            "at": pa.array([o[1] for o in out], pa.binary()),
            "windows": pa.array([o[2] for o in out], pa.binary()),
        }
    )


#: String starts whose suffix order is built at a time; whole run hashes only.
PART = 1 << 20


def _parts(khash: np.ndarray, count: np.ndarray):
    """Slices of whole run hashes with about ``PART`` string starts each."""
    if not len(khash):
        return
    first = np.flatnonzero(np.concatenate([[True], khash[1:] != khash[:-1]]))
    done = np.concatenate([[0], np.cumsum(count)])
    lo = 0
    for f, g in zip(first, np.append(first[1:], len(khash)), strict=True):
        if done[g] - done[lo] > PART and f > lo:
            yield slice(lo, f)
            lo = f
    yield slice(lo, len(khash))


def _windows(rows: np.ndarray, data: bytes, begin: np.ndarray, count: np.ndarray, doc: np.ndarray, masks: np.ndarray, length: int) -> None:
    rows = rows[np.argsort(doc[rows], kind="stable")]
    n = count[rows]
    text = np.frombuffer(b"".join(data[b : b + c + length - 1] for b, c in zip(begin[rows].tolist(), n.tolist(), strict=True)), dtype=np.uint8)
    offset = np.concatenate([[0], np.cumsum(n + length - 1)])[:-1]
    unit = np.repeat(np.arange(len(rows)), n)
    k = np.arange(len(unit)) - np.repeat(np.cumsum(n) - n, n)
    order, new = suffix_order(text, offset[unit] + k, length)
    later = np.sort(order[has_previous(doc[rows][unit[order]], new)])
    if len(later):
        # Starts of a unit are neighbours, so its bits are one slice.
        first = np.flatnonzero(np.concatenate([[True], unit[later][1:] != unit[later][:-1]]))
        masks[rows[unit[later][first]]] |= np.bitwise_or.reduceat(np.uint64(1) << k[later].astype(np.uint64), first)


def _cut(b: Block, cuts: pa.Table, length: int) -> pa.Table:
    data = b.bytes()
    cover = np.zeros(len(data) + 1, dtype=np.int32)
    for at, masks in zip(unpack(cuts.column("at"), np.int32), unpack(cuts.column("windows"), np.uint64), strict=True):
        bits = (masks[:, None] >> np.arange(length - RUN + 1, dtype=np.uint64)[None, :]) & np.uint64(1)
        row, k = np.nonzero(bits)
        starts = at[row] + k
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + length, -1)
    gone = np.cumsum(cover[:-1]) > 0
    rows = []
    for i, (s, n) in enumerate(zip(b.starts, b.sizes, strict=False)):
        g = gone[s : s + n]
        kept = data[s : s + n][~g].tobytes() if g.any() else b.texts[i]
        edge = np.diff(g.astype(np.int8), prepend=0, append=0)
        spans = [{"start": int(x), "end": int(y)} for x, y in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
        rows.append((None if b.nulls[i] else int(b.ids[i]), int(n), int(g.sum()), len(spans), hashlib.sha256(kept).hexdigest(), spans, kept))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary()]
    names = [c.split()[0] for c in RESULT.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(zip(names, kinds, strict=True))})


def drop_repeats(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, kept: bool = True) -> DataFrame:
    """One row per document: sizes, removed spans (byte offsets), digest and bytes of what is left.

    NULL text counts as empty.  A NULL doc_id counts as larger than all others.
    Documents with one id are no copies of one another.  Texts shorter than
    ``length`` lose nothing.  Only doc_id and text are read.  ``kept`` = False
    leaves the bytes out.
    """
    if not RUN <= length <= RUN + 63:
        raise ValueError(f"length must be from {RUN} to {RUN + 63}")
    texts, n = blocked(docs, block_bytes=block_bytes)

    def hashes(t: pa.Table) -> pa.Table:
        b = Block(t)
        return hash_rows(b.number, _choices(b, length)[2], n)

    flags = texts.groupBy("block").applyInArrow(hashes, HASHES).groupBy("bucket").applyInArrow(flag_shared, FLAGS)
    units = texts.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(lambda t, f: _units(Block(t), f, n, length), UNITS)
    cuts = units.groupBy("bucket").applyInArrow(lambda t: _resolve(t, length), CUTS)

    def cut(t: pa.Table, c: pa.Table) -> pa.Table:
        out = _cut(Block(t), c, length)
        return out if kept else out.set_column(out.num_columns - 1, "kept", pa.nulls(out.num_rows, pa.binary()))

    return texts.groupBy("block").cogroup(cuts.groupBy("block")).applyInArrow(cut, RESULT)


def repeat_table(docs: DataFrame) -> DataFrame:
    """The contract's columns of every document, with the removed spans."""
    return drop_repeats(docs, kept=False).drop("kept")
