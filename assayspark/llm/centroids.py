"""Centroid clustering of integer vectors: exact k-means through scalar lookup tables.

Vectors become blocks of codes once: per dimension the integers that occur in
the block, and for each vector the place of its integer in that list.  A round
tabulates the squared difference of every (dimension, occurring integer,
centroid) and a distance is a sum of gathers from these tables.  Only the
centroids (k x dimensions integers) travel to the tasks, and per round only k
rows of sums come back, reduced in Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import materialize

# Fixed values of the contract: components, their scale, centroids, rounds and the seed of the first centroids.
DIMS, SCALE, K, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Vectors in a block.
BLOCK = 16_384
#: Integers are held to +-LIMIT, so a squared distance of up to 64 components fits a long.
LIMIT = 1 << 27

BLOCKS = "ids binary, has_id binary, codes binary, starts binary, occurring binary"


def integer_vectors(vectors: DataFrame, vec_id: str, vec: str, dims: int, scale: int) -> DataFrame:
    """(id, v): vectors of exactly ``dims`` finite components as integers floor(scale * x)."""
    x = F.col(vec).cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    held = vectors.where(F.size(F.coalesce(x, F.array().cast("array<double>"))) == dims).where(F.forall(x, finite))

    def whole(c: Column) -> Column:
        return F.floor(F.greatest(F.least(c * float(scale), F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int")

    return held.select(F.col(vec_id).cast("long").alias("id"), F.transform(x, whole).alias("v"))


def first_centroids(ints: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    """The vectors with the ``k`` smallest digests of ``seed:id``, each task sending its ``k`` smallest.

    Rows of one id are ordered by their components; a NULL id is an empty one.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = ints.select(digest.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in rows], dtype=np.int64).reshape(len(rows), dims)


def encode_blocks(batches: Iterable[pa.RecordBatch], dims: int, block: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Blocks of at most ``block`` vectors: codes by dimension, and the occurring integers of each dimension."""

    def pack(ids: list, has: list, rows: list) -> pa.RecordBatch:
        v = np.concatenate(rows)
        found = [np.unique(v[:, d], return_inverse=True) for d in range(dims)]
        starts = np.cumsum([0] + [len(u) for u, _ in found]).astype(np.int32)
        codes = np.stack([c for _, c in found]).astype(np.int32)
        parts = [np.concatenate(ids), np.concatenate(has), codes, starts, np.concatenate([u for u, _ in found]).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], ["ids", "has_id", "codes", "starts", "occurring"])

    ids, has, rows, held = [], [], [], 0
    for b in batches:
        col = b.column("id")
        flat = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dims)
        for lo in range(0, b.num_rows, block):
            part = flat[lo : lo + block]
            if held and held + len(part) > block:
                yield pack(ids, has, rows)
                ids, has, rows, held = [], [], [], 0
            ids.append(col.slice(lo, len(part)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            has.append(col.slice(lo, len(part)).is_valid().to_numpy(zero_copy_only=False).astype(np.int8))
            rows.append(part.astype(np.int32))
            held += len(part)
    if held:
        yield pack(ids, has, rows)


def decode_blocks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple]:
    """(ids, has_id, codes, starts, occurring) of every block of a batch."""
    for i in range(batch.num_rows):
        get = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), dtype=kind)  # noqa: E731, B023
        yield get("ids", np.int64), get("has_id", np.int8), get("codes", np.int32).reshape(dims, -1), get("starts", np.int32), get("occurring", np.int32).astype(np.int64)


def nearest(codes: np.ndarray, starts: np.ndarray, occurring: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of the vectors of a block; ties go to the smaller number."""
    total = np.zeros((codes.shape[1], len(centroids)), dtype=np.int64)
    for d in range(len(codes)):
        lookup = (occurring[starts[d] : starts[d + 1], None] - centroids[None, :, d]) ** 2
        total += lookup[codes[d]]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(total)), cluster]


def round_sums(blocks: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """cluster -> (vectors, component sums) of one assignment; at most k x (dims + 1) rows reach the driver."""
    k, dims = centroids.shape

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for b in batches:
            for _, _, codes, starts, occurring in decode_blocks(b, dims):
                cluster, _ = nearest(codes, starts, occurring, centroids)
                count += np.bincount(cluster, minlength=k)
                for d in range(dims):
                    # Counts per (cluster, occurring integer) times the integer: sums stay whole numbers.
                    n = int(starts[d + 1] - starts[d])
                    hist = np.bincount(cluster * n + codes[d], minlength=k * n).reshape(k, n)
                    sums[:, d] += hist @ occurring[starts[d] : starts[d + 1]]
        used = np.flatnonzero(count)
        if len(used):
            cells = np.concatenate([count[used, None], sums[used]], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(used, dims + 1), pa.int32()), pa.array(np.tile(np.arange(dims + 1), len(used)), pa.int32()), pa.array(cells.ravel(), pa.int64())],
                ["cluster", "dim", "part"],
            )

    parts = blocks.mapInArrow(add, "cluster int, dim int, part long")
    rows = parts.groupBy("cluster", "dim").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for c in {r.cluster for r in rows}:
        of = {r.dim: int(r.total) for r in rows if r.cluster == c}
        out[c] = (of[0], [of[d + 1] for d in range(dims)])
    return out


def fit(blocks: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """``rounds`` rounds of assignment and floor means; empty clusters keep their centroid.

    Centroids that a round leaves as they are stay so in every later round, so it ends there.
    """
    for _ in range(rounds):
        moved = centroids.copy()
        for c, (n, sums) in round_sums(blocks, centroids).items():
            moved[c] = [s // n for s in sums]
        if (moved == centroids).all():
            break
        centroids = moved
    return centroids


def assign(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    dims = centroids.shape[1]

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, has, codes, starts, occurring in decode_blocks(b, dims):
                cluster, distance = nearest(codes, starts, occurring, centroids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64(), mask=has == 0), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"]
                )

    return blocks.mapInArrow(place, "id long, cluster int, distance long")


def cluster_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", k: int = K, rounds: int = ROUNDS, dims: int = DIMS,
    scale: int = SCALE, seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """Exact k-means: the assignments (``vec_id``, cluster, distance) and the final centroids.

    Vectors that are NULL, have another number of components, or a component
    that is NULL, NaN or infinite are left out.  Integers beyond +-2^27 are
    held there.  NULL ids and repeated rows are vectors like any other; equal
    distances go to the smaller cluster.  Fewer than ``k`` vectors give as many
    centroids; no vectors give no rows.  Other columns are not read.
    """
    ints = integer_vectors(vectors, vec_id, vec, dims, scale)
    centroids = first_centroids(ints, k, seed, dims)
    if not len(centroids):
        return ints.select(F.col("id").alias(vec_id), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    blocks = materialize(ints.mapInArrow(lambda batches: encode_blocks(batches, dims), BLOCKS), "vector-blocks")
    centroids = fit(blocks, centroids, rounds)
    return assign(blocks, centroids).withColumnRenamed("id", vec_id), centroids


def cluster_table(vectors: DataFrame) -> DataFrame:
    """Cluster, squared distance, sums of distances and centroid digest of every vector kept (see ``cluster_vectors``)."""
    placed, centroids = cluster_vectors(vectors.select("vec_id", "embedding"))
    placed = materialize(placed, "vector-clusters")
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()
    of = {r.cluster: r.s for r in sums}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("cluster"))
    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        pick([of.get(c, 0) for c in range(len(digests))] or [0]).cast("long").alias("cluster_inertia"),
        F.lit(sum(of.values())).cast("long").alias("inertia"),
        pick(digests or [""]).alias("centroid_sha256"),
    )


def cluster_sql(rounds: int = ROUNDS, dims: int = DIMS, k: int = K, scale: int = SCALE, seed: int = SEED) -> str:
    """The same rows in DuckDB SQL: one pair of common table expressions a round."""
    near = """near{r} AS MATERIALIZED (
      SELECT id, arg_min(c, (dist, c)) AS c, min(dist) AS dist
      FROM (SELECT x.id, m.c, sum((x.v - m.v) * (x.v - m.v))::BIGINT AS dist FROM long_v x JOIN mid{r} m USING (d) GROUP BY ALL)
      GROUP BY id)"""
    mean = """mid{n} AS MATERIALIZED (
      SELECT c, d, coalesce(CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END, o.v)::BIGINT AS v
      FROM mid{r} o LEFT JOIN (SELECT c, d, sum(v)::BIGINT AS s, count(*) AS n FROM near{r} JOIN long_v USING (id) GROUP BY ALL) g USING (c, d))"""
    steps = []
    for r in range(rounds):
        steps += [near.format(r=r), mean.format(r=r, n=r + 1)]
    steps.append(near.format(r=rounds))
    chain = ",\n".join(steps)
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id AS id, embedding AS e FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
), long_v AS MATERIALIZED (
  SELECT id, unnest(range({dims})) AS d, unnest(list_transform(e, lambda x: floor({scale}.0::DOUBLE * x::DOUBLE)::BIGINT)) AS v FROM kept
), mid0 AS MATERIALIZED (
  SELECT p.c, l.d, l.v FROM (SELECT id, row_number() OVER (ORDER BY sha256('{seed}:' || id)) - 1 AS c FROM kept QUALIFY c < {k}) p JOIN long_v l USING (id)
), {chain},
digest AS (SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY d)) AS s FROM mid{rounds} GROUP BY c)
SELECT id AS vec_id, c::INTEGER AS "cluster", dist AS distance, (sum(dist) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(dist) OVER ())::BIGINT AS inertia, digest.s AS centroid_sha256
FROM near{rounds} JOIN digest USING (c)
"""


CLUSTER_SQL = cluster_sql()
