"""Centroid clustering: Lloyd's rounds with the dimensions dealt into shards.

The vectors are cut into row groups of at most ``CHUNK_ROWS`` and into column
blocks of ``BLOCK_DIMS`` dimensions; a row of the frozen table is one block of
one group. A round is one Spark job:

1. Column-block tasks compute the exact partial distances of their rows to
   their own slice of the centroids.
2. The partial distances of a row group are dealt by group and added up (those
   that meet in a task already before the shuffle); the smallest sum names each
   row's centroid, the smaller number at a tie.
3. Each group's assignment goes back to its blocks, which add their rows per
   centroid. One row per task, block, centroid and dimension reaches the
   aggregate that gives a block its new slice: the exact floor of sum by count.

The blocks are written once, dealt by (group, block), and never shuffled again.
The slices are k x dims integers, a size fixed by the parameters; they are what
the driver carries from round to round, so that a lost executor costs part of
one round. Nothing else reaches the driver.

All arithmetic is on integers: components below 2**27 in size keep every squared
distance inside a long. A larger one is refused by name, as its distance has no
long; there is no silent wrap.

Defined cases: vectors that are NULL, of another length, or hold NULL or
non-finite components are left out; a NULL ``vec_id`` is kept and comes last
among the starting candidates; repeated rows are separate rows; equal ids are
ordered by their vectors; fewer than ``k`` vectors give as many centroids; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiary.llm.common import frozen

DIMS, SCALE, K, ROUNDS, SEED = 64, 1024, 8, 10, 3
BLOCK_DIMS = 16
CHUNK_ROWS = 2048
#: Components of this size or more have no exact squared distance in a long.
LIMIT = 1 << 27

RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def whole_vector(v: Column) -> Column:
    """The vector is there and holds finite numbers only."""
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return v.isNotNull() & ~F.coalesce(odd, F.lit(True))


def quantised(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): the kept vectors, each component floor(scale * c) of the double c."""
    v = F.col("embedding").cast("array<double>")
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")) \
                  .filter((F.size("v") == dims) & whole_vector(F.col("v")))
    return kept.select("vec_id", F.transform("v", lambda c: F.floor(c * scale)).alias("x"))


def starting_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k rows with the smallest SHA-256 of '<seed>:<vec_id>' (k rows reach the driver)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = rows.orderBy(key.asc_nulls_last(), "x").limit(k).select("x").collect()
    return np.array([r["x"] for r in first], dtype=np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _pack(dims: int, width: int, rows: int):
    """(g, b, ids, x): a row per group and block; block -1 holds the group's ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId() << 32
        for batch in batches:
            values = _matrix(batch.column("x"), dims)
            if values.size and np.abs(values).max() >= LIMIT:
                raise ValueError(f"a component of {LIMIT} or more after scaling: its squared distance has no long")
            values = values.astype(np.int32)
            for start in range(0, len(values), rows):
                part = values[start:start + rows]
                cut = [np.ascontiguousarray(part[:, i:i + width]).tobytes() for i in range(0, dims, width)]
                n = len(cut) + 1
                yield pa.RecordBatch.from_pydict({
                    "g": pa.array([group] * n, pa.int64()), "b": pa.array(range(-1, n - 1), pa.int32()),
                    "ids": pa.array([batch.column("vec_id")[start:start + rows].to_pylist()] + [None] * (n - 1), pa.list_(pa.int64())),
                    "x": pa.array([None, *cut], pa.binary())})
                group += 1
    return run


def _laid_out(df: DataFrame) -> DataFrame:
    """Frozen with a layout that later joins know. An adaptive plan does not tell
    how its rows are dealt, so this one write is planned ahead."""
    conf = df.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return frozen(df)
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def blocks_of(rows: DataFrame, dims: int, width: int, chunk: int) -> DataFrame:
    packed = rows.mapInArrow(_pack(dims, width, chunk), "g long, b int, ids array<long>, x binary")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _laid_out(packed.repartition(n, "g", "b").sortWithinPartitions("g", "b"))


def _partial_distances(slices: list):
    """Per row group the sum over the blocks at hand of |x - c|^2, rows x k longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for g, b, x in zip(*(batch.column(c).to_pylist() for c in ("g", "b", "x"))):
                c = slices[b]
                x = np.frombuffer(x, np.int32).reshape(-1, c.shape[1]).astype(np.int64)
                part = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
                if g == at:
                    total += part
                    continue
                if at is not None:
                    yield _row({"g": pa.int64(), "p": pa.binary()}, at, total.tobytes())
                at, total = g, part
        if at is not None:
            yield _row({"g": pa.int64(), "p": pa.binary()}, at, total.tobytes())
    return run


def _row(types: dict, *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({c: pa.array([v], t) for (c, t), v in zip(types.items(), values)})


def _sums_by_group(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(g, distances) from the partial ones, which come in order of g."""
    at, total = None, None
    for batch in batches:
        for g, p in zip(batch.column("g").to_pylist(), batch.column("p").to_pylist()):
            part = np.frombuffer(p, np.int64).reshape(-1, k)
            if g == at:
                total += part
                continue
            if at is not None:
                yield at, total
            at, total = g, part.copy()
    if at is not None:
        yield at, total


def _assign(k: int, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, d in _sums_by_group(batches, k):
            near = d.argmin(1).astype(np.int32).tobytes()
            yield pa.RecordBatch.from_pydict({"g": pa.array([g] * blocks, pa.int64()), "b": pa.array(range(blocks), pa.int32()),
                                              "near": pa.array([near] * blocks, pa.binary())})
    return run


def _final(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, d in _sums_by_group(batches, k):
            near = d.argmin(1)
            yield _row({"g": pa.int64(), "cluster": pa.list_(pa.int32()), "distance": pa.list_(pa.int64())},
                       g, near.astype(np.int32), d[np.arange(len(d)), near])
    return run


def _slice_sums(widths: list, k: int):
    """(b, cluster, dim, s, n): a task's rows added per block, centroid and dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for b, x, near in zip(*(batch.column(c).to_pylist() for c in ("b", "x", "near"))):
                x, near = np.frombuffer(x, np.int32).reshape(-1, widths[b]), np.frombuffer(near, np.int32)
                s, n = sums.setdefault(b, (np.zeros((k, widths[b]), np.int64), np.zeros(k, np.int64)))
                order = np.argsort(near, kind="stable")
                found, first = np.unique(near[order], return_index=True)
                s[found] += np.add.reduceat(x[order].astype(np.int64), first, axis=0)
                n += np.bincount(near, minlength=k)
        for b, (s, n) in sums.items():
            cluster, dim = (a.ravel() for a in np.indices(s.shape))
            yield pa.RecordBatch.from_pydict({
                "b": np.full(s.size, b, np.int32), "cluster": cluster.astype(np.int32), "dim": dim.astype(np.int32),
                "s": s.ravel(), "n": np.repeat(n, s.shape[1])})
    return run


def _distances(blocks: DataFrame, slices: list) -> DataFrame:
    """Partial distances, dealt by row group in order."""
    part = blocks.select("g", "b", "x").mapInArrow(_partial_distances(slices), "g long, p binary")
    return part.repartition("g").sortWithinPartitions("g")


def next_slices(blocks: DataFrame, slices: list) -> list:
    """One round: every block's slice after its rows have been assigned anew."""
    k, widths = len(slices[0]), [c.shape[1] for c in slices]
    near = _distances(blocks, slices).mapInArrow(_assign(k, len(slices)), "g long, b int, near binary")
    sums = blocks.join(near.hint("merge"), ["g", "b"]).select("b", "x", "near") \
                 .mapInArrow(_slice_sums(widths, k), "b int, cluster int, dim int, s long, n long")
    new = (sums.groupBy("b", "cluster", "dim").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).filter("n > 0")
               .select("b", "cluster", "dim", F.expr("(s - pmod(s, n)) div n").alias("v")))
    after = [c.copy() for c in slices]
    for r in new.collect():  # k x dims integers
        after[r["b"]][r["cluster"], r["dim"]] = r["v"]
    return after


def lloyd(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED,
          width: int = BLOCK_DIMS, chunk: int = CHUNK_ROWS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per kept vector."""
    spark = vectors.sparkSession
    rows = quantised(vectors, dims, scale)
    start = starting_centroids(rows, k, seed)
    if not len(start):
        return spark.createDataFrame([], RESULT)
    packed = blocks_of(rows, dims, width, chunk)
    blocks = packed.filter("b >= 0")
    slices = [start[:, i:i + width] for i in range(0, dims, width)]
    for _ in range(rounds):
        slices = next_slices(blocks, slices)

    final = _distances(blocks, slices).mapInArrow(_final(len(start)), "g long, cluster array<int>, distance array<long>")
    ids = packed.filter("b = -1").select("g", "ids")
    zipped = ids.join(final.hint("merge"), "g").select(F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("r"))
    placed = frozen(zipped.select(F.col("r.ids").alias("vec_id"), F.col("r.cluster").alias("cluster"), F.col("r.distance").alias("distance")))

    whole = np.concatenate(slices, axis=1)
    fits = lambda x: x if x < 1 << 63 else None
    per = {r["cluster"]: int(r["d"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    named = spark.createDataFrame(
        [(j, fits(per.get(j, 0)), fits(sum(per.values())), hashlib.sha256(",".join(map(str, whole[j].tolist())).encode()).hexdigest())
         for j in range(len(whole))], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same rounds written out as SQL over the table ``embeddings``."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""",
             "cells AS MATERIALIZED (SELECT r, unnest(x) AS v, generate_subscripts(x, 1) AS dim FROM kept)",
             f"""c0 AS MATERIALIZED (
  SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS dim FROM (
    SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), x) - 1 AS cluster, x FROM kept) f WHERE cluster < {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, min(d * {k} + cluster) AS best FROM (
    SELECT r, cluster, sum((cells.v - c{i}.v) * (cells.v - c{i}.v)) AS d
    FROM cells JOIN c{i} USING (dim) GROUP BY r, cluster) y GROUP BY r)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c{i}.cluster, c{i}.dim, CAST(coalesce((s - ((s % n) + n) % n) // n, c{i}.v) AS BIGINT) AS v
  FROM c{i} LEFT JOIN (
    SELECT best % {k} AS cluster, dim, sum(v) AS s, count(*) AS n FROM a{i} JOIN cells USING (r) GROUP BY 1, 2) t
  ON t.cluster = c{i}.cluster AND t.dim = c{i}.dim)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(best % {k} AS INTEGER) AS cluster, CAST(best // {k} AS BIGINT) AS distance,
       CAST(sum(best // {k}) OVER (PARTITION BY best % {k}) AS BIGINT) AS cluster_inertia,
       CAST(sum(best // {k}) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM kept JOIN a{rounds} USING (r)
JOIN (SELECT cluster, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster) h
  ON h.cluster = best % {k}"""
