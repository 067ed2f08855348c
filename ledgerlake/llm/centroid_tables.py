"""Centroid clustering by scalar lookup tables.

In each round a task takes its vectors in blocks and tabulates, for every
dimension and every integer value that occurs there in the block, the
squared differences to that component of all centroids; a vector's distances
are then gathered from the tables and added up. Values that repeat, as
integer components do, are squared once. A task adds its vectors up per
cluster, so a round shuffles one row per task, cluster and dimension, however
large a cluster is, and the driver gets one row per cluster and dimension.

The arithmetic is exact (integers throughout, sums as decimals), so results
do not depend on partitions. The vectors are read from a checkpoint, which a
lost executor's task reads again.

Defined results: vectors of another length, null ones and those with null or
non-finite components are left out; components stop at plus or minus 2^26
(see ``vectors``); null ids come last among equal hashes; rows that repeat
an id are vectors of their own (the smaller vector first); with fewer vectors than
centroids each vector is one; an empty table gives an empty result; a sum
beyond a long is null; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, read
from .vectors import exact_long, kept_vectors

K, DIMS, ROUNDS, SEED = 40, 64, 5, "2"
BLOCK = 4096


def occurring(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, ascending; each entry's place among them)."""
    low = int(values.min())
    span = int(values.max()) - low + 1
    if span > 4 * len(values):  # few of many: sort instead of marking
        return np.unique(values, return_inverse=True)
    seen = np.zeros(span, bool)
    seen[values - low] = True
    return np.flatnonzero(seen) + low, (np.cumsum(seen) - 1)[values - low]


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (vectors, centroids) from one lookup table per dimension."""
    total = np.zeros((len(vectors), len(centroids)), np.int64)
    for d in range(vectors.shape[1]):
        values, place = occurring(vectors[:, d])
        table = np.square(values[:, None].astype(np.int64) - centroids[None, :, d])
        total += table.take(place, axis=0)
    return total


def _blocks(batches, dims: int):
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            yield part, part.column(part.schema.get_field_index("vector")).flatten().to_numpy().astype(np.int64).reshape(-1, dims)


def _add_up(batches, centroids: np.ndarray):
    n, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
    for _, x in _blocks(batches, centroids.shape[1]):
        nearest = np.argmin(distances(x, centroids), axis=1)  # the first of equals
        order = np.argsort(nearest, kind="stable")
        own, first = np.unique(nearest[order], return_index=True)
        n[own] += np.diff(np.append(first, len(order)))
        sums[own] += np.add.reduceat(x[order], first, axis=0)
    used = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))],
                                     names=["cluster", "n", "sums"])


def _assign(batches, centroids: np.ndarray):
    for part, x in _blocks(batches, centroids.shape[1]):
        d = distances(x, centroids)
        nearest = np.argmin(d, axis=1)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(nearest.astype(np.int32)), pa.array(d[np.arange(len(d)), nearest])],
                                         names=["vec_id", "cluster", "distance"])


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; those without vectors stay."""
    c = centroids
    parts = vectors.select("vector").mapInArrow(lambda b: _add_up(b, c), "cluster int, n long, sums array<long>")
    means = parts.select("cluster", "n", F.posexplode("sums").alias("d", "s")).groupBy("cluster", "d").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    new = c.copy()
    for r in means.collect():  # at most centroids x dimensions rows
        new[r.cluster, r.d] = int(r.s) // r.n
    return new


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, dims: int = DIMS,
            rounds: int = ROUNDS, seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance of every vector; the centroids)."""
    vectors = cut(kept_vectors(df, id_col, vector_col).filter(F.size("vector") == dims))
    kind = vectors.schema["vec_id"].dataType.simpleString()
    named = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = vectors.orderBy(named, F.col("vec_id").asc_nulls_last(), "vector").limit(k).collect()
    centroids = np.array([r.vector for r in first], np.int64).reshape(len(first), dims)
    for _ in range(rounds if first else 0):
        centroids = moved(vectors, centroids)
    if not first:
        none = [F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")]
        return vectors.select("vec_id", *none), centroids
    return vectors.mapInArrow(lambda b: _assign(b, centroids), f"vec_id {kind}, cluster int, distance long"), centroids


def digest(numbers) -> str:
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def report(df: DataFrame, **options) -> DataFrame:
    """The vectors with their cluster's and the whole inertia and their centroid's digest."""
    assigned, centroids = cluster(df, **options)
    assigned = cut(assigned)
    sums = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # one row per cluster
    per = lambda values, kind: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1).cast(kind) if values else F.lit(None).cast(kind)
    inertia = [str(sums.get(c, 0)) for c in range(len(centroids))]
    return assigned.select(
        "vec_id", "cluster", "distance",
        exact_long(per(inertia, "decimal(38,0)")).alias("cluster_inertia"),
        exact_long(F.lit(str(sum(sums.values()))).cast("decimal(38,0)")).alias("inertia"),
        per([digest(c) for c in centroids.tolist()], "string").alias("centroid_sha256"))


def _oracle(k: int, dims: int, rounds: int, seed: str) -> str:
    """The same rounds in SQL: one CTE for each assignment and each move."""
    sql = [f"""v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT vec_id, unnest(vector) AS x, unnest(range({dims})) AS d FROM v),
s AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR))) - 1 AS c, vector FROM v QUALIFY c < {k}),
c0 AS MATERIALIZED (SELECT c, unnest(vector) AS y, unnest(range({dims})) AS d FROM s)"""]
    for i in range(rounds + 1):
        sql.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, arg_min(c, q * {k} + c) AS c, min(q) AS q
  FROM (SELECT vec_id, c, CAST(sum((x - y) * (x - y)) AS BIGINT) AS q FROM x JOIN c{i} USING (d) GROUP BY vec_id, c) GROUP BY vec_id)""")
        if i < rounds:
            sql.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(m, y) AS y, d FROM c{i} LEFT JOIN (
    SELECT c, d, (s - ((s % n) + n) % n) // n AS m
    FROM (SELECT c, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM x JOIN a{i} USING (vec_id) GROUP BY c, d)) USING (c, d))""")
    return "WITH " + ",\n".join(sql) + f""",
h AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, q AS distance, CAST(sum(q) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(q) OVER () AS BIGINT) AS inertia, h AS centroid_sha256 FROM a{rounds} JOIN h USING (c)"""


ORACLE = _oracle(K, DIMS, ROUNDS, SEED)


def query(spark, sf_dir):
    return report(read(spark, sf_dir, "embeddings"))
