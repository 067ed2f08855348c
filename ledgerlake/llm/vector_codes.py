"""Product codes of vectors, trained by Lloyd rounds over cover trees.

A vector is cut into PARTS equal parts. Blocks of BLOCK vectors of a
partition become, once, a cover tree per part (see ``cover_tree``), written
as one row per block to the shared folder. Each round then reads the trees
instead of the vectors: whole subtrees that one codebook entry is nearest to
add their cumulative sums, only ambiguous nodes are opened. A round
shuffles one row per task, part and entry; the driver gets one number per part, entry
and component. The last assignment turns trees back into one code per vector.

The arithmetic that decides is of integers, so results do not depend on
partitions or blocks. A lost executor's tasks read the blocks again.

Defined results: null vectors and those with null or non-finite components
are left out, and so are those whose length does not divide into the parts or
differs from that of the smallest id's vector; components stop at plus or
minus 2^26; null ids come last; rows that repeat an id are vectors of
their own (the smaller vector first); with fewer vectors than entries the
codebooks are smaller; an empty table gives an empty result; a sum beyond a
long is null; labels of any type are carried, nulls are one label; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, read, shared_folder
from .cover_tree import Forest
from .vectors import exact_long, kept_vectors

PARTS, ENTRIES, ROUNDS, BLOCK = 16, 64, 2, 4096
#: rows of the smaller side for each label, so that a hot label's vectors meet them in many tasks
SALTS = 32
ARRAYS = {"points": np.int32, "rows": np.int32, "centre": np.int32, "low": np.int32, "high": np.int32,
          "radius": np.float64, "child_low": np.int32, "child_high": np.int32}


def _grow(batches, parts: int):
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            block = batch.slice(start, BLOCK)
            vectors = block.column(2).flatten().to_numpy().reshape(block.num_rows, parts, -1)
            forest = Forest.build(vectors.transpose(1, 0, 2))
            lists = [pa.ListArray.from_arrays(pa.array([0, block.num_rows], pa.int32()), block.column(i)) for i in (0, 1)]
            blobs = [pa.array([np.ascontiguousarray(getattr(forest, a), kind).tobytes()]) for a, kind in ARRAYS.items()]
            yield pa.RecordBatch.from_arrays([*lists, *blobs], names=["vec_ids", "labels", *ARRAYS])


def _forests(batches, parts: int, dims: int):
    for batch in batches:
        for i in range(batch.num_rows):
            a = {n: np.frombuffer(batch.column(batch.schema.get_field_index(n))[i].as_py(), kind) for n, kind in ARRAYS.items()}
            a["points"], a["centre"] = a["points"].reshape(-1, dims), a["centre"].reshape(-1, dims)
            yield batch, i, Forest(parts, **a)


def _add_up(batches, books: np.ndarray):
    parts, k, dims = books.shape
    n, sums = np.zeros((parts, k), np.int64), np.zeros(books.shape, np.int64)
    for _, _, forest in _forests(batches, parts, dims):
        _, more, own = forest.assign(books)
        n += more
        sums += own
    part, entry = np.nonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]),
                                      pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])


def _code(batches, books: np.ndarray):
    parts, _, dims = books.shape
    for batch, i, forest in _forests(batches, parts, dims):
        found, _, _ = forest.assign(books)
        size = len(found) // parts
        part = np.arange(len(found)) // size
        off = np.square(forest.points - books[part, found]).sum(axis=1)
        codes, error = np.empty((size, parts), np.uint8), np.zeros(size, np.int64)
        codes[forest.rows, part] = found
        np.add.at(error, forest.rows, off)
        text, step = codes.tobytes().hex(), 2 * parts
        ids, labels = batch.column(0)[i].values, batch.column(1)[i].values
        yield pa.RecordBatch.from_arrays([ids, labels, pa.array([text[s:s + step] for s in range(0, len(text), step)]), pa.array(error)],
                                         names=["vec_id", "label", "code", "error"])


class Codes:
    """Codebooks and codes of the vectors of ``df``: ``books`` (parts,
    entries, components) and ``coded`` (vec_id, label, code, error)."""

    def __init__(self, df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS):
        if entries > 256:
            raise ValueError("two hex digits name at most 256 entries")
        vectors = kept_vectors(df, id_col, vector_col, F.col(label_col).alias("label")).select("vec_id", "label", "vector")
        vectors = vectors.filter((F.size("vector") > 0) & (F.size("vector") % parts == 0))
        kind = {f.name: f.dataType.simpleString() for f in vectors.schema}
        order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
        one = vectors.orderBy(*order).limit(1).collect()
        dims = len(one[0].vector) if one else parts
        vectors = vectors.filter(F.size("vector") == dims)
        first = vectors.orderBy(*order).limit(entries).collect()
        books = np.array([r.vector for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2) if first else np.empty((parts, 0, 1), np.int64)
        folder = f"{shared_folder(df.sparkSession)}/cover-trees-{uuid.uuid4().hex}"
        rows = f"vec_ids array<{kind['vec_id']}>, labels array<{kind['label']}>, " + ", ".join(f"{a} binary" for a in ARRAYS)
        vectors.mapInArrow(lambda b: _grow(b, parts), rows).write.parquet(folder)
        self.trees = df.sparkSession.read.schema(rows).parquet(folder)
        for _ in range(rounds if first else 0):
            books = self._moved(books)
        self.books = books
        self.coded = self.trees.mapInArrow(lambda b: _code(b, books), f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long")

    def _moved(self, books: np.ndarray) -> np.ndarray:
        sums = self.trees.drop("vec_ids", "labels").mapInArrow(lambda b: _add_up(b, books), "part int, entry int, n long, sums array<long>")
        means = sums.select("part", "entry", "n", F.posexplode("sums").alias("d", "s")).groupBy("part", "entry", "d").agg(
            F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
        new = books.copy()
        for r in means.collect():  # at most parts x entries x components rows
            new[r.part, r.entry, r.d] = int(r.s) // r.n
        return new

    def books_sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def report(df: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every coded vector."""
    codes = Codes(df, **options)
    coded = cut(codes.coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")))
    per_label = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error")).select(
        F.col("label").alias("_label"), exact_long(F.col("label_error")).alias("label_error"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    same = coded["label"].eqNullSafe(per_label["_label"]) & (coded["salt"] == per_label["_salt"])
    return coded.join(per_label, same).select("vec_id", "code", "error", "label_error", F.lit(codes.books_sha256()).alias("codebooks_sha256"))


def _oracle(parts: int, entries: int, rounds: int) -> str:
    """The same rounds in SQL: one CTE for each assignment and each move."""
    sql = [f"""v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (
  SELECT vec_id, i // w AS p, i % w AS d, x FROM (
    SELECT vec_id, len(vector) // {parts} AS w, unnest(vector) AS x, unnest(range(len(vector))) AS i FROM v)),
e0 AS MATERIALIZED (
  SELECT e, p, d, x AS y FROM x JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v QUALIFY e < {entries}) USING (vec_id))"""]
    for i in range(rounds + 1):
        sql.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, p, arg_min(e, q * {entries} + e) AS e, min(q) AS q FROM (
    SELECT vec_id, p, e, CAST(sum((x - y) * (x - y)) AS BIGINT) AS q FROM x JOIN e{i} USING (p, d) GROUP BY vec_id, p, e)
  GROUP BY vec_id, p)""")
        if i < rounds:
            sql.append(f"""e{i + 1} AS MATERIALIZED (
  SELECT e, p, d, coalesce(m, y) AS y FROM e{i} LEFT JOIN (
    SELECT e, p, d, (s - ((s % n) + n) % n) // n AS m FROM (
      SELECT e, p, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM x JOIN a{i} USING (vec_id, p) GROUP BY e, p, d)) USING (e, p, d))""")
    return "WITH " + ",\n".join(sql) + f""",
c AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(q) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, e, d)) AS h FROM e{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM c JOIN v USING (vec_id) CROSS JOIN h"""


ORACLE = _oracle(PARTS, ENTRIES, ROUNDS)


def query(spark, sf_dir):
    return report(read(spark, sf_dir, "embeddings"))
