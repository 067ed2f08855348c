"""Token-ID output in rANS-coded files, and reading them back.

``write_tokens`` deals the documents by ranges of their id (ties by a hash
of the text and the row's number, so copies of one id spread over files),
encodes each range in order and writes a folder of Parquet files whose rows
are segments: up to SEGMENT ids of whole documents, one shared frequency
table, independent interleaved blocks with checkpoints and checksums (see
``rans``). A document longer than a segment runs over several. A segment
row also holds its index: doc_ids, where each starts, the segment's number in
its file, its first id's place there and, if it holds a piece of such a long
document, the number of the segment where that begins (``run``).

Nothing but one segment of ids is held by a task. Where a file's ids start
in the whole is not written but summed from the files' index columns: one
row per file. Spark's committer makes a lost or repeated task's file appear once.

``read_digests`` and ``read_ids`` decode segments independently of each
other. The pieces of a document that runs over several are joined: CRC-32s
combine by the lengths of what follows them.

Defined results: a null text counts as empty (its only id is END); null ids
come last; rows that repeat an id are documents of their own, next to each
other; a null or empty table gives a folder without segments and an empty
result; other columns are not looked at; damaged bytes raise ValueError.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import byte_tokens, rans
from .common import read, shared_folder, slices, text_of

END = 2
SEGMENT = 1 << 20
SEGMENT_ROWS = ("part int, segment long, first_id long, n_ids long, doc_ids array<long>, doc_starts array<long>, "
                "run long, data binary")
ARROW = pa.schema([("part", pa.int32()), ("segment", pa.int64()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
                   ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64())), ("run", pa.int64()),
                   ("data", pa.binary())])
#: a document's ids in one segment
PIECE = pa.schema([("part", pa.int32()), ("run", pa.int64()), ("segment", pa.int64()), ("doc_id", pa.int64()),
                   ("first_id", pa.int64()), ("n_ids", pa.int64()), ("crc", pa.int64())])
PIECE_ROWS = "part int, run long, segment long, doc_id long, first_id long, n_ids long, crc long"
DIGEST = ["doc_id", "first_id", "n_ids", "crc"]


class _Writer:
    """Gathers the ids of whole documents into segments."""

    def __init__(self, part: int, limit: int):
        self.part, self.limit = part, limit
        self.number = self.first = 0
        self.clear()

    def clear(self) -> None:
        self.held, self.docs, self.starts, self.n = [], [], [], 0

    def close(self, run: int | None = None) -> pa.RecordBatch:
        row = [self.part, self.number, self.first, self.n, self.docs, self.starts, run, rans.encode(np.concatenate(self.held))]
        out = pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(row, ARROW)], schema=ARROW)
        self.number, self.first = self.number + 1, self.first + self.n
        self.clear()
        return out

    def add(self, docs: list, ids: np.ndarray, at: np.ndarray):
        """Segments that documents ``docs``, ids[at[i]:at[i + 1]], make full."""
        i = 0
        while i < len(docs):
            room = self.limit - self.n
            # all documents that still fit, at once
            k = int(np.searchsorted(at, at[i] + room, side="right")) - 1
            if k > i:
                self.docs += docs[i:k]
                self.starts += (self.n + at[i:k] - at[i]).tolist()
                self.held.append(ids[at[i]:at[k]])
                self.n += int(at[k] - at[i])
                i = k
                continue
            if self.n:
                yield self.close()
            if at[i + 1] - at[i] > self.limit:
                run = self.number
                for s in range(int(at[i]), int(at[i + 1]), self.limit):
                    own = ids[s:min(s + self.limit, int(at[i + 1]))]
                    self.docs, self.starts, self.held, self.n = [docs[i]], [0], [own], len(own)
                    yield self.close(run)
                i += 1


def _encode(batches, path: str, end: int, limit: int):
    writer = _Writer(TaskContext.get().partitionId(), limit)
    for batch in batches:
        for part in slices(batch, 1, rows=1 << 14, size=8 << 20):
            ids, at = byte_tokens.encode(part.column(1), path)
            n = part.num_rows
            ids = np.insert(ids, at[1:], end)
            yield from writer.add(part.column(0).to_pylist(), ids, at + np.arange(n + 1))
    if writer.n:
        yield writer.close()


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 end: int = END, segment: int = SEGMENT) -> None:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("row")]
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.select("doc_id", "text").mapInArrow(lambda b: _encode(b, tokenizer_path, end, segment), SEGMENT_ROWS).write.parquet(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The segment rows at ``path`` with the places of their first ids in the
    whole and the number of documents before them in their file."""
    rows = spark.read.schema(SEGMENT_ROWS).parquet(path)
    sizes = rows.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per file
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return rows.join(F.broadcast(before), "part").withColumn("first_id", F.col("first_id") + F.col("before")).drop("before")


def _pieces(batches, with_ids: bool):
    """A row per document of each segment."""
    schema = PIECE.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else PIECE
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_py() for n in ARROW.names}
            ids = rans.decode(row["data"]).astype("<u4", copy=False)
            if len(ids) != row["n_ids"]:
                raise ValueError(f"segment {row['segment']} of file {row['part']} holds {len(ids)} ids, not {row['n_ids']}")
            at = [*row["doc_starts"], len(ids)]
            n = len(row["doc_ids"])
            view = memoryview(ids).cast("B")
            crc = [zlib.crc32(view[4 * at[k]:4 * at[k + 1]]) for k in range(n)]
            cols = [[row["part"]] * n, [row["run"]] * n, [row["segment"]] * n, row["doc_ids"],
                    row["first_id"] + np.array(at[:-1], np.int64), np.diff(at), crc]
            cols = [pa.array(c, f.type) for c, f in zip(cols, PIECE)]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(cols, schema=schema)


def _times(matrix: list[int], vector: int) -> int:
    total = i = 0
    while vector:
        if vector & 1:
            total ^= matrix[i]
        vector >>= 1
        i += 1
    return total


def crc32_join(first: int, second: int, length: int) -> int:
    """The CRC-32 of two byte strings put together, from theirs and the
    second's length: ``length`` zero bytes, as powers of the one-bit shift
    over GF(2), move the first's."""
    shift = [0xEDB88320] + [1 << i for i in range(31)]
    bits = 8 * length
    while bits:
        if bits & 1:
            first = _times(shift, first)
        shift = [_times(shift, row) for row in shift]
        bits >>= 1
    return first ^ second


def _join(pieces: pa.Table) -> pa.Table:
    """The row of one document from its pieces."""
    rows = sorted(pieces.to_pylist(), key=lambda r: r["segment"])
    doc = rows[0]
    for r in rows[1:]:
        doc["crc"] = crc32_join(doc["crc"], r["crc"], 4 * r["n_ids"])
        doc["n_ids"] += r["n_ids"]
    return pa.Table.from_pylist([doc], schema=pa.schema([(c, pa.int64()) for c in DIGEST]))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files at ``path``."""
    rows = _segments(spark, path)
    decoded = lambda which: rows.filter(which).mapInArrow(lambda b: _pieces(b, False), PIECE_ROWS)
    # a long document's pieces are a few numbers each: one for SEGMENT ids
    long = decoded("run is not null").groupBy("part", "run").applyInArrow(_join, "doc_id long, first_id long, n_ids long, crc long")
    return decoded("run is null").select(*DIGEST).unionByName(long).select(
        "doc_id", F.col("first_id").alias("start"), F.col("n_ids").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and ids of every document; one that runs over several
    segments gives a row for each, with its own start."""
    rows = _segments(spark, path)
    return rows.mapInArrow(lambda b: _pieces(b, True), PIECE_ROWS + ", ids array<int>").select(
        "doc_id", F.col("first_id").alias("start"), "ids")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark, sf_dir):
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(read(spark, sf_dir, "documents"), folder, tokenizer_file())
    return read_digests(spark, folder)
