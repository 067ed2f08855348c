"""Exact dedup by a tree merge of digest runs.

Every partition turns its rows into a run: one entry per distinct digest
with the smallest row of that text and the number of rows. Runs are then
exchanged in rounds: in each round FANIN neighbouring lanes become one, and
their runs are merged by digest in a hash aggregation (nothing is sorted),
the smallest identifier and the sums being kept. The number of lanes falls by FANIN a round until one is left. A round
is dealt by (digest, lane), so no task holds a whole run, and a text that a
third of all rows share has at most one entry per lane from the first round
on. An entry's key is the SHA-256 and, as verification, the length and a
second 64-bit hash of the same text: texts that differ in any of these are
never merged, at any level.

Defined results: a null text counts as empty; a null id is larger than any
other; of rows that repeat both text and id exactly one stays; an empty
table gives an empty result; other columns are carried, never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, cut, read, text_of

FANIN = 8
KEY = ["sha", "n_chars", "check"]


def normalised(text: str) -> Column:
    return F.regexp_replace(text_of(text), SPACE + "+", " ")


def key_columns(text: Column) -> list[Column]:
    return [F.sha2(text, 256).alias("sha"), F.length(text).alias("n_chars"), F.xxhash64(text).alias("check")]


def merge(runs: DataFrame, lane: Column | None) -> DataFrame:
    by = KEY if lane is None else [*KEY, lane.alias("lane")]
    return runs.groupBy(*by).agg(F.min("first").alias("first"), F.sum("n").alias("n"))


def tree_merge(rows: DataFrame, fanin: int = FANIN) -> DataFrame:
    """(sha, n_chars, check, first, n): one entry per distinct text of
    ``rows`` (KEY, lane, first), ``lane`` being 0 .. lanes - 1."""
    lanes = (rows.agg(F.max("lane")).first()[0] or 0) + 1
    runs = merge(rows.withColumn("n", F.lit(1).cast("long")), F.col("lane"))
    while lanes > fanin:
        runs = merge(runs, F.floor(F.col("lane") / fanin).cast("int"))
        lanes = -(-lanes // fanin)
    return merge(runs, None)


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fanin: int = FANIN) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 and uid."""
    keyed = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("t"))
    rows = cut(keyed.select("doc_id", *key_columns(F.col("t")), F.monotonically_increasing_id().alias("uid"),
                            F.spark_partition_id().alias("lane")))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid").alias("first")
    # entries of single rows need no answer from elsewhere
    groups = tree_merge(rows.select(*KEY, "lane", first), fanin).filter("n > 1")
    out = rows.join(groups.select(*KEY, "first", "n"), KEY, "left")
    return out.select(
        "doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("first.uid") == F.col("uid"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"), "uid")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fanin: int = FANIN) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Only texts of groups (two rows or more) are looked up again: the first
    row of each group is kept, the rest fall out by an anti-join on
    (id, text key)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    verdict = decide(docs, id_col, text_col, fanin)
    # a losing row is known by its id; a row that repeats a kept row wholly
    # shares its id, so rows of an id with a kept and a lost row are told apart by key below
    lost = verdict.filter("not kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n_lost"))
    stay = verdict.filter("kept").select("doc_id", "text_sha256", F.lit(True).alias("stays"))
    fate = lost.join(stay, (lost["doc_id"].eqNullSafe(stay["doc_id"])) & (lost["text_sha256"] == stay["text_sha256"]), "left")
    fate = fate.select(lost["doc_id"].alias("_id"), lost["text_sha256"].alias("_sha"), F.coalesce("stays", F.lit(False)).alias("_stays"))
    keyed = docs.select(row, F.col(id_col).alias("_k"), F.sha2(normalised(text_col), 256).alias("_s"))
    marked = keyed.join(fate, F.col("_k").eqNullSafe(F.col("_id")) & (F.col("_s") == F.col("_sha")), "left")
    whole = marked.filter("_stays is null").select("_row.*")
    twice = marked.filter("_stays").dropDuplicates(["_k", "_s"]).select("_row.*")
    return whole.unionByName(twice)


ORACLE = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM t
"""


def query(spark, sf_dir):
    return decide(read(spark, sf_dir, "documents")).drop("uid")
