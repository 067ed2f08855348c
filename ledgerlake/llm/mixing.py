"""Mixing sources to target weights.

Tokens are summed per source, each source gets a target, its repetition rate
is target / size, and every document is emitted floor(rate) times plus once
more when its hash-seeded draw falls below the fraction of the rate. Only
built-in DataFrame functions run, and no document row meets another: the one
shuffle is that of partial sums per source.

Defined results: a null text has size 0; a null source is a source of its
own, last in order; sources without words have target 0 and rate 0; an empty
table gives an empty result; repeated rows draw alike; columns of the input
other than the named ones are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, cut, global_rank, text_of, uniform

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_RATE = 2
SEED = "mix-1"


def size_of(text: str) -> Column:
    return F.regexp_count(text_of(text), F.lit(NOT_SPACE + "+")).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size, weight, target) from (source, size) rows.

    The weights repeat over the sources in code-point order, null last. The
    common level starts at total / weights; sources whose share is above
    ``max_rate`` times their size stop there and the level rises for the
    rest. A source that stops stays stopped, so the loop ends; each round
    brings one row of three sums to the driver.
    """
    per_source = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
    ranked = global_rank(per_source, [F.col("source").asc_nulls_last()], "_rank")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    sources = cut(ranked.select("source", "source_size", w.alias("weight")))
    total, free = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    goal, stopped, level = share * total, -1, 0.0
    taken, cap = 0, F.col("source_size") * max_rate
    while free:
        level = (goal - taken) / free
        over = F.col("weight") * F.lit(level) > cap
        taken, free, now = sources.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
            F.count_if(over)).first()
        if now == stopped or (stopped < 0 and now == 0):
            break
        stopped = now
    target = F.least(F.col("weight") * F.lit(level), cap.cast("double"))
    return sources.withColumn("target", target if free else cap.cast("double"))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights=WEIGHTS, share: float = SHARE, max_rate: int = MAX_RATE, seed: str = SEED,
           carry: list[Column] | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target,
    copies and taken = size * copies, plus the ``carry`` columns."""
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        size_of(text_col).alias("size"), *(carry or []))
    targets = source_targets(sized.select("source", "size"), weights, share, max_rate)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    draw = uniform(F.lit(seed), F.col("doc_id"), F.col("size"))
    copies = F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)
    # few sources beside the documents: Spark broadcasts them when their
    # measured size allows it and otherwise splits a hot source's partition
    out = sized.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    return (out.withColumn("copies", copies.cast("long"))
            .withColumn("taken", F.col("size") * F.col("copies")).drop("_source", "weight"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as its copies say."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    out = decide(docs, carry=[row], **options).filter("copies > 0")
    return out.select(F.explode(F.array_repeat("_row", F.col("copies").cast("int"))).alias("_row")).select("_row.*")


ORACLE = r"""
WITH d AS (SELECT doc_id, source,
             CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST) AS k FROM w),
p AS (SELECT *, coalesce(sum(2 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
        sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
        1.5::DOUBLE * sum(source_size) OVER () AS goal FROM r),
l AS (SELECT *, (goal - c::DOUBLE) / rest::DOUBLE AS level FROM p),
f AS (SELECT min_by(level, k) AS level FROM l WHERE weight * level <= 2 * source_size),
t AS (SELECT source, source_size, least(weight * level, (2 * source_size)::DOUBLE) AS target FROM w, f),
j AS (SELECT doc_id, size, source_size, target,
        CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
        CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || CAST(size AS VARCHAR)), 1, 13) AS BIGINT)::DOUBLE
          / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM j
"""


def query(spark, sf_dir):
    from .common import read
    return decide(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
