"""Quality rules with risk-controlled thresholds.

Base counts come from each whole text. On top of two fixed base rules, every
score (symbol ratio, repeated-line ratio, repeated-word ratio) has a ladder
of cutoffs from lenient to strict, fixed beforehand. In each stratum
(declared languages and the rest) a cutoff is valid if the labelled clean
documents show, by the exact binomial tail, that it rejects at most ALPHA /
number of scores of clean documents: P(Binomial(n, alpha) <= rejected) is at
most the error level. The ladder is walked from its lenient end and stops at
the first cutoff that fails (fixed-sequence testing, which needs no further
correction inside a ladder); the error level of each ladder is DELTA divided
by the number of ladders (Bonferroni). With probability 1 - DELTA, no
stratum loses more than ALPHA of its clean documents to the selected rules.

All is done in DataFrame expressions. One pass computes the features, which
are cut; the labels are joined to these narrow rows; what reaches the driver
is one row per stratum and score, bounded by the parameters.

Defined results: a null or empty text has zero counts and fails the base
rule; ratios with a zero divisor are 0; unlabelled documents and labels
without a document change nothing; a document with several labels counts as
clean if any says so; without enough labels a stratum gets no cutoff and
only the base rules act; repeated rows each get their row.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, SPACE, cut, read, shared_folder, text_of

SYMBOLS = "#*$%&|<>"
STRATA = ("en", "de", "fr", "es")
ALPHA, DELTA = 0.015, 0.05
MIN_WORDS, MAX_REPEAT = 50, 50
#: fixed ladders, lenient to strict; a document is rejected if its score is above the cutoff
LADDERS = {
    "symbol_ratio": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01),
    "dup_line_ratio": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05),
    "repeat_ratio": (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08),
}


def _once(value: Column, f) -> Column:
    """``f`` of ``value``, the value being computed once per row."""
    return F.get(F.transform(F.array(value), f), 0)


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows whose three words occur at two or more places.

    Windows are hashed and the hashes sorted, so equal windows stand side by
    side. The places of repeated windows are then looked up directly where a
    text repeats only a few windows, and by sorting (hash, place) pairs
    elsewhere: n log n for any text. Each repeated place adds the words that
    the place before it has not covered."""
    n = F.size(words)
    zero = F.lit(0).cast("long")
    hashes = F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
                     F.lit(1), F.greatest(n - 2, F.lit(0)))

    def doubles(h: Column) -> Column:
        return _once(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, k: (k > 0) & (F.get(s, k - 1) == x))))

    def few(h: Column, d: Column) -> Column:
        at = F.transform(h, lambda x, i: F.when(F.array_contains(d, x), i))
        return F.filter(at, lambda i: i.isNotNull())

    def many(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda v, i: F.struct(v.alias("h"), i.alias("i"))))
        return _once(pairs, lambda p: F.array_sort(F.transform(F.filter(p, lambda x, k:
            ((k > 0) & (F.get(p, k - 1)["h"] == x["h"])) | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"])))

    def covered(places: Column) -> Column:
        return F.aggregate(places, F.struct(F.lit(-3).alias("last"), zero.alias("sum")),
                           lambda a, i: F.struct(i.alias("last"), (a["sum"] + F.least(F.lit(3), i - a["last"])).alias("sum")),
                           lambda a: a["sum"])

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), zero).otherwise(_once(doubles(h), lambda d: covered(
            F.when(F.size(d) <= 8, few(h, d)).otherwise(many(h)))))

    return F.when(n < 4, zero).otherwise(_once(hashes, count))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             carry: list[Column] | None = None) -> DataFrame:
    t = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"), F.col(lang_col).alias("_lang"), *(carry or []))
    t = t.withColumn("_words", F.array_remove(F.split("t", SPACE + "+"), ""))
    t = t.withColumn("_lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(NOT_SPACE)))
    stratum = F.when(F.col("_lang").isin(*STRATA), F.col("_lang")).otherwise(F.lit("other"))
    kept = [c for c in t.columns if c not in ("t", "_words", "_lines", "_lang")]
    out = t.select(
        *kept, stratum.alias("stratum"),
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        _repeat_words(F.col("_words")).alias("n_repeat_words"))
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))


def scores() -> dict[str, Column]:
    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(F.lit(0.0))
    return {"symbol_ratio": ratio("n_symbols", "word_chars"), "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
            "repeat_ratio": ratio("n_repeat_words", "n_words")}


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1: Stirling's series at x + 8, stepped back by the recurrence."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5.0)))
    steps = sum((F.ln(x + i) for i in range(1, 8)), F.ln(x))
    return (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + series - steps


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), exact up to rounding, for k < n p; 1 otherwise.

    Terms fall as j goes down from k; they are summed until the rest, a
    geometric series, is counted whole, so the value is never too small."""
    n, k = n.cast("double"), k.cast("double")
    top = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    terms = F.least(k, F.ceil(40 * F.sqrt(n * p) + 40).cast("double")).cast("int")
    step = F.aggregate(
        F.sequence(F.lit(0), terms), F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, j: F.struct((a["term"] * (k - j) / (n - k + j + 1) * ((1 - p) / p)).alias("term"),
                              (a["sum"] + a["term"]).alias("sum")),
        lambda a: a["sum"] + F.when(terms < k, a["term"] * n).otherwise(F.lit(0.0)))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * step))


def thresholds(feats: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff, n, rejected, bound): the strictest valid cutoff of each ladder that has one."""
    clean = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("_q")).filter("_q = 1")
    held = feats.filter("not base_failed").select("doc_id", "stratum", *[c.alias(k) for k, c in scores().items()]).join(
        clean, F.col("doc_id") == F.col("_id"))
    steps = [(rule, i, c) for rule, ladder in LADDERS.items() for i, c in enumerate(ladder)]
    counts = held.groupBy("stratum").agg(F.count("*").alias("n"), *[
        F.count_if(F.col(rule) > c).alias(f"{rule}__{i}") for rule, i, c in steps])
    table = counts.select("stratum", "n", F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("i"), F.lit(c).alias("cutoff"), F.col(f"{rule}__{i}").alias("rejected"))
        for rule, i, c in steps])).alias("s")).select("stratum", "n", "s.*")
    level = delta / ((len(STRATA) + 1) * len(LADDERS))
    tested = table.withColumn("bound", binomial_tail(F.col("n"), F.col("rejected"), alpha / len(LADDERS)))
    first_bad = tested.groupBy("stratum", "rule").agg(
        F.coalesce(F.min(F.when(F.col("bound") > level, F.col("i"))), F.lit(1 << 30)).alias("bad"))
    return (tested.join(first_bad, ["stratum", "rule"]).filter("i < bad").groupBy("stratum", "rule")
            .agg(F.max_by(F.struct("cutoff", "n", "rejected", "bound"), "i").alias("s")).select("stratum", "rule", "s.*"))


def decide(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, **cols) -> DataFrame:
    """features() plus kept; one row per row of ``docs``."""
    feats = cut(features(docs, **cols))
    return with_verdict(feats, labels, alpha, delta)


def verdict(feats: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> Column:
    # at most (strata + 1) x scores rows: a bound set by the parameters
    chosen = thresholds(feats, labels, alpha, delta).select("stratum", "rule", "cutoff").collect()
    by_rule = scores()
    over = [(F.col("stratum") == r["stratum"]) & (by_rule[r["rule"]] > r["cutoff"]) for r in chosen]
    rejected = F.col("base_failed")
    for x in over:
        rejected = rejected | x
    return ~rejected


def with_verdict(feats: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    return feats.withColumn("kept", verdict(feats, labels, alpha, delta))


def filter_docs(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    # a filter on computed counts would compute them once per mention, so rows and counts are written side by side
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    counted = features(docs, carry=[row])
    folder = f"{shared_folder(docs.sparkSession)}/quality-{uuid.uuid4().hex}"
    counted.write.parquet(folder)
    feats = docs.sparkSession.read.schema(counted.schema).parquet(folder)
    return feats.filter(verdict(feats, labels, alpha, delta)).select("_row.*")


def query(spark, sf_dir):
    return decide(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("n_lines")


def _oracle() -> str:
    ladder = ", ".join(f"('{rule}', {i}, {c}::DOUBLE)" for rule, xs in LADDERS.items() for i, c in enumerate(xs))
    strata = ", ".join(f"'{s}'" for s in STRATA)
    score = ("CASE rule WHEN 'symbol_ratio' THEN CASE WHEN word_chars > 0 THEN n_symbols::DOUBLE / word_chars ELSE 0 END "
             "WHEN 'dup_line_ratio' THEN CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END "
             "ELSE CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END END")
    p = f"({ALPHA}::DOUBLE / {len(LADDERS)})"
    level = f"({DELTA}::DOUBLE / {(len(STRATA) + 1) * len(LADDERS)})"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
    CASE WHEN lang IN ({strata}) THEN lang ELSE 'other' END AS stratum FROM documents),
e AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM e)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + o) AS c FROM rep, (SELECT unnest([0, 1, 2]) AS o) GROUP BY rid),
f AS (SELECT e.rid, doc_id, stratum, len(w) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
    coalesce(cov.c, 0) AS n_repeat_words FROM e LEFT JOIN cov ON cov.rid = e.rid),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed FROM f),
lad(rule, i, cutoff) AS (VALUES {ladder}),
sc AS (SELECT rid, stratum, base_failed, rule, {score} AS score
    FROM b, (SELECT DISTINCT rule FROM lad)),
clean AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1),
held AS (SELECT sc.* FROM sc JOIN b USING (rid) JOIN clean ON clean.doc_id = b.doc_id WHERE NOT b.base_failed),
cnt AS (SELECT h.stratum, l.rule, l.i, l.cutoff, count(*) AS n, count(*) FILTER (h.score > l.cutoff) AS k
    FROM held h JOIN lad l ON h.rule = l.rule GROUP BY ALL),
bnd AS (SELECT *, CASE WHEN k >= n * {p} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
    lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({p}) + (n - j) * ln(1 - {p})))) END AS bound FROM cnt),
bad AS (SELECT stratum, rule, coalesce(min(i) FILTER (bound > {level}), 1000000) AS bad FROM bnd GROUP BY ALL),
cut AS (SELECT stratum, rule, max_by(cutoff, i) AS cutoff FROM bnd JOIN bad USING (stratum, rule) WHERE i < bad GROUP BY ALL),
rej AS (SELECT DISTINCT rid FROM sc JOIN cut USING (stratum, rule) WHERE score > cutoff)
SELECT doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND rej.rid IS NULL AS kept FROM b LEFT JOIN rej USING (rid)
"""


ORACLE = _oracle()
