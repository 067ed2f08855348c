"""Language ID by Bayesian evidence fusion.

A page's language is the one with the largest posterior under four kinds of
evidence: the likelihood of its visible text (hashed byte trigrams, naive
Bayes), the language its markup declares, its address suffix, and a prior of
its host. The text model is fitted on every labelled language, on a bounded
sample of its distinct texts; its table takes 0.26 MB a language. The other tables are sums of text posteriors over all pages,
grouped by declaration, by suffix, by domain and by host; the host prior is
smoothed towards its domain, the domain towards all pages. A page's own
posterior is taken out of the sums it is judged by.

Defined results: null or empty markup is no text evidence and no
declaration; a null or malformed URL is a host of its own name, "" ; ties go
to the language that is first in order; repeated rows each get their row; an
empty page table gives an empty result; without any labelled document the
language is null; other columns are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, read, slices, text_of
from .url_filter import host_of

BUCKETS = 1 << 16
#: bound of the fit: distinct texts per language; every labelled language is fitted
SAMPLE = 2000
#: trigrams that are scored at a time
CHUNK = 4096
#: text evidence counts as at most this many trigrams: trigrams of a text depend on each other
TEXT_MASS = 40.0
SMOOTH, HOST_MASS, DOMAIN_MASS = 1.0, 4.0, 20.0
_HIDDEN = re.compile(r"<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[A-Za-z#0-9]+;", re.S | re.I)
_DECLARED = r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})"


def codes(text: str) -> np.ndarray:
    b = np.frombuffer(" ".join(text.lower().split()).encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.uint32)
    h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA6B)) ^ (b[2:] * np.uint32(0xC2B2AE35))
    return (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log likelihood of each trigram bucket in each language)."""
    labelled = docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), text_of(text_col).alias("text"))
    labelled = labelled.withColumn("h", F.xxhash64("text"))
    sizes = {r["lang"]: r["count"] for r in labelled.select("lang", "h").distinct().groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((BUCKETS, 0), np.float32)
    # a hash draws about SAMPLE distinct texts of each language, whole; copies count once
    below = docs.sparkSession.createDataFrame([(x, int(min(1.0, SAMPLE / n) * (1 << 20))) for x, n in sizes.items()], "_lang string, below long")
    drawn = (labelled.join(F.broadcast(below), F.col("lang") == F.col("_lang")).filter(F.pmod("h", F.lit(1 << 20)) < F.col("below"))
             .select("lang", "text").distinct())
    place = {x: j for j, x in enumerate(langs)}

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                sums[lang] += np.bincount(codes(text), minlength=BUCKETS)
        for lang, n in sums.items():
            i = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(np.full(len(i), place[lang])), pa.array(n[i])], names=["i", "j", "n"])

    found = drawn.mapInArrow(count, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).toArrow()
    i, j, n = (found[c].to_numpy() for c in ("i", "j", "n"))
    table = np.full((BUCKETS, len(langs)), 0.5, np.float32)
    table[i, j] += n
    return langs, np.log(table / table.sum(axis=0, dtype=np.float64)).astype(np.float32)


def visible(html: str) -> str:
    return _HIDDEN.sub(" ", html)


def text_posteriors(pages: DataFrame, langs: list[str], table: np.ndarray, id_col: str, url_col: str, html_col: str) -> DataFrame:
    shared = pages.sparkSession.sparkContext.broadcast(table)  # BUCKETS numbers a language
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(F.col(url_col)).alias("host"),
                        F.lower(F.regexp_extract(text_of(html_col), _DECLARED, 1)).alias("declared"), text_of(html_col).alias("html"))

    def score(batches):
        table = shared.value
        for batch in batches:
            for part in slices(batch, 3):
                post = np.empty((part.num_rows, table.shape[1]))
                for i, html in enumerate(part.column(3).to_pylist()):
                    c = codes(visible(html))
                    s = sum((table[c[k:k + CHUNK]].sum(axis=0, dtype=np.float64) for k in range(0, len(c), CHUNK)), np.zeros(table.shape[1]))
                    s *= (min(len(c), TEXT_MASS) / max(1, len(c)))
                    e = np.exp(s - s.max())
                    post[i] = e / e.sum()
                lists = pa.FixedSizeListArray.from_arrays(pa.array(post.ravel()), table.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), lists], names=["page_id", "host", "declared", "post"])

    return rows.mapInArrow(score, "page_id long, host string, declared string, post array<double>")


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, lang, probability, text_lang, declared, suffix and host, one row per page."""
    langs, table = fit(docs)
    if not langs:
        return pages.select(F.col(id_col).cast("long").alias("page_id"), F.lit(None).cast("string").alias("lang"))
    n = len(langs)
    rows = text_posteriors(pages, langs, table, id_col, url_col, html_col)
    rows = cut(rows.withColumn("suffix", F.regexp_extract("host", r"\.([a-z0-9-]+)$", 1))
               .withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)))

    def sums(by: str, name: str) -> DataFrame:
        return rows.groupBy(by).agg(F.array(*[F.sum(F.col("post")[i]) for i in range(n)]).alias(name))

    total = rows.agg(*[F.coalesce(F.sum(F.col("post")[i]), F.lit(0.0)) for i in range(n)]).first()
    base = F.array(*[F.lit(float(total[i])) for i in range(n)])
    out = rows
    for by in ("declared", "suffix", "domain", "host"):
        out = out.join(sums(by, f"{by}_sum").withColumnRenamed(by, f"_{by}"), F.col(by) == F.col(f"_{by}"), "left")
    kinds = {by: rows.select(by).distinct().count() for by in ("declared", "suffix")}

    # arrays over the languages: the sums without the page's own posterior
    out = out.withColumn("all_sum", base)
    for name in ("all", "domain", "host", "declared", "suffix"):
        out = out.withColumn(f"{name}_rest", F.zip_with(f"{name}_sum", "post", lambda s, p: F.greatest(s - p, F.lit(0.0))))

    def size(name: str):
        return F.aggregate(f"{name}_rest", F.lit(0.0), lambda a, x: a + x)

    for name in ("all", "domain", "host"):
        out = out.withColumn(f"{name}_n", size(name))
    out = out.withColumn("overall", F.transform("all_rest", lambda r: (r + SMOOTH) / (F.col("all_n") + SMOOTH * n)))
    out = out.withColumn("by_domain", F.zip_with("domain_rest", "overall", lambda r, o: (r + DOMAIN_MASS * o) / (F.col("domain_n") + DOMAIN_MASS)))
    out = out.withColumn("prior", F.zip_with("host_rest", "by_domain", lambda r, d: (r + HOST_MASS * d) / (F.col("host_n") + HOST_MASS)))
    logs = F.zip_with("prior", "post", lambda q, p: F.ln(q) + F.ln(F.greatest(p, F.lit(1e-300))))
    for by in ("declared", "suffix"):
        mass = SMOOTH * kinds[by]
        told = F.zip_with(f"{by}_rest", "all_rest", lambda r, a: F.ln((r + SMOOTH) / (a + mass)))
        out = out.withColumn(f"{by}_told", F.when(F.col(by) != "", told))
        logs = F.when(F.col(f"{by}_told").isNull(), logs).otherwise(F.zip_with(logs, f"{by}_told", lambda a, t: a + t))
    out = out.select("page_id", "host", "suffix", "declared", "post", logs.alias("logs"))
    top = F.array_max("logs")
    names = F.array(*[F.lit(x) for x in langs])
    mass = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    return out.select("page_id", F.element_at(names, F.array_position("logs", top).cast("int")).alias("lang"),
                      (F.lit(1.0) / mass).alias("probability"),
                      F.element_at(names, F.array_position("post", F.array_max("post")).cast("int")).alias("text_lang"),
                      "declared", "suffix", "host")


def query(spark, sf_dir):
    return identify(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents"))
