"""License scan: a trained paragraph classifier, confirmed by templates.

Paragraphs are lines with a word. A multinomial model (naive Bayes: a sum of weights) over
1- and 2-word n-grams, hashed by Spark's ``hash``, tells licence families from other prose. It is
trained on windows of the family templates (notices, and whole licence texts)
and on every paragraph without any word of licence talk: one pass counts its
n-grams, so the model takes the whole corpus and is of one size whatever the
corpus. A quarter of the documents is held out, all their paragraphs set the
cutoffs: for each family the smallest odds against prose (probability LEAST or
more) at which at most MAX_FALSE of the held-out prose would pass as that family.

A line is judged whole, and so are passages of it, so a notice or a whole
licence inside a line without breaks is found: runs of words whose 3-word
shingles stand in a template, and runs with gaps of up to GAP shingles
between them (names, years). The runs are sought at every word, before and
without the classifier. A line or passage is confirmed if it passes the
cutoff of its likeliest family and enough of its 3-word shingles are in a
template, or if all of them are in a notice; the template that holds most
names the family, the classifier among equals; fewer than BRIEF words are held against notices
only, as short phrases of a whole licence are common prose.

A line that has nothing confirmed is "unknown" if its probability of being a
licence is above a cutoff taken from all held-out documents without licence
talk: the largest probability over a document's lines is not above it in all but FALSE_UNKNOWN of
them. Each family counts once a line.

DataFrame functions only. The model weighs the lines that upper
bounds of their probability leave over: whole numbers for each n-gram, summed
over a line, first for all families at once, then for each. What it leaves is kept in
files, so the cutoffs take no pass of their own. Nothing is shuffled but the n-grams' counts, the parts of
lines that look like licence talk and the partial sums.
A row is known by its id and its text's digest, so a recomputed or
differently dealt input gives the same rows the same answers.

Defined results: a null or empty text has no paragraph and gives family
null, zero counts; a document with several families names the one with most
confirmed paragraphs, ties by name; repeated rows each get their row; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, text_of, written
from .licence_texts import TEXTS

BUCKETS = 1 << 13
MAX_FALSE, CONFIRM, LEAST = 0.001, 0.5, 0.3
#: one document in so many is held out; the part of those without licence talk that may be above the cutoff of "unknown"
HELD, FALSE_UNKNOWN = 4, 0.002
#: times that an n-gram of prose counts before it is seen; n-grams of prose that each family starts with, so that one
#: its templates lack speaks for prose; steps of one in the logarithm of the odds that cutoffs are set at
SMOOTH, START, ODDS_STEPS = 1.0, float(BUCKETS), 10
WINDOWS = (4, 5, 6, 8, 12, 20)
#: windows of whole licence texts, and how many starts of each size a text gives to the training
WHOLE_WINDOWS, STARTS = (12, 20, 40), 150
#: shingles between two parts of a passage, words below which notices alone confirm
GAP, BRIEF = 8, 10
#: shingles of the shortest notice
SHORTEST = 3
#: steps of one in the whole numbers that bound a probability
STEPS = 100
OTHER, UNKNOWN = "none", "unknown"
#: fixed values: opening words and usual notices of licence families
TEMPLATES = {
    "agpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation licensed under the gnu affero general public license version 3",
    "apache": "licensed under the apache license version 2 0 you may not use this file except in compliance with the license you may obtain a copy of the license at unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied released under the apache license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer released under the bsd license licensed under the bsd 3 clause license",
    "cc_by_nc": "licensed under cc by nc 4 0 this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc_by_sa": "licensed under cc by sa 4 0 this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc_by": "licensed under cc by 4 0 this work is licensed under a creative commons attribution 4 0 international license",
    "gpl": "this work is licensed under the gnu general public license version 3 this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "mit": "released under the mit license permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction licensed under the mit license",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at licensed under the mozilla public license version 2 0",
    "proprietary": "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by any means without the prior written permission of the publisher",
}
FAMILIES = sorted(TEMPLATES)
#: a paragraph without any of these is prose when the model is trained
TALK = r"(?i)licen[sc]|copyright|permission|warrant|redistribut|rights reserved|creative commons|\bgnu\b|\bmit\b"


def _words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def _shingles(texts: list[str]) -> list[str]:
    return sorted({" ".join(w[i:i + 3]) for w in map(_words, texts) for i in range(len(w) - 2)})


#: 3-word shingles of each family: notices, and notices with whole texts
NOTICES = {f: _shingles([t]) for f, t in TEMPLATES.items()}
WHOLE = {f: _shingles([t, *TEXTS.get(f, [])]) for f, t in TEMPLATES.items()}


def _among(shingles) -> str:
    """SQL list of shingles; they are letters, digits and spaces."""
    return "(" + ", ".join(f"'{s}'" for s in sorted(set(shingles))) + ")"


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def row_key(id_col: str, text_col: str) -> Column:
    """The same for the same id and text; rows that repeat both get the same answer."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.md5(text_of(text_col)))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lines; ``held``: of a held-out document, ``plain``: of one without licence talk."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"), row_key(id_col, text_col).alias("uid")).withColumn("held", held())
    rows = rows.withColumn("plain", F.when(F.col("held"), ~F.col("t").rlike(TALK)).otherwise(False))
    lines = rows.select("doc_id", "uid", "held", "plain", F.posexplode_outer(F.split("t", "\n")).alias("place", "line"))
    return lines.withColumn("words", tokens(F.col("line")))


def held() -> Column:
    return F.pmod(F.xxhash64(F.lit("held"), "uid"), F.lit(HELD)) == 0


def parts(lines: DataFrame) -> DataFrame:
    """The lines whole (part 0) and the passages of lines that stand in templates, with their words."""
    at = "concat_ws(' ', get(words, i), get(words, i + 1), get(words, i + 2))"
    every = _among(x for f in WHOLE.values() for x in f)
    notice = _among(x for f in NOTICES.values() for x in f)
    # most words of prose stand in no template at their place of a shingle: only the others are put together
    maybe = " and ".join(f"get(words, i + {j}) in {_among(x.split(' ')[j] for f in WHOLE.values() for x in f)}" for j in range(3))
    none = "cast(array() as array<int>)"
    hit = lines.withColumn("hits", F.expr(f"case when size(words) > {SHORTEST + 2} then filter(sequence(0, size(words) - 3), i -> {maybe} and {at} in {every}) else {none} end"))
    near = hit.withColumn("short", F.expr(f"case when size(hits) >= {SHORTEST} then filter(hits, i -> {at} in {notice}) else {none} end"))

    def runs(hits: str, gap: int, least: int) -> Column:
        h = F.col(hits)
        first = F.filter(h, lambda x, j: (j == 0) | (x - F.get(h, j - 1) > gap))
        last = F.filter(h, lambda x, j: (j == F.size(h) - 1) | (F.get(h, j + 1) - x > gap))
        return F.filter(F.arrays_zip(first.alias("a"), last.alias("b")), lambda r: F.size(F.filter(h, lambda x: x.between(r["a"], r["b"]))) >= least)

    empty = F.lit(None).cast("array<struct<a:int,b:int>>")
    spans = F.when(F.size("hits") >= SHORTEST, F.array_distinct(F.concat(
        runs("short", 1, SHORTEST), runs("short", GAP, SHORTEST), runs("hits", 1, BRIEF - 2), runs("hits", GAP, BRIEF - 2)))).otherwise(empty)
    cuts = F.transform(F.col("spans"), lambda r: F.slice(F.col("words"), r["a"] + 1, r["b"] - r["a"] + 3))
    whole = F.array(F.col("words"))
    spanned = near.withColumn("spans", spans)
    calm = F.when(F.col("held"), F.col("plain") | ~F.col("line").rlike(TALK)).otherwise(False).alias("calm")
    return spanned.select("doc_id", "uid", "place", "plain", calm, F.posexplode(F.when(F.col("spans").isNull(), whole).otherwise(F.concat(whole, cuts))).alias("part", "words"))


def grams(words: Column) -> Column:
    """The buckets of the 1- and 2-word n-grams, each once. The last word has no next one: its pair is the word itself."""
    def bucket(*w: Column) -> Column:
        return F.hash(*w).bitwiseAND(F.lit(BUCKETS - 1))

    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: bucket(a, b))
    return F.array_distinct(F.concat(F.transform(words, lambda w: bucket(w)), F.when(F.size(words) > 0, pairs).otherwise(F.expr("cast(array() as array<int>)"))))


def features(rows: DataFrame, buckets: Column | None = None) -> DataFrame:
    """``rows`` (words, ...) with features, a place for each bucket."""
    places = CountVectorizerModel.from_vocabulary([str(i) for i in range(BUCKETS)], inputCol="_places", outputCol="features", binary=True)
    buckets = grams(F.col("words")) if buckets is None else buckets
    return places.transform(rows.withColumn("_places", buckets.cast("array<string>"))).drop("_places")


def _hash(word: bytes, seed: int) -> int:
    """Spark's ``hash`` of a string: MurmurHash3 whose last bytes count one by one."""
    def turned(x: int, n: int) -> int:
        return (x << n | x >> 32 - n) & 0xFFFFFFFF

    whole = len(word) // 4 * 4
    for k in [*np.frombuffer(word[:whole], "<u4").tolist(), *(x & 0xFFFFFFFF for x in np.frombuffer(word[whole:], np.int8).tolist())]:
        seed = turned(seed ^ turned(k * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF, 13) * 5 + 0xE6546B64 & 0xFFFFFFFF
    seed ^= len(word)
    seed = (seed ^ seed >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    seed = (seed ^ seed >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return seed ^ seed >> 16


def gram_buckets(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(line, bucket) of lists of words, what ``grams`` gives, worked out without Spark: no job calls it, it states the buckets for tests."""
    found = set()
    for i, line in enumerate(words.to_pylist()):
        own = [w.encode() for w in line]
        codes = [_hash(w, 42) for w in own]
        found |= {(i, c % BUCKETS) for c in codes} | {(i, _hash(w, c) % BUCKETS) for c, w in zip(codes, own[1:])}
    both = np.array(sorted(found), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def may_pass(buckets: Column, model, least: float) -> Column:
    """False only where the probability of being prose is surely 1 - ``least`` or more.

    The odds against prose are a sum over the families, so at most their number times the
    largest. A family's are at most its weights against prose, here rounded up, summed over
    the n-grams; all of them at most the n-grams' largest weights."""
    weights, base = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    steps, start = np.ceil(STEPS * (weights[1:] - weights[0])).astype(int), STEPS * (base[1:] - base[0])
    need = STEPS * (np.log(least / (1 - least)) - np.log(len(start)))

    def reaches(own: np.ndarray, first: float) -> Column:
        table = F.split(F.lit(",".join(map(str, own.tolist()))), ",").cast("array<int>")  # one literal once folded
        return F.aggregate(buckets, F.lit(0), lambda total, b: total + F.get(table, b)) >= int(np.floor(need - first)) - 1

    any_family = reduce(Column.__or__, [reaches(x, y) for x, y in zip(steps, start)])
    return reaches(steps.max(axis=0), start.max()) & any_family


@dataclass
class Weights:
    """A linear model: a row of weights for each class, prose first."""
    coefficientMatrix: DenseMatrix
    interceptVector: DenseVector


def margins(buckets: Column, model) -> Column:
    """The sum of weights of each class."""
    def one(own: np.ndarray, first: float) -> Column:
        table = F.split(F.lit(",".join(map(repr, own.tolist()))), ",").cast("array<double>")  # one literal once folded
        return F.aggregate(buckets, F.lit(float(first)), lambda total, b: total + F.get(table, b))

    return F.array(*[one(x, y) for x, y in zip(model.coefficientMatrix.toArray(), model.interceptVector.toArray())])


def probable(rows: DataFrame, model, least: float = 0.0) -> DataFrame:
    """``rows`` (words, ...) with p, the model's probabilities; rows whose probability of being prose is below 1 - ``least``."""
    def once(x: Column, name: str) -> Column:
        # exploded from arrays of one: worked out once, mere columns would be for each use in a filter
        return F.explode(F.array(x)).alias(name)

    some = rows.select("*", once(grams(F.col("words")), "_grams"))
    some = some.filter(may_pass(F.col("_grams"), model, least)) if least else some
    each = some.select(*rows.columns, once(margins(F.col("_grams"), model), "_m"))
    each = each.select(*rows.columns, once(F.transform("_m", lambda x: F.exp(x - F.array_max("_m"))), "_e"))
    total = F.aggregate("_e", F.lit(0.0), lambda t, x: t + x)
    p = each.select(*rows.columns, once(F.transform("_e", lambda x: x / total), "p"))
    return p.filter(F.col("p")[0] < 1 - least) if least else p


def template_rows(spark: SparkSession) -> DataFrame:
    """Windows of several lengths and whole templates: of notices starting at every word, of licence texts at STARTS words."""
    rows = []
    for f, notice in TEMPLATES.items():
        w = _words(notice)
        rows += [(f, w[i:i + n]) for n in WINDOWS for i in range(max(1, len(w) - n + 1))] + [(f, w)]
        for text in TEXTS.get(f, []):
            w = _words(text)
            step = max(1, len(w) // STARTS)
            rows += [(f, w[i:i + n]) for n in WHOLE_WINDOWS for i in range(0, max(1, len(w) - n + 1), step)] + [(f, w)]
    return spark.createDataFrame(rows, "family string, words array<string>").filter(F.size("words") >= min(WINDOWS))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Weights, int, int]:
    """(model, held-out paragraphs of prose, held-out documents without licence talk)."""
    prose = paragraphs(docs, id_col, text_col).filter(~F.col("line").rlike(TALK) & (F.size("words") >= 2))
    # every paragraph's n-grams; a held-out paragraph counts as one of bucket -1
    found = prose.select(F.explode(F.when(F.col("held"), F.array(F.lit(-1))).otherwise(grams(F.col("words")))).alias("bucket"))
    own = template_rows(docs.sparkSession).select("family", F.explode(grams(F.col("words"))).alias("bucket"))
    counts = np.zeros((1 + len(FAMILIES), BUCKETS + 1))  # the last place is that of bucket -1
    for family, bucket, n in found.select(F.lit(OTHER).alias("family"), "bucket").unionByName(own).groupBy("family", "bucket").count().collect():
        counts[[OTHER, *FAMILIES].index(family), bucket] = n
    lines, counts = int(counts[0, -1]), counts[:, :-1]
    counts[0] += SMOOTH
    counts[1:] += START * counts[0] / counts[0].sum()
    weights = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    # prose is as likely as all families together, whatever the corpus
    base = np.log([0.5, *[0.5 / len(FAMILIES)] * len(FAMILIES)])
    text = text_of(text_col)
    plain = docs.withColumn("uid", row_key(id_col, text_col)).filter(held()).filter(~text.rlike(TALK) & text.rlike(r"[\p{L}\p{N}]")).count()
    return Weights(DenseMatrix(*weights.shape, weights.ravel(order="F")), DenseVector(base)), lines, plain


def log_odds(p: Column) -> Column:
    """ln(p / p[0]); that of a probability too small to be written is taken as ``1e-300``."""
    return F.log(F.greatest(p, F.lit(1e-300))) - F.log(F.greatest(F.col("p")[0], F.lit(1e-300)))


def cutoff(steps: Iterable[tuple[int, int]], most: int) -> float | None:
    """The smallest odds that at most ``most`` rows are above, from (odds in steps, rows); None if there are no more rows."""
    above = 0
    for step, n in sorted(steps, reverse=True):
        above += n
        if above > most:
            return step / ODDS_STEPS
    return None


def cutoffs(weighed: DataFrame, lines: int, plain: int) -> tuple[dict[str, float], float]:
    """(log odds of each family, of "unknown") that held-out prose passes in MAX_FALSE of its lines, FALSE_UNKNOWN of its documents.

    ``weighed`` holds every line whose probability of being a licence is above one half; no other can pass."""
    def step(odds: Column) -> Column:
        return F.ceil(odds * ODDS_STEPS).cast("int")

    whole = weighed.filter(F.col("part") == 0)
    each = F.array(*[F.struct(F.lit(f).alias("family"), step(log_odds(F.col("p")[i + 1])).alias("step"), F.col("p")[i + 1].alias("own")) for i, f in enumerate(FAMILIES)])
    by_line = whole.filter("calm").select(F.inline(each)).filter(F.col("own") > LEAST).select("family", "step")
    by_doc = whole.filter("plain").groupBy("uid", "place").agg(F.first(log_odds(1 - F.col("p")[0])).alias("odds"), F.count("*").alias("n")) \
        .groupBy("uid").agg(step(F.max("odds")).alias("step"), F.max("n").alias("n"))
    # at most a few thousand steps; a document that comes twice counts twice
    rows = by_line.groupBy("family", "step").agg(F.count("*").alias("n")).unionByName(
        by_doc.groupBy("step").agg(F.sum("n").alias("n")).select(F.lit(UNKNOWN).alias("family"), "step", "n")).collect()
    steps = {f: [(r.step, r.n) for r in own] for f, own in groupby(sorted(rows, key=lambda r: r.family), key=lambda r: r.family)}
    lowest = float("-inf")
    of = {f: cutoff(steps.get(f, []), int(MAX_FALSE * lines)) for f in FAMILIES}
    unsure = cutoff(steps.get(UNKNOWN, []), int(FALSE_UNKNOWN * plain))
    return {f: lowest if c is None else c for f, c in of.items()}, max(0.0, lowest if unsure is None else unsure)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, uid, place, family, probability and confirmed of each line that is not prose, a row for each family confirmed in it."""
    model, n_lines, n_plain = train(docs, id_col, text_col)
    # lines more likely prose than not are nothing, whatever the cutoffs
    weighed = written(probable(parts(paragraphs(docs, id_col, text_col).filter(F.size("words") > 0)), model, 0.5), "license_scan")
    least, unsure = cutoffs(weighed, n_lines, n_plain)
    best = F.array_max(F.slice("p", 2, len(FAMILIES)))
    place = F.array_position(F.slice("p", 2, len(FAMILIES)), best).cast("int")
    guess = weighed.select("doc_id", "uid", "place", "part", "words", best.alias("probability"), log_odds(1 - F.col("p")[0]).alias("licence"),
                     F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), place).alias("guess"),
                     ((best > LEAST) & (log_odds(best) > F.element_at(F.array(*[F.lit(least[f]) for f in FAMILIES]), place))).alias("sure"))

    def shingles(words: Column) -> Column:
        k = F.size(words)
        return F.when(k < 3, F.array(F.array_join(words, " "))).otherwise(F.array_distinct(F.transform(
            F.sequence(F.lit(0), F.greatest(k - 3, F.lit(0))), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))))

    def shares(template: dict[str, list[str]]) -> Column:
        return F.array(*[F.expr(f"size(filter(own, s -> s in {_among(template[f])})) / size(own)") for f in FAMILIES])

    names = F.array(*[F.lit(f) for f in FAMILIES])
    own = guess.withColumn("own", shingles(F.col("words")))
    held = own.withColumn("of_all", shares(WHOLE)).withColumn("of_notices", shares(NOTICES))
    held = held.withColumn("shares", F.when(F.size("words") < BRIEF, F.col("of_notices")).otherwise(F.col("of_all")))
    all_in_notice = (F.size("words") >= 3) & (F.array_max("of_notices") == 1)
    top = F.array_max("shares")
    fits = F.filter(names, lambda f: F.element_at("of_all", F.array_position(names, f).cast("int")) >= CONFIRM)
    # the template that holds most of the words names the family, the classifier among equals
    named = F.when(F.element_at("shares", F.array_position(names, F.col("guess")).cast("int")) == top, F.col("guess")).otherwise(
        F.element_at(names, F.array_position("shares", top).cast("int")))
    judged = held.select("doc_id", "uid", "place", "part", "probability", "licence", F.size("words").alias("n"), named.alias("family"), fits.alias("fits"),
                         ((F.col("sure") & (top >= CONFIRM)) | all_in_notice).alias("confirmed"))
    judged = judged.filter(F.col("confirmed") | ((F.col("part") == 0) & (F.col("licence") > unsure)))
    # a line's families, each once; unknown if none is confirmed
    line = judged.groupBy("uid", "place").agg(
        F.first("doc_id").alias("doc_id"), F.max("probability").alias("likely"),
        F.collect_list(F.when(F.col("confirmed"), F.struct("n", "family", "probability", "fits"))).alias("sure"))
    # words that the family of the line's longest part explains as well say nothing of another family
    main = F.array_max("sure")["family"]
    kept = line.withColumn("sure", F.filter("sure", lambda x: (x["family"] == main) | ~F.array_contains(x["fits"], main)))
    each = F.transform(F.array_distinct(F.transform("sure", lambda x: x["family"])), lambda f: F.struct(f.alias("family"), F.array_max(F.transform(
        F.filter("sure", lambda x: x["family"] == f), lambda x: x["probability"])).alias("probability"), F.lit(True).alias("confirmed")))
    unknown = F.array(F.struct(F.lit(UNKNOWN).alias("family"), F.col("likely").alias("probability"), F.lit(False).alias("confirmed")))
    return kept.select("doc_id", "uid", "place", F.inline(F.when(F.size("sure") > 0, each).otherwise(unknown)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, family, families, n_licence, n_confirmed, n_unknown."""
    found = classify(docs, id_col, text_col)
    ids = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("uid"))
    counts = found.groupBy("uid", "family").agg(F.count("*").alias("n"))
    known = F.col("family") != UNKNOWN
    per_doc = counts.groupBy(F.col("uid").alias("_uid")).agg(
        F.min(F.when(known, F.struct((-F.col("n")).alias("n"), "family"))).alias("top"),
        F.array_sort(F.collect_set(F.when(known, F.col("family")))).alias("families"),
        F.sum("n").alias("n_licence"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("n_confirmed"))
    zero = F.lit(0).cast("long")
    return ids.join(per_doc, F.col("uid") == F.col("_uid"), "left").select(
        "doc_id", F.coalesce(F.col("top.family"), F.when(F.col("n_licence") > 0, F.lit(UNKNOWN))).alias("family"),
        F.array_join("families", ",").alias("families"), F.coalesce("n_licence", zero).alias("n_licence"),
        F.coalesce("n_confirmed", zero).alias("n_confirmed"), (F.coalesce("n_licence", zero) - F.coalesce("n_confirmed", zero)).alias("n_unknown"))


def query(spark, sf_dir):
    return scan(read(spark, sf_dir, "documents"))
