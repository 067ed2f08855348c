"""The training-data operators against brute force, and their edge cases."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from ledgerlake.llm import (exact_dedup, language_id, license_scan, mixing, ngram_join, packing, pii, quality,
                            queries, suffix_dedup, url_filter)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua " * 6


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and clashing columns."""
    long = " ".join(f"w{i * i % 997}x{i}" for i in range(30000))
    rows = [(1, None, "en", "a"), (2, "", "en", None), (3, " \t\n", None, "a"), (4, BASE, "en", "a"), (5, BASE, "en", "a"), (5, BASE, "en", "a"),
            (6, "prefix words here " + BASE, "xx", "b"), (7, long, "en", "b"), (None, "a few words", "de", "b"), (8, "one two", "en", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clash = {c: F.lit("x") for c in ("size", "taken", "kept", "n_words", "uid", "sha", "_row", "cls", "key", "n", "piece", "lane")}
    return df.withColumns(clash)


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    first = "page_id" if "page_id" in cols else "doc_id"
    want, got = (x[cols].sort_values(first).reset_index(drop=True) for x in (want, got))
    for c in cols:
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        assert same.all(), (c, got[~same].head(), want[~same].head())


def test_mixing_edges(spark, odd):
    out = mixing.decide(odd).collect()
    assert len(out) == 10 and all(r.taken <= 2 * r.size for r in out)
    by = {r.doc_id: r for r in out}
    assert by[1].size == 0 and by[2].source_size == 0 and by[2].target == 0
    assert mixing.mix(odd).columns == odd.columns
    assert mixing.decide(odd.limit(0)).count() == 0


def test_source_targets_share_the_excess(spark):
    rows = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000)], "source string, size long")
    t = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert t["a"] == 20 and abs(t["b"] + t["c"] - (1.5 * 2010 - 20)) < 1e-6 and abs(t["c"] - 2 * t["b"]) < 1e-6 or t["c"] == 2000


def test_exact_dedup_edges(spark, odd):
    out = exact_dedup.decide(odd, fanin=2).collect()
    assert len(out) == 10
    same = [r for r in out if r.doc_id in (4, 5)]
    assert {r.keep_id for r in same} == {4} and {r.group_size for r in same} == {3} and sum(r.kept for r in same) == 1
    assert {r.keep_id for r in out if r.doc_id in (1, 2)} == {1}
    kept = exact_dedup.dedup(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in out)
    assert exact_dedup.decide(odd.limit(0)).count() == 0


def test_quality_edges_and_bound(spark, odd):
    labels = spark.createDataFrame([(4, 1, 0), (7, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.decide(odd, labels).collect()
    assert len(out) == 10 and {r.doc_id for r in out if r.kept} == {7}
    assert quality.filter_docs(odd, labels).columns == odd.columns
    assert quality.decide(odd.limit(0), labels.limit(0)).count() == 0
    from math import comb
    p = quality.ALPHA / 3
    rows = spark.createDataFrame([(n, k) for n in (50, 400, 3000) for k in (0, 1, 5, 9)], "n long, k long")
    for r in rows.withColumn("b", quality.binomial_tail(F.col("n"), F.col("k"), p)).collect():
        want = 1.0 if r.k >= r.n * p else sum(comb(r.n, j) * p**j * (1 - p)**(r.n - j) for j in range(r.k + 1))
        assert abs(r.b - want) < 1e-9


def test_packing_round_trip(spark, odd):
    out = packing.pack_docs(odd).collect()
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.tokenizer_file())
    t.encode_special_tokens = True
    want = Counter()
    for d, x in texts(odd):
        ids = np.array(t.encode(x, add_special_tokens=False).ids + [1], "<u4")
        for k, s in enumerate(range(0, len(ids), 4096)):
            want[d, k, s, len(ids[s:s + 4096]), zlib.crc32(ids[s:s + 4096].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    ends = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096
    assert packing.pack_docs(odd.limit(0)).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    lengths = np.sort(np.random.default_rng(1).integers(1, 900, 400))[::-1]
    caps = (1000, 3, 900_000)
    bins, offset = packing.best_fit(lengths, caps, rule=rule)
    for b in set(bins.tolist()):
        own = lengths[bins == b]
        assert own.sum() <= 1000 and len(own) <= 3 and (own**2).sum() <= 900_000


def test_words_are_tokenized_as_in_their_text():
    import pyarrow as pa
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.tokenizer_file())
    t.encode_special_tokens = True
    rows = ["Éa ñ'd it's ÀÉ. straße, İx ΑΣ éa <|endoftext|> x9y (a), I'll!?", "", "tab\there nb   em", "ﬁ ª º Ǆ"]
    ids, at = packing.encode_batch(pa.array(rows), packing.tokenizer_file())
    for i, x in enumerate(rows):
        assert ids[at[i]:at[i + 1]].tolist() == t.encode(x, add_special_tokens=False).ids


def brute_removed(rows):
    seen = Counter(b[i:i + 200] for _, b in rows for i in range(len(b) - 199))
    out = []
    for d, b in rows:
        cov = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                cov[i:i + 200] = b"\1" * 200
        out.append((d, len(b), sum(cov), len(re.findall(b"\1+", bytes(cov))), hashlib.sha256(bytes(x for x, c in zip(b, cov) if not c)).hexdigest()))
    return Counter(out)


def test_suffix_dedup_equals_brute_force(spark, odd, monkeypatch):
    want = brute_removed([(d, x.encode()) for d, x in texts(odd)])
    # usual; every anchor hot; no more than a row of an anchor held; all lists filled from all documents
    for limits in ({}, {"HOT": 1}, {"HELD": 1}, {"SAMPLED": 1.0, "CROWD_COPIES": 2, "CROWD_KINDS": 2}, {"SAMPLED": 1.0, "CROWD_COPIES": 3, "CROWD_KINDS": 1, "HELD": 2}):
        with monkeypatch.context() as m:
            for name, value in limits.items():
                m.setattr(suffix_dedup, name, value)
            assert Counter(tuple(r) for r in suffix_dedup.decide(odd).collect()) == want, limits
    assert suffix_dedup.decide(odd.limit(0)).count() == 0


def test_a_passage_among_many_neighbours_is_dealt_by_context(spark, monkeypatch):
    rng = np.random.default_rng(8)
    word = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    shared, short = word(230), word(120)
    rows = [(i, word(150) + (shared if i % 2 else short) + word(150)) for i in range(60)] + [(100 + i, shared + "x" * (i % 3)) for i in range(20)] + [(0, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_removed([(d, (x or "").encode()) for d, x in rows])
    for limits in ({}, {"HOT": 4, "HELD": 6}, {"SAMPLED": 1.0, "CROWD_COPIES": 4, "CROWD_KINDS": 4, "LISTED": 3}):
        with monkeypatch.context() as m:
            for name, value in limits.items():
                m.setattr(suffix_dedup, name, value)
            assert Counter(tuple(r) for r in suffix_dedup.decide(docs).collect()) == want, limits


def test_merged_transforms_find_repeats_across_shards():
    rng = np.random.default_rng(3)
    seed = rng.integers(97, 100, 700).astype(np.uint8)
    strings = [np.concatenate([rng.integers(97, 100, 40).astype(np.uint8), seed[a:a + 260], rng.integers(97, 100, 30).astype(np.uint8)]) for a in range(0, 400, 7)]
    seen = Counter(s.tobytes()[i:i + 200] for s in strings for i in range(len(s) - 199))
    for shard in (1 << 20, 900):
        for s, m in zip(strings, suffix_dedup.repeated_starts(strings, shard)):
            assert m.tolist() == [seen[s.tobytes()[i:i + 200]] > 1 for i in range(len(s) - 199)]


def brute_components(rows):
    sets = []
    for d, x in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), x))
        sets.append((d, {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    comp = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j][1])
            if a and sets[j][1] and 100 * n >= 75 * (len(a) + len(sets[j][1]) - n):
                x, y = comp[i], comp[j]
                comp = [min(x, y) if c in (x, y) else c for c in comp]
    low = {}
    for (d, _), c in zip(sets, comp):
        low[c] = min(x for x in (low.get(c), d) if x is not None) if (low.get(c), d) != (None, None) else None
    return Counter((d, len(s), low[c] if s else d) for (d, s), c in zip(sets, comp))


def test_ngram_join_equals_brute_force(spark, odd):
    words = BASE.split()
    near = [(100 + i, " ".join(words[:i] + [f"new{i}"] + words[i + 1:]), "en", "a") for i in range(0, 100, 9)]
    docs = odd.select("doc_id", "text", "lang", "source").union(spark.createDataFrame(near, "doc_id long, text string, lang string, source string"))
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.decide(docs).collect())
    assert got == brute_components(texts(docs))
    stay = ngram_join.one_of_each(odd)
    assert stay.columns == odd.columns and {r.doc_id for r in stay.collect()} >= {1, 2, 3, 4, 7}
    assert ngram_join.decide(odd.limit(0)).count() == 0


def brute_links(rows):
    """Linked pairs of different sets, and the number of links of each row's set."""
    sets = {}
    for d, x in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), x))
        s = frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
        sets.setdefault(s, []).append(d)
    own = [s for s in sets if s]
    linked = [(a, b) for i, a in enumerate(own) for b in own[:i] if 100 * len(a & b) >= 75 * len(a | b)]
    degree = Counter(s for pair in linked for s in pair)
    return linked, sets, Counter((d, degree[s]) for s, ids in sets.items() for d in ids)


@pytest.mark.parametrize("block, shingles", [(512, 1 << 20), (5, 1 << 20), (512, 2000)])
def test_ngram_join_counts_all_links(spark, odd, monkeypatch, block, shingles):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", block)
    monkeypatch.setattr(ngram_join, "LINK_CLASSES", block)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", shingles)
    words = [f"u{i}" for i in range(120)]
    # all linked to each other, then a chain whose ends are not
    near = [(100 + i, " ".join(words[:i] + [f"new{i}"] + words[i + 1:])) for i in range(0, 30)]
    chain = [(200 + i, " ".join(f"c{j}" for j in range(6 * i, 6 * i + 100))) for i in range(8)]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([*near, *near[:3], *chain], "doc_id long, text string"))
    linked, sets, want = brute_links(texts(docs))
    assert len(linked) > 30 * 29 // 2
    got = ngram_join.decide(docs).collect()
    assert Counter((r.doc_id, r.n_links) for r in got) == want
    if block == 5:
        low = {s: min((d for d in ids if d is not None), default=None) for s, ids in sets.items()}
        pairs = Counter(frozenset((r.a, r.b)) for r in ngram_join.all_links(docs).collect())
        assert pairs == Counter(frozenset((low[a], low[b])) for a, b in linked)


def test_ngram_join_of_unlinked_near_copies(spark, monkeypatch):
    """A group whose texts mostly miss the threshold, over many blocks, cells and folds."""
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 7)
    monkeypatch.setattr(ngram_join, "CELL", 16)
    monkeypatch.setattr(ngram_join, "FOLD", 50)
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(120)]

    def changed(i, times):
        words = list(base)
        for at in rng.integers(0, len(words), times):
            words[at] = f"x{i}y{at}"
        return " ".join(words)

    rows = [(i, changed(i, 2 + i % 6)) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows)
    assert 3 < len({c for _, _, c in want}) < 80
    got = ngram_join.decide(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert Counter((r.doc_id, r.n_links) for r in got) == brute_links(rows)[2]


def test_tree_bounds_lose_no_pair():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 6, (30, ngram_join.GROUPS))
    points = np.repeat(base, 10, axis=0) + (rng.random((300, ngram_join.GROUPS)) < 0.1)
    sizes, comps = points.sum(axis=1), np.arange(300)
    got = {tuple(sorted(p)) for a, b in ngram_join.Tree(points, sizes, comps).pairs() for p in zip(a.tolist(), b.tolist())}
    assert got == {(i, j) for i in range(300) for j in range(i + 1, 300) if 7 * np.minimum(points[i], points[j]).sum() >= 3 * (sizes[i] + sizes[j])}


def test_pii_disguises_map_back(spark, odd):
    text = "mail bob [at] example [dot] com or bоb@ex.org, 4111 1111 1111 1111, 1.2.3.4.5 and 300.1.1.1, +49 (30) 1234-5678"
    base = pii.find(text)
    assert [(pii.KINDS[k], text[a:b]) for a, k, b in base] == [
        ("email", "b@ex.org"), ("card", "4111 1111 1111 1111"), ("ip", "1.2.3.4"), ("phone", "+49 (30) 1234-5678")]
    assert [text[a:b] for a, _, b in pii.hidden(text, base)] == ["bob [at] example [dot] com"]
    wide = "see ｂｏｂ＠example.com and +four nine one five one two three four five six seven"
    assert [wide[a:b] for a, _, b in pii.hidden(wide, [])] == ["ｂｏｂ＠example.com", "+four nine one five one two three four five six seven"]
    out = pii.scan(odd).collect()
    assert len(out) == 10 and {r.base_sha256 for r in out if r.doc_id == 1} == {hashlib.sha256(b"").hexdigest()}
    assert pii.scan(odd.limit(0)).count() == 0


@pytest.mark.parametrize("text, want", [
    ("mail jоhn.smith@example.com now", ["jоhn.smith@example.com"]),
    ("card ４111 1111 1111 1111 ok", ["４111 1111 1111 1111"]),
    ("call +49 30 one two three 4567 89 now", ["+49 30 one two three 4567 89"]),
    ("ruf +49, eins zwei drei, 30 4567 89", ["+49, eins zwei drei, 30 4567 89"]),
    ("bob [arroba] ejemplo [punto] com", ["bob [arroba] ejemplo [punto] com"]),
    ("bob arroba ejemplo punto com punto mx", ["bob arroba ejemplo punto com punto mx"]),
    ("bob arobase exemple.fr", ["bob arobase exemple.fr"]),
    ("bob [ät] beispiel punkt de", ["bob [ät] beispiel punkt de"]),
    ("two ４111 1111 1111 1111", ["４111 1111 1111 1111"]),
    ("bob@ex.fr point de vente", []), ("in 2019 one man had 3 cats", []),
])
def test_pii_adds_what_no_base_span_holds(text, want):
    base = pii.find(text)
    assert [text[a:b] for a, _, b in pii.added(text, base)] == want
    batch = pa.record_batch({"doc_id": [1], "text": [text]})
    row = next(pii._scan([batch])).to_pylist()[0]
    assert row["n_added"] == len(want) and row["spans"] == pii.joined(base + pii.added(text, base))


def test_url_filter_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.x.com/p/q?z", 10), (2, None, 10), (3, "not a url", 10), (4, "https://X.com:80/", 5), (4, "https://X.com:80/", None)],
                                  "page_id long, url string, t long").withColumn("n", F.lit(1))
    events = spark.createDataFrame([("x.com", 6, True), ("x.com", 11, False), ("a.x.com/p", 1, True), (None, 1, True), ("a.x.com/p", 2, True)], "pattern string, at long, listed boolean")
    got = {(r.page_id, r.blocked, r.n_entries, r.pattern) for r in url_filter.filter_urls(pages, events, time_col="t").collect()}
    assert got == {(1, True, 2, "a.x.com/p"), (2, False, 0, None), (3, False, 0, None), (4, False, 0, None)}
    assert url_filter.filter_urls(pages.limit(0), events).count() == 0 if "fetched_at" in pages.columns else True


def test_url_filter_asks_deep_hosts_and_long_paths(spark):
    urls = ["http://a.b.c.d.e.f.g.h.i.example.com/x", "http://" + ".".join(f"l{i}" for i in range(100)) + ".spam.org/",
            "http://www.p.net/a/b/c/d?q", "http://x.example.net/a", "http://other.com/a/b"]
    pages = spark.createDataFrame([(i, u, 10) for i, u in enumerate(urls)], "page_id long, url string, t long")
    events = spark.createDataFrame([(p, 1, True) for p in ("example.com", "spam.org", "www.p.net/a/b/c", "p.net/a/b/c/d", "example.net/a", "other.com/a/b/c")],
                                   "pattern string, at long, listed boolean")
    got = {r.page_id: (r.n_entries, r.pattern) for r in url_filter.filter_urls(pages, events, time_col="t").collect()}
    assert got == {0: (1, "example.com"), 1: (1, "spam.org"), 2: (2, "www.p.net/a/b/c"), 3: (1, "example.net/a"), 4: (0, None)}
    none = url_filter.filter_urls(pages, events.limit(0), time_col="t").collect()
    assert len(none) == 5 and not any(r.blocked for r in none)


def test_language_id_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pages = docs.filter("doc_id % 2 = 1 and length(text) > 200").select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"),
                                                                         F.concat(F.lit("<p>"), "text").alias("html"), "lang")
    got = language_id.identify(pages, docs.filter("doc_id % 2 = 0")).join(pages.select("page_id", F.col("lang").alias("want")), "page_id")
    assert got.count() == pages.count() and got.filter("lang = want").count() >= 0.95 * got.count()
    assert language_id.identify(pages.limit(0), docs).count() == 0


def test_language_id_knows_every_labelled_language(spark):
    rng = np.random.default_rng(7)
    words = {f"l{k:02}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(30)] for k in range(40)}

    def text(lang):
        return " ".join(rng.choice(words[lang], 40))

    # the last languages have the fewest documents
    rows = [(text(x), x) for k, x in enumerate(words) for _ in range(3 if k > 20 else 8)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    pages = spark.createDataFrame([(k, f"http://h{k}.org/", f"<p>{text(x)}</p>") for k, x in enumerate(words)], "page_id long, url string, html string")
    got = {r.page_id: r.lang for r in language_id.identify(pages, docs).collect()}
    assert got == dict(enumerate(words))
    copies = spark.range(500).select(F.lit(rows[0][0]).alias("text"), F.lit("l00").alias("lang"))
    langs, table = language_id.fit(docs)
    assert len(langs) == 40 and np.array_equal(table, language_id.fit(docs.union(copies))[1])


def test_license_scan_finds_families(spark, odd):
    extra = spark.createDataFrame([(50, "Some words\nReleased under the MIT License."), (51, "Licensed under the Apache License, Version 2.0.")], "doc_id long, text string")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").filter("doc_id >= 60").union(extra).union(odd.select("doc_id", "text"))
    got = {r.doc_id: r.family for r in license_scan.scan(docs).collect()}
    assert got[50] == "mit" and got[51] == "apache" and got[1] is None and got[7] is None


def test_license_scan_does_not_depend_on_how_rows_are_dealt(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(docs.filter("doc_id < 5"))  # repeated rows get their row each
    shuffled = docs.repartition(13, "text").union(docs.limit(0))
    a, b = (sorted(map(str, license_scan.scan(d).collect())) for d in (docs, shuffled))
    assert a == b and len(a) == docs.count()


def test_license_scan_leaves_prose_alone_and_reads_short_lines(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([
        (10**6, "All rights reserved."), (10**6 + 1, "one two three four five six seven released under the MIT License"),
        (10**6 + 2, "one two three four five six seven eight released under the MIT License"), (10**6 + 3, None), (10**6 + 4, "")],
        "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(docs.union(extra)).collect()}
    assert got[10**6].family == "proprietary" and got[10**6 + 1].family == got[10**6 + 2].family == "mit"
    assert got[10**6 + 3].n_licence == got[10**6 + 4].n_licence == 0
    talk = re.compile(license_scan.TALK)
    prose = [d for d, t in texts(docs) if not talk.search(t)]
    flagged = sum(got[d].n_licence > 0 for d in prose)
    assert len(prose) > 800 and flagged < 0.01 * len(prose), flagged


def test_license_scan_weighs_lines_as_the_model_does(spark):
    lines = [["mit"], ["ünïcode", "日本語", "a", "a", "a"], ["x" * 1000, "y"], ["the"] * 50, [], ["released", "under", "the", "mit", "license"]]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(lines)], "i long, words array<string>")
    labelled = license_scan.template_rows(spark).withColumn("label", F.when(F.col("family") == "mit", 1.0).when(F.col("family") == "bsd", 2.0).otherwise(0.0))
    model = LogisticRegression(maxIter=3, regParam=1e-3, family="multinomial", standardization=False).fit(license_scan.features(labelled))
    made = license_scan.features(rows)
    want = {r.i: (sorted(r.features.indices.tolist()), r.probability.toArray().tolist()) for r in model.transform(made).collect()}
    line, bucket = license_scan.gram_buckets(pa.array(lines, pa.list_(pa.string())).slice(0))
    assert [sorted(bucket[line == i].tolist()) for i in want] == [want[i][0] for i in want]
    got = {r.i: r.p for r in license_scan.probable(rows, model).collect()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i][1], abs=1e-12) for i in want)
    few = {r.i for r in license_scan.probable(rows, model, 0.5).collect()}
    assert few == {i for i in want if want[i][1][0] < 0.5}


def test_license_scan_runs_no_python_on_executors(spark):
    docs = spark.createDataFrame([(i, "some plain prose of a line\nReleased under the MIT License.") for i in range(20)], "doc_id long, text string")
    plan = license_scan.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("MapInArrow|Python|Pandas", plan)


def test_license_scan_bound_drops_no_line_the_model_keeps(spark):
    notices = [(i, (n[:k] + ["word", "other", f"w{i}"] * j)) for i, n in enumerate(license_scan.TEMPLATES[f].split(" ") for f in license_scan.FAMILIES) for k in (3, 6, 12, 400) for j in (0, 1, 2, 5, 40)]
    rows = spark.createDataFrame(notices + [(-1, []), (-2, ["word"])], "i long, words array<string>")
    labelled = license_scan.template_rows(spark).withColumn("label", F.array_position(F.array(*[F.lit(f) for f in license_scan.FAMILIES]), F.col("family")).cast("double"))
    prose = spark.createDataFrame([(0.0, ["word", "other", "prose", f"p{i}"]) for i in range(500)], "label double, words array<string>")
    model = LogisticRegression(maxIter=5, regParam=1e-3, family="multinomial", standardization=False).fit(
        license_scan.features(labelled.select("label", "words").unionByName(prose)))
    every = license_scan.probable(rows, model).collect()
    for least in (0.5, 0.9):
        want = sorted((r.i, r.words) for r in every if r.p[0] < 1 - least)
        assert sorted((r.i, r.words) for r in license_scan.probable(rows, model, least).collect()) == want and 0 < len(want) < len(every)


def test_license_scan_finds_whole_texts_and_embedded_notices(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").filter("doc_id >= 60")
    prose = " ".join(x for _, x in texts(docs.filter("doc_id < 70")) if x).replace("\n", " ").split()
    prose = " ".join(w for w in prose if not re.search("licen|copyright|rights", w.lower()))
    mit, bsd, apache = (license_scan.TEXTS[f][0] for f in ("mit", "bsd", "apache"))
    first = " ".join(mit[mit.index("Permission is"):mit.index("The above copyright")].split())
    flat = " ".join(mit[mit.index("THE SOFTWARE IS"):].split())
    clause = " ".join(bsd[bsd.index("2. Redistributions in binary"):bsd.index("3. Neither")].split())
    patent = " ".join(apache[apache.index("3. Grant of Patent"):apache.index("4. Redistribution")].split())
    rows = [(900001, first, "mit"), (900002, flat, "mit"), (900003, clause, "bsd"), (900004, patent, "apache"),
            (900005, f"{prose[:2000]} Released under the MIT License. {prose[2000:4000]}", "mit"),
            (900006, f"{prose[:3000]} {' '.join(mit.split())} {prose[3000:5000]}", "mit"),
            (900007, f"{prose[:500]} Licensed under the Apache License, Version 2.0 {prose[500:900]}", "apache"),
            (900008, prose[:6000], None)]
    extra = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(docs.union(extra)).collect()}
    assert {d: got[d].family for d, _, _ in rows} == {d: f for d, _, f in rows}


def test_pipeline_stages(spark):
    import corpus_pipeline
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert len(out) and out.groupby("sequence_id").length.sum().max() <= 4096


def test_small_groups_are_compared_like_trees(monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for key in range(40):
        base = rng.integers(0, 6, ngram_join.GROUPS)
        for cls in rng.choice(300, rng.integers(1, 50), replace=False):
            rows.append((key, 0, int(cls), int(cls) % 7, 0, 1, int(cls) % 5, base))
    size = {r[2]: int(rng.integers(150, 190)) for r in rows}
    vec = {r[2]: (r[7] + rng.integers(0, 2, ngram_join.GROUPS)).astype(np.uint8).tobytes() for r in rows}
    rows = [(*r, 1 + r[0] % 3) for r in rows]
    names = ("key", "cell", "cls", "comp", "own", "blocks", "blk")
    table = pa.table({**{n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(names)},
                      "n": pa.array([size[r[2]] for r in rows], pa.int64()), "vec": pa.array([vec[r[2]] for r in rows], pa.binary()),
                      "w": pa.array([r[8] for r in rows], pa.int64()), "ct": pa.array([10 + r[2] % 20 for r in rows], pa.int64())})
    got = []
    for leaf in (2, 8, 32, 64):
        monkeypatch.setattr(ngram_join, "LEAF", leaf)
        got.append(sorted(map(tuple, ngram_join._search(table).to_pandas().itertuples(index=False))))
    assert got[0] and all(g == got[0] for g in got)


def test_cells_and_overlaps_equal_plain_sets(monkeypatch):
    rng = np.random.default_rng(6)
    core, other = rng.integers(1, 1 << 62, 40), rng.integers(1, 1 << 62, 200)
    sets = [np.unique(np.concatenate([core[rng.random(40) < .95], rng.choice(other, rng.integers(0, 12))])).astype(np.uint64) for _ in range(90)]
    plain = [set(s.tolist()) for s in sets]
    got = ngram_join.overlaps(sets[:50], sets[50:])
    assert got.tolist() == [[len(a & b) for b in plain[50:]] for a in plain[:50]]
    want = {(i, j) for i in range(90) for j in range(i + 1, 90) if 4 * len(plain[i] & plain[j]) >= 3 * len(plain[i] | plain[j])}
    assert 0 < len(want) < 90 * 89 / 2
    for most in (512, 7):
        monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", most)
        found = []
        for i in range(3):
            for j in range(i, 3):
                rows = [(0, i * 3 + j, c, c % 3, 3, sets[c].tobytes()) for c in range(90) if c % 3 in (i, j)]
                found += list(zip(*(x.tolist() for x in ngram_join._cell_links(rows))))
        assert len(found) == len(set(found)) and set(found) == want


def test_license_scan_is_trained_on_every_paragraph(spark):
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some plain words"), F.concat(F.lit("w"), F.col("id"))).alias("text"))
    docs = docs.withColumn("text", F.concat_ws("\n", "text", F.lit("a second line of them"), F.lit("released under the mit license")))
    model, lines, plain = license_scan.train(docs)
    uids = [r.held for r in license_scan.paragraphs(docs, "doc_id", "text").filter("place = 0").select("held").collect()]
    assert lines == 2 * sum(uids) and plain == 0 and 1500 < sum(uids) < 3000
    # each paragraph of the other documents counts, those with licence talk do not
    rows = license_scan.paragraphs(docs, "doc_id", "text").filter("not held and place < 2").select(F.explode(license_scan.grams(F.col("words"))).alias("b"))
    want = np.full(license_scan.BUCKETS, license_scan.SMOOTH)
    for b, n in rows.groupBy("b").count().collect():
        want[b] += n
    assert np.allclose(model.coefficientMatrix.toArray()[0], np.log(want / want.sum()))
    assert license_scan.train(docs.filter("doc_id < 0"))[1:] == (0, 0)


def test_license_scan_cutoffs_take_every_held_out_line(spark):
    n, k = 1 + len(license_scan.FAMILIES), license_scan.FAMILIES.index("mit") + 1
    p = lambda own: [1 - own, *[own if i == k else 0.0 for i in range(1, n)]]
    rows = [(f"u{i}", 0, 0, True, True, p(0.4 + i / 200)) for i in range(100)] + [("t", 0, 0, False, False, p(0.999)), ("u1", 0, 1, True, True, p(0.999))]
    weighed = spark.createDataFrame(rows, "uid string, place int, part int, plain boolean, calm boolean, p array<double>")
    of, unsure = license_scan.cutoffs(weighed, 10000, 5000)  # ten lines and ten documents may pass
    odds = np.log([x[5][k] / x[5][0] for x in rows[:100]])
    assert 0 < sum(odds > of["mit"]) <= 10 and 0 < sum(odds > unsure) <= 10 and of["gpl"] == float("-inf")
    assert license_scan.cutoffs(weighed, 200000, 100000) == ({f: float("-inf") for f in license_scan.FAMILIES}, 0.0)
