"""Vector codes, token files and centroid clustering against brute force, and their edge cases."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import byte_tokens, centroid_tables, queries, rans, token_files, vector_codes
from ledgerlake.llm.cover_tree import Forest

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def odd_vectors(spark, dims, n=150, seed=3):
    """Ties, repeated rows and ids, nulls, odd lengths, huge values, clashing columns."""
    r = random.Random(seed)
    point = lambda: [r.choice([-0.5, 0.0, 0.004, 0.25, 1.5]) for _ in range(dims)]
    rows = [(i, point(), r.choice(["a", "b", None])) for i in range(n)]
    hot = point()
    rows += [(1000 + i, hot, "a") for i in range(n)]
    rows += [(5, hot, "b"), (5, hot, "b"), (5, point(), None), (None, point(), "a"), (None, None, "a"), (2000, None, "b"), (2001, [], "b"),
             (2002, [None] * dims, "a"), (2003, [NAN] + [0.0] * (dims - 1), "a"), (2004, [INF] + [0.0] * (dims - 1), "a"),
             (2005, [0.0] * (dims - 1), "a"), (2006, [1e300, -1e300] + [0.0] * (dims - 2), "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    return df.withColumns({c: F.lit("x") for c in ("cluster", "distance", "code", "error", "vector", "salt", "n", "sums", "part")})


def whole(df, dims):
    top = float(1 << 26)
    rows = [(r.vec_id, r.label, tuple(math.floor(min(max(x * 256, -top), top)) for x in r.embedding)) for r in df.collect()
            if r.embedding and len(r.embedding) == dims and all(x is not None and math.isfinite(x) for x in r.embedding)]
    return rows


def off(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def lloyd(points, centres, rounds):
    """Plain Lloyd rounds; the last assignment and the centres."""
    def nearest(p):
        return min(range(len(centres)), key=lambda c: (off(p, centres[c]), c))
    for _ in range(rounds):
        groups = defaultdict(list)
        for p in points:
            groups[nearest(p)].append(p)
        centres = [tuple(sum(v) // len(v) for v in zip(*groups[c])) if groups[c] else old for c, old in enumerate(centres)]
    return [nearest(p) for p in points], centres


def sha(numbers):
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def test_clusters_equal_plain_rounds(spark):
    df, dims = odd_vectors(spark, 6), 6
    rows = whole(df, dims)
    name = lambda i: hashlib.sha256(f"2:{'null' if i is None else i}".encode()).hexdigest()
    first = sorted(rows, key=lambda r: (name(r[0]), r[2]))[:9]
    got, centres = lloyd([r[2] for r in rows], [r[2] for r in first], 4)
    d = [off(r[2], centres[c]) for r, c in zip(rows, got)]
    per = defaultdict(int)
    for c, x in zip(got, d):
        per[c] += x
    fit = lambda x: x if x < 1 << 63 else None
    want = [(str(r[0]), c, x, fit(per[c]), fit(sum(d)), sha(centres[c])) for r, c, x in zip(rows, got, d)]
    out = centroid_tables.report(df, k=9, dims=dims, rounds=4)
    assert sorted(map(str, want)) == sorted(str((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256))
                                            for r in out.collect())


def test_clusters_of_few_or_no_vectors(spark):
    df = odd_vectors(spark, 6)
    few = centroid_tables.report(df.filter("vec_id < 3"), k=9, dims=6).collect()
    assert len(few) == 3 and {r.distance for r in few} == {0}
    for none in (df.limit(0), df.filter("embedding is null")):
        out = centroid_tables.report(none, dims=6)
        assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_lookup_tables_give_squared_distances():
    r = np.random.default_rng(1)
    for values in (3, 1000, 1 << 26):
        x, c = r.integers(-values, values, (500, 5)), r.integers(-values, values, (7, 5))
        assert (centroid_tables.distances(x, c) == np.square(x[:, None] - c[None]).sum(axis=2)).all()


def test_codes_equal_plain_rounds(spark):
    df, dims, parts, entries = odd_vectors(spark, 12), 12, 4, 10
    rows = whole(df, dims)
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    cuts = [slice(3 * p, 3 * p + 3) for p in range(parts)]
    solved = [lloyd([r[2][s] for r in rows], [r[2][s] for r in first], 2) for s in cuts]
    digest = sha(x for _, centres in solved for c in centres for x in c)
    error = [sum(off(r[2][s], centres[got[i]]) for s, (got, centres) in zip(cuts, solved)) for i, r in enumerate(rows)]
    label = defaultdict(int)
    for r, e in zip(rows, error):
        label[r[1]] += e
    want = [str((r[0], "".join(f"{got[i]:02x}" for got, _ in solved), error[i], label[r[1]], digest)) for i, r in enumerate(rows)]
    out = vector_codes.report(df, parts=parts, entries=entries).collect()
    assert sorted(want) == sorted(str((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256)) for r in out)


def test_codes_of_few_or_no_vectors(spark):
    df = odd_vectors(spark, 12)
    few = vector_codes.report(df.filter("vec_id < 3"), parts=4).collect()
    assert len(few) == 3 and {r.error for r in few} == {0}
    for none in (df.limit(0), df.filter("embedding is null")):
        assert vector_codes.report(none, parts=4).collect() == []


@pytest.mark.parametrize("n,scale", [(1, 5), (9, 1), (700, 2), (3000, 40), (500, 1 << 25)])
def test_cover_trees_keep_their_rules_and_assign_exactly(n, scale):
    r = np.random.default_rng(n)
    points = np.floor(r.normal(size=(3, n, 4)) * scale).clip(-(1 << 26), 1 << 26).astype(np.int32)
    points[1, n // 2:] = points[1, 0]  # a third of all is one point
    f = Forest.build(points)
    for i in range(len(f.low)):
        own = f.points[f.low[i]:f.high[i]].astype(np.int64)
        assert np.isclose(f.radius[i] ** 2, np.square(own - f.centre[i]).sum(axis=1).max())
        kids = range(f.child_low[i], f.child_high[i])
        if kids:
            power = 2.0 ** (math.ceil(math.log2(max(f.radius[i], 1))) - 1)
            assert f.low[kids[0]] == f.low[i] and f.high[kids[-1]] == f.high[i]
            assert (f.centre[kids[0]] == f.centre[i]).all() and (f.radius[list(kids)] <= power).all()
            centres = f.centre[list(kids)].astype(np.int64)
            apart = np.square(centres[:, None] - centres[None]).sum(axis=2) + np.eye(len(kids)) * 1e30
            assert (apart > power ** 2).all()
    books = points[:, r.integers(0, n, 20)].astype(np.int64)  # equal entries too
    code, number, sums = f.assign(books)
    want = np.square(points.astype(np.int64)[:, :, None] - books[:, None]).sum(axis=3).argmin(axis=2)
    got = np.empty((3, n), int)
    got[np.arange(3 * n) // n, f.rows] = code
    assert (got == want).all()
    assert all(number[t, e] == (want[t] == e).sum() and (sums[t, e] == points[t][want[t] == e].sum(axis=0)).all() for t in range(3) for e in range(20))


@pytest.mark.parametrize("name", ["op11_vector_codes", "op13_centroid_tables"])
def test_vector_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.execute(queries.ORACLE_SQL[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    want, got = (x.sort_values("vec_id").reset_index(drop=True).astype(str) for x in (want, got))
    assert got.equals(want)


# token files ---------------------------------------------------------------

def full_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_files.tokenizer_file())
    t.encode_special_tokens = True
    return t


def odd_documents(spark):
    long = " ".join(f"w{i * i % 997}x{i}" for i in range(4000)) + "é" * 3000
    rows = [(7, "seven"), (3, None), (3, ""), (3, "again"), (3, "again"), (1, long), (2, " \n\n\t a\r\n\r\nb  c  d\u0085"), (None, "no id"), (9, "don't we'll 's '' <|endoftext|>"),
            (8, "z" * 30000), (10, "ends in blanks  \n"), (11, "\n begins so")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("row", "part", "segment", "run", "data", "first_id", "ids", "start")})


def plain_ids(docs):
    t = full_tokenizer()
    return [(r.doc_id, t.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in docs.collect()]


@pytest.mark.parametrize("segment", [1 << 20, 3000, 7])
def test_token_files_round_trip(spark, tmp, segment):
    docs = odd_documents(spark)
    token_files.write_tokens(docs, tmp + "/t", token_files.tokenizer_file(), segment=segment)
    rows = token_files.read_digests(spark, tmp + "/t").collect()
    want = sorted((str(d), len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in plain_ids(docs))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == want
    rows.sort(key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda d: (d is None, d or 0))
    stream = [i for r in sorted(token_files.read_ids(spark, tmp + "/t").collect(), key=lambda r: r.start) for i in r.ids]
    assert len(stream) == at and all(zlib.crc32(np.array(stream[r.start:r.start + r.n_tokens], "<u4").tobytes()) == r.ids_crc32 for r in rows)
    if segment == 3000:  # each segment is decoded from its own row alone
        kept = spark.read.parquet(tmp + "/t").filter("segment % 2 = 1")
        kept.write.parquet(tmp + "/odd")
        assert token_files.read_ids(spark, tmp + "/odd").count() > 0


def test_token_files_of_an_empty_table(spark, tmp):
    token_files.write_tokens(odd_documents(spark).limit(0), tmp + "/t", token_files.tokenizer_file())
    assert token_files.read_digests(spark, tmp + "/t").collect() == [] and token_files.read_ids(spark, tmp + "/t").collect() == []


def test_token_query_equals_the_tokenizer(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want, at = {}, 0
    for d, i in sorted(plain_ids(docs)):
        want[d] = (at, len(i), zlib.crc32(np.array(i, "<u4").tobytes()))
        at += len(i)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.query(spark, SF).collect()} == want


def test_parts_of_a_text_are_those_of_the_splitter():
    r = random.Random(8)
    letters = "abZé ÷×ñ  \n\t'.,!?0195’  \u0085  中д😀_-<|>'s\x1c\x00\r"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(20000)] + [None]
    ids, at = byte_tokens.encode(pa.array(texts), token_files.tokenizer_file())
    for k, e in enumerate(full_tokenizer().encode_batch_fast([x or "" for x in texts], add_special_tokens=False)):
        assert ids[at[k]:at[k + 1]].tolist() == e.ids, texts[k]


@pytest.mark.parametrize("n", [0, 1, 17, 4095, 4096, 65536, 65537, 150001])
def test_coded_ids_round_trip(n):
    r = np.random.default_rng(n)
    for ids in (np.minimum(r.zipf(1.3, n), 50256), r.integers(0, 1 << 24, n), np.full(n, 3)):
        ids = ids.astype(np.uint32)
        data = rans.encode(ids)
        assert (rans.decode(data) == ids).all() and len(rans.decode(data)) == n
    if n:
        share = np.unique(ids, return_counts=True)[1] / n
        assert len(data) < n * -(share * np.log2(share)).sum() / 8 * 1.1 + 20000
    if n == 150001:  # from any block and checkpoint
        s = rans.Segment(rans.encode(ids := r.integers(0, 999, n).astype(np.uint32)))
        assert (s.decode([1], 1) == ids[rans.BLOCK + rans.CHECK * rans.LANES:2 * rans.BLOCK]).all()
        assert (s.decode([2, 0]) == np.concatenate([ids[2 * rans.BLOCK:], ids[:rans.BLOCK]])).all()


def test_damaged_bytes_are_found():
    data = rans.encode(np.random.default_rng(0).integers(0, 500, 9000).astype(np.uint32))
    for k in range(0, len(data), 97):
        bad = bytearray(data)
        bad[k] ^= 4
        with pytest.raises(ValueError):
            rans.decode(bytes(bad))
    with pytest.raises(ValueError):
        rans.decode(data[:-5])
    with pytest.raises(ValueError):
        rans.encode(np.array([1 << 24], np.uint32))


def test_checksums_join():
    r = random.Random(1)
    for a, b in ((0, 0), (0, 5), (7, 0), (1000, 333), (5, 100000)):
        x, y = r.randbytes(a), r.randbytes(b)
        assert token_files.crc32_join(zlib.crc32(x), zlib.crc32(y), b) == zlib.crc32(x + y)
