"""Repeated passages by merged Burrows-Wheeler transforms.

Every byte covered by a 200-byte string that also starts anywhere else goes.
The work is cut into pieces that fit a task before any suffix is sorted:

1. Each 200-byte window names its anchor, the least of the hashes of its
   64-byte strings. Equal windows name equal anchors, and the windows of one
   anchor stand side by side; together they are the anchor's context, which
   belongs to no other. Only hashes and places travel, and only once: rows
   are dealt by anchor and read in order of (anchor, context).
2. A context met twice is repeated whole; an anchor met with one context only
   has no other repeat. What is left are anchors with several different
   contexts: one copy of each such context is fetched, and anchors are dealt
   to slices.
3. In a slice, shards of contexts get their suffixes sorted and become
   Burrows-Wheeler transforms. The transforms are merged by interleave
   refinement: all suffixes start in blocks by first symbol, and each round
   splits the blocks by the block of the rest of the suffix, which the
   transforms give, so shards, sorted as they are, are only merged. The
   round that parts two neighbours is their common prefix; blocks that stay
   together through 200 bytes are the repeated intervals. A symbol is 25
   bytes, each of the 25 alignments being a string of its own, so eight
   rounds suffice and no start is left out.
4. An anchor with more than HOT different contexts does not enter a slice:
   its windows are counted by hash, dealt by window.
5. Repeated starts become byte ranges of documents, and ranges are united.

What would crowd one task is named beforehand by a sample of the documents,
in two lists of at most LISTED hashes: contexts with very many copies, whose
rows are known to be repeated and need not meet, and anchors with very many
contexts, which are dealt by context. The lists say where rows go, never
what is found: with other lists, or none, the result is the same.

Defined results: a null text is an empty one; texts under 200 bytes keep all
bytes; repeated rows are copies of each other; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, slices, text_of, written
from .ngram_join import MULT, INVERSE, mixed, powers

LENGTH, KMER, SYMBOL = 200, 64, 25
SHARD, SLICE_ROWS, HOT = 1 << 19, 3_000, 2048
#: the sample of the documents, how many copies or contexts in it make a hash a crowded one, how many are listed
SAMPLED, CROWD_COPIES, CROWD_KINDS, LISTED = 1 / 32, 16, 64, 20_000
#: rows of one anchor that are held at once; beyond it the anchor counts as one of more than HOT contexts
HELD = 1 << 18
BLOCK = 1 << 20
_LOW = np.uint64((1 << 24) - 1)
BYTE = np.random.default_rng(4).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Hasher:
    """Hashes of any byte range of ``data``."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTE[data] * powers(MULT, n), dtype=np.uint64)])
        self.back = powers(INVERSE, n + 1)

    def each(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return mixed((self.sums[width:] - self.sums[:n]) * self.back[:n])

    def ranges(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mixed((self.sums[hi] - self.sums[lo]) * self.back[lo] + (hi - lo).astype(np.uint64) * MULT)


def anchors(data: np.ndarray, width: int = LENGTH, kmer: int = KMER):
    """(anchor, context hash, first start, last start, place) arrays of one text, in blocks."""
    n = len(data)
    for base in range(0, max(0, n - width + 1), BLOCK):
        part = data[base:base + BLOCK + width - 1]
        if len(part) < width:
            return
        h = Hasher(part)
        k = h.each(kmer)
        value = (k & ~_LOW) | np.arange(len(k), dtype=np.uint64)
        span, low = 1, value
        want = width - kmer + 1
        while span * 2 <= want:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < want:
            low = np.minimum(low[:len(low) - (want - span)], low[want - span:])
        place = (low & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(first[1:], len(place)) - 1
        yield k[place[first]], h.ranges(first, last + width), first + base, last + base


def _bytes(column) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint8) for x in column.cast(pa.binary())]


#: how a row travels: by its anchor, by its context, or as a range that is known to be repeated
BY_ANCHOR, BY_CONTEXT, KNOWN = 0, 1, 2
CONTEXTS = "uid long, anchor long, ctx long, first long, last long, how byte, n byte"


def contexts(docs: DataFrame, copied: np.ndarray | None = None, crowded: np.ndarray | None = None) -> DataFrame:
    """CONTEXTS of ``docs`` (uid, text); ranges of ``copied`` contexts, side by side, are one row each."""
    copied = np.empty(0, np.int64) if copied is None else copied
    crowded = np.empty(0, np.int64) if crowded is None else crowded
    types = [pa.int64()] * 5 + [pa.int8()] * 2

    def rows_of(u: int, data: np.ndarray):
        for a, c, s, e in anchors(data):
            a, c = a.view(np.int64), c.view(np.int64)
            known = np.isin(c, copied)
            own = ~known
            yield np.full(own.sum(), u), a[own], c[own], s[own], e[own], np.where(np.isin(a[own], crowded), BY_CONTEXT, BY_ANCHOR), np.ones(own.sum(), np.int64)
            lo, hi = runs(known).reshape(-1, 2).T
            none = np.zeros(len(lo), np.int64)
            yield np.full(len(lo), u), none, none, s[lo], e[hi], none + KNOWN, none + 1

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                found = [r for u, data in zip(part.column(0).to_pylist(), _bytes(part.column(1))) for r in rows_of(u, data)]
                cols = [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0)] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(cols, types)],
                                                 names=["uid", "anchor", "ctx", "first", "last", "how", "n"])

    return docs.mapInArrow(run, CONTEXTS)


def crowds(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, list]:
    """(contexts with very many copies, anchors with very many contexts, one row for each of those contexts)."""
    kinds = contexts(docs.sample(SAMPLED, 4)).groupBy("anchor", "ctx").agg(
        F.count("*").alias("copies"), F.min(F.struct("uid", "first", "last")).alias("one"))
    copied = kinds.filter(F.col("copies") >= CROWD_COPIES).orderBy(F.desc("copies"), "ctx").limit(LISTED).select("one.uid", "anchor", "ctx", "one.first", "one.last").collect()
    crowded = kinds.groupBy("anchor").agg(F.count("*").alias("d")).filter(F.col("d") >= CROWD_KINDS).orderBy(F.desc("d"), "anchor").limit(LISTED).collect()
    of = np.array([r.anchor for r in crowded], np.int64)
    named = [(*r, BY_CONTEXT if r.anchor in of else BY_ANCHOR, 2) for r in copied]
    return np.array([r.ctx for r in copied], np.int64), of, named


SETTLED = "whole boolean, uid long, anchor long, ctx long, first long, last long, twice boolean, hot boolean"


def settle(most: int, hold: int):
    """Rows in order of (anchor, ctx) become ranges that are repeated whole and,
    where an anchor has other contexts beside one met once, one row per context.
    An anchor with more than ``most`` contexts, or more than ``hold`` rows, is hot."""
    names = [c.split()[0] for c in SETTLED.split(", ")]

    def run(batches):
        held, over = None, None

        def table(whole, uid, anchor, ctx, first, last, twice, hot):
            n = len(uid)
            flags = [np.full(n, x, bool) if np.ndim(x) == 0 else x for x in (whole, twice, hot)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (flags[0], uid, anchor, ctx, first, last, *flags[1:])], names=names)

        def answer(uid, anchor, ctx, first, last, how, n):
            if not len(uid):
                return
            new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
            new = new_anchor | np.concatenate([[True], ctx[1:] != ctx[:-1]])
            start = np.flatnonzero(new)
            run, total = np.cumsum(new) - 1, np.add.reduceat(n.astype(np.int64), start)
            twice = total > 1
            rep = twice[run]
            none = np.zeros(rep.sum(), np.int64)
            yield table(True, uid[rep], none, none, first[rep], last[rep], True, False)
            group = np.cumsum(new_anchor[start]) - 1
            d = np.bincount(group)
            hot = (d > most) | (how[start[np.flatnonzero(new_anchor[start])]] == BY_CONTEXT)
            if over is not None:
                hot |= anchor[start[np.flatnonzero(new_anchor[start])]] == over
            open_ = hot | (d > 1) & (np.bincount(group, ~twice) > 0)
            at = start[open_[group]]
            yield table(False, uid[at], anchor[at], ctx[at], first[at], last[at], twice[open_[group]], hot[group][open_[group]])

        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            known = rows[5] == KNOWN
            if known.any():
                zero = np.zeros(known.sum(), np.int64)
                yield table(True, rows[0][known], zero, zero, rows[3][known], rows[4][known], True, False)
                rows = [c[~known] for c in rows]
            held = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            if not len(held[0]):
                continue
            tail = int(np.searchsorted(held[1], held[1][-1]))
            yield from answer(*[c[:tail] for c in held])
            held = [c[tail:] for c in held]
            if len(held[0]) > hold:
                over = held[1][-1]
                tail = int(np.searchsorted(held[2], held[2][-1]))
                yield from answer(*[c[:tail] for c in held])
                held = [c[tail:].copy() for c in held]
                if len(held[0]) > hold:  # copies of one context: one of them stands for the others
                    zero = np.zeros(len(held[0]) - 1, np.int64)
                    yield table(True, held[0][1:], zero, zero, held[3][1:], held[4][1:], True, False)
                    held = [c[:1] for c in held]
                    held[6][:] = 2
        if held is not None:
            yield from answer(*held)

    return run


def settled(docs: DataFrame) -> DataFrame:
    """SETTLED of ``docs`` (uid, text), from a table in the shared folder."""
    copied, crowded, named = crowds(docs)
    rows = contexts(docs, copied, crowded).unionByName(docs.sparkSession.createDataFrame(named, CONTEXTS))
    to = F.when(F.col("how") == BY_ANCHOR, F.col("anchor")).when(F.col("how") == BY_CONTEXT, F.col("ctx")).otherwise(F.xxhash64("uid", "first"))
    return written(rows.repartition(to).sortWithinPartitions("anchor", "ctx").mapInArrow(settle(HOT, HELD), SETTLED), "contexts")


def build(strings: list[np.ndarray]):
    """One shard, in suffix order: (transform, string, start).

    Each string is SYMBOL strings of SYMBOL-byte symbols, one per alignment;
    the transform holds, in suffix order, the symbol before each suffix; 0
    is the end mark."""
    lengths = np.array([len(s) + 1 for s in strings], np.int64)  # one place for the suffix that is only the end mark
    at = np.concatenate([[0], np.cumsum(lengths)])
    data = np.concatenate([x for s in strings for x in (s, np.zeros(1, np.uint8))])
    owner = np.repeat(np.arange(len(strings)), lengths)
    n = len(data)
    symbol = np.zeros(n + 1, np.uint64)  # at n: the end mark
    h = Hasher(data).each(SYMBOL) | np.uint64(1)
    inside = np.arange(len(h)) + SYMBOL < at[1:][owner[:len(h)]]
    symbol[:len(h)][inside] = h[inside]
    _, rank = np.unique(symbol, return_inverse=True)  # places without a whole symbol are empty suffixes: rank 0
    rank = rank.astype(np.int64)
    step = SYMBOL
    place = np.arange(n + 1)
    while True:
        later = np.minimum(place + step, n)
        # beyond the own string there is nothing but the end mark
        far = np.where((rank > 0) & (place < n) & (place + step < np.append(at[1:][owner], 0)), rank[later], 0)
        key = rank * (n + 2) + far
        order = np.argsort(key, kind="stable")
        new = np.empty(n + 1, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        if step >= SYMBOL * 16 or new.max() == rank.max():
            break
        rank, step = new, step * 2
    order = order[order < n]
    start = order - at[owner[order]]
    before = np.where(start >= SYMBOL, symbol[np.maximum(order - SYMBOL, 0)], np.uint64(0))
    return before, owner[order], start


def refine(shards: list[tuple[np.ndarray, np.ndarray]], rounds: int = LENGTH // SYMBOL) -> list[np.ndarray]:
    """Block numbers of the suffixes of each shard after ``rounds`` symbols.

    A shard is (first symbols, next): the symbol each suffix begins with, in
    suffix order, and the place of the suffix that follows it (-1 for none)."""
    firsts = np.concatenate([f for f, _ in shards])
    sizes = np.cumsum([0] + [len(f) for f, _ in shards])
    nxt = np.concatenate([np.where(x >= 0, x + base, -1) for (_, x), base in zip(shards, sizes)])
    _, first = np.unique(firsts, return_inverse=True)
    first = first.astype(np.int64)
    block = first
    for _ in range(rounds - 1):
        key = first * (len(first) + 1) + np.where(nxt >= 0, block[nxt] + 1, 0)
        merged = np.argsort(key, kind="stable")  # one ascending run for each shard: a merge
        split = key[merged][1:] != key[merged][:-1]
        new = np.empty(len(first), np.int64)
        new[merged] = np.concatenate([[0], np.cumsum(split)])
        if new.max() == block.max():  # no block was parted
            block = new
            break
        block = new
    return [block[a:b] for a, b in zip(sizes[:-1], sizes[1:])]


def from_transform(before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first symbols, next) from a transform.

    A stable sort of the transform lists the suffixes by the symbol before
    them: the i-th suffix that begins with a symbol is followed by the i-th
    suffix that has it before."""
    real = np.flatnonzero(before != 0)
    follows = real[np.argsort(before[real], kind="stable")]
    ends = len(before) - len(follows)  # suffixes that are only the end mark come first
    first = np.concatenate([np.zeros(ends, np.uint64), before[follows]])
    return first, np.concatenate([np.full(ends, -1, np.int64), follows])


def repeated_starts(strings: list[np.ndarray], shard: int = SHARD) -> list[np.ndarray]:
    """For each string, which starts 0 .. len - LENGTH begin a LENGTH-byte string that begins elsewhere too."""
    marks = [np.zeros(max(0, len(s) - LENGTH + 1), bool) for s in strings]
    groups, held = [[]], 0
    for i, s in enumerate(strings):
        if held + len(s) > shard and groups[-1]:
            groups.append([])
            held = 0
        groups[-1].append(i)
        held += len(s)
    built, where = [], []
    for g in groups:
        if not g:
            continue
        before, owner, start = build([strings[i] for i in g])
        built.append(from_transform(before))
        where.append((np.array(g)[owner], start))
    if not built:
        return marks
    sizes = np.array([len(s) for s in strings], np.int64)
    blocks = refine(built)
    full = [start + LENGTH <= sizes[own] for own, start in where]
    met = np.bincount(np.concatenate([b[f] for b, f in zip(blocks, full)]), minlength=max(int(b.max()) for b in blocks) + 1)
    for b, f, (own, start) in zip(blocks, full, where):
        hit = f & (met[b] > 1)
        for i, s in zip(own[hit].tolist(), start[hit].tolist()):
            marks[i][s] = True
    return marks


def runs(mark: np.ndarray) -> np.ndarray:
    """(first, last) of the runs of true values, flattened."""
    edge = np.diff(np.concatenate([[0], mark.view(np.int8), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1], axis=1).ravel()


def _slice(table: pa.Table) -> pa.Table:
    strings = [np.frombuffer(x.as_buffer(), np.uint8) for x in table["bytes"].combine_chunks()]
    out = []
    # a context met twice is repeated whole already, it stands here for the others
    for mark, uid, first, twice in zip(repeated_starts(strings), table["uid"].to_pylist(), table["first"].to_pylist(), table["twice"].to_pylist()):
        if not twice:
            pairs = runs(mark).reshape(-1, 2) + first
            out.append(np.column_stack([np.full(len(pairs), uid), pairs]))
    rows = np.concatenate(out) if out else np.empty((0, 3), np.int64)
    return pa.table({"uid": pa.array(rows[:, 0]), "first": pa.array(rows[:, 1]), "last": pa.array(rows[:, 2])})


def fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (uid, anchor, first, last, twice, hot) with the bytes of their windows."""
    names = ["anchor", "first", "last", "twice", "hot"]
    lists = wanted.groupBy(F.col("uid").alias("_uid")).agg(F.collect_list(F.struct(*names)).alias("w"))
    joined = docs.join(lists.hint("merge"), F.col("uid") == F.col("_uid")).select("text", "w", "uid")

    def run(batches):
        for batch in batches:
            for part in slices(batch, 0):
                rows = [(u, w["anchor"], w["first"], w["twice"], w["hot"], data[w["first"]:w["last"] + LENGTH].tobytes())
                        for data, ws, u in zip(_bytes(part.column(0)), part.column(1).to_pylist(), part.column(2).to_pylist()) for w in ws]
                cols = zip(*rows) if rows else [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.bool_()] * 2 + [pa.binary()])],
                                                 names=["uid", "anchor", "first", "twice", "hot", "bytes"])

    return joined.mapInArrow(run, "uid long, anchor long, first long, twice boolean, hot boolean, bytes binary")


def _hot(strings: DataFrame) -> DataFrame:
    """(uid, first, last) of the repeated windows of contexts of very common anchors: windows counted by hash."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                cols = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, bool)]]
                for u, first, twice, x in zip(*[part.column(i).to_pylist() for i in range(3)], part.column(3)):
                    data = np.frombuffer(x.as_buffer(), np.uint8)
                    s = np.arange(len(data) - LENGTH + 1)
                    window = Hasher(data).ranges(s, s + LENGTH).view(np.int64)
                    for col, v in zip(cols, (np.full(len(s), u), s + first, window, np.full(len(s), twice))):
                        col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names=["uid", "start", "window", "twice"])

    windows = strings.select("uid", "first", "twice", "bytes").mapInArrow(run, "uid long, start long, window long, twice boolean")
    met = windows.groupBy(F.col("window").alias("_w")).agg(F.count("*").alias("n")).filter("n > 1").select("_w")
    return windows.filter("not twice").join(met, F.col("window") == F.col("_w")).select("uid", F.col("start").alias("first"), F.col("start").alias("last"))


def _cut_text(batches):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        for part in slices(batch, 1):
            rows = []
            for d, data, spans in zip(part.column(0).to_pylist(), _bytes(part.column(1)), part.column(2).to_pylist()):
                kept, removed, n, end = hashlib.sha256(), 0, 0, 0
                for lo, hi in zip((spans or [])[::2], (spans or [])[1::2]):
                    kept.update(data[end:lo])
                    removed, n, end = removed + hi - lo, n + 1, hi
                kept.update(data[end:])
                rows.append((d, len(data), removed, n, kept.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()])], names=names)


def united(lo: list[int], hi: list[int]) -> list[int]:
    """The union of the ranges, flattened in order."""
    out: list[int] = []
    for a, b in sorted(zip(lo, hi)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _unite(batches):
    for b in batches:
        flat = [united(x, y) for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(flat, pa.list_(pa.int64()))], names=["uid", "spans"])


def spans(docs: DataFrame) -> DataFrame:
    """(uid, lo, hi): the byte ranges to remove; they may meet."""
    rows = settled(docs)
    wanted = rows.filter("not whole")
    strings = written(fetched(docs, wanted), "strings")
    slices_n = max(1, -(-wanted.filter("not hot").count() // SLICE_ROWS))
    usual = strings.filter("not hot").select("uid", "first", "twice", "bytes", F.pmod(F.xxhash64("anchor"), F.lit(slices_n)).alias("_s"))
    found = usual.groupBy("_s").applyInArrow(_slice, "uid long, first long, last long").unionByName(_hot(strings.filter("hot")))
    return rows.filter("whole").select("uid", "first", "last").unionByName(found).select(
        "uid", F.col("first").alias("lo"), (F.col("last") + LENGTH).alias("hi"))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256, one row per row of ``docs``."""
    text = text_of(text_col)
    keyed = docs.select(F.xxhash64(F.col(id_col), text).alias("uid"), text.alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    met = spans(keyed.select("uid", "text")).groupBy("uid").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))
    ranges = met.mapInArrow(_unite, "uid long, spans array<long>").withColumnRenamed("uid", "_uid")
    joined = keyed.join(ranges.hint("merge"), F.col("uid") == F.col("_uid"), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(_cut_text, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def query(spark, sf_dir):
    return decide(read(spark, sf_dir, "documents"))
