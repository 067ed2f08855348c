"""Near-duplicate join on 5-word shingles with count-vector R-trees.

Two texts link when the Jaccard similarity of their shingle sets is 0.75 or
more. Every step keeps all links:

1. Texts with the same set form a class; classes are joined from here on.
2. A class is routed by the prefix of its set under one global order (the
   shingles of a bounded list of common ones last, else by hash): sets that
   reach the threshold share a shingle of their prefixes, so a link's two
   ends meet at some key.
3. Seeds: a class meets one partner, the smallest class of the keys it shares
   most, if they share many. The classes of one partner are dealt in blocks;
   all pairs of a block are verified on full sets inside its task, and only
   links that join two components leave it. This joins large groups of near
   copies in as many rows as classes.
4. Keys whose classes are not yet in one component are searched with an
   R-tree. A class is a point: its shingles hashed into GROUPS groups, and
   the counts of the groups. The sum of coordinate minima bounds the overlap
   of two points, the sum over the upper corners that of two boxes; pairs of
   boxes below the threshold, or inside one component, are not opened. Very
   common keys are dealt in cells of bounded size.
   Survivors are not listed pair by pair: classes lie in blocks of classes
   that the seeds connect, and a task names each pair of blocks that holds
   survivors once, with the classes concerned. The keys at which a class has
   a survivor, and what lies beyond a prefix, bound its overlaps once more.
5. All pairs of the classes named for a pair of blocks are verified on full
   sets inside its task, as in step 3; components follow.
6. For n_links, and for the links themselves, each component is dealt in cells
   of two blocks of its classes. All pairs of a cell are verified on full sets
   inside its task, each pair in one cell, so no link inside a component is
   missed and only counts (or true links) leave the task.

Texts are read four times: for set ids, vectors and common shingles; for the
prefixes; for the sets of step 3; for those that step 5 adds. Step 6 reads the
sets of both.

One tree over all classes would not prune: in this many dimensions the boxes
of unrelated texts overlap. The trees therefore stand under the keys.

The common list only changes the order, never the result, so it may be
approximate; its size is bounded by COMMON_MAX.

Defined results: texts without words (null, empty, white space) have an
empty set and their own component; fewer words than five are one shingle;
repeated rows get equal rows; a null id never names a component unless all
ids of it are null; an empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, read, slices, text_of

WORDS = 5
GROUPS = 64
#: the common shingles: listed in all, named by a task, texts of a task that make one; counters of a task
COMMON_MAX, COMMON_LOCAL, COMMON_LEAST, COUNTERS = 100_000, 30_000, 4, 1 << 24
CELL = 1024
#: a block of a component holds about this many classes and shingles; columns of one product
BLOCK_CLASSES, BLOCK_SHINGLES, COLUMNS = 512, 1 << 20, 4096
#: a cell of a component's links holds two blocks of this many classes, compared BLOCK_CLASSES by BLOCK_CLASSES
LINK_CLASSES = 4096
LEAF = 32
#: rows (cls, sid) of 24 bytes each
BROADCAST_ROWS = 250_000
#: pairs of points a search holds before it folds them
FOLD = 1 << 19
#: rows of a bucket of the search
BUCKET_ROWS = 20_000
BLOCK = 1 << 19

_rng = np.random.default_rng(20240131)
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE[65:91] = BYTE[97:123]  # A-Z as a-z
MULT = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(MULT), -1, 1 << 64))
PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), to be read only: up to two blocks of them are kept."""
    kept = _powers.get(int(base))
    if kept is None or len(kept) < n:
        kept = np.full(max(n, min(2 * n, 2 * BLOCK)), base, np.uint64)
        kept[:1] = 1
        kept = np.cumprod(kept, dtype=np.uint64)
        if len(kept) <= 2 * BLOCK:
            _powers[int(base)] = kept
    return kept[:n]


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, its first byte) of texts lying side by side in
    ``data``, beginning at ``bounds``. Blocks end at white space or between texts."""
    hashes, places, lo, n = [], [], 0, len(data)
    space = IS_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    while lo < n:
        hi = min(n, lo + BLOCK)
        if hi < n:
            ok = np.flatnonzero(space[hi:] | edge[hi:n])
            hi = hi + int(ok[0]) if len(ok) else n
        word = ~space[lo:hi]
        start = word.copy()
        start[1:] &= ~word[:-1] | edge[lo + 1:hi]
        s = np.flatnonzero(start)
        if len(s):
            run = np.concatenate([[np.uint64(0)], np.cumsum(np.where(word, BYTE[data[lo:hi]], np.uint64(0)) * powers(MULT, hi - lo), dtype=np.uint64)])
            e = np.append(s[1:], hi - lo)  # white space adds nothing to a word's sum
            hashes.append(mixed((run[e] - run[s]) * powers(INVERSE, hi - lo)[s]))
            places.append(s + lo)
        lo = hi
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def shingle_sets(texts: pa.Array):
    """The sorted distinct shingle hashes of each text."""
    texts = texts.cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if len(texts) == 0:
        return
    data = np.frombuffer(texts.buffers()[2], np.uint8)[at[0]:at[-1]] if at[-1] > at[0] else np.empty(0, np.uint8)
    at = at - at[0]
    words, places = word_hashes(data, at[:-1])
    first = np.searchsorted(places, at)
    whole = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for j in range(WORDS):
        whole += words[j:j + len(whole)] * PLACE[j]
    whole = mixed(whole)
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if b - a >= WORDS:
            yield np.unique(whole[a:b - WORDS + 1])
        elif b > a:
            yield mixed(np.array([(words[a:b] * PLACE[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64))
        else:
            yield np.empty(0, np.uint64)


def _arrow(schema: pa.Schema, rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _set_id(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def prefix_length(n: int) -> int:
    """n - ceil(3 n / 4) + 1: whoever shares 3/4 of n shingles shares one of these."""
    return n - -(-3 * n // 4) + 1


def over_texts(docs: DataFrame, rows_of, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``rows_of(ids, sets)`` gives the rows of a part of the documents."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    fields = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    arrow = pa.schema([(n, fields[t]) for n, t in (x.split() for x in schema.split(", "))])

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                yield _arrow(arrow, list(rows_of(part.column(0).to_pylist(), shingle_sets(part.column(1)))))

    return rows.mapInArrow(run, schema)


def _vector(s: np.ndarray) -> bytes:
    counts = np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=GROUPS)
    # one byte a group as long as the counts allow it
    return counts.astype(np.uint8 if counts.max() < 256 else np.int32).tobytes()


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n, sid, vec) of each document, and the sorted hashes of shingles met in many texts: each
    task names its most frequent ones, their counts are summed and the largest are kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sid", pa.binary()), ("vec", pa.binary()), ("key", pa.int64()), ("c", pa.int64())])

    def run(batches):
        # a counter stands for all shingles that fall on it, so a count may be too high, never too low
        counters, keys = np.zeros(COUNTERS, np.uint16), np.empty(0, np.uint64)
        slot = np.uint64(COUNTERS - 1)
        for batch in batches:
            for part in slices(batch, 1):
                sets = list(shingle_sets(part.column(1)))
                yield _arrow(schema, [(d, len(s), _set_id(s), _vector(s), None, None) for d, s in zip(part.column(0).to_pylist(), sets)])
                # copies of one set count once
                own = list({s.tobytes(): s for s in sets if len(s)}.values())
                if own:
                    k, c = np.unique(np.concatenate(own), return_counts=True)
                    at = k & slot
                    counters[at] = np.minimum(counters[at] + c, 60_000)
                    keys = np.union1d(keys, k[counters[at] >= COMMON_LEAST])
                    if len(keys) > 8 * COMMON_LOCAL:
                        keys = np.sort(keys[np.argpartition(counters[keys & slot], -4 * COMMON_LOCAL)[-4 * COMMON_LOCAL:]])
        counts = counters[keys & slot].astype(np.int64)
        stay = np.argsort(-counts, kind="stable")[:COMMON_LOCAL]
        yield _arrow(schema, [(None, None, None, None, k, c) for k, c in zip(keys[stay].view(np.int64).tolist(), counts[stay].tolist())])

    both = cut(rows.mapInArrow(run, "doc_id long, n long, sid binary, vec binary, key long, c long"))
    # at most COMMON_MAX of the highest counts, by steps of an eighth of a power of two: no task or driver sorts the candidates
    top = both.filter("sid is null").groupBy("key").agg(F.sum("c").alias("c")).withColumn("step", F.floor(F.log2("c") * 8))
    room, least = COMMON_MAX, None
    for r in top.groupBy("step").count().orderBy(F.desc("step")).collect():
        room -= r["count"]
        if room < 0:
            break
        least = r["step"]
    top = top.filter(F.col("step") >= F.lit(least))
    return (both.filter("sid is not null").select("doc_id", "n", "sid", "vec"),
            # one list of numbers: as many rows would hold 60 MB of the driver
            np.sort(np.array(top.agg(F.collect_list("key")).first()[0], np.int64).view(np.uint64)))


def full_sets(docs: DataFrame, need: DataFrame, **cols) -> DataFrame:
    """(cls, shingles) of the classes of ``need`` (cls, sid), one row each, written once."""
    need = cut(need)
    full = over_texts(docs, lambda ids, sets: ((_set_id(s), s.tobytes()) for s in sets if len(s)), "sid binary, shingles binary", **cols)
    small = need.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return cut(full.join(F.broadcast(need) if small else need, "sid").groupBy("cls").agg(F.first("shingles").alias("shingles")))


def _join_components(rows: list[tuple]) -> list[tuple[int, int]]:
    """Links that join the components of the classes of one group of (ba, bb, cls, comp, shingles)."""
    if len({r[3] for r in rows}) < 2:
        return []
    sets = [np.frombuffer(r[4], np.uint64) for r in rows]
    n = np.array([len(x) for x in sets], np.int64)
    ok = 7 * overlaps(sets, sets) >= 3 * (n[:, None] + n[None])
    label = np.unique([r[3] for r in rows], return_inverse=True)[1]
    out = []
    for i in range(len(rows)):
        near = np.flatnonzero(ok[i])
        found, first = np.unique(label[near], return_index=True)
        for other, j in zip(found.tolist(), near[first].tolist()):
            if other != label[i]:
                out.append((min(rows[i][2], rows[j][2]), max(rows[i][2], rows[j][2])))
                label[label == other] = label[i]
    return out


def spanning(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that join components, of all pairs of classes of each group (ba, bb) of ``rows`` (ba, bb, cls, comp)."""
    dealt = rows.join(sets, "cls").select("ba", "bb", "cls", "comp", "shingles").repartition("ba", "bb").sortWithinPartitions("ba", "bb")

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            for part in slices(batch, 4):
                out = []
                for r in zip(*[c.to_pylist() for c in part.columns]):
                    if held and held[0][:2] != r[:2]:
                        out += _join_components(held)
                        held.clear()
                    held.append(r)
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
        out = _join_components(held) if held else []
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return cut(dealt.mapInArrow(run, "a long, b long"))


def blocks_for(classes, shingles, most: int = BLOCK_CLASSES):
    """How many blocks a group of so many classes and shingles is dealt in."""
    return F.greatest(F.ceil(classes / most), F.ceil(shingles / BLOCK_SHINGLES)).cast("long")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(cls, comp): comp is the smallest class reachable over ``links`` (a, b).

    Each round takes the smallest label of all neighbours and then that
    label's own label, so paths shorten by half or more."""
    both = cut(links.union(links.select("b", "a")).toDF("cls", "other").distinct())
    labels = cut(both.select("cls").distinct().withColumn("comp", F.col("cls")))
    while True:
        near = both.join(labels.select(F.col("cls").alias("other"), F.col("comp").alias("c")), "other").groupBy("cls").agg(F.min("c").alias("c"))
        low = labels.join(near, "cls").select("cls", F.least("comp", "c").alias("comp"), F.col("comp").alias("old"))
        low = cut(low)
        up = low.select(F.col("cls").alias("comp"), F.col("comp").alias("up"))
        new = cut(low.join(up, "comp", "left").select("cls", F.least("comp", F.coalesce("up", "comp")).alias("comp"), "old"))
        if new.filter("comp < old").limit(1).count() == 0:
            break
        labels = new.select("cls", "comp")
    return nodes.join(labels.select("cls", F.col("comp").alias("c")), "cls", "left").select("cls", F.coalesce("c", "cls").alias("comp"))


class Tree:
    """An R-tree over count vectors, packed by size and then by counts."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, comps: np.ndarray):
        heavy = np.argsort(-points.var(axis=0), kind="stable")[:2]
        self.order = np.lexsort((points[:, heavy[1]], points[:, heavy[0]], (np.log(sizes) * 8).astype(int)))
        self.points, self.sizes, self.comps = points[self.order], sizes[self.order], comps[self.order]
        starts = np.arange(0, len(sizes), LEAF)
        level = (np.maximum.reduceat(self.points, starts), np.minimum.reduceat(self.sizes, starts), np.maximum.reduceat(self.sizes, starts),
                 np.minimum.reduceat(self.comps, starts), np.maximum.reduceat(self.comps, starts))
        self.levels = [level]
        while len(level[1]) > 1:
            s = np.arange(0, len(level[1]), 8)
            level = tuple(f.reduceat(x, s) for f, x in zip((np.maximum, np.minimum, np.maximum, np.minimum, np.maximum), level))
            self.levels.append(level)

    def _open(self, depth: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        top, least, most, c_low, c_high = self.levels[depth]
        stay = np.zeros(len(a), bool)
        for i in range(0, len(a), 4096):
            x, y = a[i:i + 4096], b[i:i + 4096]
            bound = np.minimum(top[x], top[y]).sum(axis=1, dtype=np.int64)
            one = (c_low[x] == c_high[x]) & (c_low[y] == c_high[y]) & (c_low[x] == c_low[y])
            stay[i:i + 4096] = (7 * bound >= 3 * (least[x] + least[y])) & (4 * most[x] >= 3 * least[y]) & (4 * most[y] >= 3 * least[x]) & ~one
        return a[stay], b[stay]

    def pairs(self):
        """Places (i, j) of points whose bound reaches the threshold, in different components."""
        depth = len(self.levels) - 1
        a = b = np.zeros(1, np.int64)
        while depth > 0:
            a, b = self._open(depth, a, b)
            depth -= 1
            n = len(self.levels[depth][1])
            kids = np.arange(8)
            x = (a[:, None] * 8 + kids).repeat(8, axis=1).ravel()
            y = np.tile(b[:, None] * 8 + kids, (1, 8)).ravel()
            ok = (x < n) & (y < n) & (x <= y)
            a, b = x[ok], y[ok]
        a, b = self._open(0, a, b)
        for x, y in zip(a.tolist(), b.tolist()):
            i, j = np.arange(x * LEAF, min((x + 1) * LEAF, len(self.sizes))), np.arange(y * LEAF, min((y + 1) * LEAF, len(self.sizes)))
            bound = np.minimum(self.points[i][:, None], self.points[j][None]).sum(axis=2, dtype=np.int64)
            ok = (7 * bound >= 3 * (self.sizes[i][:, None] + self.sizes[j][None])) & (self.comps[i][:, None] != self.comps[j][None])
            if x == y:
                ok &= i[:, None] < j[None]
            p, q = np.nonzero(ok)
            yield self.order[i[p]], self.order[j[q]]


def _fold(codes: np.ndarray, low: np.ndarray, high: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """One entry for each code: the lowest ``low``, the highest ``high``, the sum of ``count``."""
    if not len(codes):
        return codes, low, high, count
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[at], np.minimum.reduceat(low[order], at), np.maximum.reduceat(high[order], at), np.add.reduceat(count[order], at)


def _leaves(lo: np.ndarray, hi: np.ndarray, points: np.ndarray, size: np.ndarray, comp: np.ndarray):
    """Survivors (p, q) of the groups lo .. hi that are a leaf on their own: a tree without boxes, for many groups at once."""
    one = (hi - lo > 1) & (hi - lo <= LEAF)
    lo, hi = lo[one], hi[one]
    at = np.arange((hi - lo).sum()) + np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo)
    later = np.repeat(hi, hi - lo) - at - 1
    ends = np.cumsum(later)
    start = 0
    while start < len(at):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + (1 << 15), side="right")))
        p, times = at[start:stop], later[start:stop]
        first = np.cumsum(times) - times
        p = np.repeat(p, times)
        q = p + 1 + np.arange(len(p)) - np.repeat(first, times)
        ok = (comp[p] != comp[q]) & (4 * size[p] >= 3 * size[q]) & (4 * size[q] >= 3 * size[p])
        p, q = p[ok], q[ok]
        bound = np.minimum(points[p], points[q]).sum(axis=1, dtype=np.int64)
        ok = 7 * bound >= 3 * (size[p] + size[q])
        yield p[ok], q[ok]
        start = stop


def _search(table: pa.Table) -> pa.Table:
    """Survivors of one bucket of (key, cell) groups: for each pair of blocks the
    classes that have some, with the sizes of their partners and at how many keys."""
    key, cell = table["key"].to_numpy(), table["cell"].to_numpy()
    order = np.lexsort((cell, key))
    cls, comp, size, blk = (table[c].to_numpy()[order] for c in ("cls", "comp", "n", "blk"))
    points = np.vstack([np.frombuffer(x, np.uint8 if len(x) == GROUPS else np.int32).astype(np.int32)
                        for x in table["vec"].take(pa.array(order)).to_pylist()])
    key, cell, own, blocks = key[order], cell[order], table["own"].to_numpy()[order], table["blocks"].to_numpy()[order]
    classes, first, c = np.unique(cls, return_index=True, return_inverse=True)
    names, block = np.unique(blk, return_inverse=True)
    edges = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1]), [True]]))
    group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    weight = table["w"].to_numpy()[order][edges[:-1]]
    total = (np.empty(0, np.int64),) * 4

    def ends(held):
        """Both ends of survivors, folded; a group counts once for a class, with all its keys."""
        p, q = (np.concatenate(x) for x in zip(*held))
        pair = np.minimum(block[p], block[q]) * len(names) + np.maximum(block[p], block[q])
        codes = np.concatenate([pair * len(classes) + c[p], pair * len(classes) + c[q]])
        partner, met = np.concatenate([size[q], size[p]]), np.concatenate([group[p], group[p]])
        order = np.lexsort((met, codes))
        codes, partner, met = codes[order], partner[order], met[order]
        again = np.concatenate([[False], (codes[1:] == codes[:-1]) & (met[1:] == met[:-1])])
        return _fold(codes, partner, partner, np.where(again, 0, weight[met]))

    ct, beyond = table["ct"].to_numpy()[order], -(-3 * size // 4) - 1

    def counted_here(p, q):
        # the bound of ``reaches`` below, with all keys of a class; of the cells that two classes of a block share, one counts the pair
        near = 7 * (np.minimum(ct[p], ct[q]) + np.maximum(beyond[p], beyond[q])) >= 3 * (size[p] + size[q])
        return near & (np.minimum(own[p], own[q]) * blocks[p] + np.maximum(own[p], own[q]) == cell[p])

    held, n = [], 0
    # groups of one leaf are compared side by side
    for p, q in _leaves(edges[:-1], edges[1:], points, size, comp):
        mine = counted_here(p, q)
        if mine.any():
            held.append((p[mine], q[mine]))
            n += int(mine.sum())
        if n > FOLD:
            total = _fold(*(np.concatenate(x) for x in zip(total, ends(held))))
            held, n = [], 0
    large = np.flatnonzero(np.diff(edges) > LEAF)
    for lo, hi in zip(edges[large], edges[large + 1]):
        if (comp[lo:hi] != comp[lo]).any():
            for p, q in Tree(points[lo:hi], size[lo:hi], comp[lo:hi]).pairs():
                p, q = p + lo, q + lo
                mine = counted_here(p, q)
                if mine.any():
                    held.append((p[mine], q[mine]))
                    n += int(mine.sum())
                if n > FOLD:
                    total = _fold(*(np.concatenate(x) for x in zip(total, ends(held))))
                    held, n = [], 0
    if held:
        total = _fold(*(np.concatenate(x) for x in zip(total, ends(held))))
    codes, low, high, count = total
    pair, who = np.divmod(codes, len(classes))
    a, b = np.divmod(pair, len(names))
    columns = {"ba": names[a], "bb": names[b], "cls": classes[who], "comp": comp[first][who], "n": size[first][who],
               "low": low, "high": high, "c": count}
    return pa.table({k: pa.array(v, pa.int64()) for k, v in columns.items()})


def searched(members: DataFrame, labels: DataFrame, vectors: DataFrame, dealt: DataFrame) -> DataFrame:
    """(ba, bb, cls, comp): the classes that the trees leave over for each pair of blocks, from
    keys whose classes lie in several components. ``dealt`` (cls, blk) names each class's block."""
    rows = members.join(labels, "cls")
    # keys of the very same classes, such as those of one passage, are one key that counts so often
    same = [F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("y")]
    open_keys = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"),
                                         F.min("cls").alias("head"), *same).filter("lo < hi")
    open_keys = open_keys.groupBy("m", "x", "y").agg(F.min("key").alias("key"), F.count("*").alias("w"), F.first("head").alias("head"))
    # keys with one smallest class mostly hold the same classes: they share a bucket as far as they fit, and fold there
    fit = open_keys.groupBy("head").agg(F.ceil(F.sum(F.col("m") * F.ceil(F.col("m") / CELL)) / BUCKET_ROWS).alias("parts"))
    rows = cut(rows.join(open_keys.join(fit, "head").select("key", "m", "w", "head", "parts"), "key"))
    # cells of a common key: a class joins one row and one column of the triangle of blocks
    blocks = F.ceil(F.col("m") / CELL).cast("int")
    own = F.pmod(F.xxhash64("cls"), blocks).cast("int")
    cells = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.least(own, j) * blocks + F.greatest(own, j))
    # no pair shares more of these keys than either of its classes has
    most = rows.groupBy("cls").agg(F.sum("w").alias("ct"))
    rows = cut(rows.select("key", "head", "parts", "w", "cls", "comp", own.alias("own"), blocks.alias("blocks"), F.explode(cells).alias("cell"))
               .join(vectors.join(dealt, "cls").join(most, "cls"), "cls"))
    buckets = max(1, -(-rows.count() // BUCKET_ROWS))
    family = F.xxhash64("head", "cell", F.pmod(F.xxhash64("key"), F.col("parts")))
    rows = rows.withColumn("_b", F.pmod(family, F.lit(buckets))).drop("head", "parts")
    ends = rows.groupBy("_b").applyInArrow(_search, "ba long, bb long, cls long, comp long, n long, low long, high long, c long")
    ends = ends.groupBy("ba", "bb", "cls", "comp", "n").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("c").alias("c"))

    def reaches(m):
        # two classes share at most c shingles of one's prefix; beyond it that one has ceil(3 n / 4) - 1. As a
        # function of the partner's size the slack is largest at one end of the sizes
        return 7 * (F.col("c") + F.greatest("n", m) * 0.75 - 0.25) >= 3 * (F.col("n") + F.col(m))

    return ends.filter(reaches("low") | reaches("high")).select("ba", "bb", "cls", "comp")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``left`` shares with each of ``right``."""
    # shingles of one side, or of one set, only cannot be shared; a set's overlap with itself is not asked
    if left is right:
        both, times = np.unique(np.concatenate(left), return_counts=True)
        both = both[times > 1]
    else:
        both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float64)

    def places(sets):
        at = [np.searchsorted(both, s) for s in sets]
        hit = [p[(p < len(both)) & (both[np.minimum(p, len(both) - 1)] == s)] for p, s in zip(at, sets)]
        col = np.concatenate(hit)
        row = np.repeat(np.arange(len(sets)), [len(h) for h in hit])
        order = np.argsort(col, kind="stable")
        return row[order], col[order]

    if len(both):
        (ri, ci), (rj, cj) = places(left), places(right)
        # shingles of few sets are counted pair by pair, the others by products
        ti, tj = np.bincount(ci, minlength=len(both)), np.bincount(cj, minlength=len(both))
        few = 512 * ti * tj <= len(left) * len(right)
        flat = out.ravel()
        i, j = few[ci], few[cj]
        (pi, qi), pj = (ri[i], ci[i]), rj[j]
        begin = np.cumsum(np.where(few, tj, 0)) - np.where(few, tj, 0)
        for lo in range(0, len(pi), 1 << 16):
            p, q = pi[lo:lo + (1 << 16)], qi[lo:lo + (1 << 16)]
            times = tj[q]
            offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            np.add.at(flat, np.repeat(p, times) * len(right) + pj[np.repeat(begin[q], times) + offset], 1)
        name = np.cumsum(~few) - 1
        (ri, ci), (rj, cj) = (ri[~i], name[ci[~i]]), (rj[~j], name[cj[~j]])
        both = both[~few]
        for lo in range(0, len(both), COLUMNS):
            width = min(COLUMNS, len(both) - lo)
            x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
            for m, r, c in ((x, ri, ci), (y, rj, cj)):
                a, b = np.searchsorted(c, [lo, lo + width])
                m[r[a:b], c[a:b] - lo] = 1
            out += x @ y.T  # counts up to COLUMNS are exact in single precision
    return out


def _cell_links(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs of classes of one cell, each named in the one cell that counts it."""
    blocks, cell = rows[0][4], rows[0][1]
    i, j = divmod(cell, blocks)
    none = np.empty(0, np.int64)
    left, right = [r for r in rows if r[3] == i], [r for r in rows if r[3] == j]
    if not left or not right:
        return none, none
    found = [(none, none)]
    for x in range(0, len(left), BLOCK_CLASSES):
        for y in range(x if i == j else 0, len(right), BLOCK_CLASSES):
            found.append(_linked(left[x:x + BLOCK_CLASSES], right[y:y + BLOCK_CLASSES], i == j and x == y))
    a, b = (np.concatenate(x) for x in zip(*found))
    return np.minimum(a, b), np.maximum(a, b)


def _linked(left: list[tuple], right: list[tuple], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs of two blocks, or of one with itself."""
    a, b = (np.array([r[2] for r in side], np.int64) for side in (left, right))
    x = [np.frombuffer(r[5], np.uint64) for r in left]
    y = x if same else [np.frombuffer(r[5], np.uint64) for r in right]
    na, nb = (np.array([len(s) for s in side], np.int64) for side in (x, y))
    ok = 7 * overlaps(x, y) >= 3 * (na[:, None] + nb[None])
    if same:
        ok &= a[:, None] < b[None]
    p, q = np.nonzero(ok)
    return a[p], b[q]


def inside(found: DataFrame, sets: DataFrame, classes: DataFrame, pairs: bool = False) -> DataFrame:
    """All links of the components ``found`` (cls, comp): n_links of each linked
    class or, with ``pairs``, the links (a, b)."""
    sizes = found.join(classes.select("cls", "n"), "cls").groupBy("comp").agg(F.count("*").alias("m"), F.sum("n").alias("total")).filter("m > 1")
    blocks = blocks_for(F.col("m"), F.col("total"), LINK_CLASSES)
    need = found.join(sizes.select("comp", blocks.alias("blocks")), "comp")
    own = F.pmod(F.xxhash64("cls"), F.col("blocks"))
    # a pair of two blocks meets in their one cell, a pair of one block is counted in the block's own cell
    cells = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: F.least(F.col("own"), j) * F.col("blocks") + F.greatest(F.col("own"), j))
    rows = (sets.join(need.select("cls", "comp", "blocks", own.alias("own")), "cls")
            .select("comp", F.explode(cells).alias("cell"), "cls", "own", "blocks", "shingles")
            .repartition("comp", "cell").sortWithinPartitions("comp", "cell"))

    def run(batches):
        held: list[tuple] = []
        counts: dict[int, int] = {}

        def closed():
            a, b = _cell_links(held) if len(held) > 1 else (np.empty(0, np.int64),) * 2
            held.clear()
            if pairs:
                return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            c, n = np.unique(np.concatenate([a, b]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(c), pa.array(n.astype(np.int64))], names=["cls", "n"])

        for batch in batches:
            for part in slices(batch, 5):
                for r in zip(*[c.to_pylist() for c in part.columns]):
                    if held and held[0][:2] != r[:2]:
                        yield closed()
                    held.append(r)
        if held:
            yield closed()

    if pairs:
        return rows.mapInArrow(run, "a long, b long")
    return rows.mapInArrow(run, "cls long, n long").groupBy("cls").agg(F.sum("n").alias("n_links"))


def decide(docs: DataFrame, links: bool = True, **cols) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links, the classes that the row's class is linked to; one row
    per row of ``docs``. Without ``links`` only components are sought, and there is no n_links."""
    base, classes, found, sets = joined(docs, **cols)
    named = classes.join(found, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    if links:
        named = named.join(inside(found, sets, classes), "cls", "left")
    named = cut(named)
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    count = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if links else []
    per_class = named.join(least, "comp").select(F.col("sid").alias("_sid"), "component_id", *count)
    # an empty set is in no class
    return (base.join(per_class, F.col("sid") == F.col("_sid"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                    *count, F.col("sid").alias("_sid")))


def all_links(docs: DataFrame, **cols) -> DataFrame:
    """(a, b): every link between different texts, each text under the smallest identifier of its rows."""
    _, classes, found, sets = joined(docs, **cols)
    name = classes.select("cls", "rep")
    pairs = inside(found, sets, classes, pairs=True)
    return (pairs.join(name.toDF("a", "_a"), "a").join(name.toDF("b", "_b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))


def joined(docs: DataFrame, **cols) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows, classes, components, sets): rows have doc_id, n and sid, classes sid, rep, n and cls, components
    cls and comp, sets cls and shingles. Components are of the classes that share a key, sets of those
    that were verified with others."""
    base, late = described(docs, **cols)
    classes = cut(base.filter("n > 0").groupBy("sid").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.first("vec").alias("vec"))
                  .withColumn("cls", F.monotonically_increasing_id()))
    common = docs.sparkSession.sparkContext.broadcast(late)

    def prefixes(ids, sets):
        late = common.value
        for s in sets:
            if len(s):
                at = np.searchsorted(late, s)
                rank = (late[np.minimum(at, len(late) - 1)] == s) if len(late) else np.zeros(len(s), bool)
                k = prefix_length(len(s))
                yield _set_id(s), np.concatenate([s[~rank], s[rank]])[:k].view(np.int64)

    own = over_texts(docs, prefixes, "sid binary, prefix array<long>", **cols).groupBy("sid").agg(F.first("prefix").alias("prefix"))
    keys = own.join(classes.select("sid", "cls"), "sid").select("cls", F.explode("prefix").alias("key"))
    shared = keys.groupBy("key").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi")
    members = cut(keys.join(shared.select("key", "lo"), "key"))

    seeds = members.filter("cls <> lo").groupBy("cls", "lo").count().groupBy("cls").agg(
        F.max("count").alias("shared"), F.max_by("lo", F.struct("count", -F.col("lo"))).alias("lo"))
    # a seed is worth its verification if the two share a quarter of a prefix; other links are left to the trees
    seeds = cut(seeds.join(classes.select("cls", "n"), "cls").filter("16 * shared >= n").select("lo", "cls", "n"))
    nodes = cut(members.select("cls").distinct())

    # the partner stands in every block of its classes
    stars = seeds.groupBy("lo").agg(F.count("*").alias("m"), F.sum("n").alias("total"))
    stars = stars.select(F.col("lo").alias("ba"), blocks_for(F.col("m"), F.col("total")).alias("blocks"))
    ends = seeds.select(F.col("lo").alias("ba"), "cls").join(stars, "ba").select("ba", F.pmod(F.xxhash64("cls"), F.col("blocks")).alias("bb"), "cls")
    heads = stars.select("ba", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("bb"), F.col("ba").alias("cls"))
    met = cut(ends.union(heads))
    sets = full_sets(docs, met.select("cls").distinct().join(classes.select("cls", "sid"), "cls"), **cols)
    links = spanning(met.withColumn("comp", F.col("cls")), sets)
    labels = cut(components(nodes, links))

    # blocks of the search: classes that the seeds connect, verified or not
    near = cut(components(nodes, seeds.select(F.col("lo").alias("a"), F.col("cls").alias("b"))).join(classes.select("cls", "n"), "cls"))
    count = near.groupBy("comp").agg(F.count("*").alias("m"), F.sum("n").alias("total"))
    count = count.select("comp", blocks_for(F.col("m"), F.col("total")).alias("k"))
    dealt = near.join(count, "comp").select("cls", F.xxhash64("comp", F.pmod(F.xxhash64("cls"), F.col("k"))).alias("blk"))

    met = cut(searched(members.select("key", "cls"), labels, classes.select("cls", "n", "vec"), dealt))
    rest = met.select("cls").distinct().join(sets, "cls", "left_anti").join(classes.select("cls", "sid"), "cls")
    sets = sets.union(full_sets(docs, rest, **cols))
    found = cut(components(nodes, links.union(spanning(met, sets)).distinct()))
    return base, classes, found, sets


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row that names
    it, and every row without words. Rows that repeat the naming row's id and
    set are kept once."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    verdict = decide(docs, links=False, id_col=id_col, text_col=text_col)
    lost = verdict.filter("n_shingles > 0 and doc_id <> component_id").select("doc_id").distinct()
    # only ids of rows that go are looked up; documents of other ids pass through
    marked = docs.select(row, F.col(id_col).cast("long").alias("_k")).join(lost, F.col("_k") == lost["doc_id"], "left_anti")
    again = verdict.filter("n_shingles > 0 and doc_id = component_id").groupBy(F.col("doc_id").alias("_d")).count().filter("count > 1").select("_d")
    marked = cut_repeats(marked, again)
    return marked.select("_row.*")


def cut_repeats(rows: DataFrame, repeated_ids: DataFrame) -> DataFrame:
    """``rows`` (_row, _k) with one row for each id of ``repeated_ids``."""
    found = rows.join(repeated_ids, F.col("_k") == F.col("_d"), "left")
    return found.filter("_d is null").select("_row").unionByName(
        found.filter("_d is not null").groupBy("_k").agg(F.first("_row").alias("_row")).select("_row"))


def query(spark, sf_dir):
    return decide(read(spark, sf_dir, "documents")).drop("_sid")
