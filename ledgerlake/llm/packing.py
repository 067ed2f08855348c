"""Best-fit packing of token pieces under several capacities.

Documents are tokenized inside tasks; only those longer than a sequence are
cut. Each piece asks for a vector of tokens, one document slot and attention
cost (its length squared). A sequence offers a capacity for each, and a
piece goes to the open sequence that fits it in every dimension and is best
by one of two rules: the smallest weighted norm of what would stay free
("norm"), or the largest weighted dot product of demand and free capacity
("dot"). Pieces come longest first; without a fit a new sequence opens.

Pieces are dealt by hash to groups of about GROUP pieces, each packed by one
task, so a task's memory does not depend on the corpus, and the cost of
grouping is a few part-filled sequences per GROUP pieces.

Defined results: a null text is an empty one (its only id is END); a row
gives at least one piece; repeated rows give their pieces again; ties
between sequences go to the oldest; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, read, slices, text_of

MAX_TOKENS, MAX_DOCS, END = 4096, 4096, 1
MAX_COST = MAX_TOKENS * MAX_TOKENS
GROUP = 12_000
CACHE_WORDS = 600_000
#: Latin letters whose normal form and lower case are their own, then closing punctuation
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
WEIGHTS = (1.0, 0.01, 0.01)


class _Memo:
    """A worker's tokenizer and bounded memo of the words it has met.

    A run of unaccented or precomposed Latin letters, with closing
    punctuation or without, is split by the vocabulary into the letters and
    the punctuation; its lower case is that of each letter, so the merges
    can be asked for directly. Any other word takes the full tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self.words: dict[str, bytes] = {}  # ids as little-endian 32-bit numbers
        self.runs: dict[str, bytes] = {}

    def run(self, letters: str) -> bytes:
        ids = self.runs.get(letters)
        if ids is None:
            own = letters if letters.isascii() else letters.translate(self.bytes)
            ids = self.runs[letters] = array("I", [t.id for t in self.model.tokenize(own)]).tobytes()
        return ids

    def learn(self, new: list[str]) -> None:
        odd = []
        for w in new:
            if m := PLAIN.fullmatch(w):
                letters, marks = m.groups()
                ids = self.run(letters.lower())
                self.words[w] = ids + self.run(marks) if marks else ids
            else:
                odd.append(w)
        for w, e in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)):
            self.words[w] = array("I", e.ids).tobytes()
        if len(self.runs) > CACHE_WORDS:
            self.runs.clear()


def _memo(path: str) -> _Memo:
    name = "_word_ids_" + path
    if name not in sys.modules:
        holder = types.ModuleType(name)
        holder.memo = _Memo(path)
        sys.modules[name] = holder
    return sys.modules[name].memo


def encode_batch(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, one after another, offsets).

    The vocabulary's normaliser and splitter never join what white space
    parts, so a text's ids are those of its words in order; each distinct
    word is encoded once as long as the worker's memo holds it."""
    memo = _memo(path)
    lists = pc.split_pattern_regex(texts, "[\\x20\\x09-\\x0D]+")
    words = lists.flatten().dictionary_encode()
    distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
    if len(memo.words) > CACHE_WORDS:
        memo.words.clear()
    memo.learn([w for w in distinct if w not in memo.words])
    per_word = [memo.words[w] for w in distinct]
    size = np.fromiter(map(len, per_word), np.int64, len(per_word)) // 4
    flat = np.frombuffer(b"".join(per_word), "<u4")
    at = np.concatenate([[0], np.cumsum(size)])
    code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = size[code]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    take = np.repeat(at[code] - (ends - n), n) + np.arange(total)
    word_ends = np.concatenate([[0], ends])
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return flat[take], word_ends[offsets - offsets[0]]


def _pieces(batches, path: str, max_tokens: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end = np.array([END], "<u4")
    for batch in batches:
        for part in slices(batch, 1):
            ids, at = encode_batch(part.column(1), path)
            doc, piece, start, length, crc = [], [], [], [], []
            for i, d in enumerate(part.column(0).to_pylist()):
                own = np.concatenate([ids[at[i]:at[i + 1]], end])
                for k, s in enumerate(range(0, len(own), max_tokens)):
                    x = own[s:s + max_tokens]
                    doc.append(d), piece.append(k), start.append(s), length.append(len(x)), crc.append(zlib.crc32(x.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip((doc, piece, start, length, crc), schema)], schema=schema)


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           max_tokens: int = MAX_TOKENS) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(lambda b: _pieces(b, tokenizer_path, max_tokens),
                           "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, caps=(MAX_TOKENS, MAX_DOCS, MAX_COST), weights=WEIGHTS, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; ``lengths`` must come longest first."""
    caps = np.asarray(caps, float)
    w = np.asarray(weights, float)
    least = float(lengths.min()) if len(lengths) else 0.0
    # the open sequences: what is free in each dimension, and their numbers; closed ones are swept out now and then
    free = np.empty((3, max(1, len(lengths))))
    names = np.empty(max(1, len(lengths)), np.int64)
    bins, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = here = closed = 0
    for i, n in enumerate(lengths.tolist()):
        need = np.array([n, 1.0, float(n) * n])
        if (need > caps).any():
            raise ValueError(f"a piece of {n} tokens exceeds a sequence's capacity")
        fits = np.flatnonzero(free[0, :here] >= n)
        if len(fits):
            fits = fits[(free[1, fits] >= 1) & (free[2, fits] >= need[2])]
        if len(fits):
            left = free[:, fits]
            if rule == "norm":
                score = ((((left.T - need) / caps) ** 2) * w).sum(axis=1)
            else:
                score = -((left.T / caps) * (need / caps) * w).sum(axis=1)
            best = int(fits[np.argmin(score)])
        else:
            best, here = here, here + 1
            free[:, best], names[best], made = caps, made, made + 1
        bins[i], offset[i] = names[best], int(caps[0] - free[0, best])
        free[:, best] -= need
        if free[0, best] < least or free[1, best] < 1 or free[2, best] < least * least:  # nothing fits here any more
            free[0, best], closed = -1.0, closed + 1
            if closed > 64 and closed * 4 > here:
                stay = np.flatnonzero(free[0, :here] >= 0)
                free[:, :len(stay)], names[:len(stay)] = free[:, stay], names[stay]
                here, closed = len(stay), 0
    return bins, offset


def _pack_group(table: pa.Table, caps, weights, rule: str) -> pa.Table:
    order = pc.sort_indices(table, sort_keys=[("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
    table = table.take(order)
    bins, offset = best_fit(table["length"].to_numpy(), caps, weights, rule)
    first = (int(table["_group"][0].as_py()) << 32) if table.num_rows else 0
    return table.drop_columns(["_group"]).append_column("sequence_id", pa.array(bins + first, pa.int64())).append_column(
        "offset", pa.array(offset, pa.int64()))


def pack(cut_pieces: DataFrame, caps=(MAX_TOKENS, MAX_DOCS, MAX_COST), weights=WEIGHTS, rule: str = "norm", group: int = GROUP) -> DataFrame:
    """``cut_pieces`` (see ``pieces``) plus sequence_id and offset."""
    rows = cut(cut_pieces)
    groups = max(1, -(-rows.count() // group))
    # the row's own number keeps repeated rows apart
    salt = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups))
    return rows.withColumn("_group", salt).groupBy("_group").applyInArrow(
        lambda t: _pack_group(t, caps, weights, rule),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_docs(docs: DataFrame, tokenizer_path: str | None = None, **options) -> DataFrame:
    return pack(pieces(docs, tokenizer_path or tokenizer_file()), **options)


def query(spark, sf_dir):
    return pack_docs(read(spark, sf_dir, "documents"))
