"""Exact byte-level BPE over Arrow batches.

The vocabulary's splitter works left to right without look-behind, and looks
ahead only past white space. So a text may be parted wherever a splitter
piece surely ends, the parts encoded alone, and the ids joined:

* between ASCII letters (Latin-1 letters too), digits and marks;
* before white space that follows one of these;
* before the last character of a run of white space that precedes one of these;
* behind such a last character that is no blank.

The apostrophe parts from nothing but white space (contractions), nor does
any byte outside these classes. A part made of these classes alone is one
piece of the splitter, whose ids come straight from the merges; any other
takes the whole tokenizer. A worker remembers the parts it has met.
"""

from __future__ import annotations

import re
import sys
import types

import numpy as np
import pyarrow as pa

CACHE_PARTS, CACHE_BYTES = 700_000, 64 << 20
OTHER, BLANK, LETTER, DIGIT, MARK, QUOTE = range(6)
#: parts of one class, and so one piece of the splitter, but for the apostrophe and all else
PLAIN = re.compile(rb"(?:[\x09-\x0d\x20-\x26\x28-\x7e]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*")


def _classes() -> np.ndarray:
    c = np.zeros(256, np.uint8)
    c[33:127] = MARK
    c[9:14] = c[32] = BLANK
    c[48:58] = DIGIT
    c[65:91] = c[97:123] = LETTER
    c[39] = QUOTE
    return c


CLASS = _classes()


def part_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted places where the texts of ``data``, one after another at ``offsets``, may be parted."""
    n = len(data)
    kind = CLASS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) if n > 1 else np.empty(0, np.int64)
    if len(lead):
        after = data[lead + 1]
        lead = lead[(after >= 0x80) & (after < 0xC0) & (after != 0x97) & (after != 0xB7)]
        kind[lead] = kind[lead + 1] = LETTER
    cut = np.zeros(n + 1, bool)
    if n > 1:
        here, before = kind[1:], kind[:-1]
        blank, was_blank = here == BLANK, before == BLANK
        solid, was_solid = here > BLANK, before > BLANK
        cut[1:n] = blank & was_solid
        cut[1:n] |= solid & was_solid & (here != before) & (here != QUOTE) & (before != QUOTE)
        cut[1:n] |= solid & was_blank & (data[:-1] != 32)
        last = (blank & was_blank)[:-1] & solid[1:]
        begins = offsets[(offsets >= 2) & (offsets < n)]
        last[begins - 2] = False  # what follows is another text
        cut[1:n - 1] |= last
    cut[offsets] = True
    return np.flatnonzero(cut)


class Memo:
    """A worker's tokenizer and the ids of the parts it has met."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # the splitter's letter for each byte that plain parts hold
        self.letter = {b: level.pre_tokenize_str(chr(b))[0][0] for b in range(9, 127)}
        for b in range(0xC0, 0x100):
            two = level.pre_tokenize_str(chr(b))[0][0]
            self.letter[0xC3], self.letter[b - 0x40] = two[0], two[1]
        self.forget()

    def forget(self) -> None:
        self.at: dict[bytes, int] = {}
        self.size = np.empty(1 << 16, np.int64)
        self.start = np.empty(1 << 16, np.int64)
        self.ids = np.empty(1 << 18, np.uint32)
        self.n = self.filled = self.held = 0

    def learn(self, parts: list[bytes]) -> None:
        whole = PLAIN.fullmatch
        plain = [p for p in parts if whole(p)]
        known = [[t.id for t in self.model.tokenize(p.decode("latin-1").translate(self.letter))] for p in plain]
        if len(plain) < len(parts):
            odd = [p for p in parts if not whole(p)]
            known += [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in odd], add_special_tokens=False)]
            plain += odd
        sizes = np.fromiter(map(len, known), np.int64, len(known))
        total = int(sizes.sum())
        while self.n + len(known) > len(self.size):
            self.size, self.start = np.resize(self.size, 2 * len(self.size)), np.resize(self.start, 2 * len(self.start))
        while self.filled + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        new = slice(self.n, self.n + len(known))
        self.size[new] = sizes
        self.start[new] = self.filled + np.cumsum(sizes) - sizes
        self.ids[self.filled:self.filled + total] = np.fromiter((i for x in known for i in x), np.uint32, total)
        self.at.update(zip(plain, range(self.n, self.n + len(known))))
        self.n, self.filled = self.n + len(known), self.filled + total
        self.held += sum(map(len, plain)) + 4 * total

    def numbers(self, parts: list[bytes]) -> np.ndarray:
        if self.n > CACHE_PARTS or self.held > CACHE_BYTES:
            self.forget()
        new = [p for p in parts if p not in self.at]
        if new:
            self.learn(new)
        return np.fromiter(map(self.at.__getitem__, parts), np.int64, len(parts))


def memo(path: str) -> Memo:
    """The memo of this worker process for the vocabulary at ``path``."""
    name = "_byte_ids_" + path
    if name not in sys.modules:
        holder = types.ModuleType(name)
        holder.memo = Memo(path)
        sys.modules[name] = holder
    return sys.modules[name].memo


def encode(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, one after another, their offsets); a null text is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    ends = part_ends(data, offsets)
    parts = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])
    parts = parts.dictionary_encode()
    m = memo(path)
    number = m.numbers(parts.dictionary.to_numpy(zero_copy_only=False).tolist())[parts.indices.to_numpy()]
    n = m.size[number]
    filled = np.concatenate([[0], np.cumsum(n)])
    take = np.repeat(m.start[number] - filled[:-1], n)
    take += np.arange(len(take))
    return m.ids[take], filled[np.searchsorted(ends, offsets)]
