"""Static range asymmetric numeral system over blocks of token ids.

A segment is a run of ids with one frequency table that all its blocks
share. A block holds LANES interleaved coders: id j belongs to lane
j % lanes, and all lanes move in step. A coder's state x stays in
[2^31, 2^63); before an id of frequency f (of 2^PRECISION) is put in, a state
of f * 2^(63 - PRECISION) or more gives its low 32 bits away as a word.
Encoding runs from the last step to the first, so decoding runs forward.

Every CHECK steps a block keeps a checkpoint: the states of all lanes and
the number of words before it. A decoder may begin at any checkpoint, and
``decode`` takes all of a segment's checkpoints side by side, as lanes of
one array. It must end each on the states of the next checkpoint, and each
block's bytes must have their CRC-32; else ValueError.

Bytes of a segment (little endian): MAGIC; PRECISION, lanes, steps between
checkpoints, blocks, distinct ids, size of the table as uint32; the table,
deflated (differences of the ascending ids, frequencies); per block its
number of ids, words, checkpoints and CRC-32; the CRC-32 of all so far; then
the blocks, each its words before each checkpoint, its states, its words.
Ids are below MAX_ID.
"""

from __future__ import annotations

import zlib

import numpy as np

MAGIC = b"RANS0001"
PRECISION, LANES, CHECK, BLOCK, MAX_ID = 20, 256, 128, 1 << 16, 1 << 24
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)


def table(ids: np.ndarray, precision: int = PRECISION) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ids, frequencies that sum to 2^precision, 1 at least)."""
    n = np.bincount(ids)
    symbols = np.flatnonzero(n)
    n = n[symbols]
    total = 1 << precision
    if len(symbols) > total:
        raise ValueError(f"{len(symbols)} distinct ids do not fit a table of 2^{precision}")
    free = total - len(symbols)
    share = 1 + n * free // n.sum()
    share[np.argmax(share)] += total - share.sum()
    return symbols.astype(np.uint32), share.astype(np.uint32)


def _shape(n: int) -> tuple[int, int]:
    """(lanes, ids of a whole block) for a segment of ``n`` ids."""
    lanes = LANES if n >= 16 * LANES else max(1, n // 16)
    return lanes, BLOCK // LANES * lanes


def _put(places: np.ndarray, freq: np.ndarray, start: np.ndarray, precision: int):
    """Encode ``places`` (blocks, steps, lanes) of the table: states at the
    checkpoints (blocks, checks, lanes), words (blocks, steps, lanes) and which of them are given away."""
    blocks, steps, lanes = places.shape
    places = np.ascontiguousarray(places.transpose(1, 0, 2))
    room = np.uint64(63 - precision)
    f_all, c_all = freq.astype(np.uint64), start.astype(np.uint64)
    x = np.full((blocks, lanes), LOW)
    states = np.empty((-(-steps // CHECK), blocks, lanes), np.uint64)
    words = np.empty((steps, blocks, lanes), np.uint32)
    given = np.empty((steps, blocks, lanes), bool)
    for t in range(steps - 1, -1, -1):
        f = f_all.take(places[t])
        out = np.greater_equal(x, f << room, out=given[t])
        words[t] = x
        x >>= out * WORD
        whole = x // f
        x += whole * (np.uint64(1 << precision) - f)  # (whole << precision) + x - whole * f
        x += c_all.take(places[t])
        if t % CHECK == 0:
            states[t // CHECK] = x
    return states.transpose(1, 0, 2), words.transpose(1, 0, 2), given.transpose(1, 0, 2)


def encode(ids: np.ndarray) -> bytes:
    if len(ids) and int(ids.max()) >= MAX_ID:
        raise ValueError(f"ids must be below {MAX_ID}")
    symbols, freq = table(ids) if len(ids) else (np.empty(0, np.uint32), np.empty(0, np.uint32))
    start = np.cumsum(freq, dtype=np.int64) - freq
    lanes, size = _shape(len(ids))
    rank = np.zeros(int(symbols[-1]) + 1 if len(symbols) else 1, np.int32)
    rank[symbols] = np.arange(len(symbols))
    place = rank[ids]
    whole = len(ids) // size
    parts = [place[:whole * size].reshape(whole, size // lanes, lanes)] if whole else []
    if len(ids) > whole * size:  # the last block is filled up with the commonest id
        tail = place[whole * size:]
        tail = np.concatenate([tail, np.full(-len(tail) % lanes, int(np.argmax(freq)))])
        parts.append(tail.reshape(1, -1, lanes))
    heads, bodies = [], []
    for part in parts:
        states, words, given = _put(part, freq, start, PRECISION)
        for b in range(len(part)):
            own = words[b][given[b]]
            per_step = given[b].sum(axis=1)
            before = np.concatenate([[0], np.cumsum(per_step)])[:len(per_step):CHECK].astype("<u4")
            body = before.tobytes() + states[b].astype("<u8").tobytes() + own.astype("<u4").tobytes()
            n = min(size, len(ids) - len(heads) * size)
            heads.append((n, len(own), len(before), zlib.crc32(body)))
            bodies.append(body)
    packed = zlib.compress(np.diff(symbols, prepend=np.uint32(0)).astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 1)
    head = MAGIC + np.array([PRECISION, lanes, CHECK, len(heads), len(symbols), len(packed)], "<u4").tobytes()
    head += packed + np.array(heads, "<u4").tobytes()
    return b"".join([head, np.array([zlib.crc32(head)], "<u4").tobytes(), *bodies])


class Segment:
    """The header, table and block index of ``data``; blocks decode on request."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a segment of coded ids")
        self.data = data
        self.precision, self.lanes, self.check, blocks, distinct, packed = map(int, np.frombuffer(data, "<u4", 6, 8))
        at = 32 + packed + 16 * blocks
        if len(data) < at + 4 or zlib.crc32(memoryview(data)[:at]) != int.from_bytes(data[at:at + 4], "little"):
            raise ValueError("a segment's table and index do not have their checksum")
        self.index = np.frombuffer(data, "<u4", 4 * blocks, 32 + packed).reshape(blocks, 4).astype(np.int64)
        pairs = np.frombuffer(zlib.decompress(data[32:32 + packed]), "<u4").reshape(2, distinct)
        self.symbols, self.freq = np.cumsum(pairs[0], dtype=np.uint32), pairs[1]
        at += 4
        sizes = self.index[:, 2] * (4 + 8 * self.lanes) + 4 * self.index[:, 1]
        self.at = at + np.cumsum(sizes) - sizes
        self.sizes = sizes
        if int(sizes.sum()) + at != len(data):
            raise ValueError("a segment's blocks are cut")
        self.slots = np.repeat(np.arange(distinct, dtype=np.int32), self.freq)

    def _block(self, b: int):
        """Words before each checkpoint, states, words of block ``b``, its checksum verified."""
        at, size = int(self.at[b]), int(self.sizes[b])
        body = memoryview(self.data)[at:at + size]
        _, words, checks, crc = self.index[b]
        if zlib.crc32(body) != crc:
            raise ValueError(f"block {b} of a segment does not have its checksum")
        before = np.frombuffer(body, "<u4", checks).astype(np.int64)
        states = np.frombuffer(body, "<u8", checks * self.lanes, 4 * checks).reshape(checks, self.lanes)
        return before, states, np.frombuffer(body, "<u4", words, int(checks * (4 + 8 * self.lanes)))

    def decode(self, blocks=None, first_check: int = 0) -> np.ndarray:
        """The ids of ``blocks`` (all), each from its checkpoint ``first_check`` on."""
        blocks = range(len(self.index)) if blocks is None else blocks
        runs = []  # states, next states, first word, steps of each run between checkpoints
        streams, filled = [], 0
        for b in blocks:
            before, states, words = self._block(b)
            steps = -(-int(self.index[b, 0]) // self.lanes)
            ends = np.concatenate([states[1:], np.full((1, self.lanes), LOW)])
            for c in range(first_check, len(before)):
                runs.append((states[c], ends[c], filled + before[c], min(self.check, steps - c * self.check)))
            streams.append(words)
            filled += len(words)
        if not runs:
            return np.empty(0, np.uint32)
        order = sorted(range(len(runs)), key=lambda i: -runs[i][3])  # longest first: those that go on are a prefix
        x = np.array([runs[i][0] for i in order], np.uint64)
        goal = np.array([runs[i][1] for i in order], np.uint64)
        word_at = np.array([runs[i][2] for i in order], np.int64)
        steps = np.array([runs[i][3] for i in order])
        words = np.concatenate([*streams, np.zeros(1, np.uint32)]).astype(np.uint64)
        freq, start = self.freq.astype(np.uint64), (np.cumsum(self.freq, dtype=np.int64) - self.freq).astype(np.uint64)
        mask, p = np.uint64((1 << self.precision) - 1), np.uint64(self.precision)
        out = np.empty((int(steps[0]), len(runs), self.lanes), np.int32)
        go = len(runs) - np.searchsorted(steps[::-1], np.arange(int(steps[0])), side="right")  # runs with more than t steps
        for t, n in enumerate(go.tolist()):
            now = x[:n]
            slot = now & mask
            s = self.slots.take(slot)
            out[t, :n] = s
            now >>= p
            now *= freq.take(s)
            now += slot
            now -= start.take(s)
            lack, lane = np.nonzero(now < LOW)  # in lane order within a run, as the words lie
            before = np.searchsorted(lack, np.arange(n + 1))
            i = word_at[lack] + np.arange(len(lack)) - before[lack]
            if len(i) and i.max() >= filled:
                raise ValueError("a block's words end too early")
            now[lack, lane] = now[lack, lane] << WORD | words.take(i)
            word_at[:n] += np.diff(before)
        if (x != goal).any():
            raise ValueError("a run of a block does not end on its next checkpoint")
        back = np.argsort(order)
        ids = []
        at = 0
        for b in blocks:
            own = back[at:at + int(self.index[b, 2]) - first_check]
            at += len(own)
            got = np.concatenate([out[:steps[r], r].ravel() for r in own]) if len(own) else np.empty(0, np.int32)
            ids.append(got[:max(0, int(self.index[b, 0]) - first_check * self.check * self.lanes)])
        return self.symbols[np.concatenate(ids)]


def decode(data: bytes) -> np.ndarray:
    return Segment(data).decode()
