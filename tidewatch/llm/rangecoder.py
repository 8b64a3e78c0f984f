"""Adaptive context-mixing range coder for blocks of token ids, many blocks in step.

Every block starts with an empty model and is decoded on its own.  For each id the model makes

* an order-2 guess (what followed the last two ids before) and an order-1 guess (what followed the
  last id), each with a confidence that grows with hits and falls with misses;
* an order-0 distribution over classes of ids, from counts that halve and are laid out anew every
  ``EPOCH`` ids.  Ids below ``SINGLE`` are classes of their own; above, ``2 ** GROUP_BITS`` neighbours share one
  and the rest of the id goes to a plain byte stream.

The chances of the guesses mix what their confidence promises with how well guesses of that order
have done in the block so far.  One interval of 2**24 (order-2 hit, order-1 hit or an order-0 class) is
coded for each id by a 48-bit range coder with 16-bit output words; a carry is settled at a block's end.  All
arithmetic is on integers, so any machine decodes what another one wrote.

A packed block: magic, number of ids, CRC-32 of the ids as little-endian unsigned 32-bit numbers,
numbers of words and plain bytes, the words (little-endian), the plain bytes.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK_IDS = 4096
EPOCH = 256
SINGLE, GROUP_BITS = 2048, 8
IDS = 1 << 16
CLASSES = SINGLE + ((IDS - SINGLE) >> GROUP_BITS)
SLOTS1, SLOTS2 = 1 << 11, 1 << 12
HEADER = struct.Struct("<4sIIII")
MAGIC = b"TWC1"
#: Chance in 4096ths that a guess of a confidence from 0 to 7 is right.
PROMISE = np.array([40, 700, 1300, 1900, 2500, 3000, 3400, 3700], np.int64)
_CLASS_OF = np.concatenate([np.arange(SINGLE), SINGLE + (np.arange(IDS - SINGLE) >> GROUP_BITS)]).astype(np.int64)
_GRAIN = 12                      # order-0 distributions have 2**12 parts
_SPARE = (1 << _GRAIN) - CLASSES  # every class has one part at least


class _Model:
    """The state of many blocks; lanes are rows."""

    def __init__(self, lanes: int):
        self.n = lanes
        self.lane = np.arange(lanes)
        self.one = np.zeros(lanes * SLOTS1, np.int32)       # id << 3 | confidence
        self.two = np.zeros(lanes * SLOTS2, np.int32)
        self.base1, self.base2 = self.lane * SLOTS1, self.lane * SLOTS2
        self.last = np.zeros(lanes, np.int64)
        self.rate1 = np.full(lanes, 400, np.int64)
        self.rate2 = np.full(lanes, 600, np.int64)
        self.count = np.zeros((lanes, CLASSES), np.int32)
        self.mix2 = self.lane * 0
        self.layout()

    def layout(self) -> None:
        """Parts of the order-0 distribution from the counts; counts halve."""
        total = np.maximum(self.count.sum(1, keepdims=True), 1)
        part = 1 + self.count * _SPARE // total
        part[:, 0] += (1 << _GRAIN) - part.sum(1)
        self.start = np.zeros((self.n, CLASSES + 1), np.int32)
        np.cumsum(part, axis=1, out=self.start[:, 1:])
        self.flat = self.start.ravel()
        self.row = self.lane * (CLASSES + 1)
        self.count -= self.count >> 1

    def guesses(self) -> None:
        self.at1 = self.base1 + (self.last * 0x9E35 >> 5 & SLOTS1 - 1)
        self.at2 = self.base2 + (self.mix2 & SLOTS2 - 1)
        g1, g2 = self.one[self.at1], self.two[self.at2]
        self.c1, self.c2 = g1 & 7, g2 & 7
        self.g1, self.g2 = g1 >> 3, g2 >> 3
        # at most 15/16 of the interval for the guesses together
        self.f2 = PROMISE[self.c2] * 3 + self.rate2 * 1 >> 2
        self.f2[self.c2 == 0] = 8
        free = 3840 - self.f2
        self.f1 = (free * (PROMISE[self.c1] * 3 + self.rate1) >> 14) + 4
        self.f1[self.g1 == self.g2] = 4

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        for table, at, guess, confidence in ((self.one, self.at1, self.g1, self.c1), (self.two, self.at2, self.g2, self.c2)):
            right = guess == ids
            new = np.where(right, np.minimum(confidence + 1, 7), confidence >> 1)
            table[at] = np.where(right | (confidence > 1), guess << 3, ids << 3 | 1) | np.where(right | (confidence > 1), new, 0)
        self.rate2 += np.where(hit2, 4095 - self.rate2, -self.rate2) >> 5
        self.rate1 += np.where(hit2, 0, np.where(hit1, 4095 - self.rate1, -self.rate1)) >> 5
        self.mix2 = self.last * 0x2F0B + ids * 0x6C8F >> 3
        self.last = ids


_TOP, _LOW = 32, (1 << 32) - 1


def encode(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(words, plain bytes) of each row of ``ids`` (lanes x length)."""
    lanes, length = ids.shape
    m = _Model(lanes)
    low = np.zeros(lanes, np.int64)
    span = np.full(lanes, 1 << 48, np.int64)
    out = np.zeros((lanes, 2 * length + 4), np.int32)   # words of 16 bits and a carry
    flat, used, base = out.ravel(), np.zeros(lanes, np.int64), np.arange(lanes) * out.shape[1]
    plain = [[] for _ in range(2)]
    columns = np.ascontiguousarray(ids.T)
    for t in range(length):
        if t % EPOCH == 0 and t:
            m.layout()
        x = columns[t].astype(np.int64)
        m.guesses()
        hit2 = m.g2 == x
        hit1 = ~hit2 & (m.g1 == x)
        missed = ~(hit2 | hit1)
        begin = np.where(hit2, 0, m.f2) << _GRAIN
        size = np.where(hit2, m.f2, m.f1) << _GRAIN
        e = np.flatnonzero(missed)
        if len(e):
            y = x[e]
            k = _CLASS_OF[y]
            rest = 4096 - m.f2[e] - m.f1[e]
            a = m.row[e] + k
            lo = m.flat[a].astype(np.int64)
            begin[e] = ((m.f2[e] + m.f1[e]) << _GRAIN) + lo * rest
            size[e] = (m.flat[a + 1] - lo) * rest
            m.count[e, k] += 32
            wide = y >= SINGLE
            plain[0].append(e[wide])
            plain[1].append(y[wide] - SINGLE & (1 << GROUP_BITS) - 1)
        unit = span >> 24
        low += begin * unit
        span = size * unit
        for _ in range(2):
            small = np.flatnonzero(span < 1 << _TOP)
            if not len(small):
                break
            flat[base[small] + used[small]] = low[small] >> _TOP
            used[small] += 1
            low[small] = (low[small] & _LOW) << 16
            span[small] <<= 16
        m.learn(x, hit2, hit1)
    for shift in (32, 16, 0):
        flat[base + used] = low >> shift if shift == 32 else low >> shift & 0xFFFF
        used += 1
    while (out >> 16).any():  # carries
        carry = out[:, 1:] >> 16
        out[:, 1:] &= 0xFFFF
        out[:, :-1] += carry
    who = np.concatenate(plain[0]) if plain[0] else np.zeros(0, np.int64)
    what = (np.concatenate(plain[1]) if plain[1] else np.zeros(0, np.int64)).astype(np.uint8)
    order = np.argsort(who, kind="stable")
    cut = np.searchsorted(who[order], np.arange(lanes + 1))
    what = what[order]
    return [(out[i, :used[i]].astype("<u2"), what[cut[i]:cut[i + 1]]) for i in range(lanes)]


def decode(blocks: list[tuple[np.ndarray, np.ndarray]], length: int) -> np.ndarray:
    """The ids (lanes x length) of blocks as ``encode`` made them."""
    lanes = len(blocks)
    m = _Model(lanes)
    sizes = np.array([len(w) for w, _ in blocks]) + 3
    words = np.zeros(int(sizes.sum()), np.int64)
    at = np.cumsum(sizes) - sizes
    plain_sizes = np.array([len(p) for _, p in blocks]) + 1
    plain = np.zeros(int(plain_sizes.sum()), np.int64)
    plain_at = np.cumsum(plain_sizes) - plain_sizes
    for i, (w, p) in enumerate(blocks):
        words[at[i]:at[i] + len(w)] = w
        plain[plain_at[i]:plain_at[i] + len(p)] = p
    code = words[at] << 32 | words[at + 1] << 16 | words[at + 2]
    at += 3
    span = np.full(lanes, 1 << 48, np.int64)
    out = np.zeros((length, lanes), np.uint16)
    for t in range(length):
        if t % EPOCH == 0 and t:
            m.layout()
        m.guesses()
        unit = span >> 24
        part = code // unit
        coarse = part >> _GRAIN
        both = m.f2 + m.f1
        hit2 = coarse < m.f2
        missed = coarse >= both
        hit1 = ~(hit2 | missed)
        x = np.where(hit2, m.g2, m.g1).astype(np.int64)
        begin = np.where(hit2, 0, m.f2) << _GRAIN
        size = np.where(hit2, m.f2, m.f1) << _GRAIN
        e = np.flatnonzero(missed)
        if len(e):
            rest = 4096 - both[e]
            first = both[e] << _GRAIN
            want = np.minimum((part[e] - first) // rest, (1 << _GRAIN) - 1)
            row = m.row[e]
            lo, hi = np.zeros(len(e), np.int64), np.full(len(e), CLASSES, np.int64)
            for _ in range(CLASSES.bit_length()):
                mid = lo + hi >> 1
                right = m.flat[row + mid] <= want
                lo, hi = np.where(right, mid, lo), np.where(right, hi, mid)
            k = lo
            begin_k = m.flat[row + k].astype(np.int64)
            begin[e] = first + begin_k * rest
            size[e] = (m.flat[row + k + 1] - begin_k) * rest
            m.count[e, k] += 32
            y = k.copy()
            wide = np.flatnonzero(k >= SINGLE)
            if len(wide):
                own = e[wide]
                y[wide] = SINGLE + ((k[wide] - SINGLE) << GROUP_BITS) + plain[plain_at[own]]
                plain_at[own] += 1
            x[e] = y
        code -= begin * unit
        span = size * unit
        for _ in range(2):
            small = np.flatnonzero(span < 1 << _TOP)
            if not len(small):
                break
            code[small] = code[small] << 16 | words[np.minimum(at[small], len(words) - 1)]
            at[small] += 1
            span[small] <<= 16
        m.learn(x, hit2, hit1)
        out[t] = x
    return out.T


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """Packed blocks of ``BLOCK_IDS`` ids each (the last one may have fewer)."""
    n = -(-len(ids) // BLOCK_IDS)
    if not n:
        return []
    if len(ids) and int(ids.max()) >= IDS:
        raise ValueError(f"ids must be below {IDS}")
    padded = np.zeros(n * BLOCK_IDS, np.uint32)
    padded[:len(ids)] = ids
    out = []
    for i, (words, plain) in enumerate(encode(padded.reshape(n, BLOCK_IDS))):
        own = padded[i * BLOCK_IDS:min((i + 1) * BLOCK_IDS, len(ids))].astype("<u4")
        out.append(HEADER.pack(MAGIC, len(own), zlib.crc32(own.tobytes()), len(words), len(plain)) + words.tobytes() + plain.tobytes())
    return out


def unpack_blocks(packed: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; a wrong checksum is an error."""
    heads, parts = [], []
    for raw in packed:
        magic, n, crc, n_words, n_plain = HEADER.unpack_from(raw)
        if magic != MAGIC or len(raw) != HEADER.size + 2 * n_words + n_plain:
            raise ValueError("not a block of token ids")
        heads.append((n, crc))
        parts.append((np.frombuffer(raw, "<u2", n_words, HEADER.size), np.frombuffer(raw, np.uint8, n_plain, HEADER.size + 2 * n_words)))
    if not packed:
        return []
    ids = decode(parts, BLOCK_IDS).astype("<u4")
    out = []
    for i, (n, crc) in enumerate(heads):
        own = np.ascontiguousarray(ids[i, :n])
        if zlib.crc32(own.tobytes()) != crc:
            raise ValueError("a block of token ids is damaged")
        out.append(own)
    return out
