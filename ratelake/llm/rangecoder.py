"""Adaptive context-mixing range coder for id sequences, in blocks.

A block is coded by itself: its model starts empty and a checksum closes it.
Inside a block the ids are dealt to lanes (consecutive stretches), and step
``t`` codes the t-th id of every lane at once with numpy. All lanes share one
model, which is updated after each step from what the step coded, so the
decoder can follow.

The model mixes three predictions of the next id:

* order 2: the id last confirmed after the two ids before (hashed table),
* order 1: the id last confirmed after the id before,
* order 0: adaptive frequencies of all ids.

``P(id) = w0 * P0(id) + w1 * [id = guess1] + w2 * [id = guess2]``; the weights
are learned per pair of confidences from how often each guess was right. The
mixture is turned into cumulative integer frequencies which drive a carry-free
range coder with 64-bit state and 16-bit output words.

Layout of a block: header (magic, version, alphabet, ids, lanes, lane lengths
in words), words of all lanes, CRC-32 of all that.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC, VERSION = b"CMRC", 1
_HEAD = struct.Struct("<4sIIQI")
MAX_LANES, LANE_IDS = 4096, 64
_CONF = 8
_T0, _TOT = 20, 28
_MIN_W = 1 << _T0  # keeps every id codable: order 0 holds 1/256 of the mixture at least
_HASH_BITS = 16
_BOT = np.uint64(1 << 36)
_16, _48, _28 = np.uint64(16), np.uint64(48), np.uint64(_TOT)


class _Model:
    """Shared state of one block; encoder and decoder drive it alike."""

    REFRESH = 16384

    def __init__(self, alphabet: int):
        self.m = alphabet
        self.count = np.ones(alphabet, np.int64)
        self.pending: list[np.ndarray] = []
        self.since = 0
        self.c1 = np.zeros(alphabet, np.int64)
        self.f1 = np.zeros(alphabet, np.int64)
        self.c2 = np.zeros(1 << _HASH_BITS, np.int64)
        self.f2 = np.zeros(1 << _HASH_BITS, np.int64)
        # Outcomes per state: neither guess, guess 1 only, guess 2.
        self.seen = np.ones((_CONF * _CONF * 2, 3))
        self._refresh()

    def _refresh(self) -> None:
        n = (self.count * ((1 << _T0) - self.m)) // self.count.sum() + 1
        self.cdf = np.empty(self.m + 1, np.int64)
        self.cdf[0] = 0
        np.cumsum(n, out=self.cdf[1:])
        # What rounding leaves over belongs to the last id.
        self.cdf[-1] = 1 << _T0

    def guess(self, p1: np.ndarray, p2: np.ndarray) -> None:
        """Guesses and weights for lanes with the ids before (p1, then p2)."""
        self.p1 = p1
        self.slot = ((p1 * 0x9E3779B1 + p2 * 0x85EBCA77) >> 8) & ((1 << _HASH_BITS) - 1)
        self.g1, self.g2 = self.c1.take(p1), self.c2.take(self.slot)
        self.k1, self.k2 = self.f1.take(p1), self.f2.take(self.slot)
        same = self.g1 == self.g2
        self.state = (self.k2 * _CONF + self.k1) * 2 + same
        share = self.seen / self.seen.sum(axis=1, keepdims=True)
        w = (share * ((1 << _TOT) - _MIN_W)).astype(np.int64)
        w1, w2 = w[:, 1].take(self.state), w[:, 2].take(self.state)
        w1[same] = 0
        self.w0 = (1 << _TOT) - w1 - w2
        swap = self.g1 < self.g2
        self.lo, self.hi = np.minimum(self.g1, self.g2), np.maximum(self.g1, self.g2)
        self.wl, self.wh = np.where(swap, w1, w2), np.where(swap, w2, w1)

    def base(self, ids: np.ndarray) -> np.ndarray:
        return (self.cdf.take(ids) * self.w0) >> _T0

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, end = self.base(ids), self.base(ids + 1)
        begin = start + self.wl * (ids > self.lo) + self.wh * (ids > self.hi)
        return begin, end - start + self.wl * (ids == self.lo) + self.wh * (ids == self.hi)

    def find(self, v: np.ndarray) -> np.ndarray:
        """The id whose interval holds ``v``."""
        lo_end = self.base(self.lo + 1) + self.wl
        is_lo = (v >= self.base(self.lo)) & (v < lo_end)
        x = v - self.wl * (v >= lo_end)
        hi_end = self.base(self.hi + 1) + self.wh
        past = v >= lo_end
        is_hi = past & (x >= self.base(self.hi)) & (x < hi_end)
        x = x - self.wh * (past & (x >= hi_end))
        y = (((x + 1) << _T0) - 1) // self.w0
        ids = np.searchsorted(self.cdf, y, "right") - 1
        return np.where(is_lo, self.lo, np.where(is_hi, self.hi, ids))

    def update(self, ids: np.ndarray) -> None:
        hit1, hit2 = ids == self.g1, ids == self.g2
        kind = np.where(hit2, 2, hit1.astype(np.int64))
        self.seen += np.bincount(self.state * 3 + kind, minlength=self.seen.size).reshape(self.seen.shape)
        if self.seen.max() > 1e6:
            self.seen = self.seen / 2 + 0.5
        self.c1[self.p1] = np.where(hit1 | (self.k1 > 0), self.g1, ids)
        self.f1[self.p1] = np.where(hit1, np.minimum(self.k1 + 1, _CONF - 1), self.k1 >> 1)
        self.c2[self.slot] = np.where(hit2 | (self.k2 > 0), self.g2, ids)
        self.f2[self.slot] = np.where(hit2, np.minimum(self.k2 + 1, _CONF - 1), self.k2 >> 1)
        self.pending.append(ids)
        self.since += len(ids)
        if self.since >= self.REFRESH or self.since * 4 >= self.count.sum() - self.m:
            self.count += 32 * np.bincount(np.concatenate(self.pending), minlength=self.m)
            self.pending, self.since = [], 0
            self._refresh()


def _shape(n: int) -> tuple[int, int]:
    """(lanes, ids of a lane)."""
    lanes = max(1, min(MAX_LANES, n // LANE_IDS))
    steps = -(-n // lanes) if n else 0
    return (-(-n // steps) if n else 1), steps


def _settle(low: np.ndarray, rng: np.ndarray):
    """Move settled words out of ``low`` and ``rng`` (in place): lanes and their words, until none is left.

    Only lanes that moved can have to move again.
    """
    move, lo, ra = None, low, rng
    while True:
        settled = ((lo ^ (lo + ra)) >> _48) == 0
        small = ra < _BOT
        hit = np.flatnonzero(settled | small)
        if not len(hit):
            return
        move = hit if move is None else move[hit]
        lo, ra = lo[hit], ra[hit]
        ra = np.where(settled[hit], ra, (~lo + np.uint64(1)) & (_BOT - np.uint64(1))) << _16
        word = (lo >> _48).astype(np.uint16)
        lo = lo << _16
        low[move], rng[move] = lo, ra
        yield move, word


def encode_block(ids: np.ndarray, alphabet: int) -> bytes:
    ids = np.asarray(ids, np.int64)
    n = len(ids)
    if n and (ids.min() < 0 or ids.max() >= alphabet):
        raise ValueError("an id is outside the alphabet")
    lanes, steps = _shape(n)
    model = _Model(alphabet)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0), np.uint64)
    at = np.arange(lanes) * steps
    p1 = p2 = np.zeros(lanes, np.int64)
    out_lane, out_word = [], []
    for t in range(steps):
        a = (n - 1 - t) // steps + 1  # lanes that have a t-th id come first
        x = ids[at[:a] + t]
        model.guess(p1[:a], p2[:a])
        cum, freq = model.interval(x)
        r = rng[:a] >> _28
        lo = low[:a] + r * cum.astype(np.uint64)
        ra = r * freq.astype(np.uint64)
        for move, word in _settle(lo, ra):
            out_lane.append(move)
            out_word.append(word)
        low[:a], rng[:a] = lo, ra
        model.update(x)
        p1, p2 = x, p1[:a]
    for k in range(4):
        out_lane.append(np.arange(lanes))
        out_word.append((low >> np.uint64(48 - 16 * k)).astype(np.uint16))
    lane, word = np.concatenate(out_lane), np.concatenate(out_word)
    order = np.argsort(lane.astype(np.uint16), kind="stable")  # MAX_LANES fit
    body = _HEAD.pack(MAGIC, VERSION, alphabet, n, lanes)
    body += np.bincount(lane, minlength=lanes).astype("<u4").tobytes() + word[order].astype("<u2").tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block; ValueError when it is damaged."""
    if len(block) < _HEAD.size + 4 or struct.unpack("<I", block[-4:])[0] != zlib.crc32(block[:-4]):
        raise ValueError("checksum of the block is wrong")
    magic, version, alphabet, n, lanes = _HEAD.unpack_from(block)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a block of this format")
    sizes = np.frombuffer(block, "<u4", lanes, _HEAD.size).astype(np.int64)
    words = np.frombuffer(block[:-4], "<u2", -1, _HEAD.size + 4 * lanes).astype(np.uint64)
    words = np.concatenate([words, np.zeros(8, np.uint64)])
    _, steps = _shape(n)
    out = np.empty(n, np.int64)
    model = _Model(alphabet)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0), np.uint64)
    ptr = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    code = np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = (code << _16) | words[ptr]
        ptr = ptr + 1
    at = np.arange(lanes) * steps
    p1 = p2 = np.zeros(lanes, np.int64)
    for t in range(steps):
        a = (n - 1 - t) // steps + 1
        model.guess(p1[:a], p2[:a])
        r = rng[:a] >> _28
        lo = low[:a]
        v = np.minimum((code[:a] - lo) // r, np.uint64((1 << _TOT) - 1)).astype(np.int64)
        x = model.find(v)
        cum, freq = model.interval(x)
        lo = lo + r * cum.astype(np.uint64)
        ra = r * freq.astype(np.uint64)
        for move, _ in _settle(lo, ra):
            at_word = ptr[move]
            code[move] = (code[move] << _16) | words[at_word]
            ptr[move] = at_word + 1
        low[:a], rng[:a] = lo, ra
        out[at[:a] + t] = x
        model.update(x)
        p1, p2 = x, p1[:a]
    return out
