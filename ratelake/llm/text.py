"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Separators are ASCII, so words can be cut on bytes. A word's 64-bit hash is a
polynomial over its bytes, taken from running sums over the whole buffer and
mixed; no Python loop runs per word. Work goes on in slices of a few MB, so
memory follows the slice and the longest single text, not the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 4 << 20
#: Where nothing is summed over a slice, a small one does.
SMALL = 1 << 20
_SEGMENT = 1 << 17
_R = np.uint64(0x9E3779B97F4A7C55)
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_powers = {}

#: Byte tables: ASCII lower case; white space; anything but ASCII letters, digits and non-ASCII bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[0x00:0x30] = NOT_ALNUM[0x3A:0x61] = NOT_ALNUM[0x7B:0x80] = True


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "n" not in _powers or _powers["n"] < n:
        up, down = np.full(n, _R, np.uint64), np.full(n, _R_INV, np.uint64)
        up[0] = down[0] = 1
        _powers.update(n=n, up=np.cumprod(up), down=np.cumprod(down))
    return _powers["up"], _powers["down"]


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalising step of splitmix64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column (NULL: empty)."""
    if pa.types.is_null(column.type):
        column = column.cast(pa.large_string())
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``limit`` text bytes and ``rows`` rows at most (one row at least)."""
    column = batch.column(batch.schema.get_field_index(text))
    _, off = utf8(column)
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, i + rows)
        yield batch.slice(i, j - i)
        i = j


class Words:
    """Word borders of a string column; ``off[d]:off[d + 1]`` are document d's words."""

    def __init__(self, column: pa.Array, separators: np.ndarray = SPACE):
        data, offsets = utf8(column)
        self.data = LOWER[data]
        n = len(data)
        inside = ~separators[self.data]
        begin = np.empty(n, bool)
        if n:
            begin[0] = True
            np.logical_not(inside[:-1], out=begin[1:])
            begin[offsets[:-1][offsets[:-1] < n]] = True
            end = np.empty(n, bool)
            end[-1] = True
            end[:-1] = begin[1:] | ~inside[1:]
            self.starts = np.flatnonzero(inside & begin)
            self.ends = np.flatnonzero(inside & end) + 1
        else:
            self.starts = self.ends = np.zeros(0, np.int64)
        self.off = np.searchsorted(self.starts, offsets)
        self.n_docs = len(offsets) - 1

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), np.diff(self.off))

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        i = 0
        while i < len(self.starts):
            base = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.ends, base + _SEGMENT, "right")))
            part = self.data[base : self.ends[j - 1]]
            up, down = _power_tables(max(_SEGMENT, len(part) + 1))
            total = np.empty(len(part) + 1, np.uint64)
            total[0] = 0
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=total[1:])
            s, e = self.starts[i:j] - base, self.ends[i:j] - base
            out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
            i = j
        return mix64(out)


_Q = np.uint64(0xD6E8FEB86659FD93)


def shingles(words: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k`` consecutive words per document, and their offsets.

    A document of fewer words, but not none, gives its whole sequence as one.
    """
    counts = np.diff(off)
    n = len(words)
    full = np.zeros(max(n, 1), np.uint64)
    if n >= k:
        acc = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            acc = acc * _Q + words[j : n - k + 1 + j]
        full[: n - k + 1] = acc
    short = np.flatnonzero((counts > 0) & (counts < k))
    for d in short:
        acc = np.uint64(0)
        with np.errstate(over="ignore"):
            for w in words[off[d] : off[d + 1]]:
                acc = acc * _Q + w
        full[off[d]] = acc + np.uint64(counts[d])
    per = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    out_off = np.concatenate([[0], np.cumsum(per)])
    pos = np.arange(out_off[-1]) + np.repeat(off[:-1] - out_off[:-1], per)
    return mix64(full[pos]), out_off


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on (document borders not looked at)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc = acc * _Q + words[j : n + j]
    return mix64(acc)


def map_texts(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], text: str = "text", limit: int = SLICE):
    """A ``mapInArrow`` function that applies ``fn`` slice by slice."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, text, limit):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out

    return run
