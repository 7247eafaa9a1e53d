"""Words, shingles and their hashes, vectorised over Arrow text buffers.

All hashes are polynomials modulo 2**64 over a random odd base, finished with a
bit mixer: one prefix sum per buffer gives the hash of every word, a second one
over word hashes gives that of every run of k words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_U = np.uint64
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
PLAIN_WORD = ~SPACES
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
# Bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]: digits, a-z and everything outside ASCII.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x30:0x3A] = True
ALNUM_WORD[0x61:0x7B] = True
ALNUM_WORD[0x80:] = True


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, byte offsets) of runs of rows; a null is empty, a row is never cut.

    A batch of long texts is many times a chunk, so its bytes are used where they are; only one with nulls is copied.
    """
    texts = pc.fill_null(column, "") if column.null_count else column
    if not len(texts):
        return
    if texts.type not in (pa.string(), pa.large_string()):
        texts = texts.cast(pa.large_string())
    kind = np.dtype(np.int32 if texts.type == pa.string() else np.int64)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], kind, len(texts) + 1, texts.offset * kind.itemsize).astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def find_words(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each text the index of its first word (one entry more than texts)."""
    inside = word_byte[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    borders = offsets[offsets < len(data)]
    before[borders] = False
    borders = offsets[offsets > 0] - 1
    after[borders] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of each text joined by one space, and where each word now starts and ends."""
    keep = np.zeros(len(data) + 1, bool)
    mark = np.zeros(len(data) + 1, np.int8)
    mark[starts] += 1
    mark[ends] -= 1
    keep[:] = np.cumsum(mark) > 0
    last = np.zeros(len(ends), bool)
    last[first[1:][first[1:] > first[:-1]] - 1] = True
    out = np.append(data, np.uint8(0x20))
    gaps = ends[~last]
    out[gaps] = 0x20
    keep[gaps] = True
    where = np.cumsum(keep)
    return out[keep].tobytes(), where[starts] - 1, where[ends - 1]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class Hasher:
    """Hashes of words and of runs of words; equal seeds give equal hashes everywhere."""

    def __init__(self, seed: int = 1):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.table = rng.integers(0, 2**64, 256, dtype=_U)
        bases = [int(b) | 1 for b in rng.integers(0, 2**64, 2, dtype=_U)]
        self._bases = bases
        self._powers: list[tuple[np.ndarray, np.ndarray]] = [self._grown(b, 1 << 16) for b in bases]

    @staticmethod
    def _grown(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        up, down = np.full(n, base, _U), np.full(n, pow(base, -1, 2**64), _U)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)

    def _of(self, lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self._powers[lane][0]):
            self._powers[lane] = self._grown(self._bases[lane], 2 * n)
        up, down = self._powers[lane]
        return up[:n], down[:n]

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self._of(0, len(data) + 1)
        sums = np.zeros(len(data) + 1, _U)
        np.cumsum(self.table[data] * up[:-1], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])

    def runs(self, hashes: np.ndarray, k: int) -> np.ndarray:
        """At i the hash of the k word hashes from i on; empty if there are fewer."""
        n = len(hashes)
        if n < k:
            return np.zeros(0, _U)
        up, down = self._of(1, n + 1)
        sums = np.zeros(n + 1, _U)
        np.cumsum(hashes * up[:-1], out=sums[1:])
        return mix((sums[k:] - sums[:-k]) * down[:n - k + 1] + _U(k))


def run_starts(first: np.ndarray, k: int) -> np.ndarray:
    """True at each word index where a run of k words starts within one text; as long as :meth:`Hasher.runs`."""
    n = int(first[-1])
    if n < k:
        return np.zeros(0, bool)
    good = np.ones(n, bool)
    for back in range(1, k):
        at = first[1:] - back
        good[at[at >= first[:-1]]] = False
    return good[:n - k + 1]
