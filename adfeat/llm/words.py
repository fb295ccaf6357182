"""Words and shingles of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))

#: Bytes that end a word: space and tab to carriage return.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[32, 9, 10, 11, 12, 13]] = True

_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]  # A-Z hash as a-z

_BASE = _U(0x9E6C63D0876A9A35)
_INVERSE = _U(pow(0x9E6C63D0876A9A35, -1, 2**64))
#: Text hashed at a time; cut only where a word ends, so that a longer word is hashed whole.
_BLOCK = 1 << 18
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    key = str(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        x = np.full(max(n, 2 * _BLOCK), base, _U)
        x[0] = 1
        have = _powers[key] = np.multiply.accumulate(x)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, number of words before each row) of rows given as bytes and offsets.

    Words are runs of other bytes than SEPARATOR; they end with their row.  ``fold`` reads A-Z
    as a-z.  Equal words have equal hashes; different words do by chance of about 2**-64.
    """
    n = len(data)
    rows = len(offsets) - 1
    if not n:
        return np.zeros(0, _U), np.zeros(rows + 1, np.int64)
    inside = ~SEPARATOR[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    out = np.empty(len(starts), _U)
    table, i = (_FOLDED if fold else _BYTE), 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + _BLOCK, "right")))
        hi = ends[j - 1]
        sums = np.zeros(hi - lo + 1, _U)
        np.cumsum(table[data[lo:hi]] * _power(_BASE, hi - lo), out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * _power(_INVERSE, hi - lo)[s]
        i = j
    return mix(out), np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, at: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every ``width``-word shingle in order, shingles before each row).

    A row of fewer words (one at least) has one shingle, its whole sequence, which equals no
    shingle of another length; a row without words has none.
    """
    n = np.diff(at)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(int(bounds[-1]), _U)
    m = len(words) - width + 1
    if m > 0:
        h = np.zeros(m, _U)
        for k in range(width):
            h = h * _U(0x2545F4914F6CDD1D) + words[k : k + m]
        long = np.flatnonzero(n >= width)
        src = np.repeat(at[long] - bounds[long], count[long]) + _spans(bounds[long], count[long])
        dst = _spans(bounds[long], count[long])
        out[dst] = h[src]
    for r in np.flatnonzero((n > 0) & (n < width)):
        x = int(n[r])
        for w in words[at[r] : at[r + 1]].tolist():
            x = (x * 0x2545F4914F6CDD1D + w) % 2**64
        out[bounds[r]] = x
    return mix(out), bounds


def _spans(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... for count[i] numbers each, one after the other."""
    if not len(count):
        return np.zeros(0, np.int64)
    total = np.cumsum(count)
    return np.arange(total[-1]) - np.repeat(total - count, count) + np.repeat(start, count)
