"""Word n-grams of whole texts as 64-bit hashes, computed for many texts at once in numpy.

Words are runs of characters other than space, tab, line feed, form feed and carriage return, in lower case; a text with fewer than n words has one n-gram, all
its words; a text without words has none.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 12, 13, 32]] = True
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
WINDOW = 1 << 20
_powers = {"n": 0, "up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for name, b in (("up", _BASE), ("down", inverse)):
            f = np.full(n, b, np.uint64)
            f[0] = 1
            _powers[name] = np.multiply.accumulate(f)
        _powers["n"] = n
    return _powers["up"], _powers["down"]


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all the texts' words in a row, and how many each text has.

    The bytes are taken window by window, each ending at white space, so what is held beside them is bounded unless a single
    word is longer than a window.
    """
    enc = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    lens = np.fromiter(map(len, enc), np.int64, len(enc)) + 1
    buf = np.frombuffer(b" ".join(enc) + b" ", np.uint8)
    del enc
    hashes, firsts, lo = [], [], 0
    while lo < len(buf):
        hi = min(len(buf), lo + WINDOW)
        while hi < len(buf):
            at = np.flatnonzero(_SPACE[buf[max(lo, hi - 4096) : hi]])
            if len(at):
                hi = max(lo, hi - 4096) + int(at[-1]) + 1
                break
            hi = min(len(buf), hi + 4096)
        h, first = _window(buf[lo:hi])
        hashes.append(h)
        firsts.append(first + lo)
        lo = hi
    h, first = (np.concatenate(hashes), np.concatenate(firsts)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return h, np.diff(np.searchsorted(first, np.append(np.cumsum(lens) - lens, len(buf))))


def _window(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and beginnings of the words of bytes that end with white space."""
    up, down = _power_tables(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * up[: len(buf)], out=sums[1:])
    gap = np.concatenate([[True], _SPACE[buf]])
    first, end = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
    return _mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64)), first


def ngrams(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all the texts' n-grams in a row (with repeats), and how many each text has."""
    h, counts = words(texts)
    have = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    starts = np.cumsum(counts) - counts
    total = int(have.sum())
    at = np.arange(total) - np.repeat(np.cumsum(have) - have, have) + np.repeat(starts, have)
    out = np.zeros(total, np.uint64)
    size = np.repeat(np.minimum(counts, n), have)
    for k in range(n):
        inside = size > k
        w = h[np.minimum(at + k, max(len(h) - 1, 0))] if len(h) else np.zeros(total, np.uint64)
        out = np.where(inside, out * _U(_BASE) + w, out)
    return _mix(out + size.astype(np.uint64)), have


def sets(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct n-grams, sorted, in a row, and how many it has."""
    h, have = ngrams(texts, n)
    doc = np.repeat(np.arange(len(texts)), have)
    order = np.argsort(h)
    order = order[np.argsort(doc[order].astype(np.uint16), kind="stable")] if len(texts) <= 65536 else np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=len(texts))
